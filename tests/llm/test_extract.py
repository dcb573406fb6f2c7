import numpy as np

from orderlens.llm import dom, extract as x

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href=/>Home</a></li><li><a href=/a>More</a></li></ul></nav><div class="ad">Buy {i} now</div>
<article><h1>Title &amp; number {i}</h1><p>First   paragraph of page {i},\n with <b>bold</b> words and an end.
<p>Second&nbsp;one, a longer piece of text. It goes on for a while, as articles do, and ends here.</p>{more}</article>
<footer>&copy; Site {i}</footer></body></html>"""


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_articles_are_found_and_everything_else_is_left_out(spark):
    more = ['', '<aside class="sidebar"><p>Read also this other page</p></aside>',
            '<div class="comments"><p>Nice page, thanks a lot</p></div>', '<form><p>Your mail</p><input></form>']
    rows = [(i, f"http://h/{i}", PAGE.format(i=i, more=more[i % 4]), "clash") for i in range(60)]
    got = {r["page_id"]: r for r in x.extract(pages_of(spark, rows)).collect()}
    for i in range(60):
        want = (f"Title & number {i}\n\nFirst paragraph of page {i}, with bold words and an end.\n\nSecond one, a longer "
                "piece of text. It goes on for a while, as articles do, and ends here.")
        assert got[i]["text"] == want and got[i]["n_chars"] == len(want)


def test_odd_pages(spark):
    rows = [(i, f"u{i}", PAGE.format(i=i, more=""), None) for i in range(20)]
    rows += [(100, None, None, None), (101, "u", "", None), (102, "u", "<p", None), (103, "u", "</div></p><b>", None),
             (104, "u", "<script>only", None), (105, "u", "<div>" * 3000 + "deep" + "</div>" * 10, None),
             (None, "u", PAGE.format(i=7, more=""), None), (3, "u3", PAGE.format(i=3, more=""), None),
             (106, "u", "<article>" + "<p>Long text, with a stop. </p>" * 5000 + "</article>", None)]
    out = x.extract(pages_of(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {r["page_id"]: r["text"] for r in out}
    assert [got[k] for k in (100, 101, 103, 104)] == [""] * 4
    assert got[None].startswith("Title & number 7")
    assert got[106].count("Long text") == 5000
    assert x.extract(pages_of(spark, [])).collect() == []


def test_blocks_and_references():
    nodes = dom.parse("<p>a<br>b &lt;c&gt; &#233;&eacute;<p>x <i>y</i>\n\tz<ul><li>1<li>2</ul>tail<!-- <p>no</p> -->")
    assert x.main_text(nodes, np.ones(len(nodes), bool)) == "a b <c> éé\n\nx y z\n\n1\n\n2\n\ntail"


def test_raw_elements_end_at_their_own_closing_tag():
    raw = ["<script>for(i=0;i<n;i++){}</script>", "<SCRIPT type='a'>if(a<b)c='<p>\"</p>'</Script >", "<style>a<b{}</style>",
           "<script>x<arr.length;'</scripts>'\n</script\n>", "<textarea>i<n and <p>it's</textarea>", "<title>a <b</title>",
           "<script><!-- if(i<n) x='</p>' //--></script>", "<svg><path d='m'/><text>a<b</text></svg>", "<script>i<n</script/>",
           "<noscript><img src=a></noscript>", "<iframe>a<b</iframe>", "<button>a<b</button>", "<select><option>a<b</select>",
           "<template><p>a<b</template>"]
    for x_ in [*raw, "".join(raw)]:
        nodes = dom.parse(f"<div>Before</div>{x_}<p>Article <b>text</b></p>{x_}<p>Last</p>")
        assert x.main_text(nodes, np.ones(len(nodes), bool)) == "Before\n\nArticle text\n\nLast", x_
    for open_end in ("<script>i<n", "<style>a<b{}</styles>", "<textarea>a</textarea"):
        nodes = dom.parse("<p>Before</p>" + open_end)
        assert x.main_text(nodes, np.ones(len(nodes), bool)) == "Before"


def text_of(page):
    nodes = dom.parse(page)
    return x.main_text(nodes, np.ones(len(nodes), bool))


def test_attributes_follow_the_states_of_the_standard():
    assert text_of("<p>One</p><p class=it's>Article</p><p>Don't stop</p><p>Last</p>") == "One\n\nArticle\n\nDon't stop\n\nLast"
    for tag in ('<img alt="5" tall">', "<a href='x' title=\"it\"s\">", '<b title="a>b">', "<b x='>'y=\">\">", "<b a=b'c\"d>",
                "<b =x>", '<b "x">', "<b a= b c =d e = f>", "<b/ x/y = 'z>'/>", "<b a=>", "<b\nclass\n=\n'q>'>", "<!-->", "<!--->",
                "<!--x--!>", "<?xml a>", "</ x>", "<!doctype x>", "<B A='\n>\n'>"):
        assert text_of(f"<p>before {tag}after</p><p>next</p>").replace("  ", " ") == "before after\n\nnext", tag
    assert text_of("<p>a < b, 1<2 and <3</p>") == "a < b, 1<2 and <3"
    nodes = dom.parse('<div CLASS=side-bar ID="mainNav" data-class="article" role=\'search\' title=class=post>x</div>')
    assert nodes[1].tokens == {"side", "bar", "main", "nav", "search"}


def test_an_open_quote_takes_the_rest_and_is_read_once():
    import time
    assert text_of("<p>a</p><a href='x>b</a><p>c</p>") == "a"
    t = time.time()
    text_of("<p>a</p>" + "<a href='x\" y=\"" * 40_000)
    text_of("<" * 100_000 + "<a " * 50_000)
    assert time.time() - t < 20


def test_siblings_count_the_same_on_long_pages():
    kinds = []
    for n in (150, 250):
        nodes = dom.parse("<div><h2>t</h2>" + "<p>text</p>" * n + "</div>")
        f = dom.features(nodes)
        kinds.append([f[2][2 * len(dom.KINDS) + 7] * (n + 1), f[3][2 * len(dom.KINDS) + 7] * (n + 1)])
    assert np.allclose(kinds, [[1, 150], [1, 250]])


def test_a_long_article_keeps_every_paragraph(spark):
    parts = [f"<p>Paragraph {k}, with a few more words of the text. And an end.</p>" for k in range(300)]
    heads = [f"<h2>Part {k}</h2>" if k % 30 == 0 else "" for k in range(300)]
    rows = [(i, f"http://h/{i}", PAGE.format(i=i, more=""), None) for i in range(40)]
    rows.append((99, "u", PAGE.format(i=99, more="".join(h + p for h, p in zip(heads, parts, strict=True))), None))
    text = {r["page_id"]: r["text"] for r in x.extract(pages_of(spark, rows)).collect()}[99]
    want = [w for h, p in zip(heads, parts, strict=True) for w in (h[4:-5], p[3:-4]) if w]
    assert text.split("\n\n")[3:] == want


def test_only_pages_that_tell_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(x, "SAMPLE", 20)
    plain = "<body><div><p>Just {i}</p></div></body>"
    rows = [(i, f"http://p/{i}", plain.format(i=i), None) for i in range(300)]
    rows += [(1000 + i, f"http://h/{i}", PAGE.format(i=i, more=""), None) for i in range(20)]
    got = {r["page_id"]: r["text"] for r in x.extract(pages_of(spark, rows)).collect()}
    assert all(got[1000 + i].startswith(f"Title & number {i}\n\nFirst") and "Home" not in got[1000 + i] for i in range(20))


def test_a_table_without_article_or_main_loses_its_menus(spark):
    page = PAGE.replace("<article>", '<div class="post-content">').replace("</article>", "</div>")
    bare = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    for shape in (page, bare):
        rows = [(i, f"http://h/{i}", shape.format(i=i, more="<p>More text of it, and so on.</p>"), None) for i in range(60)]
        got = {r["page_id"]: r["text"] for r in x.extract(pages_of(spark, rows)).collect()}
        for i in range(60):
            assert got[i].startswith(f"Title & number {i}\n\nFirst paragraph") and got[i].endswith("and so on."), got[i]
            assert not any(w in got[i] for w in ("Home", "Buy", "Site"))


def test_script_with_a_comparison_leaves_the_article(spark):
    page = PAGE.replace('var a="</p>";', "for(i=0;i<n;i++){{}}")
    rows = [(i, f"http://h/{i}", (page if i % 2 else PAGE).format(i=i, more=""), None) for i in range(40)]
    got = {r["page_id"]: r["text"] for r in x.extract(pages_of(spark, rows)).collect()}
    assert all(got[i].startswith(f"Title & number {i}\n\nFirst paragraph of page {i},") for i in range(40))


def test_decoding_is_consistent_and_best():
    import itertools
    r = np.random.default_rng(3)
    for _ in range(60):
        nodes = [dom.Node("html", frozenset(), None)]
        for _ in range(r.integers(1, 8)):
            nodes.append(dom.Node("p", frozenset(), nodes[r.integers(len(nodes))]))
        nodes = _page_order(nodes[0])
        for i, v in enumerate(nodes):
            v.runs = [(i, "x" * int(r.integers(0, 50)))]
        odds = r.normal(size=len(nodes)) * 2
        gain = np.array([0.2 + np.log1p(len(v.runs[0][1])) for v in nodes]) * odds
        place = {id(v): i for i, v in enumerate(nodes)}

        def value(keep):
            ok = keep[0] and all(keep[place[id(v.parent)]] or not keep[i] for i, v in enumerate(nodes) if v.parent)
            return np.where(keep, gain, -gain).sum() if ok else -np.inf

        best = max(value(np.array(k)) for k in itertools.product([True, False], repeat=len(nodes)))
        assert np.isclose(value(x.decode(nodes, odds)), best)


def _page_order(root):
    out = [root]
    for child in root.children:
        out += _page_order(child)
    return out


def test_trees_learn_an_interaction():
    r = np.random.default_rng(0)
    data = r.normal(size=(2000, 5)).astype(np.float32)
    y = ((data[:, 0] > 0) ^ (data[:, 3] > 0.5)).astype(float)
    model = x.Trees(data[:1500], y[:1500], np.ones(1500))
    assert ((model.predict(data[1500:]) > 0) == y[1500:]).mean() > 0.95
