import datetime as dt

from orderlens.llm import urllists as u


def day(n, s=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, seconds=s)


def tables(spark, caps, log):
    return (spark.createDataFrame(caps, "page_id long, url string, fetched timestamp_ntz, blocked string"),
            spark.createDataFrame(log, "entry_id long, list_name string, domain string, action string, "
                                       "entry_time timestamp_ntz, host string"))


def brute(caps, log):
    import re
    out = []
    log = sorted((e for e in log if e[1] and e[2] and e[4]), key=lambda e: (e[4], e[0]))
    for page, url, at, _ in caps:
        m = re.match(u.HOST, url or "")
        name = m[1].lower() if m else ""
        best, n = None, 0
        if name and at:
            for key in {(e[1], e[2].lower()) for e in log}:
                last = [e for e in log if (e[1], e[2].lower()) == key and e[4] <= at]
                if last and last[-1][3] == "add" and (name == key[1] or name.endswith("." + key[1])):
                    n += 1
                    k = (-len(key[1]), key[0], key[1], last[-1][0])
                    best = k if best is None else min(best, k)
        out.append((page or -1, name, n > 0, n, best and best[1], best and best[2], best and best[3]))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    import random
    r = random.Random(4)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "x.org", "deep.x.org", "notx.org"]
    caps = [(i, f"https://{r.choice(hosts).upper() if i % 9 == 0 else r.choice(hosts)}/p/{i}?q", day(r.randrange(400), r.randrange(3)), None)
            for i in range(300)]
    caps += [(1000, None, day(3), None), (1001, "no url", day(3), None), (1002, "http://x.org", None, None),
             (1003, "http://user@x.org:80/", day(50), None), (None, "http://x.org/", day(50), None), (1004, "http://./", day(9), None)]
    log = [(i, r.choice(["spam", "adult"]), r.choice([*hosts, "com", "X.ORG"]), r.choice(["add", "remove"]),
            day(r.randrange(400), r.randrange(2)), None) for i in range(120)]
    log += [(500, None, "x.org", "add", day(0), None), (501, "spam", None, "add", day(0), None),
            (502, "spam", "x.org", "add", None, None), (503, "spam", "b.example.com", "add", day(5), None),
            (504, "spam", "b.example.com", "remove", day(5), None), (505, "old", "org", "add", dt.datetime(2015, 3, 1), None)]
    got = [(x["page_id"] or -1, x["host"], x["blocked"], x["n_entries"], x["list"], x["domain"], x["entry_id"])
           for x in u.judge(*tables(spark, caps, log)).collect()]
    assert sorted(got, key=str) == brute(caps, log)


def test_an_entry_holds_from_its_time_until_the_next(spark):
    log = [(1, "l", "h.com", "add", day(10), None), (2, "l", "h.com", "remove", day(20), None)]
    caps = [(n, "http://h.com/", day(n), None) for n in (9, 10, 19, 20)]
    got = {x["page_id"]: (x["blocked"], x["valid_to"]) for x in u.judge(*tables(spark, caps, log)).collect()}
    assert got == {9: (False, None), 10: (True, day(20)), 19: (True, day(20)), 20: (False, None)}


def test_empty_tables(spark):
    assert u.judge(*tables(spark, [], [(1, "l", "h.com", "add", day(1), None)])).collect() == []
    assert [r["blocked"] for r in u.judge(*tables(spark, [(1, "http://h.com", day(2), None)], [])).collect()] == [False]
