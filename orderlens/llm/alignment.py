"""Alignment of two tokenizers' tokens by their byte ends, with corpus-wide link counts.

A document's text is encoded by both tokenizers; each side is a list of byte offsets at which its
tokens end. The shorter list drives a galloping search into the longer: each end starts at the
place that its share of the list suggests, doubles its step until it has passed the wanted offset,
and bisects the bracket. All ends of an Arrow batch are searched at once: the documents' offsets are
laid end to end, so one sorted list of all of them serves. Offsets found in both lists cut the
tokens into groups; the difference of neighbouring ranks is the range of tokens that one token
overlaps, and each token is linked with its whole range (links="overlap"), or with all tokens of the
other side in its group (links="group"). In a long group, a stretch without common ends, each id is
paired once and its occurrences are multiplied, so no list of all its token pairs is made.

A single space between two characters that are no space starts a token on both sides (the byte-level
side's splitting pattern gives it to what follows, and no piece has a space behind another
character), so such a text is encoded word by word and a worker keeps the ids of the words it has
met; new words are encoded many at a time. Other texts are encoded as they are.

A pair's count is the number of documents that hold it linked. Each document's distinct pairs, with
how often they occur in it, are written once; Spark counts the pairs (partially aggregated before
the shuffle), and the counts meet the stored pairs in blocks of at most BLOCK pairs, a hash range
of the pairs each: as many passes over the stored pairs as there are blocks, one while the pairs fit
in one. A block is what is sent to the workers, so its size is bounded whatever the corpus holds.

Defined cases: texts null, empty, or whose joined tokens differ from the space and the text (on
either side) have no tokens: zeros, and the digest of groups is ''; ties for an A id's highest count
are all best; a repeated row counts as a document of its own; rows without doc_id are answered with
a null doc_id; a very long text is encoded whole; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c

WORD_CACHE = 400_000  # words whose ids a worker keeps
BLOCK = 2_000_000  # pairs whose counts are sent to the workers at once
LONG = 4096  # token pairs of a group from which its ids are paired in place of its tokens
_ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<long>, times array<long>")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """Ids and token bytes of a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # byte-level symbols: printable Latin-1 stands for itself, the rest follows from U+0100 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        of = {chr(b): b for b in plain} | {chr(256 + x): b for x, b in enumerate(other)}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(of[ch] for ch in token) if all(ch in of for ch in token) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Ids and token bytes of a piece vocabulary file; it adds the space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(m.id_to_piece(i)[3:-1], 16)]) if m.is_byte(i)
                      else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Words:
    """Ids of texts as little-endian 32-bit numbers, None where the tokens do not join to the space
    and the text. Words are encoded once while they are kept."""

    def __init__(self, side: ByteLevel | Pieces) -> None:
        self.side = side
        self.size = np.array([len(x) for x in side.bytes])
        # no token goes on from a character that is no space into a space
        self.apart = not any(re.search(r"\S ", x.decode("utf-8", "replace")) for x in side.bytes)
        self.known: dict[str, bytes | None | bool] = {}  # False: the spaces beside it need not start a token

    def _whole(self, text: str) -> bytes | None:
        ids = self.side.encode([text])[0]
        same = b"".join([self.side.bytes[x] for x in ids]) == b" " + text.encode()
        return np.array(ids, "<i4").tobytes() if same else None

    def _learn(self, words: set[str]) -> None:
        unsure = [w for w in words if not w or w[0].isspace() or w[-1].isspace()]
        self.known |= dict.fromkeys(unsure, False)
        words = list(words.difference(unsure))
        groups = [words[i:i + 500] for i in range(0, len(words), 500)]
        joined = [" ".join(g) for g in groups]
        for group, text, found in zip(groups, joined, self.side.encode(joined), strict=True):
            ids = np.array(found, "<i4")
            ends = np.cumsum(self.size[ids])
            cuts = np.cumsum([len(w.encode()) + 1 for w in group])
            at = np.searchsorted(ends, cuts)
            if (b"".join([self.side.bytes[x] for x in found]) == b" " + text.encode()
                    and (ends[np.minimum(at, len(ends) - 1)] == cuts).all()):
                raw, a = ids.tobytes(), 0
                for word, b in zip(group, (4 * (at + 1)).tolist(), strict=True):
                    self.known[word] = raw[a:b]
                    a = b
            else:  # a word whose tokens do not join to it
                self.known |= {w: self._whole(w) for w in group}

    def ids(self, texts: list[str]) -> list[bytes | None]:
        if not self.apart:
            return [self._whole(t) for t in texts]
        split = [t.split(" ") for t in texts]
        words = set().union(*split)
        if len(self.known) > WORD_CACHE:  # what is in use now stays
            self.known = {w: self.known[w] for w in words & self.known.keys()}
        self._learn(words - self.known.keys())
        get, out = self.known.__getitem__, []
        for t, own in zip(texts, split, strict=True):
            parts = list(map(get, own))
            try:
                out.append(b"".join(parts))
            except TypeError:  # parts that are no bytes
                out.append(self._whole(t) if False in parts else None)
        return out


def gallop(wanted: np.ndarray, among: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """How many of ``among`` (ascending) are smaller than each wanted value: exponential steps from
    the guess until the value is bracketed, then a binary search of the bracket."""
    n = len(among)
    low, high = np.full(len(wanted), -1), np.full(len(wanted), n)  # among[low] < wanted <= among[high]
    at, step = np.clip(guess, 0, n - 1), 1
    todo = np.arange(len(wanted)) if n else np.zeros(0, int)
    up = among[at] < wanted if n else np.zeros(len(wanted), bool)
    while len(todo):
        here = at[todo]
        smaller = among[here] < wanted[todo]
        low[todo[smaller]], high[todo[~smaller]] = here[smaller], here[~smaller]
        # go on upwards while smaller, downwards while not
        todo = todo[smaller == up[todo]]
        to = at[todo] + np.where(up[todo], step, -step)
        outside = (to < 0) | (to >= n)
        at[todo] = to
        todo = todo[~outside]
        step *= 2
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        mid = (low[todo] + high[todo]) >> 1
        smaller = among[mid] < wanted[todo]
        low[todo[smaller]], high[todo[~smaller]] = mid[smaller], mid[~smaller]
        todo = todo[high[todo] - low[todo] > 1]
    return high


def overlaps(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of the shorter list (ends): the first and the last token of the longer list
    that it overlaps, and whether the two lists end together there. Both start at one offset."""
    rank = gallop(short, long, guess)
    common = long[np.minimum(rank, len(long) - 1)] == short
    first = np.zeros(len(short), np.int64)
    first[1:] = rank[:-1] + common[:-1]
    return first, rank, common


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) for every j in first[i]..last[i]."""
    size = last - first + 1
    i = np.repeat(np.arange(len(first)), size)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + first[i]


class Aligner:
    def __init__(self, a, b) -> None:
        self.a, self.b = a, b
        self.words = Words(a), Words(b)
        # group text: each id as "id," within and "id|" or "id;" at the end of its side of a group
        self.text, self.base = [], []
        for side, close in ((a, b"|"), (b, b";")):
            for mark in (b",", close):
                self.base.append(len(self.text))
                self.text += [b"%d" % i + mark for i in range(len(side.bytes))]

    def align(self, texts: list[str | None], links: str = "overlap",
              ) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs and their times per text."""
        none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        out = [none] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        picked = [texts[i] for i in some]
        sides: tuple[list, list] = [], []  # documents in which A, or B, is the shorter list
        for i, x, y in zip(some, self.words[0].ids(picked), self.words[1].ids(picked), strict=True):
            if x is not None and y is not None:
                sides[len(x) > len(y)].append((i, x, y))
        for b_short, rows in enumerate(sides):
            if rows:
                for (i, _, _), found in zip(rows, self._aligned(rows, bool(b_short), links), strict=True):
                    out[i] = found
        return out

    def _aligned(self, rows, b_short: bool, links: str):
        # A and B tokens of all documents end to end; number of the document of each
        n = [np.array([len(r[x]) // 4 for r in rows]) for x in (1, 2)]
        ids = [np.frombuffer(b"".join([r[x] for r in rows]), "<i4").astype(np.int64) for x in (1, 2)]
        ends = [np.cumsum(side.size[x]) for side, x in zip(self.words, ids, strict=True)]
        s, m = (1, 0) if b_short else (0, 1)
        doc = np.repeat(np.arange(len(rows)), n[s])
        begin = [np.cumsum(x) - x for x in n]
        guess = begin[m][doc] + (np.arange(len(ids[s])) - begin[s][doc]) * n[m][doc] // n[s][doc]
        first, last, common = overlaps(ends[s], ends[m], guess)
        ends = np.flatnonzero(common), last[common]  # last tokens of the groups
        if links == "group":
            n_links, per = self._group_pairs(ids, ends[::-1] if b_short else ends, doc[ends[0]], len(rows))
        else:
            i, j = _spread(first, last)
            x, y = (j, i) if b_short else (i, j)
            n_links = np.bincount(doc, last - first + 1, len(rows)).astype(np.int64)
            per = self._pairs(ids[0][x] * len(self.b.bytes) + ids[1][y], np.repeat(doc, last - first + 1), len(rows))
        groups = np.bincount(doc, common, len(rows)).astype(np.int64)
        shas = self._texts(ids, *ends, s, np.cumsum(groups))
        return zip(n[0].tolist(), n[1].tolist(), groups.tolist(), n_links.tolist(), shas, *per, strict=True)

    def _group_pairs(self, ids, ends, doc: np.ndarray, n: int):
        """Links of each document, its distinct pairs and their times, where a group's A tokens are
        linked with all its B tokens; the last A and B token, and the document, of each group."""
        size = [np.diff(e, prepend=-1) for e in ends]
        links = np.bincount(doc, size[0] * size[1], n).astype(np.int64)
        group = [np.repeat(np.arange(len(doc)), x) for x in size]
        ids, times = list(ids), None
        if (long := size[0] * size[1] > LONG).any():
            times = [np.ones(len(x), np.int64) for x in ids]
            for x, side in enumerate((self.a, self.b)):
                many = long[group[x]]
                keys, t = np.unique(group[x][many] * len(side.bytes) + ids[x][many], return_counts=True)
                g = np.append(group[x][~many], keys // len(side.bytes))
                order = np.argsort(g, kind="stable")
                group[x], ids[x] = g[order], np.append(ids[x][~many], keys % len(side.bytes))[order]
                times[x] = np.append(times[x][~many], t)[order]
            size[1] = np.bincount(group[1], minlength=len(doc))
        first = (np.cumsum(size[1]) - size[1])[group[0]]
        i, j = _spread(first, first + size[1][group[0]] - 1)
        return links, self._pairs(ids[0][i] * len(self.b.bytes) + ids[1][j], doc[group[0][i]], n,
                                  None if times is None else times[0][i] * times[1][j])

    def _pairs(self, pairs: np.ndarray, doc: np.ndarray, n: int, times: np.ndarray | None = None):
        """Distinct pairs of each document, ascending, and how often each occurs."""
        of_doc = len(self.a.bytes) * len(self.b.bytes)  # two vocabularies and a batch fit in 63 bits
        keys = doc * of_doc + pairs
        if times is None:
            keys.sort()
        else:
            order = np.argsort(keys)
            keys, times = keys[order], times[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        times = np.diff(np.append(at, len(keys))) if times is None else np.add.reduceat(times, at)
        keys = keys[at]
        cuts = np.searchsorted(keys, np.arange(1, n) * of_doc)
        return np.split(keys % of_doc, cuts), np.split(times, cuts)

    def _texts(self, ids, short_end, long_end, s: int, groups: np.ndarray) -> Iterator[str]:
        """SHA-256 of each document's groups as text; the last tokens of the groups on the
        shorter and the longer side, and the number of groups up to each document's end."""
        end = (short_end, long_end) if s == 0 else (long_end, short_end)
        code = []
        for x in (0, 1):
            mark = ids[x] + self.base[2 * x]
            mark[end[x]] = ids[x][end[x]] + self.base[2 * x + 1]
            code.append(mark)
        # each group's A tokens, then its B tokens
        group = [np.zeros(len(t), np.int64) for t in ids]
        for x in (0, 1):
            group[x][end[x][:-1] + 1] = 1
            group[x] = np.cumsum(group[x])
        upto = [np.append(0, e + 1) for e in end]
        mixed = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        mixed[np.arange(len(ids[0])) + upto[1][group[0]]] = code[0]
        mixed[np.arange(len(ids[1])) + upto[0][group[1] + 1]] = code[1]
        get, a = self.text.__getitem__, 0
        for b in (upto[0][groups] + upto[1][groups]).tolist():
            yield hashlib.sha256(b"".join(map(get, mixed[a:b].tolist()))[:-1]).hexdigest()
            a = b


_KNOWN: dict[tuple[str, str], Aligner] = {}


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None, links: str = "overlap") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked id pairs
    (A id times the size of B, plus B id) with their times, for each row of docs."""
    if links not in ("overlap", "group"):
        raise ValueError(f"links must be overlap or group, not {links!r}")
    default = default_tokenizers()
    paths = a or default[0], b or default[1]

    def run(batches):
        if paths not in _KNOWN:
            _KNOWN[paths] = Aligner(ByteLevel(paths[0]), Pieces(paths[1]))
        for batch in batches:
            ids, text = c.columns(batch, "doc_id", "text")
            texts = text.to_pylist()
            found = []
            for some in _portions(texts):
                found += _KNOWN[paths].align(some, links)
            cols = list(zip(*found, strict=True)) or [()] * 7
            yield pa.record_batch(
                [ids, *(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.string()),
                 c.list_array(list(cols[5]), pa.int64()), c.list_array(list(cols[6]), pa.int64())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return c.texts(docs).mapInArrow(run, _ALIGNED)


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, about half a million characters at a time."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size > 1 << 19:
            yield some
            some, size = [], 0
    if some:
        yield some


def pair_counts(found: DataFrame, vocabulary_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (its count is its A id's highest)."""
    counts = c.written(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")),
                       "pair_counts")
    a = F.expr(f"pair div {vocabulary_b}").alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _judged(found: DataFrame, block: DataFrame) -> DataFrame:
    """row, n_best, count_sum: what the pairs of one block add to each row of found."""
    table = block.toArrow()
    order = np.argsort(table.column("pair").to_numpy())
    known = found.sparkSession.sparkContext.broadcast(
        tuple(table.column(x).to_numpy()[order] for x in ("pair", "n", "best")))

    def run(batches):
        pair, n, best = known.value
        for batch in batches:
            rows, pairs, times = c.columns(batch, "row", "pairs", "times")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(pairs.offsets.to_numpy()))
            p, t = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.searchsorted(pair, p)
            at[at == len(pair)] = 0
            here = pair[at] == p if len(pair) else np.zeros(len(p), bool)  # others are of other blocks
            at, t, doc = at[here], t[here], doc[here]
            # the sums stay below 2**53, so they are exact in doubles
            sums = [np.bincount(doc, w, batch.num_rows).astype(np.int64) for w in (t * best[at], t * n[at])]
            yield pa.record_batch([rows, *map(pa.array, sums)], names=["row", "n_best", "count_sum"])

    return found.select("row", "pairs", "times").mapInArrow(run, "row long, n_best long, count_sum long")


def align(docs: DataFrame, a: str | None = None, b: str | None = None, block: int = BLOCK,
          links: str = "overlap") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of docs;
    see the module's text. ``links``: which tokens are linked, those that overlap or all of a group."""
    b = b or default_tokenizers()[1]
    # numbered once and written, so a row has one number in all that follows
    found = c.written(aligned(docs, a, b, links).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = c.written(pair_counts(found, len(Pieces(b).bytes)), "pairs")
    blocks = max(1, -(-counts.count() // block))
    slot = F.pmod(F.xxhash64("pair"), F.lit(blocks))
    sums = [c.written(_judged(found, counts.filter(slot == i)), "sums") for i in range(blocks)]
    total = sums[0]
    for more in sums[1:]:
        total = total.unionByName(more)
    total = total.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.join(total, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                           "groups_sha256")
