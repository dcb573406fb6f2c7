"""Toxicity scores of texts restored by a noisy-channel decoder.

Restoration: stretches that mix letters with look-alike signs (before, between or behind them),
repeat a letter three times or more, space a word out character by character, or part it by a
separator are decoded. Each stretch is one lattice in which, at any place, a sign may be itself or
a letter it stands for, a repeated letter may be one or two, and separators may stay or go; the
channel gives each choice a probability, a character language model (charlm, counted over all
documents, one for all of them) the rest, and Viterbi search keeps the best path for each model
state. Everything else is left as it is.

Score: features of a restored word are the word and its first 4, 5 and 6 bytes, hashed to
BUCKETS. Spark counts in how many toxic and clean training texts each occurs; a feature's
strength is the lower confidence bound of its log odds. A text is scored by logistic
regression on its two strongest words and the number of strong ones. Training texts are the
at most FIT_ROWS labelled documents with the smallest hashes of their doc_id. Labels, language, source and doc_id are no inputs of the score. Rows whose crc32(doc_id as text) mod 5 is 0 are held out.

Defined cases: null text is empty and gets the score of a text without features; rows without
doc_id are not held out and not trained on; repeated rows are answered one by one; null or
missing labels do not count; extra columns are ignored; without labels of both kinds every
score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import charlm, common as c

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
FIT_ROWS = 50_000  # labelled documents that are learned from
FOLDS = 5
STRONG = 1.0  # a feature counts as strong from this bound of its log odds on
Z = 2.0
_U = np.uint64

# fixed values: signs that stand for letters
LOOKALIKES = {"4": "a", "@": "a", "8": "b", "(": "c", "3": "e", "6": "g", "9": "g", "1": "il", "!": "i",
              "|": "il", "0": "o", "5": "s", "$": "s", "7": "t", "+": "t", "2": "z"}
KEEP, SWAP, ONE, TWO, JOIN = np.log([0.3, 0.7, 0.7, 0.3, 0.5]).tolist()

_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_SIGN = np.zeros(256, bool)
_SIGN[[ord(x) for x in LOOKALIKES]] = True
_TAIL = np.zeros(256, bool)  # signs that count behind a word: others end sentences
_TAIL[[ord(x) for x in "0123456789@$"]] = True
_PART = np.zeros(256, bool)
_PART[[ord(x) for x in ".*_/"]] = True
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_SEPARATORS = " .-_*/"
_MIXED = re.compile(
    # from the start of a stretch of letters and digits on, so that each is tried once
    r"(?<![^\W_])[^\W_]*(?:[^\W\d_][0-9@$|!+(]+(?=[^\W\d_])|[0-9@$]+(?=[^\W\d_])|([^\W\d_])\1\1)[\w@$|!+(]*[^\W_][0-9@$]*"
    r"|(?<![\w@$|!+(])[!|+(]+[^\W\d_][\w@$|!+(]*[^\W_][0-9@$]*"  # a sign in front
    r"|(?<![^\W_])[^\W_]*[^\W\d_][0-9@$]+(?!\w)",  # signs at the end
    re.UNICODE)
_SINGLE = r"(?:[^\W_]|[@$|!+(])"
_SPACED = re.compile(rf"(?<![\w@$|!+(])(?:{_SINGLE}[ .\-_*/]{{1,2}}){{2,}}{_SINGLE}(?![\w@$|!+(])")
_PARTED = re.compile(r"(?<![\w./])[^\W\d_]{2,}[.*_/][^\W\d_]{2,}(?![\w/]|\.\w)")  # one separator; not a path or an address


def suspicious(data: np.ndarray) -> bool:
    """Whether a UTF-8 text has anything to decode (a quick test that never misses)."""
    letter, sign = _LETTER[data], _SIGN[data]
    if (letter[1:] & sign[:-1]).any() or (letter[:-1] & _TAIL[data[1:]]).any():
        return True
    if len(data) > 2 and (letter[2:] & (_fold(data[2:]) == _fold(data[1:-1])) & (_fold(data[1:-1]) == _fold(data[:-2]))).any():
        return True
    if len(data) < 5:
        return False
    if (_PART[data[1:-1]] & letter[:-2] & letter[2:]).any():
        return True
    word = np.concatenate(([False], _WORD[data] | sign, [False]))
    # first bytes of characters between two non-word bytes: single letters or signs
    lead = (data & 0xC0) != 0x80
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    ends = np.flatnonzero(word[:-1] & ~word[1:])
    count = np.concatenate(([0], np.cumsum(lead)))
    single = (count[ends] - count[starts]) == 1
    near = starts[1:] - ends[:-1] <= 2
    return bool((single[:-2] & single[1:-1] & single[2:] & near[:-1] & near[1:]).any()) if len(starts) > 2 else False


def _fold(data: np.ndarray) -> np.ndarray:
    return c._LOWER[data]


class Decoder:
    """Viterbi search over the readings of a stretch under a character model."""

    def __init__(self, model: charlm.Model) -> None:
        self.model, self.order, self.memo, self.done, self.folded = model, len(model.grams), {}, {}, {}

    def step(self, state: int, symbol: int) -> tuple[float, int]:
        gram = (state << 5) | symbol
        if gram not in self.memo:
            self.memo[gram] = float(self.model.logp(np.array([gram], np.uint32))[0])
        return self.memo[gram], gram & (charlm.SYMBOLS ** (self.order - 1) - 1)

    def symbols(self, reading: str) -> list[int]:
        if reading not in self.folded:
            if len(self.folded) > 100_000:
                self.folded.clear()
            self.folded[reading] = charlm.fold(reading.lower().encode()).tolist() if reading else []
        return self.folded[reading]

    def lattice(self, stretch: str) -> list[list[tuple[str, float]]]:
        """For each place the possible readings and their channel log probabilities."""
        out, i = [], 0
        while i < len(stretch):
            ch = stretch[i]
            j = i
            while j < len(stretch) and stretch[j] == ch:
                j += 1
            if ch in _SEPARATORS:
                while j < len(stretch) and stretch[j] in _SEPARATORS:
                    j += 1
                out.append([(stretch[i:j], KEEP), ("", SWAP)])
            elif ch in LOOKALIKES:
                for _ in range(i, min(j, i + 2)) if j - i >= 3 else range(i, j):
                    out.append([(ch, KEEP), *((x, SWAP) for x in LOOKALIKES[ch])])
            elif j - i >= 3 and ch.isalpha():
                out.append([(ch, ONE), (ch * 2, TWO)])
            else:
                out.append([(stretch[i:j], 0.0)])
            i = j
        return out

    def read(self, stretch: str) -> str:
        if stretch not in self.done:
            if len(self.done) > 100_000:
                self.done.clear()
            best = {0: (0.0, "")}  # state: log probability and reading; 0 is after a space
            for options in [*self.lattice(stretch), [(" ", 0.0)]]:
                new: dict[int, tuple[float, str]] = {}
                folded = [(reading, channel, self.symbols(reading)) for reading, channel in options]
                for state, (score, text) in best.items():
                    for reading, channel, symbols in folded:
                        s, at = score + channel, state
                        for symbol in symbols:
                            p, at = self.step(at, symbol)
                            s += p
                        if at not in new or s > new[at][0]:
                            new[at] = (s, text + reading)
                best = new
            self.done[stretch] = max(best.values())[1][:-1]
        return self.done[stretch]

    def restore(self, text: str) -> str:
        text = text.lower()
        for pattern in (_SPACED, _MIXED, _PARTED):  # a word spaced out is read as a whole first
            text = pattern.sub(self._reading, text)
        return text

    def _reading(self, match: re.Match) -> str:
        stretch = match[0]
        return self.read(stretch) if any(map(str.isalpha, stretch)) else stretch  # no plain numbers


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of a restored text, and the word each belongs to."""
    data = c.as_bytes(text)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    kinds = [c.span_hashes(data, starts, ends)]
    which = [np.arange(len(starts))]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        kinds.append(c.mix(c.span_hashes(data, starts[long], starts[long] + k) + _U(k)))
        which.append(long)
    return (np.concatenate(kinds) % _U(BUCKETS)).astype(np.int64), np.concatenate(which)


def _restored(batch, decoder: Decoder):
    for t in c.text_bytes(batch.column("text")):
        if suspicious(c.as_bytes(t)):
            yield decoder.restore(t.decode("utf-8", "replace")).encode()
        else:
            yield t.decode("utf-8", "replace").lower().encode()


def _class_counts(train: DataFrame, model) -> DataFrame:
    """(feature, toxic, clean): training texts of each kind that hold a feature; the row of
    feature -1 counts the texts."""

    def run(batches):
        decoder = Decoder(model.value)
        table = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for toxic, t in zip(batch.column("toxic").to_pylist(), _restored(batch, decoder), strict=True):
                table[toxic, c.distinct_sorted(features(t)[0])] += 1
                table[toxic, BUCKETS] += 1
        found = np.flatnonzero(table.any(0))
        yield pa.record_batch([np.where(found == BUCKETS, -1, found), table[1, found], table[0, found]],
                              names=["feature", "toxic", "clean"])

    return (train.mapInArrow(run, "feature long, toxic long, clean long").groupBy("feature")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def strength(n_toxic: int, n_clean: int):
    """Lower confidence bound of the log odds of a row of class counts."""
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    return F.log(a / b) - float(np.log((n_toxic + 1) / (n_clean + 1))) - Z * F.sqrt(1 / a + 1 / b)


def summary(text: bytes, buckets: np.ndarray, strength: np.ndarray) -> tuple[float, float, float]:
    """Strength of the two strongest words of a text, and the log count of strong words."""
    own, word = features(text)
    if not len(own) or not len(buckets):
        return 0.0, 0.0, 0.0
    at = np.minimum(np.searchsorted(buckets, own), len(buckets) - 1)
    hit = np.flatnonzero(buckets[at] == own)
    if not len(hit):
        return 0.0, 0.0, 0.0
    _, w = np.unique(word[hit], return_inverse=True)
    top = np.zeros(w.max() + 1)
    np.maximum.at(top, w, strength[at[hit]])
    top.sort()
    return float(top[-1]), float(top[-2]) if len(top) > 1 else 0.0, float(np.log1p(len(top)))


def _summaries(docs: DataFrame, model, table, *more: str) -> DataFrame:
    """doc_id, held_out, x1, x2, x3 of each row, and the named columns."""

    def run(batches):
        decoder = Decoder(model.value)
        for batch in batches:
            x = np.array([summary(t, *table.value) for t in _restored(batch, decoder)]).reshape(-1, 3).T
            rest = c.columns(batch, "doc_id", *more)
            yield pa.record_batch([*rest, *x], names=["doc_id", *more, "x1", "x2", "x3"])

    kinds = "".join(f", {x} int" for x in more)
    return docs.mapInArrow(run, f"doc_id long{kinds}, x1 double, x2 double, x3 double")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs."""
    docs = c.texts(docs)
    sc = docs.sparkSession.sparkContext
    # one model for all texts: a tag of a row must not change its score
    model = sc.broadcast(charlm.train(docs.withColumn("lang", F.lit("all"))).get("all") or charlm.Model([]))
    known = (labels.select("doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)")
             .filter(~_held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    # at most FIT_ROWS rows, so they meet the texts in the scan and no text is shuffled
    known = c.cut(c.smallest_hashes(known, FIT_ROWS, "doc_id"))
    train = docs.join(F.broadcast(known), "doc_id")
    counts = c.written(_class_counts(train, model), "counts")
    n_toxic, n_clean = (int(x or 0) for x in counts.filter("feature < 0").agg(F.sum("toxic"), F.sum("clean")).first())
    strong = (counts.filter("feature >= 0").select("feature", strength(n_toxic, n_clean).alias("s"))
              .filter(F.col("s") >= STRONG).toPandas().sort_values("feature"))  # at most BUCKETS rows
    table = sc.broadcast((strong["feature"].to_numpy(np.int64), strong["s"].to_numpy(float)))
    if n_toxic and n_clean:
        # one row for each of at most FIT_ROWS documents
        rows = _summaries(train, model, table, "toxic").dropDuplicates(["doc_id"]).toPandas()
        w = logistic(rows[["x1", "x2", "x3"]].to_numpy(), rows["toxic"].to_numpy())
        z = sum(F.lit(float(v)) * F.col(k) for v, k in zip(w, ("x1", "x2", "x3"))) + F.lit(float(w[3]))
        score = 1 / (1 + F.exp(-z))
    else:
        score = F.lit(0.0)
    out = _summaries(docs, model, table).withColumn("score", score)
    return out.select("doc_id", _held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
