"""Quality rules: text statistics and a perplexity band for each language.

The base rule rejects texts of fewer than MIN_WORDS words and texts of which more than
REPEAT_PERCENT percent of the words lie in WINDOW-word windows that occur twice in the text.
The method scores the words of each text with the modified Kneser-Ney model of its language (langmodel),
counted over all words of all documents, and rejects perplexities (per character and word end) outside the language's band: the middle
half of the log perplexities of all texts that pass the base rule, widened on each side by
BELOW or ABOVE times its width. A single text's mean strays with its length, so the band of a
text of n characters is widened by SHORT / sqrt(n).

Defined cases: null text is empty, has no words and fails the base rule; null languages are a
language of their own; repeated rows are answered one by one; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c, langmodel

MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
BELOW = 2.0
ABOVE = 4.0
SHORT = 1.2
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#*$%&|<>")] = True


def statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    return _measured(text)[0]


def _measured(text: bytes) -> tuple[tuple[int, int, int, int, int], np.ndarray, np.ndarray, np.ndarray]:
    """The statistics of a text, and the hashes, starts and ends of its words."""
    data = c.as_bytes(text)
    starts, ends = c.word_spans(data)
    first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before a byte
    hashes = c.span_hashes(data, starts, ends)
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(b" \t\n\v\f\r"):
            seen.add(line)
    repeated = 0
    windows = c.window_hashes(hashes, WINDOW)
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(windows), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(hashes) + 1, np.int32)
        cover[:len(windows)] += twice
        cover[WINDOW:] -= twice
        repeated = int((np.cumsum(cover[:-1]) > 0).sum())
    return (len(starts), int((first[ends] - first[starts]).sum()), int(_SIGNS[data].sum()), dup, repeated), \
        hashes, starts, ends


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the five statistics, n_chars, perplexity and base_failed of each row."""
    docs = c.texts(docs, "lang")
    trained, words = langmodel.train(docs)
    sc = docs.sparkSession.sparkContext
    model, known = sc.broadcast(trained), sc.broadcast(langmodel.frequent(words))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            ids, langs, text = c.columns(batch, "doc_id", "lang", "text")
            stats, size, logp, rest = [], [], [], []
            new: tuple[list, list, list] = [], [], []  # words that are not broadcast, their rows and languages
            for lang, t in zip(langs.to_pylist(), c.text_bytes(text), strict=True):
                found, hashes, starts, ends = _measured(t)
                stats.append(found)
                size.append(int(((c.as_bytes(t) & 0xC0) != 0x80).sum()))
                own = langmodel.keys(hashes, lang)
                some, others = langmodel.looked_up(own, *known.value)
                if model.value is not None:
                    new[0].extend([t[a:b] for a, b in zip(starts[others].tolist(), ends[others].tolist(), strict=True)])
                    new[1].extend([len(logp)] * int(others.sum()))
                    new[2].extend([lang] * int(others.sum()))
                    others[:] = False
                logp.append(some)
                rest.append(own[others])
            if new[0]:
                logp = np.add(logp, np.bincount(new[1], model.value.score(new[0], langmodel.salts(new[2])), batch.num_rows))
            cols = np.array(stats, np.int64).reshape(-1, 5).T
            yield pa.record_batch([ids, langs, *cols, pa.array(size, pa.int64()), pa.array(logp, pa.float64()),
                                   c.list_array(rest, pa.int64())],
                                  names=["doc_id", "lang", *names, "n_chars", "known", "rest"])

    rows = docs.mapInArrow(run, "doc_id long, lang string, " + ", ".join(f"{x} long" for x in names)
                           + ", n_chars long, known double, rest array<long>")
    # numbered and written, so a row has one number in both branches
    rows = c.written(rows.withColumn("_row", F.monotonically_increasing_id()), "measured")
    # words that were not scored on the way: none with a broadcast model
    rest = (rows.select("_row", F.explode("rest").alias("key")).join(words.select("key", "logp"), "key")
            .groupBy("_row").agg(F.sum("logp").alias("others")))
    logp = F.col("known") + F.coalesce("others", F.lit(0.0))
    # of each character of the words and each word's end; a text without words has none
    perplexity = F.exp(-logp / F.nullif(F.col("n_words") + F.col("word_chars"), F.lit(0)))
    rows = (rows.drop("rest").join(rest, "_row", "left")
            .select("doc_id", "lang", *names, "n_chars", perplexity.alias("perplexity")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, kept, perplexity, lower and upper for each row."""
    rows = c.written(scored(docs), "scored")
    log = F.log("perplexity")
    q = F.percentile_approx(log, [0.25, 0.75], 10000)
    wide = F.col("q")[1] - F.col("q")[0]
    bands = (rows.filter("not base_failed").groupBy("lang").agg(q.alias("q"))
             .select(F.col("lang").alias("_lang"), (F.col("q")[0] - BELOW * wide).alias("_low"),
                     (F.col("q")[1] + ABOVE * wide).alias("_high")))
    slack = SHORT / F.sqrt(F.greatest("n_chars", F.lit(1)))
    lower, upper = F.exp(F.col("_low") - slack), F.exp(F.col("_high") + slack)
    # one row for each language tag, joined by AQE on its measured size
    out = (rows.join(bands, rows["lang"].eqNullSafe(bands["_lang"]), "left")
           .withColumns({"lower": lower, "upper": upper}))
    fits = F.coalesce(F.col("perplexity").between(F.col("lower"), F.col("upper")), F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", (~F.col("base_failed") & fits).alias("kept"),
                      "perplexity", "lower", "upper")
