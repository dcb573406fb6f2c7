"""Corpus cleaning pipeline: each stage works on all documents its predecessor kept.

A stage gets the documents as read back from the stage before and returns them with the same
columns; the last returns the packed pieces. Rows travel as one struct, so no column of the
documents, whatever its name, meets a column of the operators. An empty table stays empty;
null and empty texts follow the operators' rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm import common as c
from orderlens.llm import decontam, near_dup, packing, quality_rules as rules, suffix_dedup

# Sketches, 400-byte matches, alignments and fitted patterns have no SQL form.
ORACLE_SQL = None


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, a key of doc_id and text, and the whole row."""
    return docs.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_key"),
                       F.struct("*").alias("_row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rule or the perplexity band of their language rejects;
    a doc_id goes if any of its rows is rejected, rows without doc_id stay."""
    gone = c.cut(rules.quality_rules(docs).filter("not kept").select("doc_id").distinct())
    return c.without_ids(_rows(docs), gone).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the smallest doc_id) of each group of near duplicates on five-word
    shingles; repeated rows of a document collapse to one, rows without doc_id stay."""
    gone = c.cut(near_dup.near_duplicates(docs, words=5, percent=80).filter("not kept")
                 .select("doc_id").distinct())
    rest = c.without_ids(_rows(docs), gone)
    twice = c.cut(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    one = c.only_ids(rest, twice).dropDuplicates(["doc_id"])
    return c.without_ids(rest, twice).unionByName(one).select("_row.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the bytes of every 400-byte string that starts twice out of the texts (n_chars
    follows where there is such a column). Documents of which nothing is left go."""
    cut = c.written(suffix_dedup.cut_texts(docs), "cut")
    rows = _rows(docs)
    hit = c.only_ids(rows, cut, "_key").join(cut, "_key").filter("kept_text <> ''")
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    hit = hit.select(*[new.get(x, F.col(f"_row.`{x}`")).alias(x) for x in docs.columns])
    return c.without_ids(rows, cut, "_key").select("_row.*").unionByName(hit)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a test item of the benchmark table."""
    found = decontam.contaminated(docs, c.read(spark, sf_dir, "benchmark"))
    return c.without_ids(_rows(docs), c.cut(found.select("doc_id").distinct())).select("_row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most 2,048 tokens."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_array_dedup", suffix_array_dedup),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = c.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = c.written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
