"""Registered queries of the training-data operators: opN_<name>, each over whole tables."""

from __future__ import annotations

from orderlens.llm import common as c
from orderlens.llm import (alignment, decontam, exact_dedup, extract, labelmodel, licences, near_dup, packing, periodic, quality_rules,
                           suffix_dedup, toxicity, urllists)


def op1_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a test item, exact or edited, with the alignment's score and place."""
    return decontam.contaminated(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark, sf_dir):
    """Text statistics, base rule and the perplexity band of each document's language."""
    return quality_rules.quality_rules(c.read(spark, sf_dir, "documents"))


def op3_license_scans(spark, sf_dir):
    """Licence passages of all documents with their family, probability and template similarity."""
    return licences.scan(c.read(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    """Toxicity scores of all documents; the labels of every fifth are held out."""
    return toxicity.toxicity(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "labels"))


def op5_url_filters(spark, sf_dir):
    """Every page judged by the list entries that held when it was fetched."""
    return urllists.out_times(urllists.judge(urllists.captures_of(spark, sf_dir), urllists.entries_of(spark, sf_dir)))


def op6_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate components on 4-word shingles at a similarity of 0.8."""
    return near_dup.near_duplicates(c.read(spark, sf_dir, "documents"), words=4, percent=80)


def op7_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return extract.extract(c.read(spark, sf_dir, "pages"))


def op8_quality_classifier(spark, sf_dir):
    """Posterior of the label model and score of the trained linear scorer for all documents."""
    return labelmodel.quality(c.read(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark, sf_dir):
    """Places of all pieces in sequences of at most 2,048 tokens."""
    return packing.pack(c.read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark, sf_dir):
    """What is left of each document without the 400-byte strings that start twice."""
    return suffix_dedup.remove_repeats(c.read(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark, sf_dir):
    """Byte alignment of two tokenizers over all documents, with corpus-wide counts of the ids that
    share a group."""
    return alignment.align(c.read(spark, sf_dir, "documents"), links="group")


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of words of every document, every tenth with a planted period."""
    return periodic.digest(periodic.periodic_runs(c.read(spark, sf_dir, "documents"), rewrite=periodic.planted))


def op13_exact_dedup(spark, sf_dir):
    """Equal texts without white space: the group of every document and the row that stays."""
    return exact_dedup.exact_duplicates(c.read(spark, sf_dir, "documents"))


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql():
    return {"op5_url_filters": urllists.ORACLE_SQL, "op13_exact_dedup": exact_dedup.ORACLE_SQL}
