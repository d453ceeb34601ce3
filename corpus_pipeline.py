"""Corpus pipeline: quality rules, language, near-duplicates, repeated passages, packing.

A stage takes (spark, docs, sf_dir) and returns a table; all but the last return
the columns of ``documents``.  ``run`` writes each stage's table to the shared folder
and reads it back as the next one's input.

Rows of any kind pass through: null and empty texts are rejected by the quality
rules; repeated rows are near-duplicates of each other; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.llm import mixture_language, residual_packing, rule_ledger, sketch_dedup, weighted_minhash
from docweave.llm.common import durable, ready, table
from docweave.llm.queries import SEQUENCE, language_model, tokenizer_path
from docweave.llm.registry import query


def _whole(docs, without=()):
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without))


def quality(spark, docs, sf_dir):
    """Documents that the standard policy of the rule ledger keeps."""
    book = rule_ledger.ledger(docs.select(_whole(docs).alias("row"), "text"), key="row")
    return book.where(rule_ledger.kept(rule_ledger.STANDARD)).select("row.*")


def language(spark, docs, sf_dir, least_share=0.5):
    """Documents of which one language makes up at least ``least_share``."""
    ready(spark)
    rows = docs.select(_whole(docs, ("text",)).alias("row"), "text")          # the text goes to Python once
    told = mixture_language.identify(rows, language_model(docs), ("row", "text"))
    kept = told.where((F.col("lang_pred") != mixture_language.UNKNOWN) & (F.col("score") >= least_share))
    return kept.select(*(F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns))


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near-duplicates: the one of the least doc_id."""
    ready(spark)
    return weighted_minhash.keep_firsts(docs, weighted_minhash.near_duplicates(docs))


def passages(spark, docs, sf_dir):
    """Documents without the words of windows that start anywhere else, too."""
    ready(spark)
    cut = sketch_dedup.remove_repeated_windows(docs.select(_whole(docs, ("text",)).alias("doc_id"), "text"))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*(new.get(c, F.col(f"doc_id.`{c}`")).alias(c) for c in docs.columns))


def packing(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences."""
    ready(spark)
    return residual_packing.pack_documents(docs, tokenizer_path(), SEQUENCE)


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", passages),
    ("best_fit_packing", packing),
]

#: Language inference is iterative, so SQL cannot express the whole; tests hold
#: each stage against a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
