"""Each stage on its own input against a brute-force version, then the whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from docweave.llm.common import durable, ready

from . import brute
from ..conftest import SF001


@pytest.fixture(scope="module")
def tables(spark):
    docs = ready(spark).read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(durable(stage(spark, out[-1], SF001)))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(tables):
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_quality_and_language_only_filter(tables):
    quality, lang = rows(tables[1]), rows(tables[2])
    assert set(quality) <= set(rows(tables[0])) and set(lang) <= set(quality)
    assert all(len(brute.words(r[1])) >= 50 for r in quality)
    assert len(lang) >= 0.98 * len(quality) > 0


def test_one_document_of_each_class_stays(tables):
    before = sorted(rows(tables[2]))
    classes = brute.near_classes([(r[0], r[1]) for r in before])
    assert rows(tables[3]) == sorted((r for i, r in enumerate(before) if classes[i] == i), key=str)


def test_passages_are_cut(tables):
    before = rows(tables[3])
    want = []
    for r, (w, gone) in zip(before, brute.repeated_windows([r[1] for r in before], 35)):
        text = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        want.append((r[0], text, r[2], r[3], len(text)))
    assert rows(tables[4]) == sorted(want, key=str)


def test_packing_holds_every_document(tables):
    packed = tables[5]
    assert packed.select("doc_id").distinct().count() == tables[4].count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_awkward_documents_pass(spark):
    docs = ready(spark).createDataFrame(brute.awkward(), brute.SCHEMA)
    for _, stage in pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF001))
        assert docs.columns == [c.strip("`").split("`")[0] for c in spark.createDataFrame([], brute.SCHEMA).columns] or "n_chars" in docs.columns
    assert pipeline.packing(spark, docs, SF001).count() > 0
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        none = durable(stage(spark, none, SF001))
        assert none.count() == 0
