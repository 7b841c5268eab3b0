"""The pipeline's stages on awkward rows and on the driver's tables."""

import os

import corpus_pipeline
import pytest
from helpers import AWKWARD, prose

DATA = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def corpus(spark, tmp_path):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in AWKWARD]
    rows += [(100 + i, prose(200 + i, 40) + "\n" + prose(999, 8), None, None, None) for i in range(8)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(100, 108)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_keep_the_columns_and_the_clean_documents(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, corpus).collect(), DOCUMENTS)
        assert docs.columns == columns, name
    rows = docs.collect()
    assert {r.doc_id for r in rows} <= before and {1, 5, 7, 100, 107, None} <= {r.doc_id for r in rows}
    assert [r.doc_id for r in rows].count(6) == 0  # a copy of 1
    assert sum(prose(999, 8) in (r.text or "") for r in rows) == 1
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_near_duplicate_stage_keeps_one_row_of_an_id(spark):
    rows = [(3, prose(1, 50), None, None, None)] * 3 + [(4, prose(1, 50), None, None, None), (None, prose(1, 50), None, None, None)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id for r in left), key=str) == [3, None]


def test_near_duplicate_stage_keeps_a_text_of_each_component(spark):
    """Rows of one id that hold different texts are judged each by its own component."""
    a, b, c, d = (prose(i, 50) for i in (1, 2, 3, 4))
    texts = [(3, a), (5, a), (5, b), (9, b), (7, c), (7, d), (7, d), (8, d), (None, d)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], DOCUMENTS)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(3, a), (5, b), (7, c), (7, d), (0, d)])


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_run(spark):
    packed = corpus_pipeline.run(spark, DATA)
    rows = packed.collect()
    assert rows and all(r.length > 0 for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "substring dedup", "packing"]
