"""Toxicity: held-out accuracy, misspellings, and rows out of the ordinary."""

import os
import random

import pyarrow as pa
import pytest
from helpers import AWKWARD, SYLLABLES, awkward, prose
from pyspark.sql import functions as F

from fareflow.llm import queries, toxicity
from fareflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def corpus(n: int, seed: int = 0):
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(seed * 10000 + i, r.randint(20, 200)).split()
        if i % 4 == 0:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(["grunzig", "flomper", "vexwort"]) + r.choice(["", "s", "er", *SYLLABLES[:3]])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(*corpus(400, 1))


def scores(model, texts):
    return toxicity._sigmoid(toxicity._Scores(model).logits(pa.array(texts, pa.string())))


def test_held_out_accuracy(model):
    texts, labels = corpus(200, 2)
    found = scores(model, texts) >= 0.7
    hits = sum(f for f, y in zip(found, labels) if y)
    false = sum(f for f, y in zip(found, labels) if not y)
    assert hits >= 45 and false <= 3


def test_unseen_spellings_share_ngrams(model):
    clean = prose(999, 60)
    assert scores(model, [clean + " grunziig flomperr"])[0] > scores(model, [clean])[0] + 0.2


def test_one_class_or_nothing_gives_the_share(spark):
    assert scores(toxicity.fit([], []), ["a", ""]).tolist() == [0.5, 0.5]
    low = scores(toxicity.fit(["a b", "c d"], [0, 0]), ["a", ""])
    assert low[0] == low[1] < 0.5


def test_rows_out_of_the_ordinary(spark, model):
    found = toxicity.score(awkward(spark, AWKWARD), model).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    same = {r.score for r in found if r.doc_id in (2, 3, 4)}
    assert len(same) == 1  # no evidence
    assert len({r.score for r in found if r.doc_id == 6} | {r.score for r in found if r.doc_id == 1}) == 1
    assert toxicity.score(awkward(spark, []), model).count() == 0
    kept = toxicity.keep_clean(awkward(spark, [*AWKWARD, (77, "flomper vexwort grunzig " * 9)]), model, 0.7)
    assert kept.columns == awkward(spark, []).columns
    assert 77 not in {r.doc_id for r in kept.collect()}


def test_words_and_signs():
    scored = toxicity.Model(toxicity.np.arange(toxicity.BUCKETS, dtype="f4"), 0.0).word_scores(["Ab", "ab,", "--", "", "ab-cd", "cd"])
    assert scored[0] == scored[1] and scored[4] == pytest.approx((scored[0] + scored[5]) / 2)
    assert toxicity.np.isnan(scored[2]) and toxicity.np.isnan(scored[3])


def test_grams_are_those_of_the_word_alone():
    words = ["ab", "x", "longerword", "É😀", ""]
    flat, counts = toxicity.grams(words)
    at = 0
    for word, n in zip(words, counts):
        alone, m = toxicity.grams([word])
        assert n == m[0] and flat[at : at + n].tolist() == alone.tolist()
        size = len(word) + 2
        assert n == sum(max(0, size - k + 1) for k in range(toxicity.SHORTEST, toxicity.LONGEST + 1))
        at += n


def test_sample_is_bounded_and_balanced(spark):
    texts = [(i, f"text {i}") for i in range(60)] + [(60, "x" * 50), (61, None), (62, "y"), (63, "z"), (None, "n"), (0, "text 0")]
    labels = [(i, i % 2) for i in range(62)] + [(62, None), (63, 7), (None, 1), (99, 1), (0, 0)]
    documents, known = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(labels, "id long, label int")
    found, classes, share = toxicity.sample(documents, known, max_rows=100, max_chars=20)
    assert sorted(found) == sorted(f"text {i}" for i in [0, *range(60)]) and sum(classes) == 30
    assert share == pytest.approx(32 / 63)
    found, classes, _ = toxicity.sample(documents, known, max_rows=10, max_chars=20)
    assert 15 <= len(found) <= 20 and {*classes} == {0, 1}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_query_on_the_held_out_third(spark):
    found = QUERIES["op2_toxicity"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    assert found.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    rows = found.join(labels, "doc_id").filter("held_out").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("score"))).alias("toxic"),
        F.avg(F.when(F.col("toxic") == 0, F.col("score"))).alias("clean"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false"),
    )
    row = rows.first()
    assert row.toxic > row.clean + 0.2 and row.false < 0.05


def test_fit_takes_little_memory_beside_its_ngrams():
    """The driver fits, beside the JVM: what a step takes on the way must not be many times the n-grams."""
    import tracemalloc

    r = random.Random(3)
    words = ["".join(r.choice(SYLLABLES) for _ in range(5)) for _ in range(60_000)]
    texts = [" ".join(words[at : at + 100]) for at in range(0, len(words), 100)]
    kept = 4 * int(toxicity.grams(sorted(set(words)))[1].sum())
    tracemalloc.start()
    toxicity.train(texts, [i % 2 for i in range(len(texts))], epochs=12)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * kept + (40 << 20), (peak, kept)


def test_blocks_do_not_change_a_bit(monkeypatch):
    texts, labels = corpus(60, 5)
    whole = toxicity.train(texts, labels, epochs=12)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    parts = toxicity.train(texts, labels, epochs=12)
    assert whole.bias == parts.bias and whole.gram_scores.tobytes() == parts.gram_scores.tobytes()


def test_model_is_fitted_in_a_task(spark, monkeypatch):
    """The driver's memory does not hold the sample: it gets the finished model."""
    texts, labels = corpus(200, 6)
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = spark.createDataFrame([(i, c) for i, c in enumerate(labels)], "doc_id long, toxic int")
    of = known.filter("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1").toDF("id", "label")
    here = toxicity.fit(*toxicity.sample(documents.toDF("id", "text"), of))
    empty = queries.toxicity_model(documents.limit(0), known)
    assert scores(empty, ["a"]).tolist() == scores(toxicity.fit([], [], 0.25), ["a"]).tolist()

    def fit(*args):
        raise AssertionError("fitted on the driver")

    monkeypatch.setattr(toxicity, "fit", fit)
    model = queries.toxicity_model(documents, known)
    assert scores(model, texts) == pytest.approx(scores(here, texts), abs=1e-3)
    assert max(scores(model, texts)) > 0.7
