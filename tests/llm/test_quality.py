"""Quality rules against plain Python and, on the driver's tables, against SQL."""

import os
import re
from collections import Counter

import pytest
from helpers import AWKWARD, awkward, prose

from fareflow.llm import quality
from fareflow.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
JUNK = [
    (20, " ".join(["Der"] * 80)),
    (21, "\n".join([prose(3, 12)] * 9)),
    (22, " ".join(f"{w}%%%" for w in prose(4, 80).split())),
    (23, prose(5, 90).upper()),
    (24, " ".join(str(7919 * i) for i in range(90))),
    (25, prose(6, 200) + " " + prose(6, 40)),
    (26, "a b c a b c"),
    (27, "a a a a"),
    (28, "ab c d a bc d ab cd"),
    (29, " \t lead " + prose(7, 70) + "  \r\n\n"),
]


def plain(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    joined = "".join(words)
    n = {
        "n_words": len(words),
        "word_chars": len(joined),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", joined)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_letters": sum(c.isalpha() for c in joined),
        "n_capitals": sum(c.isupper() for c in joined),
    }
    broken = [
        n["n_words"] < 50,
        100 * n["n_repeat_words"] > 50 * n["n_words"],
        10 * n["n_symbols"] > n["n_words"],
        not 3 * n["n_words"] <= n["word_chars"] <= 10 * n["n_words"],
        10 * n["n_dup_lines"] > 4 * n["n_lines"],
        100 * n["n_letters"] < 60 * n["word_chars"],
        2 * n["n_capitals"] > n["n_letters"],
    ]
    return (*n.values(), sum(b << i for i, b in enumerate(broken)))


def test_against_plain_python(spark):
    rows = AWKWARD + JUNK + [(100 + i, prose(i, 30 + 7 * i)) for i in range(30)]
    docs = awkward(spark, rows)
    found = quality.ledger(docs)
    assert found.columns == [c for c in docs.columns if c != "text"] + [*quality.MEASURES, "failed"]
    got = sorted((tuple(r) for r in found.select("doc_id", *quality.MEASURES, "failed").collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert sum(r[-1] == 0 for r in got) > 25


def test_a_very_long_text(spark):
    text = prose(1, 60_000) + " " + prose(1, 500)
    assert len(text) > 400_000
    found = quality.ledger(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(found)[1:] == plain(text)


def test_policies_and_ablations(spark):
    entries = spark.createDataFrame([(i, f) for i, f in enumerate([0, 0, 1, 1, 2, 3, 4, 5, 64, 127])], "doc_id long, failed long")
    assert [r.kept for r in quality.apply(entries, quality.BASE).orderBy("doc_id").collect()] == [True, True, False, False, False, False, True, False, True, False]
    lenient = quality.Policy("lenient", quality.FULL.mask, allowed=1)
    assert [r.kept for r in quality.apply(entries, lenient).orderBy("doc_id").collect()] == [True] * 5 + [False, True, False, True, False]
    masks = [r.failed for r in entries.collect()]
    expected = set()
    for policy in (quality.BASE, quality.FULL, lenient):
        for i, rule in enumerate(quality.RULES):
            if policy.mask >> i & 1:
                bits = [bin(m & policy.mask).count("1") for m in masks]
                without = [bin(m & policy.mask & ~(1 << i)).count("1") for m in masks]
                expected.add((policy.version, rule.name, sum(b > policy.allowed for b in bits), sum(m >> i & 1 for m in masks), sum(m & policy.mask == 1 << i for m in masks), sum(b > policy.allowed >= w for b, w in zip(bits, without))))
    found = quality.ablations(entries, [quality.BASE, quality.FULL, lenient])
    assert {tuple(r) for r in found.select("version", "rule", "rejected", "breaking", "alone", "kept_without").collect()} == expected
    assert quality.mask_of(["symbols", "few_words"]) == 5
    names = entries.filter("doc_id = 7").select(quality.broken_rules().alias("r")).first().r
    assert names == ["few_words", "symbols"]


def test_empty_table(spark):
    empty = quality.ledger(awkward(spark, []))
    assert empty.count() == 0 and quality.ablations(empty, [quality.FULL]).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    quality.apply(quality.ledger(awkward(spark, JUNK)), quality.FULL).explain()
    text = capsys.readouterr().out
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_query_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cursor = db.execute(ORACLE["op11_quality_rules"])
    names = [c[0] for c in cursor.description]
    found = QUERIES["op11_quality_rules"](spark, DATA)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")
def test_good_documents_are_kept_and_junk_is_not(spark):
    kept = QUERIES["op11_quality_rules"](spark, DATA).filter("not base_failed").select("doc_id", "kept")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = {(r.quality, r.kept): r["count"] for r in kept.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    share = {q: found.get((q, True), 0) / sum(found.get((q, k), 0) for k in (True, False)) for q in (0, 1)}
    assert share[1] > 0.97 and share[0] < 0.1
