"""Fingerprints against a brute-force version; edited texts and likeness."""

import hashlib
import random
import struct
from collections import Counter

import pytest
import xxhash
from helpers import AWKWARD, awkward, prose

from fareflow.llm import imatch

BAND = (0.01, 0.5)
SIGNS = ".,;:!?\"'()[]{}*&%$#"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_words(text):
    import re

    words = re.split(r"[ \t\n\x0b\f\r]+", text.lower())
    return sorted({signed(xxhash.xxh64_intdigest(w.strip(SIGNS).encode(), seed=42)) for w in words})


def hash_all(numbers):
    seed = 42
    for n in numbers:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", n), seed=seed)
    return seed


def prints(texts, corpus):
    held = Counter(t for text in corpus for t in hash_words(text))
    low, high = BAND[0] * len(corpus), max(1.0, BAND[1] * len(corpus))
    out = []
    for text in texts:
        terms = hash_words(text)
        found = [t for t in terms if low <= held[t] <= high]
        marks, shift, number, first = "", 0, 0, []
        for bits, subsets in imatch.SUBSETS:
            for j in range(subsets):
                members = [t for t in found if (t % (1 << 64)) >> shift & ((1 << bits) - 1) == j]
                first += [signed(hash_all(members))] if members and not number else []
                marks += f"{(number + j) << 32 | hash_all(members) & 0x7FFFFFFF:010x}" if members else ""
            shift, number = shift + bits, number + subsets
        out.append(f"{hash_all(sorted(first) or terms):016x}:{marks}")
    return out


def test_against_brute_force(spark):
    rows = [(10 * i, prose(i // 3 if i % 3 else i, 10 + i)) for i in range(60)] + [(1, None), (2, ""), (3, "one"), (4, "É ß\x0b中 😀")]
    random.Random(1).shuffle(rows)
    found = {r.doc_id: r for r in imatch.compare_with_edited(awkward(spark, rows).repartition(5), BAND).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    texts = [t for _, t in ordered]
    edited = []
    for n, text in enumerate(texts):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + texts[(n + 1) % len(texts)][:half])
    own, other = prints(texts, texts), prints(edited, texts)
    for n, (i, text) in enumerate(ordered):
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited[n].encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (own[n], other[n])
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert (r.near_next == 1) == (own[n][:16] == own[(n + 1) % len(own)][:16])
    assert len(found) == len(rows)
    near = [found[i].near_edited > 0 for i, t in ordered if len(t) > 100]
    assert sum(near) > 0.8 * len(near)


def test_rows_out_of_the_ordinary(spark):
    found = imatch.compare_with_edited(awkward(spark, AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    equal = {r.fingerprint for r in found if r.doc_id in (1, 6)}
    assert len(equal) == 1
    twice = [r for r in found if r.doc_id == 6]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_single_document_and_empty_table(spark):
    text = prose(3, 21)
    (r,) = imatch.compare_with_edited(awkward(spark, [(5, text)])).collect()
    half = len(text) // 2
    assert r.near_next == 1 and r.edited_sha256 == hashlib.sha256((text[: len(text) - half] + text[:half]).encode()).hexdigest()
    assert imatch.compare_with_edited(awkward(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    imatch.compare_with_edited(awkward(spark, AWKWARD)).explain()
    text = capsys.readouterr().out
    assert "Python" not in text and "Arrow" not in text


def test_no_term_outside_the_band_enters(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choices(words[: 1 + i % 300], k=20)) for i in range(400)]
    held = Counter(w for t in texts for w in set(t.split()))
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {x[0] for x in imatch.lexicon(rows, 400, (0.01, 0.1)).collect()}
    assert found == {signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w, n in held.items() if 4 <= n <= 40}
    assert 50 < len(found) < 300


@pytest.mark.parametrize(("a", "b", "expected"), [([], [], 0.0), ([3], [3, 5 << 32], 0.5), ([3], [5], 0.0), ([3, 1 << 32], [5, 1 << 32], 0.5)])
def test_likeness(spark, a, b, expected):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([((1, a), (2, b))], "a struct<whole: long, marks: array<long>>, b struct<whole: long, marks: array<long>>")
    assert rows.select(imatch.likeness(F.col("a"), F.col("b"))).first()[0] == expected
    assert rows.select(imatch.likeness(F.col("a"), F.col("a"))).first()[0] == 1.0
