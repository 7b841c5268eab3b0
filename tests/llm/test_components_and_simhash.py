"""Components against union-find, SimHash against all pairs."""

import os
import random

import pytest
import xxhash
from helpers import AWKWARD, awkward, prose

from fareflow import context
from fareflow.llm import simhash
from fareflow.llm.components import components


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none"])
def test_components(spark, kind):
    r = random.Random(1)
    links = {
        "random": [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(0, 120)],
        "star": [(500, i) for i in range(400)] + [(500, 500), (3, 3)],
        "none": [],
    }[kind]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame([*links, (None, 4)], "a long, b long"))
    assert {x.node: x.root for x in found.collect()} == union_find(nodes, links)


def test_components_keep_one_round(spark):
    """Tables of earlier rounds go, and what Spark holds for them."""
    with context.scope(spark, "rounds"):
        found = components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"))
        folder = context.work_dir(spark).rsplit("/", 1)[0]
    assert len(os.listdir(folder.removeprefix("file:"))) == 1
    assert {x.root for x in found.collect()} == {0}


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    """Clusters of texts that differ in a word or two, unrelated ones, and copies."""
    r, out = random.Random(2), []
    for base in range(6):
        words = prose(base, 150).split()
        for _ in range(12):
            w = list(words)
            w[r.randrange(len(w))] = "changed"
            out.append(" ".join(w))
        out += [" ".join(words)] * 3
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(("max_bits", "shared"), [(2, 16), (2, 1), (1, 1), (1, 16), (0, 16)])
def test_near_duplicates_equal_all_pairs(spark, max_bits, shared):
    rows = near_texts() + [x for x in AWKWARD if x[0] is not None and x[0] not in (6, 7)]
    rows = [(100 + n, t) for n, (_, t) in enumerate(rows)]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= max_bits]
    expected = union_find(prints, links)
    found = simhash.near_duplicates(awkward(spark, rows), max_bits=max_bits, shared=shared).collect()
    assert {r.doc_id: r.bits % (1 << 64) for r in found} == prints
    assert {r.doc_id: r.component_id for r in found} == expected
    assert max_bits < 2 or len(set(expected.values())) < len(rows) - 10


def test_rows_repeat_and_ids_may_be_missing(spark):
    found = simhash.near_duplicates(awkward(spark, AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    by = {(r.doc_id, r.bits): r.component_id for r in found}
    assert by[6, [r.bits for r in found if r.doc_id == 1][0]] == 1
    assert {r.component_id for r in found if r.bits == 0} == {2}  # no words: texts of 2, 3, 4 and a row without id
    assert simhash.near_duplicates(awkward(spark, [])).count() == 0


def test_distances_beyond_two_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "bits long"), max_bits=3)
