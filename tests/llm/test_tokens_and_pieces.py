"""Token counts against a brute-force longest match; pieces against the library."""

import random

import public_tokenizers
import pyarrow as pa
import sentencepiece
from helpers import AWKWARD, awkward, prose

from fareflow.llm import pieces, tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def longest_match(vocabulary: set, word: bytes) -> int:
    count = at = 0
    while at < len(word):
        length = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in vocabulary), 1)
        at += length
        count += 1
    return count


def test_automaton_on_random_vocabularies():
    r = random.Random(3)
    for _ in range(400):
        vocabulary = [bytes(r.choice(b"abc") for _ in range(r.randint(1, 7))) for _ in range(r.randint(0, 12))]
        automaton = tokens.Automaton(vocabulary)
        for _ in range(20):
            word = bytes(r.choice(b"abcd") for _ in range(r.randint(0, 25)))
            assert automaton.count(word) == longest_match(set(vocabulary), word)


def test_counts_of_awkward_rows(spark):
    vocabulary = set(tokens.read_ranks(RANKS))
    expected = sorted(
        (str(i), len((t or "").encode().split()), sum(longest_match(vocabulary, b" " + w) for w in (t or "").encode().split()))
        for i, t in AWKWARD
        if len(t or "") < 20000
    )
    found = tokens.count_tokens(awkward(spark, [x for x in AWKWARD if len(x[1] or "") < 20000]), RANKS).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in found) == expected
    assert tokens.count_tokens(awkward(spark, []), RANKS).count() == 0


def test_pieces_equal_the_library():
    library, model = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.PieceModel(MODEL)
    r = random.Random(5)
    texts = ["".join(r.choice("abcdehint ▁ \n\t.,éß中😀019AZ'<>") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += [prose(s, 200) for s in range(5)] + ["", " ", "a" * 700, "in" * 400, " " * 40 + "x" + " " * 20, "=" * 99, "abc" * 999]
    ids, begins = model.encode_all(pa.array([*texts, None]))
    for text, a, b in zip(texts, begins, begins[1:]):
        assert ids[a:b].tolist() == library.encode(text) == model.encode(text), text
        assert model.decode(ids[a:b].tolist()) == text.replace("▁", " ")
    assert begins[-1] == begins[-2]


def test_a_small_window_commits_the_same(monkeypatch):
    model = pieces.PieceModel(MODEL)
    texts = [prose(s, 40).replace(" ", "").lower() for s in range(20)] + ["the" * 100, "ab" * 200]
    expected = [model.encode_stretch("▁" + t) for t in texts]
    model._window = model._longest + 1
    assert [model.encode_stretch("▁" + t) for t in texts] == expected


def test_round_trip_of_awkward_rows(spark):
    there = pieces.encode(awkward(spark, AWKWARD), MODEL)
    back = pieces.decode(there, MODEL).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in AWKWARD)
    assert pieces.decode(pieces.encode(awkward(spark, []), MODEL), MODEL).count() == 0
