"""Packing: every id in one piece, no gaps, hardly any padding."""

import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import AWKWARD, awkward, prose
from tokenizers import Tokenizer

from fareflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def encoded(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_equal_whole_texts(tokenizer):
    import random

    r = random.Random(5)
    bits = [*"abcXYZ   \n\t\r.,'sé́İΣς ß中😀09_-<|>\x0b\x1c\x85", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(2000)]
    texts += [prose(s, 300) for s in range(5)]
    encoder = packing.WordEncoder(PATH, limit=300)
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        for text, ids in zip(some, encoder.encode_all(pa.array([*some, None]))):
            assert ids.tolist() == encoded(tokenizer, text)[:-1], text


def check(rows, documents, tokenizer, capacity):
    """The contract, by brute force."""
    expected = defaultdict(int)
    pieces_of = defaultdict(list)
    for i, text in documents:
        expected[i, tuple(encoded(tokenizer, text))] += 1
        pieces_of[i].append(encoded(tokenizer, text))
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    for i, texts in pieces_of.items():
        found = defaultdict(int)
        for r in by_doc[i]:
            fits = [t for t in texts if len(t) == r.doc_tokens and crc(t[r.start : r.start + r.length]) == r.ids_crc32]
            assert fits, r
            found[r.start, r.length] += 1
        assert sum(r.length for r in by_doc[i]) == sum(map(len, texts))
    assert sum(r.length for r in rows) == sum(len(k) * n for (_, k), n in expected.items())
    return padding


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


@pytest.mark.parametrize(("capacity", "windows", "parts"), [(64, 2, 9), (4096, 32, 3), (100, 5, 70), (1, 1, 2)])
def test_contract(spark, tokenizer, capacity, windows, parts):
    documents = [(i, prose(i, i % 40)) for i in range(120)] + AWKWARD if capacity > 1 else AWKWARD[:4]
    docs = awkward(spark, documents).repartition(parts)
    rows = packing.pack(docs, PATH, capacity=capacity, windows=windows).collect()
    assert check(rows, documents, tokenizer, capacity) == 0


def test_merge_rounds(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    documents = [(i, prose(i, 7)) for i in range(40)]
    rows = packing.pack(awkward(spark, documents).repartition(13), PATH, capacity=32, windows=2).collect()
    assert check(rows, documents, tokenizer, 32) == 0


def test_empty_table(spark):
    assert packing.pack(awkward(spark, []), PATH).count() == 0


def test_best_fit_and_top_up():
    packer = packing.Packer(10, 2)
    for doc, tokens in enumerate([6, 7, 3, 5]):
        packer.add(doc, 0, bytes(4 * tokens), tokens)
    # 3 goes to the window of 7 and fills it; 5 fits neither 6 nor opens more than two windows at a time.
    assert [[(p[0], len(p[2]) // 4) for p in w] for w in packer.take_closed()] == [[(1, 7), (2, 3)]]
    packer.add(4, 0, bytes(4 * 6), 6)
    assert [[(p[0], len(p[2]) // 4) for p in w] for w in packer.take_closed()] == [[(0, 6), (4, 4)]]
    assert [sum(len(p[2]) // 4 for p in w) for w in packer.leftovers()] == [7]


def test_few_texts_are_encoded_at_a_time(spark):
    """A worker holds the ids of one slice in several arrays, so slices are small."""
    assert packing.pack(spark.createDataFrame([(i, "a b") for i in range(600)], "doc_id long, text string"), PATH).count() >= 600
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512


def test_frequent_words_stay_when_the_pool_is_full(tokenizer):
    """A stream of words that come once must not push out those of every batch."""
    encoder, asked = packing.WordEncoder(PATH, limit=200), []
    learn = encoder._learn
    encoder._learn = lambda new: (asked.extend(new), learn(new))
    often = [f"word{'abcdefghij'[i]}" for i in range(10)]
    for batch in range(30):
        once = [prose(1000 * batch + i, 1).lower() + "xyzuvw"[batch % 6] * (1 + batch // 6) for i in range(40)]
        text = " ".join(["Often", "often,", "été", "ÉTÉ;!", "e\u0301,", "x1,", *often, *once])
        assert encoder.encode_all(pa.array([text]))[0].tolist() == encoded(tokenizer, text)[:-1]
        assert len(encoder._pool._slots) <= 200 + 60
    assert all(asked.count(word) == 1 for word in often)


def test_words_of_letters_and_signs_are_learnt_together(tokenizer):
    """No call of the tokenizer for each word with signs behind it."""
    encoder = packing.WordEncoder(PATH)
    calls, ids = [], encoder._ids
    encoder._ids = lambda text: (calls.append(text), ids(text))[1]
    text = " ".join(prose(i, 1).strip(".").lower() + sign for i in range(500) for sign in ("", "***", "!!", ",.", "é$$$"))
    assert encoder.encode_all(pa.array([text]))[0].tolist() == encoded(tokenizer, text)[:-1]
    assert len(calls) < 20
