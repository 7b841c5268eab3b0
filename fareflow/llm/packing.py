"""Packing token sequences into windows, online and in bounded space (operator 4).

Each partition keeps a fixed number of open windows.  A document's last part
(its full windows stand alone) goes to the open window it fits best.  When it
fits none, the fullest window is topped up with its head and emitted, so closed
windows carry no padding.  The windows left open at the end of a partition are
packed again in groups of partitions, round by round, until one group is left;
its last, partial window is cut at powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import materialize
from . import common

#: Bytes of one id: unsigned, little-endian, 32 bits.
WIDTH = 4
#: Partitions whose open windows are merged in one task.
FAN_IN = 64
#: Texts encoded at a time; the ids of all their words are held in several arrays.
TEXTS = 512
#: Signs often found behind a word; no letter before them or mark behind them joins them.
SIGNS = ".,;:!?#$%&*"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary, part long"
)


class WordEncoder:
    """Ids of whole texts, word by word, equal to encoding the text at once.

    The tokenizer drops white space and never joins across it, so each distinct
    word is encoded once.  It takes a run of letters, and a run of signs, as one
    stretch, and leaves lower-case ASCII letters as they are, so such a stretch
    goes to its model at once.  Other letters, with a run of signs behind them or
    not, are encoded many words at a time and told apart by the tokens that end a
    stretch.  A text that may spell a special token is encoded whole.
    """

    def __init__(self, path: str, word_end: str = "</w>", limit: int = 300_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._final = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._final[[i for token, i in vocabulary.items() if token.endswith(word_end)]] = True
        self._pool = common.IdPool(limit)
        self._signs = common.Memo(lambda signs: self._ids(signs).tolist(), 10_000)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        # Case differs for nothing but the words remembered: the tokenizer lowers them anyway.
        distinct, codes, starts = common.words(pc.ascii_lower(texts))
        self._learn(self._pool.unknown(distinct))
        ids, begins = self._pool.ids_of(distinct, codes, starts)
        found = np.split(ids, begins[1:-1])
        for row in np.flatnonzero(pc.fill_null(pc.match_substring(texts, "<|"), False).to_numpy(zero_copy_only=False)):
            found[row] = self._ids(texts[int(row)].as_py())
        return found

    def _learn(self, new: list[str]) -> None:
        """Encode words not seen before, many at a time."""
        ascii_words, each, letters, ends, mixed = [], [], [], [], []
        for word in new:
            stem = word.rstrip(SIGNS)
            if not stem.isalpha() or "İ" in stem:
                mixed.append(word)
            elif stem.isascii():
                ids = [token.id for token in self._model.tokenize(stem)]
                if len(stem) < len(word):
                    ids += self._signs[word[len(stem) :]]
                ascii_words.append(word)
                each.append(ids)
            else:
                (letters if stem == word else ends).append(word)
        self._add(ascii_words, each)
        for words, stretches in ((letters, 1), (ends, 2)):
            for at in range(0, len(words), 4096):
                some = words[at : at + 4096]
                ids = self._ids(" ".join(some))
                self._keep(some, ids, np.flatnonzero(self._final[ids])[stretches - 1 :: stretches] + 1)
        self._add(mixed, [self._ids(word).tolist() for word in mixed])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _add(self, words: list[str], each: list[list[int]]) -> None:
        ids = np.fromiter(chain.from_iterable(each), "<u4")
        self._pool.add(words, ids, np.cumsum([len(some) for some in each], dtype=np.int64))

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        if len(ends) == len(words):
            self._pool.add(words, ids, ends)
        else:
            self._add(words, [self._ids(word).tolist() for word in words])


class Packer:
    """The open windows of one task."""

    def __init__(self, capacity: int, windows: int):
        self._capacity, self._open_limit = capacity, windows
        self._open: list[tuple[int, list]] = []  # tokens, pieces
        self.closed: list[list] = []

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        """Place ids of a document from ``start`` on."""
        whole = self._capacity * WIDTH
        while len(ids) >= whole:
            self.closed.append([(doc_id, start, ids[:whole], doc_tokens)])
            ids, start = ids[whole:], start + self._capacity
        need = len(ids) // WIDTH
        if not need:
            return
        fitting = [i for i, (used, _) in enumerate(self._open) if used + need <= self._capacity]
        if fitting:
            best = max(fitting, key=lambda i: self._open[i][0])
        elif len(self._open) < self._open_limit:
            self._open.append((0, []))
            best = len(self._open) - 1
        else:
            fullest = max(range(len(self._open)), key=lambda i: self._open[i][0])
            used, pieces = self._open.pop(fullest)
            head = (self._capacity - used) * WIDTH
            self.closed.append([*pieces, (doc_id, start, ids[:head], doc_tokens)])
            self.add(doc_id, start + head // WIDTH, ids[head:], doc_tokens)
            return
        used, pieces = self._open[best]
        pieces.append((doc_id, start, ids, doc_tokens))
        if used + need == self._capacity:
            self.closed.append(pieces)
            self._open.pop(best)
        else:
            self._open[best] = (used + need, pieces)

    def take_closed(self) -> list[list]:
        done, self.closed = self.closed, []
        return done

    def leftovers(self) -> list[list]:
        """The windows still open, the fullest first."""
        return [p for _, p in sorted(self._open, key=lambda w: -w[0])]


def _powers_of_two(pieces: list) -> Iterator[list]:
    """One partial window as windows whose lengths are powers of two."""
    left = sum(len(ids) for _, _, ids, _ in pieces) // WIDTH
    todo = list(pieces)
    while left:
        room = size = 1 << (left.bit_length() - 1)
        window = []
        while room:
            doc_id, start, ids, total = todo.pop(0)
            head = ids[: room * WIDTH]
            window.append((doc_id, start, head, total))
            room -= len(head) // WIDTH
            if len(head) < len(ids):
                todo.insert(0, (doc_id, start + len(head) // WIDTH, ids[len(head) :], total))
        yield window
        left -= size


def _rows(windows: list[list], number, keep_ids: bool, part: int, schema: pa.Schema) -> pa.RecordBatch:
    """Windows as rows; ``number`` gives sequence ids, or nothing for windows that are still open."""
    rows = []
    for pieces in windows:
        offset, sequence = 0, number()
        for doc_id, start, ids, total in pieces:
            length = len(ids) // WIDTH
            rows.append((doc_id, start, length, zlib.crc32(ids), total, sequence, offset, ids if keep_ids else None, part))
            offset += length
    return common.arrow_batch(list(zip(*rows)) if rows else [[] for _ in schema], schema)


class _Numbers:
    """Sequence ids that no other task of any round gives: round, task, count."""

    def __init__(self, level: int, part: int):
        self._next = level << 56 | part << 28

    def __call__(self) -> int:
        self._next += 1
        return self._next


def _first_pass(path: str, end_id: int, capacity: int, windows: int, schema: pa.Schema):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        # Workers live on: what jobs before this one have freed goes back to the machine.
        common.release()
        encoder = common.kept(("words", path), lambda: WordEncoder(path))
        end = end_id.to_bytes(WIDTH, "little")
        packer, number = Packer(capacity, windows), _Numbers(0, part)
        for some in common.slices(batches, TEXTS):
            for doc_id, ids in zip(some.column("_id").to_pylist(), encoder.encode_all(some.column("_text")), strict=True):
                packer.add(doc_id, 0, ids.tobytes() + end, len(ids) + 1)
            yield _rows(packer.take_closed(), number, False, part, schema)
        yield _rows(packer.leftovers(), lambda: None, True, part, schema)

    return run


def _merge(level: int, capacity: int, windows: int, last: bool, schema: pa.Schema):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        part = rows[0]["group"]
        rows.sort(key=lambda r: (-r["length"], r["part"], r["doc_id"] is None, r["doc_id"] or 0, r["start"]))
        packer, number = Packer(capacity, 1 if last else windows), _Numbers(level, part)
        for r in rows:
            packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
        out = [_rows(packer.take_closed(), number, False, part, schema)]
        left = packer.leftovers()
        if last:
            out += [_rows([*_powers_of_two(p)], number, False, part, schema) for p in left]
        else:
            out.append(_rows(left, lambda: None, True, part, schema))
        return pa.Table.from_batches(out, schema)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = 4096,
    windows: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id of every document, and ``end_id`` behind it, lies in exactly one
    piece; a sequence holds at most ``capacity`` ids and its offsets have no
    gaps.  Only the very last sequences are shorter than ``capacity``, and those
    are powers of two.  A NULL or empty text is its end id alone; a repeated row
    or id is packed again; a document longer than a window takes several.  An
    empty table gives no rows.  A task holds ``windows`` open windows, a merge
    task those of ``FAN_IN`` partitions; sequence ids are unique, not gapless.
    """
    common.ship(docs.sparkSession, TEXTS)
    schema = common.arrow_schema(PIECES)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    made = materialize(rows.mapInArrow(_first_pass(tokenizer, end_id, capacity, windows, schema), PIECES), "pack")
    result = made.filter("sequence_id is not null")
    left, level = made.filter("sequence_id is null"), 1
    top = left.agg(F.max("part")).first()[0]
    while top is not None:
        groups = top // FAN_IN + 1
        fold = left.withColumn("group", F.expr(f"part div {FAN_IN}"))
        merged = fold.groupBy("group").applyInArrow(_merge(level, capacity, windows, groups == 1, schema), PIECES)
        made = materialize(merged, "pack-merge")
        result = result.unionByName(made.filter("sequence_id is not null"))
        left, level = made.filter("sequence_id is null"), level + 1
        top = None if groups == 1 else groups - 1
    return result.drop("ids", "part")
