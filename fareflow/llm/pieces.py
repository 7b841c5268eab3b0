"""SentencePiece encoding and decoding as a streaming search over prefixes (operator 9).

The search walks a text once.  For every prefix it keeps the back-pointer of the
path that survives there, and only prefixes within the longest piece can be
extended.  As soon as the paths to all of these run through one boundary, what
lies before it is final: its ids are emitted and its back-pointers dropped.

The model at hand is a merge model (BPE).  A path survives a piece if piece and
predecessor also come out of merging their joined text; one path survives for
each prefix, and it is the library's result.  Adding up piece scores, as for a
unigram model, would give other ids than the library does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: How models write a space, and what decoding shows for the unknown piece.
META = "▁"
UNKNOWN = " ⁇ "

NONE = -1  # no piece of the vocabulary
NOWHERE = -2  # no path survives to this boundary


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(chars: np.ndarray) -> np.ndarray:
    """A 64-bit number for each character."""
    x = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class PieceModel:
    """Pieces and scores of a model file, with encoding and decoding."""

    def __init__(self, path: str, encoding: bool = True):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in size]
        byte_of = {i: int(pieces[i][3:5], 16) for i in size if model.is_byte(i)}
        hidden = {i for i in size if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self._ids = {pieces[i]: i for i in size if i not in byte_of and i not in hidden}
        self._scores = {piece: model.get_score(i) for piece, i in self._ids.items()}
        self._longest = max(map(len, self._ids), default=1)
        self._window = 4 * self._longest
        self._unknown = model.unk_id()
        self._byte_ids = {b: i for i, b in byte_of.items()}
        self._shown = [
            bytes([byte_of[i]]) if i in byte_of else b"" if model.is_control(i) else
            UNKNOWN.encode() if model.is_unknown(i) else pieces[i].replace(META, " ").encode()
            for i in size
        ]
        if encoding:
            self._prepare(pieces)

    def _prepare(self, pieces: list[str]) -> None:
        """Tables that only encoding needs."""
        made = {p for p in self._ids if len(p) == 1 or self._merge(p) == [p]}
        # Every end of a piece, with the id where it is a piece itself: tells when longer starts are in vain.
        self._tails = {p[at:]: NONE for p in made for at in range(len(p))} | {p: self._ids[p] for p in made}
        self._pieces = pieces
        # All paths meet between two characters that stand together in no piece.
        self._joined = {p[at : at + 2] for p in self._ids for at in range(len(p) - 1)}
        self._apart = not any(META in p.lstrip(META) or "\n" in p for p in self._ids)
        # Sums of all heads of pieces, for looking up many places at once.
        self._chars = np.array(sorted({ord(c) for p in made for c in p}), "<u4")
        mixed = dict(zip(map(chr, self._chars.tolist()), _mixed(self._chars).tolist()))
        heads: dict[int, int] = {}
        for piece in made:
            total = 0
            for char in piece:
                total = (total * int(_BASE) + mixed[char]) % (1 << 64)
                heads.setdefault(total, NONE)
            heads[total] = self._ids[piece]
        self._head_sums = np.array(sorted(heads), np.uint64)
        self._head_ids = np.array([heads[x] for x in self._head_sums.tolist()])
        self._chars = np.array(sorted(ord(p) for p in made if len(p) == 1), "<u4")
        self._agree = common.Memo(self._stay_apart, 2_000_000)
        self._known = common.IdPool(600_000)

    def _merge(self, text: str) -> list[str]:
        """The merge rule on a text of two pieces at most: best score first, then leftmost."""
        parts = list(text)
        while True:
            scored = [(s, -i) for i, p in enumerate(zip(parts, parts[1:])) if (s := self._scores.get(p[0] + p[1])) is not None]
            if not scored:
                return parts
            at = -max(scored)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stay_apart(self, pair: int) -> bool:
        left, right = self._pieces[pair >> 32], self._pieces[pair & 0xFFFFFFFF]
        return self._merge(left + right) == [left, right]

    def encode_stretch(self, text: str) -> list[int]:
        """Ids of a text, emitted window by window."""
        if (whole := self._tails.get(text, NONE)) != NONE:
            return [whole]
        out: list[int] = []
        base, before, room = 0, NONE, self._window
        while base < len(text):
            part = text[base : base + room]
            starts, last = self._walk(part, before)
            ends = [len(part)] if base + room >= len(text) else range(len(part) - self._longest + 1, len(part) + 1)
            shared = self._shared(starts, ends)
            if not shared:  # the paths have not met yet
                room *= 2
                continue
            for end in reversed(shared):
                out += [last[end]] if last[end] != NONE else self._outside(part[starts[end] : end])
            base, before, room = base + shared[0], last[shared[0]], self._window
        return out

    def _walk(self, text: str, before: int) -> tuple[list[int], list[int]]:
        """For each boundary of a window, where the piece of its surviving path begins, and which it is.

        ``before`` is the piece in front of the window.
        """
        look, agree = self._tails.get, self._agree
        starts, last = [0], [before]
        for end in range(1, len(text) + 1):
            start, found = end - 1, NOWHERE
            piece = look(text[start:end])
            if piece is None:  # a character outside the vocabulary takes part in no merge
                found, piece = start, NONE
            while found == NOWHERE and piece is not None:
                if piece != NONE and starts[start] != NOWHERE and (last[start] == NONE or agree[last[start] << 32 | piece]):
                    found = start
                elif start == 0:
                    break
                else:
                    start -= 1
                    piece = look(text[start:end])
            starts.append(found)
            last.append(NONE if found == NOWHERE else piece)
        return starts, last

    @staticmethod
    def _shared(starts: list[int], ends) -> list[int]:
        """Boundaries that the paths to all ``ends`` share, the last one first."""
        shared = None
        for end in ends:
            if starts[end] == NOWHERE:
                continue
            path = []
            while end > 0:
                path.append(end)
                end = starts[end]
            shared = path if shared is None else [e for e in shared if e in path]
        return shared or []

    def _outside(self, char: str) -> list[int]:
        return [self._byte_ids[b] for b in char.encode()] if self._byte_ids else [self._unknown]

    def encode_written(self, text: str) -> list[int]:
        """Ids of a text in the model's writing, stretch by stretch."""
        joined, begin, out = self._joined, 0, []
        for at in range(1, len(text)):
            if text[at - 1 : at + 1] not in joined:
                out += self.encode_stretch(text[begin:at])
                begin = at
        return out + self.encode_stretch(text[begin:])

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return self.encode_written((" " + text).replace(" ", META)) if text else []

    def _candidates(self, chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All places of pieces in words that lie one behind the other: place, length, piece.

        ``ends`` has the end of each character's word.  Places are followed for
        as long as some piece begins like the text there.
        """
        codes = _mixed(chars)
        at, found = np.arange(len(chars)), []
        sums = np.zeros(len(chars), np.uint64)
        for length in range(1, self._longest + 1):
            sums = sums * _BASE + codes[at + length - 1]
            place = np.minimum(np.searchsorted(self._head_sums, sums), len(self._head_sums) - 1)
            hit = self._head_sums[place] == sums
            at, sums, piece = at[hit], sums[hit], self._head_ids[place[hit]]
            found.append((at[piece != NONE], np.full((piece != NONE).sum(), length), piece[piece != NONE]))
            more = at + length < ends[at]
            at, sums = at[more], sums[more]
        return tuple(np.concatenate(x) for x in zip(*found))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short words in one array, and where each word's ids end.

        The search of :meth:`encode_stretch`, step by step for all words at once.
        Long words and those with characters outside the vocabulary take their
        own way.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(lengths) - lengths
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        word_of = np.repeat(np.arange(len(words)), lengths)
        alone = lengths > self._window
        alone[word_of[~np.isin(chars, self._chars)]] = True
        # Boundary k of a word lies at begin + word + k.
        starts, last = np.full(len(chars) + len(words), NOWHERE), np.full(len(chars) + len(words), NONE)
        starts[begin + np.arange(len(words))] = 0
        at, size, piece = self._candidates(chars, np.repeat(begin + lengths, lengths))
        word = word_of[at]
        at, size, piece, word = (x[~alone[word]] for x in (at, size, piece, word))
        step = (at - begin[word] + size) * (self._longest + 1) + size  # by end, then by length
        order = np.argsort(step, kind="stable")
        left, right, piece = (at + word)[order], (at + word + size)[order], piece[order]
        cuts = np.flatnonzero(np.diff(step[order], prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            some = a + np.flatnonzero((starts[right[a:b]] == NOWHERE) & (starts[left[a:b]] != NOWHERE))
            before = last[left[some]]
            pairs, which = np.unique(before << 32 | piece[some], return_inverse=True)
            apart = np.fromiter((p < 0 or self._agree[p] for p in pairs.tolist()), bool, len(pairs))
            some = some[apart[which]]
            starts[right[some]], last[right[some]] = left[some], piece[some]
        # Back from the ends, all words at once.
        own, now = np.arange(len(words)), begin + np.arange(len(words)) + lengths
        alone |= starts[now] == NOWHERE
        own, now = own[~alone & (lengths > 0)], now[~alone & (lengths > 0)]
        steps = []
        while len(own):
            steps.append((own, last[now]))
            now = starts[now]
            go_on = now != begin[own] + own
            own, now = own[go_on], now[go_on]
        singles = {int(i): self.encode_written(words[i]) for i in np.flatnonzero(alone)}
        counts = np.bincount(np.concatenate([o for o, _ in steps] or [np.zeros(0, int)]), minlength=len(words))
        for i, ids in singles.items():
            counts[i] = len(ids)
        ends = np.cumsum(counts)
        out = np.zeros(ends[-1] if len(ends) else 0, "<u4")
        for back, (own, ids) in enumerate(steps):
            out[ends[own] - 1 - back] = ids
        for i, ids in singles.items():
            out[ends[i] - len(ids) : ends[i]] = ids
        return out, ends

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts in one array, and where each text's ids begin.

        Words are what stands between single spaces, or begins a line; each distinct
        one is encoded once.  Texts with runs of spaces, or the mark itself, are
        encoded one by one.
        """
        odd = pc.or_(pc.match_substring_regex(texts, f"^ |  |{META}"), pc.equal(texts, ""))
        odd = pc.fill_null(odd, True).to_numpy(zero_copy_only=False) if self._apart else np.ones(len(texts), bool)
        plain = pc.replace_substring(pc.if_else(pa.array(odd), "", texts), "\n", " \n")
        distinct, codes, starts = common.words(plain, " ")
        new = self._known.unknown(distinct)
        lines = [w for w in new if w[:1] == "\n"]
        self._known.add(*self._with_break(lines))
        inner = [w for w in new if w[:1] != "\n"]
        self._known.add(inner, *self.encode_words([META + w for w in inner]))
        ids, begins = self._known.ids_of(distinct, codes, starts)
        if not odd.any():
            return ids, begins
        parts = np.split(ids, begins[1:-1])
        for row in np.flatnonzero(odd):
            parts[row] = np.array(self.encode(texts[int(row)].as_py() or ""), "<u4")
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def _with_break(self, lines: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Words that begin a line, with the ids of the line break in front of their own."""
        ids, ends = self.encode_words([w[1:] for w in lines])
        front = np.array(self.encode_written("\n"), "<u4")
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return lines, np.insert(ids, np.repeat(begins, len(front)), np.tile(front, len(lines))), ends + len(front) * np.arange(1, len(lines) + 1)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are put together, the space in front goes."""
        text = b"".join(map(self._shown.__getitem__, ids))
        return text.removeprefix(b" ").decode("utf-8", "replace")


def _model(path: str, encoding: bool) -> PieceModel:
    return common.kept(("pieces", path, encoding), lambda: PieceModel(path, encoding))


def _encode(part: pa.RecordBatch, path: str) -> list:
    model = _model(path, True)
    ids, begins = model.encode_all(part.column("_text"))
    return [part.column("_id"), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view("<i4")))]


def _decode(part: pa.RecordBatch, path: str) -> list:
    model = _model(path, False)
    found = [model.decode(ids or []) for ids in part.column("ids").to_pylist()]
    return [part.column("doc_id"), part.column("ids"), found]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row: ids are the library's for the whole text.

    A NULL or empty text has no ids; a repeated row gives a repeated result;
    other columns are not read.  The window of the search, not the text, bounds
    what is kept besides text and ids.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return common.map_slices(rows, _encode, "doc_id long, ids array<int>", model)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, text`` of the rows of :func:`encode`.

    Gives the encoded text back, but for the model's own space mark, which comes
    back as a space; no ids or NULL give an empty text.
    """
    return common.map_slices(encoded.select("doc_id", "ids"), _decode, "doc_id long, ids array<int>, text string", model)
