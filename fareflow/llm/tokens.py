"""Token counts by greedy longest match, without building the pieces (operator 1).

The vocabulary becomes a trie.  Every node also knows, for the moment when the
text goes on in a way the trie does not, how many pieces greedy matching has
then settled (its *pops*) and which node holds the rest (its *failure link*).
A word is counted in one left-to-right walk, in time linear in its length.
"""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ROOT = 0
NONE = -1


class Automaton:
    """Linear-time greedy longest-match counter over byte strings.

    Every single byte counts as a piece, so matching never gets stuck and a byte
    that no piece covers is one token.
    """

    def __init__(self, vocabulary):
        step: dict[int, int] = {}
        whole, parent, label, depth = [False], [NONE], [0], [0]
        for piece in [*(bytes([b]) for b in range(256)), *vocabulary]:
            node = ROOT
            for byte in piece:
                child = step.get(node << 8 | byte)
                if child is None:
                    child = step[node << 8 | byte] = len(whole)
                    whole.append(False)
                    parent.append(node)
                    label.append(byte)
                    depth.append(depth[node] + 1)
                node = child
            whole[node] = node != ROOT
        pops, fail = [0] * len(whole), [NONE] * len(whole)
        for node in sorted(range(1, len(whole)), key=depth.__getitem__):  # shorter texts first
            if whole[node]:
                pops[node], fail[node] = 1, ROOT
                continue
            # What the parent's text settles, and then as far as the new byte needs it.
            settled, rest = pops[parent[node]], fail[parent[node]]
            while rest << 8 | label[node] not in step:
                settled += pops[rest]
                rest = fail[rest]
            pops[node], fail[node] = settled, step[rest << 8 | label[node]]
        self._step, self._pops, self._fail = step, pops, fail

    def count(self, word: bytes) -> int:
        step, pops, fail = self._step, self._pops, self._fail
        node, total = ROOT, 0
        for byte in word:
            while (child := step.get(node << 8 | byte)) is None:
                total += pops[node]
                node = fail[node]
            node = child
        while node != ROOT:
            total += pops[node]
            node = fail[node]
        return total


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def _counter(path: str) -> common.Memo:
    automaton = Automaton(read_ranks(path))
    return common.Memo(lambda word: automaton.count(b" " + word.encode()) if word else 0)


def _count(part, path: str) -> list:
    memo = common.kept(("tokens", path), lambda: _counter(path))
    distinct, codes, starts = common.words(part.column("_text"))
    lengths = np.fromiter(map(memo.__getitem__, distinct), np.int64, len(distinct))[codes]
    return [part.column("_id"), common.sums(lengths > 0, starts), common.sums(lengths, starts)]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every row.

    Words stand between ASCII white space and are matched with one space in
    front, as the vocabulary's word-initial pieces are written.  ``vocabulary``
    is a file all executors can read.  A NULL or empty text has 0 of both; a
    repeated row gives a repeated result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return common.map_slices(rows, _count, "doc_id long, n_words long, n_tokens long", vocabulary)
