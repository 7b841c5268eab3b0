"""What the operators share: Arrow passes over texts, a process-wide memo, code shipping."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows turned into Python objects at a time; an Arrow batch holds more.
SLICE = 1024

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


class Memo(dict):
    """A dict that computes missing values and starts anew at ``limit`` entries.

    It saves time only: what is asked for again after the restart is computed again.
    """

    def __init__(self, compute: Callable, limit: int = 500_000):
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._compute(key)
        return value


_KEPT: dict = {}


def kept(key: tuple, make: Callable):
    """The object of this key in this Python worker, such as a loaded vocabulary.

    Workers live on from job to job, so they keep the last one only.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Give the machine back what is freed: a process that lives on, driver or worker, keeps it otherwise."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def ship(spark: SparkSession, batch_rows: int = SLICE) -> None:
    """Let Python workers import this package from where the driver found it, and bound the rows of an Arrow batch.

    Batches wait on both sides of a worker; texts are long, so they hold few.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def words(texts: pa.Array, between: str | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words between ASCII white space, or one character: the distinct ones, codes of all, where each text's codes begin.

    A text may begin or end with an empty word; NULL is an empty text.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, between) if between else pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
    # Through numpy: a list made by Arrow builds a scalar for every word on the way.
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.concatenate(([0], ends))


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``values``; stretch i goes from ``starts[i]`` to ``starts[i + 1]``."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


class IdPool:
    """Ids of words, as stretches of one array.

    Beyond ``limit`` words only those stay that several batches held, the most frequent
    of them, half the limit at most: most words come once and fill it otherwise.
    """

    def __init__(self, limit: int):
        self._limit = limit
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._ids = np.zeros(1 << 16, dtype="<u4")
        self._from = np.zeros(1 << 14, dtype=np.int64)  # by slot; a slot ends where the next one begins
        self._seen = np.zeros(1 << 14, dtype=np.int32)  # batches that held the word, by slot
        self._used = 0

    def _thin(self) -> None:
        """Forget the words of one batch, and the less frequent ones beyond half the limit."""
        seen = self._seen[: len(self._slots)]
        stay = np.argsort(-seen, kind="stable")[: self._limit // 2]
        stay = np.sort(stay[seen[stay] > 1])
        begin, length = self._from[stay], self._from[stay + 1] - self._from[stay]
        ends = np.cumsum(length)
        ids = self._ids[np.repeat(begin - ends + length, length) + np.arange(length.sum())]
        words = list(self._slots)  # by slot
        words, seen = [words[slot] for slot in stay.tolist()], seen[stay] // 2
        self._forget()
        self.add(words, ids, ends)
        self._seen[: len(words)] = seen

    def unknown(self, words: list[str]) -> list[str]:
        """Those that have to be added before :meth:`ids_of`."""
        if len(self._slots) > self._limit:
            self._thin()
        return [w for w in words if w not in self._slots]

    def add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """New words, whose ids lie in ``ids`` one behind the other and end at ``ends``."""
        first, used = len(self._slots), self._used
        while used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while first + len(words) + 1 > len(self._from):
            self._from = np.concatenate([self._from, np.zeros_like(self._from)])
            self._seen = np.concatenate([self._seen, np.zeros_like(self._seen)])
        self._ids[used : used + len(ids)] = ids
        self._from[first + 1 : first + 1 + len(words)] = used + ends
        self._slots.update(zip(words, range(first, first + len(words))))
        self._used = used + len(ids)

    def ids_of(self, distinct: list[str], codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts given by :func:`words`, in one array, and where each text's ids begin."""
        known = np.fromiter(map(self._slots.__getitem__, distinct), np.int64, len(distinct))
        self._seen[known] += 1
        slots = known[codes]
        begin, length = self._from[slots], self._from[slots + 1] - self._from[slots]
        ends = np.concatenate(([0], np.cumsum(length)))
        return self._ids[np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])], ends[starts]


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def arrow_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    """Columns as a batch; those that are Arrow arrays already are passed on as they are."""
    made = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def map_slices(df: DataFrame, work: Callable, ddl: str, *args) -> DataFrame:
    """``work(slice, *args) -> list of columns`` over slices of a few hundred rows, in Arrow batches.

    ``work`` must be a module-level function; it sees a bounded number of rows at a time.
    """
    ship(df.sparkSession)
    schema = arrow_schema(ddl)

    def run(batches):
        for part in slices(batches):
            yield arrow_batch(work(part, *args), schema)

    return df.mapInArrow(run, ddl)
