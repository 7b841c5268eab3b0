"""Training of factorisation machines on blocks of rows.

``FMClassifier`` walks its rows one by one in every iteration.  Here the rows are
written once as blocks of a few thousand, and an iteration adds up their gradients
block by block with numpy.  Start, gradients and steps are those of ``FMClassifier``
(AdamW over all rows, the same convergence test), so the model is the same up to
the rounding of sums, and it is the model class of ``pyspark.ml`` that is returned.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import discard, materialize

#: Rows that one task trains on: what it holds of them in memory does not show in the size of their files.
ROWS_PER_TASK = 250_000
BLOCK = 4096
#: Features whose gradients are added up as one row.
CHUNK = 8192

#: Blocks of an Arrow batch, which waits whole on both sides of a Python worker.
BLOCKS_PER_BATCH = 16

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCKS = "labels binary, lengths binary, known binary, codes binary, vals binary"
_GRADIENTS = "chunk int, rows long, sums binary"


def spread(train: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal rows evenly to tasks where there are more than one task should train on.

    A scan makes tasks by the bytes of files, and a thousand times as many rows as
    expected may be in them, since feature columns compress well.
    """
    tasks = -(-train.count() // rows_per_task)
    return train if tasks <= 1 else train.repartition(max(tasks, train.sparkSession.sparkContext.defaultParallelism))


def fit(machine: FMClassifier, train: DataFrame) -> FMClassificationModel:
    """The model that ``machine`` fits, by AdamW over all rows and without regularisation."""
    label, features = machine.getLabelCol(), machine.getFeaturesCol()
    train = train.select(F.col(label).cast("double").alias(label), features)
    # Without an iteration the estimator gives the weights to start from.
    start = machine.copy({machine.maxIter: 0}).fit(train.limit(1))
    width, size = start.numFeatures, machine.getFactorSize()
    weights = np.concatenate([start.factors.toArray().ravel(), start.linear.toArray(), [start.intercept]])
    blocks = materialize(spread(train).mapInArrow(_blocks, _BLOCKS), "training-blocks")
    with batches_of(train.sparkSession, BLOCKS_PER_BATCH):
        weights = _descend(blocks, weights, width, size, machine.getMaxIter(), machine.getStepSize(), machine.getTol())
    discard(blocks)
    return _model(machine, start, weights, width, size)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _model(machine: FMClassifier, start: FMClassificationModel, weights: np.ndarray, width: int, size: int) -> FMClassificationModel:
    factors = DenseMatrix(width, size, weights[: width * size], isTransposed=True)
    linear = DenseVector(weights[width * size : -1])
    made = "org.apache.spark.ml.classification.FMClassificationModel"
    return machine._copyValues(FMClassificationModel(JavaWrapper._new_java_obj(made, start.uid, float(weights[-1]), linear, factors)))


def _descend(blocks: DataFrame, w: np.ndarray, width: int, size: int, iterations: int, step: float, tol: float) -> np.ndarray:
    """AdamW as ``FMClassifier`` does it."""
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, iterations + 1):
        rows, total = _gradient(blocks, w, width, size)
        if not rows:
            return w
        g = total / rows
        mean = 0.9 * mean + (1 - 0.9) * g
        square = 0.999 * square + (1 - 0.999) * g * g
        new = w - step * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.999**i)) + 1e-8)
        near = np.linalg.norm(w - new) < tol * max(np.linalg.norm(new), 1.0)
        w = new
        if near and i > 1:
            break
    return w


def _gradient(blocks: DataFrame, w: np.ndarray, width: int, size: int) -> tuple[int, np.ndarray]:
    """Number of rows and summed gradient; the driver gets each weight's sum once."""
    found = blocks.mapInArrow(_add_up(w, width, size), _GRADIENTS).groupBy("chunk").applyInArrow(_join, _GRADIENTS).collect()
    factors, linear, rows, intercept = np.zeros((width, size)), np.zeros(width), 0, 0.0
    for r in found:
        sums = np.frombuffer(r["sums"])
        if r["chunk"] < 0:
            rows, intercept = r["rows"], sums[0]
        else:
            part = sums.reshape(-1, size + 1)
            at = slice(r["chunk"] * CHUNK, r["chunk"] * CHUNK + len(part))
            factors[at], linear[at] = part[:, :size], part[:, size]
    return rows, np.concatenate([factors.ravel(), linear, [intercept]])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks: labels, entries of each row, the features a block has, and entries as (place in those, value)."""
    names = ["labels", "lengths", "known", "codes", "vals"]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            labels, vectors = some.column(0), some.column(1)
            if vectors.null_count:
                raise ValueError("a vector is NULL")
            y = labels.to_numpy(zero_copy_only=False)
            if labels.null_count or not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels have to be 0 or 1")
            kind, _, indices, values = vectors.flatten()
            lengths = values.value_lengths().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(y)), lengths)
            feature = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            feature[(kind.to_numpy() == 0)[row]] = indices.flatten().to_numpy()
            value = values.flatten().to_numpy()
            if not np.isfinite(value).all():
                raise ValueError("vectors have to be finite")
            there = value != 0
            known, codes = np.unique(feature[there], return_inverse=True)
            lengths = np.bincount(row[there], minlength=len(y))
            parts = [y, lengths.astype(np.int32), known, codes.astype(np.int32), value[there]]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names)


def _add_up(w: np.ndarray, width: int, size: int):
    """Gradients of a task's blocks, in chunks of features, and its number of rows with the intercept's under chunk -1."""

    def run(batches):
        factors, linear, intercept = w[: width * size].reshape(width, size), w[width * size : -1], w[-1]
        sums, rows, bias = np.zeros((width, size + 1)), 0, 0.0
        for batch in batches:
            for block in batch.to_pylist():
                y, lengths = np.frombuffer(block["labels"]), np.frombuffer(block["lengths"], np.int32)
                known, codes = np.frombuffer(block["known"], np.int64), np.frombuffer(block["codes"], np.int32)
                value = np.frombuffer(block["vals"])
                n, row = len(y), np.repeat(np.arange(len(y)), lengths)
                rated = factors[known][codes] * value[:, None]
                both = np.stack([np.bincount(row, rated[:, f], n) for f in range(size)], axis=1)
                raw = intercept + np.bincount(row, linear[known][codes] * value, n)
                raw += 0.5 * ((both * both).sum(axis=1) - np.bincount(row, (rated * rated).sum(axis=1), n))
                off = np.exp(-np.logaddexp(0, -raw)) - y
                pull = off[row] * value
                pulls = pull[:, None] * (both[row] - rated)
                added = [np.bincount(codes, pulls[:, f], len(known)) for f in range(size)]
                sums[known] += np.stack([*added, np.bincount(codes, pull, len(known))], axis=1)
                rows, bias = rows + n, bias + off.sum()
        if not rows:
            return
        chunks = range(-(-width // CHUNK))
        data = [np.array([bias]).tobytes(), *[sums[c * CHUNK : (c + 1) * CHUNK].tobytes() for c in chunks]]
        for chunk, each in zip([-1, *chunks], data):
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([rows], pa.int64()), pa.array([each], pa.binary())], ["chunk", "rows", "sums"])

    return run


def _join(group: pa.Table) -> pa.Table:
    """One chunk's sums over all tasks."""
    total = sum(np.frombuffer(part) for part in group.column("sums").to_pylist())
    rows = sum(group.column("rows").to_pylist())
    return pa.table({"chunk": group.column("chunk").slice(0, 1), "rows": pa.array([rows], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})
