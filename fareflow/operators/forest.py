"""Training of random forests on blocks of binned rows.

``RandomForestClassifier`` keeps every row as objects with a count for each tree,
many times as large as its values, spills what memory does not hold, and walks the
rows one by one for each tree and level.  Here the values are binned once, a byte
each, and written as blocks; a level of all trees is one pass that counts labels by
bin with numpy, and the best splits are chosen where the counts of a tree meet.
Bins, gains, ties, stops and pruning are those of ``RandomForestClassifier``, and it
is the model class of ``pyspark.ml`` that is returned: where nothing is drawn, the
same model.  Drawn rows and features have the same distribution, but other seeds: a
tree's own, by block and by node, while Spark's depend on the partitions.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import discard, materialize
from .factorisation import ROWS_PER_TASK, batches_of, spread

#: Rows of a block: enough to make up for a call, few enough for a core's cache.
BLOCK = 65_536
LEAST = 8_192
#: Values of a block.
VALUES = 1 << 22
#: Bytes of counts that a task holds; nodes beyond are another pass.
SUMS = 1 << 26
#: Spark's own bounds: rows looked at to find bins, impurity that counts as none.
SAMPLED = 10_000
EPSILON = 2.0**-52

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCKS = "block long, rows int, bins binary"
_COUNTS = "tree int, sums binary"
_SPLITS = "tree int, node long, feature int, bin int, gain double, left binary, right binary"


def fit(forest: RandomForestClassifier, train: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> RandomForestClassificationModel:
    """The model that ``forest`` fits; rows that are one task's work, and nominal features, are left to Spark."""
    label, features = F.col(forest.getLabelCol()).cast("double"), forest.getFeaturesCol()
    odd = F.count_if(label.isNull() | F.isnan(label) | (label < 0) | (label != F.floor(label)))
    rows, top, wrong = train.agg(F.count(F.lit(1)), F.max(label), odd).first()
    if rows <= rows_per_task:
        return forest.fit(train)
    nominal = _nominal(train, forest.getLabelCol()) or _nominal(train, features)
    if wrong or top >= 100 or nominal or forest.getMaxBins() > 256:
        return forest.fit(spread(train, rows_per_task))
    classes = max(2, int(top) + 1)
    # Arrays go to Python many times faster than vectors.
    arrays = [label.alias("label"), vector_to_array(features).alias("features")]
    enough = max(forest.getMaxBins() ** 2, SAMPLED)
    some = train.sample(enough / rows, forest.getSeed()) if enough < rows else train
    cuts = _cuts(some.select(*arrays), forest.getMaxBins())
    cores = train.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(BLOCK, VALUES // len(cuts), max(LEAST, rows // (4 * cores))))
    # What a pass costs follows the rows, so the blocks are dealt evenly.
    coded = train.select(*arrays).mapInArrow(_coded(cuts, size), _BLOCKS).repartition(max(-(-rows // rows_per_task), cores))
    blocks = materialize(coded, "forest-blocks")
    with batches_of(train.sparkSession, 4):
        trees = _grow(forest, blocks, [len(c) for c in cuts], classes)
    discard(blocks)
    return _model(forest, trees, cuts, classes)


def _nominal(train: DataFrame, column: str) -> bool:
    """Whether a column is described as one of categories, or a vector as having some."""
    about = train.schema[column].metadata.get("ml_attr", {})
    return bool({"nominal", "binary"} & {about.get("type"), *about.get("attrs", {})})


def _cuts(some: DataFrame, bins: int) -> list[np.ndarray]:
    """Thresholds of each feature between the values of some rows, as many as Spark looks at."""
    values = some.select(F.posexplode("features").alias("feature", "value"))
    counted = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    found = counted.groupBy("feature").applyInArrow(_between(bins - 1), "feature int, cuts binary").collect()
    by_feature = {r["feature"]: np.frombuffer(r["cuts"]) for r in found}
    return [by_feature[f] for f in range(len(by_feature))]


def _between(most: int):
    def run(group: pa.Table) -> pa.Table:
        pairs = sorted(zip(group.column("value").to_pylist(), group.column("n").to_pylist()))
        values, counts = np.array([p[0] for p in pairs]), [p[1] for p in pairs]
        middles = (values[:-1] + values[1:]) / 2.0
        if len(middles) > most:
            step = sum(counts) / (most + 1)
            kept, seen, target = [], counts[0], step
            for i, n in enumerate(counts[1:]):
                if abs(seen - target) < abs(seen + n - target):
                    kept.append(i)
                    target += step
                seen += n
            middles = middles[kept]
        return pa.table({"feature": group.column("feature").slice(0, 1), "cuts": pa.array([middles.tobytes()], pa.binary())})

    return run


def _coded(cuts: list[np.ndarray], size: int):
    """Rows as blocks: labels, then the bins of each feature, a byte each."""

    def bins(some: pa.RecordBatch) -> np.ndarray:
        labels, vectors = some.column(0).to_numpy(zero_copy_only=False), some.column(1)
        dense = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
        if len(dense) != len(labels) or not np.isfinite(dense).all():
            raise ValueError(f"vectors have to be finite and {len(cuts)} wide")
        return np.stack([labels, *[np.searchsorted(c, v) for c, v in zip(cuts, dense.T)]]).astype(np.uint8)

    def run(batches):
        first, made, held = TaskContext.get().partitionId() << 33, 0, []

        def block():
            whole = np.concatenate(held, axis=1)
            columns = [pa.array([first + made], pa.int64()), pa.array([whole.shape[1]], pa.int32()), pa.array([whole.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "rows", "bins"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held.append(bins(batch.slice(at, size)))
                if sum(h.shape[1] for h in held) >= size:
                    yield block()
                    made, held = made + 1, []
        if held:
            yield block()

    return run


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1)
    impurity = np.ones(total.shape)
    for c in range(counts.shape[-1]):
        share = counts[..., c] / np.maximum(total, 1)
        impurity -= share * share
    return np.where(total == 0, 0.0, impurity)


def _grow(forest: RandomForestClassifier, blocks: DataFrame, cuts: list[int], classes: int) -> list[dict]:
    """Trees as nodes by number, the children of ``i`` being ``2 i`` and ``2 i + 1``: (counts, valid, split or nothing)."""
    number, deepest, seed, width = forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed(), len(cuts)
    strategy = forest.getFeatureSubsetStrategy()
    if strategy not in ("auto", "all", "sqrt"):
        raise ValueError(f"unknown strategy {strategy!r}")
    some = strategy == "sqrt" or (strategy == "auto" and number > 1)
    features = math.ceil(math.sqrt(width)) if some else width
    shape = (features, max(cuts) + 1, classes)
    draws = (seed, forest.getSubsamplingRate(), forest.getBootstrap())
    limits = (forest.getMinInstancesPerNode(), forest.getMinInfoGain())
    trees, waiting = [{} for _ in range(number)], [(t, 1) for t in range(number)]
    at_once = max(1, SUMS // (8 * math.prod(shape)))
    for level in range(deepest):
        following = []
        for at in range(0, len(waiting), at_once):
            wanted: dict[int, dict[int, np.ndarray]] = {}
            for t, node in waiting[at : at + at_once]:
                picks = np.random.default_rng([seed % 2**64, t, node]).permutation(width)[:features] if some else np.arange(width)
                wanted.setdefault(t, {})[node] = picks
            ways = {t: _ways(trees[t], nodes) for t, nodes in wanted.items()}
            counted = blocks.mapInArrow(_count(wanted, ways, shape, draws), _COUNTS)
            for r in counted.groupBy("tree").applyInArrow(_best(wanted, cuts, shape, limits), _SPLITS).collect():
                tree, node, gain = trees[r["tree"]], r["node"], r["gain"]
                left, right = np.frombuffer(r["left"], np.int64), np.frombuffer(r["right"], np.int64)
                tree[node] = (left + right, gain >= 0, (r["feature"], r["bin"], gain) if gain > 0 else None)
                for child, counts in ((2 * node, left), (2 * node + 1, right)) if gain > 0 else ():
                    tree[child] = (counts, True, None)
                    if level + 1 < deepest and _gini(counts) >= EPSILON:
                        following.append((r["tree"], child))
        waiting = sorted(following)
    return trees


def _ways(tree: dict, nodes) -> dict[int, tuple[int, int]]:
    """The splits that lead to some nodes."""
    above = {n >> up for n in nodes for up in range(1, n.bit_length())}
    return {n: tree[n][2][:2] for n in above}


def _drawn(rng: np.random.Generator, rows: int, rate: float, again: bool) -> np.ndarray:
    """Rows that a tree draws from a block, in any order.

    A Poisson number of uniform draws gives each row its own Poisson number.
    """
    if again:
        return rng.integers(0, rows, rng.poisson(rate * rows))
    return np.arange(rows) if rate >= 1 else np.flatnonzero(rng.random(rows) < rate)


def _count(wanted: dict, ways: dict, shape: tuple[int, int, int], draws: tuple[int, float, bool]):
    """For each tree, rows of its nodes by feature, bin and label."""

    def run(batches):
        (_, bins, classes), (seed, rate, again) = shape, draws
        cells = bins * classes
        sums = {t: np.zeros((len(nodes), shape[0], cells), np.int64) for t, nodes in wanted.items()}
        seen = False
        for batch in batches:
            for number, rows, data in zip(*[c.to_pylist() for c in batch.columns]):
                seen = True
                held = np.frombuffer(data, np.uint8).reshape(-1, rows)
                keys = held[1:].astype(np.uint8 if cells <= 256 else np.uint16) * classes + held[0]
                for t, nodes in wanted.items():
                    place, total = {n: i for i, n in enumerate(nodes)}, sums[t]
                    waiting = [(1, _drawn(np.random.default_rng([seed % 2**64, t, number, 1]), rows, rate, again))]
                    while waiting:
                        node, at = waiting.pop()
                        if node in place:
                            for k, f in enumerate(nodes[node]):
                                total[place[node], k] += np.bincount(keys[f].take(at), minlength=cells)
                        elif node in ways[t]:
                            feature, last = ways[t][node]
                            left = keys[feature].take(at) < (last + 1) * classes
                            waiting += [(2 * node, at.compress(left)), (2 * node + 1, at.compress(~left))]
        if seen:
            for t, total in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["tree", "sums"])

    return run


def _best(wanted: dict, cuts: list[int], shape: tuple[int, int, int], limits: tuple[int, float]):
    """The best split of each node of a tree; the gain is negative infinity where none is allowed."""

    def run(group: pa.Table) -> pa.Table:
        t, (fewest, least) = group.column("tree")[0].as_py(), limits
        nodes, total = wanted[t], 0
        for part in group.column("sums").to_pylist():
            total = total + np.frombuffer(part, np.int64)
        below = total.reshape(len(nodes), *shape).cumsum(axis=2)
        left, whole = below[:, :, :-1], below[:, :, -1:]
        right = whole - left
        few, many = left.sum(axis=-1), right.sum(axis=-1)
        every = np.maximum(few + many, 1)
        gain = _gini(whole) - few / every * _gini(left) - many / every * _gini(right)
        cut = np.array(cuts)[np.array([*nodes.values()])]
        there = (np.arange(shape[1] - 1) < cut[:, :, None]) & (few >= fewest) & (many >= fewest) & (gain >= least)
        gain = np.where(there, gain, -np.inf).reshape(len(nodes), -1)
        best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(nodes), int)
        found = []
        for i, (node, picks) in enumerate(nodes.items()):
            k, b = divmod(int(best[i]), max(1, shape[1] - 1))
            by = float(gain[i, best[i]]) if gain.shape[1] else -math.inf
            sides = (left[i, k, b], right[i, k, b]) if by >= 0 else (whole[i, 0, 0], 0 * whole[i, 0, 0])
            found.append((t, node, int(picks[k]), b, by, *[s.tobytes() for s in sides]))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
        names = ["tree", "node", "feature", "bin", "gain", "left", "right"]
        return pa.table([pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], names=names)

    return run


def _pruned(tree: dict, node: int = 1):
    """A leaf as (prediction, impurity, counts), another node with gain, split and children too; leaves that say the same are one."""
    counts, valid, split = tree[node]
    prediction, impurity = int(counts.argmax()), float(_gini(counts))
    if split is None:
        return prediction, impurity if valid else -1.0, counts
    children = _pruned(tree, 2 * node), _pruned(tree, 2 * node + 1)
    if all(len(c) == 3 for c in children) and children[0][0] == children[1][0]:
        return prediction, impurity, counts
    return prediction, impurity, counts, split, *children


def _model(forest: RandomForestClassifier, trees: list[dict], cuts: list[np.ndarray], classes: int) -> RandomForestClassificationModel:
    from pyspark import SparkContext

    gateway, names = SparkContext._active_spark_context._gateway, SparkContext._active_spark_context._jvm.org.apache.spark
    gini, leaf, inner, below = names.mllib.tree.impurity.GiniCalculator, names.ml.tree.LeafNode, names.ml.tree.InternalNode, names.ml.tree.ContinuousSplit
    one, whole = names.ml.classification.DecisionTreeClassificationModel, names.ml.classification.RandomForestClassificationModel

    def java(made):
        prediction, impurity, counts = made[:3]
        stats = gateway.new_array(gateway.jvm.double, classes)
        for c in range(classes):
            stats[c] = float(counts[c])
        held = gini(stats, int(counts.sum()))
        if len(made) == 3:
            return leaf(float(prediction), impurity, held)
        (feature, last, gain), *children = made[3:]
        return inner(float(prediction), impurity, gain, *[java(c) for c in children], below(feature, float(cuts[feature][last])), held)

    fitted = gateway.new_array(one, len(trees))
    for i, tree in enumerate(trees):
        fitted[i] = one(java(_pruned(tree)), len(cuts), classes)
    model = forest._copyValues(RandomForestClassificationModel(whole(forest.uid, fitted, len(cuts), classes)))
    model._transfer_params_to_java()
    return model
