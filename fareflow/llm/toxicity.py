"""Toxicity from averaged subword embeddings and a linear softmax (operator 2).

A word is the average of the embeddings of its character n-grams, a passage the
average of its words, and a two-class softmax over that decides.  Embeddings and
softmax are trained together, so a misspelt or inflected word is judged by the
n-grams it shares with words seen in training.

A few words make a long text toxic, so a text is as toxic as its worst passage:
the highest score of any run of ``WINDOW`` words.  Training follows the same
rule: after a start on whole texts, each step trains on every text's worst
passage.

Softmax over two classes depends on the difference of the class weights alone.
Averages are linear, so a word's share in the score is one number, kept once
computed.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rows of the n-gram table, and numbers in each.
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIM = 8
#: Lengths of the n-grams of a word with its borders.
SHORTEST, LONGEST = 3, 6
#: Words of a passage.
WINDOW = 2
#: The sample a model is fitted on: rows of each class, and characters of a row.
MAX_ROWS_PER_CLASS = 1_500
MAX_CHARS = 10_000
#: The order of the rows of a sample; rows equal in it are equal.
SAMPLE_ORDER = ("label", "id", "text")
#: Words whose n-grams are made, or gathered by bucket, at a time.
BLOCK = 4096
#: An n-gram counts from this many texts (times its words in them) on; weight of the squared embeddings in the loss.
MIN_TEXTS = 6
DECAY = 6e-5

_WORD = re.compile(r"\w+")


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words with their borders, one word behind the other, and how many each word has.

    Words too short for an n-gram have themselves as one.  Computed block by block:
    what it takes on the way is many times the result.
    """
    buckets, counts = zip(*(_grams(words[at : at + BLOCK]) for at in range(0, max(1, len(words)), BLOCK)))
    return np.concatenate(buckets), np.concatenate(counts)


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`grams` of one block."""
    marked = [f"<{w}>" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (chars + np.uint64(1)) * _FACTOR
    codes ^= codes >> np.uint64(31)
    begin = np.cumsum(sizes) - sizes
    left = np.repeat(begin + sizes, sizes) - np.arange(len(codes))  # characters from each to its word's end
    at, sums = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
    found = []
    for n in range(1, LONGEST + 1):
        inside = left[at] >= n
        at, sums = at[inside], sums[inside]
        sums = sums * _FACTOR + codes[at + n - 1]
        if n >= SHORTEST:
            found.append((at, (sums ^ (sums >> np.uint64(29))) * _FACTOR >> np.uint64(64 - BUCKET_BITS)))
    places, buckets = (np.concatenate(x) for x in zip(*found)) if len(codes) else (np.zeros(0, int),) * 2
    order = np.argsort(places, kind="stable")
    counts = np.bincount(np.repeat(np.arange(len(words)), sizes)[places], minlength=len(words))
    return buckets[order].astype(np.int32), counts


def _blocks(counts: np.ndarray) -> list[tuple[slice, slice]]:
    """Words of each block, and where the n-grams of these words lie."""
    ends = np.concatenate(([0], np.cumsum(counts)))
    cuts = [*range(0, len(counts), BLOCK), len(counts)]
    return [(slice(a, b), slice(ends[a], ends[b])) for a, b in zip(cuts, cuts[1:])]


def _by_word(gram_values: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of the values of each word's n-grams."""
    found = [np.add.reduceat(gram_values[flat[g]], np.cumsum(counts[w]) - counts[w]) for w, g in _blocks(counts)]
    return np.concatenate(found) / counts


def _by_gram(word_values: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the values of the words by n-gram, added up in the order of the n-grams."""
    total = np.zeros(BUCKETS)
    for w, g in _blocks(counts):
        np.add.at(total, flat[g], np.repeat(word_values[w], counts[w]))
    return total


@dataclass(frozen=True)
class Model:
    """Score of each n-gram (its embedding times the weight difference), and the bias."""

    gram_scores: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Mean over the n-grams of the words inside each; NaN for mere signs."""
        parts = [[w] if w.isalnum() else _WORD.findall(w) for w in map(str.lower, words)]
        number = np.array([len(p) for p in parts], np.int64)
        found = np.full(len(words), np.nan)
        if number.any():
            # Summed stretch by stretch: a word's score must not depend on the words beside it.
            flat, counts = grams([p for some in parts for p in some])
            each = np.add.reduceat(self.gram_scores[flat].astype(float), np.cumsum(counts) - counts) / counts
            real = number > 0
            found[real] = np.add.reduceat(each, (np.cumsum(number) - number)[real]) / number[real]
        return found

    def worst(self, scores: np.ndarray) -> float:
        """Logit of the worst passage of a text, from its words' scores."""
        scores = scores[~np.isnan(scores)]
        if not len(scores):
            return self.bias
        size = min(WINDOW, len(scores))
        total = np.concatenate(([0.0], np.cumsum(scores)))
        return self.bias + float((total[size:] - total[:-size]).max()) / size


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[str], labels: list[int], epochs: int = 30, warm_up: int = 10, rate: float = 0.05, seed: int = 7) -> Model:
    """Fit on texts held in memory.

    Without texts, or with one class only, every text gets the smoothed share of
    class 1.  Classes weigh the same in the loss; the bias is then moved to the
    share they have in the sample.
    """
    y = np.array(labels, dtype=float)
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    ids: dict[str, int] = {}
    rows = [array("i", [ids.setdefault(w, len(ids)) for w in _WORD.findall((t or "").lower())]) for t in texts]
    used = [i for i, r in enumerate(rows) if r]
    if len({labels[i] for i in used}) < 2:
        return Model(np.zeros(BUCKETS, np.float32), prior)
    y = y[used]
    codes = np.concatenate([np.frombuffer(rows[i], np.int32) for i in used])
    lengths = np.array([len(rows[i]) for i in used])
    begins = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    flat, gram_count = grams([*ids])
    # An n-gram seen in few texts would only learn those by heart.
    text_of = np.repeat(np.arange(len(used)), lengths)
    pairs = np.unique(text_of * len(ids) + codes)
    in_texts = np.bincount(pairs % len(ids), minlength=len(ids))
    seen = _by_gram(in_texts, flat, gram_count) >= MIN_TEXTS
    del text_of, pairs

    # Passages: every run of WINDOW words, or the whole of a shorter text.
    size = np.minimum(lengths, WINDOW)
    runs = lengths - size + 1
    run_begin = np.concatenate(([0], np.cumsum(runs)))[:-1]
    at = np.arange(runs.sum()) + np.repeat(begins - run_begin, runs)
    run_size = np.repeat(size, runs)

    random = np.random.default_rng(seed)
    weights = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    state = {
        "table": (random.normal(0, 0.1, (BUCKETS, DIM)) * seen[:, None]).astype(np.float32),
        "vector": random.normal(0, 1, DIM).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }
    first, second = ({k: np.zeros_like(v) for k, v in state.items()} for _ in range(2))
    for step in range(1, epochs + 1):
        scores = _by_word(state["table"] @ state["vector"], flat, gram_count)
        total = np.concatenate(([0.0], np.cumsum(scores[codes], dtype=float)))
        if step <= warm_up:
            start, count = begins, lengths
        else:
            means = (total[at + run_size] - total[at]) / run_size
            best = np.maximum.reduceat(means, run_begin)
            hit = np.flatnonzero(means == np.repeat(best, runs))
            start = at[hit[np.searchsorted(hit, run_begin)]]
            count = size
        logit = state["bias"][0] + (total[start + count] - total[start]) / count
        error = weights * (_sigmoid(logit) - y)
        # Each word of a passage has an equal share in it.
        delta = np.zeros(len(codes) + 1)
        np.add.at(delta, start, error / count)
        np.add.at(delta, start + count, -error / count)
        by_word = np.bincount(codes, np.cumsum(delta)[:-1], len(ids))
        by_gram = _by_gram(by_word / gram_count, flat, gram_count).astype(np.float32)
        slope = {
            "table": (by_gram * seen)[:, None] * state["vector"] + DECAY * state["table"],
            "vector": by_gram @ state["table"],
            "bias": np.array([error.sum()], np.float32),
        }
        for k, v in state.items():
            first[k] += 0.1 * (slope[k] - first[k])
            second[k] += 0.01 * (slope[k] ** 2 - second[k])
            v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model((state["table"] @ state["vector"]).astype(np.float32), float(state["bias"][0]) + prior / 2)


class _Scores:
    """Word scores of a model, remembered for a bounded number of words."""

    def __init__(self, model: Model, limit: int = 700_000):
        self._model, self._limit, self._known = model, limit, {}

    def logits(self, texts: pa.Array) -> np.ndarray:
        distinct, codes, starts = common.words(texts)
        if len(self._known) > self._limit:
            self._known = {}
        new = [w for w in distinct if w not in self._known]
        self._known.update(zip(new, self._model.word_scores(new).tolist()))
        scores = np.fromiter(map(self._known.__getitem__, distinct), float, len(distinct))[codes]
        return np.array([self._model.worst(scores[a:b]) for a, b in zip(starts, starts[1:])])


def fit(texts: list[str], labels: list[int], share: float | None = None) -> Model:
    """:func:`train`, with logits turned into probabilities.

    Two models, each trained on one half, score the other half; a logistic curve
    through these scores gives slope and offset.  ``share`` is the share of class
    1 among the rows the sample stands for.  With under ten rows of a class in a
    half nothing can be learnt safely: every text gets the share.
    """
    y = np.array(labels, dtype=float)
    share = float(y.mean()) if share is None and len(y) else share or 0.0
    half = np.array([zlib.crc32(f"{i}".encode()) % 2 for i in range(len(y))]) if len(y) else np.zeros(0)
    if any(min((y[half == h] == 1).sum(), (y[half == h] == 0).sum()) < 10 for h in (0, 1)):
        return train([], []) if not len(y) else Model(np.zeros(BUCKETS, np.float32), _logit((share * len(y) + 0.5) / (len(y) + 1)))
    model = train(texts, labels)
    x = np.zeros(len(y))
    for h in (0, 1):
        other = np.flatnonzero(half != h)
        one = train([texts[i] for i in other], [labels[i] for i in other])
        mine = np.flatnonzero(half == h)
        x[mine] = _Scores(one).logits(pa.array([texts[i] for i in mine], pa.string()))
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())) / len(y)
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton's method; the small ridge keeps it from running off
        p = _sigmoid(slope * x + offset)
        g = np.array([(weights * (p - y) * x).sum() + 1e-4 * (slope - 1), (weights * (p - y)).sum()])
        w = weights * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-4, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - float(np.clip(step[0], -1, 1)), offset - float(np.clip(step[1], -1, 1))
    slope = max(slope, 0.0)
    return Model((slope * model.gram_scores).astype(np.float32), slope * model.bias + offset)


def _sample_rows(documents: DataFrame, labels: DataFrame, max_rows: int, max_chars: int) -> tuple[DataFrame, float]:
    """The sample as ``id, text, label``, in its order, and the share of class 1, see :func:`sample`."""
    known = labels.filter("id is not null and label in (0, 1)").select("id", F.col("label").cast("int").alias("label"))
    known = known.groupBy("id", "label").count()
    share = known.agg(F.avg("label")).first()[0]
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [known.filter(F.col("label") == c).orderBy(*order).limit(max_rows) for c in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).select("id", "label")
    # Bounded by the two limits.
    read = documents.select("id", "text").join(F.broadcast(chosen), "id").filter(F.length("text") <= max_chars)
    return read.orderBy(*SAMPLE_ORDER).limit(2 * max_rows), float(share or 0.0)


def sample(
    documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS, max_chars: int = MAX_CHARS
) -> tuple[list[str], list[int], float]:
    """At most ``max_rows`` texts of each class, of at most ``max_chars`` characters, and the share of class 1 in all.

    ``documents`` has ``id, text`` and ``labels`` has ``id, label``.  Labelled
    ids are chosen by hash before any text is read, so a class loses the share of
    its texts that are longer, NULL or not there.  Labels other than 0 and 1 and
    NULL ids are left out; of rows that repeat an id at most ``max_rows`` in all stay.
    """
    rows, share = _sample_rows(documents, labels, max_rows, max_chars)
    rows = rows.collect()
    return [r["text"] for r in rows], [r["label"] for r in rows], share


def _fit_rows(batches, share: float, schema: pa.Schema):
    texts, labels = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        labels += batch.column("label").to_pylist()
    model = fit(texts, labels, share)
    yield common.arrow_batch([[model.gram_scores.tobytes()], [model.bias]], schema)
    common.release()


def fit_sample(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS_PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """:func:`fit` on the :func:`sample`, in one task: the driver gets the finished model only."""
    common.ship(documents.sparkSession)
    rows, share = _sample_rows(documents, labels, max_rows, max_chars)
    rows = rows.repartition(1).sortWithinPartitions(*SAMPLE_ORDER).select("text", "label")
    ddl = "gram_scores binary, bias double"
    schema = common.arrow_schema(ddl)
    found = rows.mapInArrow(lambda batches: _fit_rows(batches, share, schema), ddl).collect()
    # A sample that Spark knows to be empty has no partition, so no task either.
    return Model(np.frombuffer(found[0]["gram_scores"], np.float32), found[0]["bias"]) if found else fit([], [], share)


def _score(part, model: Model) -> list:
    return [part.column("_id"), _sigmoid(_scores_of(model).logits(part.column("_text")))]


def _scores_of(model: Model) -> _Scores:
    key = ("toxicity", model.bias, zlib.crc32(model.gram_scores.tobytes()))
    return common.kept(key, lambda: _Scores(model))


def _flag(part, model: Model, threshold: float, text_col: str) -> list:
    texts = pc.struct_field(part.column("_row"), text_col)
    return [part.column("_row"), _sigmoid(_scores_of(model).logits(texts)) >= threshold]


def keep_clean(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all their columns.

    A NULL or empty text stays unless no evidence at all is already too much.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    row_type = rows.schema["_row"].dataType.simpleString()
    flagged = common.map_slices(rows, _flag, f"_row {row_type}, toxic boolean", model, threshold, text_col)
    return flagged.filter("not toxic").select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: the probability of class 1, over the whole text.

    A NULL or empty text, or one of mere signs, gets the score of no evidence (the
    bias).  Equal texts get equal scores, repeated rows repeated results; no other
    column is read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return common.map_slices(rows, _score, "doc_id long, score double", model)
