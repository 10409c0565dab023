"""Quality of documents by supervised subword embeddings.

A text is a bag of its words and of the runs of 3 and 4 characters inside them (a space marks where a
word begins and ends), each hashed to a row of a table of vectors; a word that repeats the one before it
adds a row of its own kind, the same for all words. The mean of a text's vectors goes through a linear layer and a softmax; vectors and layer are learned together by stochastic gradient
descent in numpy, one text at a time, with a falling rate. Case, punctuation and signs stay as they are:
they tell much of a text's quality.

The fit reads at most ``SAMPLE_ROWS`` labelled documents, those with the smallest hashes of their ids
among all labelled ones outside fold 0; scores are of every document and its whole text. Since the layer
is linear, a hashed row adds a fixed amount to the difference of both classes. That amount, one number a
row, is the model that travels to the tasks: it has 2**BUCKET_BITS + 1 of them, whatever the corpus.

Odd rows:

* Null, empty and white texts have the score of the feature that all texts share, which is learned too.
* Texts of any length are read whole; work arrays hold a portion of bounded size, and at least one text.
* An id labelled several times counts once if all its labels agree, else not at all. Of several rows of
  one labelled id, one is learned from (the one whose text hashes lowest); all are scored.
* A null id is scored and never learned from; its ``held_out`` is false. Equal texts have equal scores.
* Without labelled rows of both classes every score is the share of class 1 among them, or 0 without any.
* Only ``doc_id`` and ``text`` (``doc_id`` and the label column) are read; other columns are ignored. An
  empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.llm.store import fold
from pipecast.llm.words import lists, mix, portions

SAMPLE_ROWS = 6_000
BUCKET_BITS = 18
# Rows of the table: one for each hash and one for repeated words.
BUCKETS = (1 << BUCKET_BITS) + 1
DIMENSIONS = 12
EPOCHS = 5
RATE = 2.0
THRESHOLD = 0.3
WIDTHS = (3, 4)
PORTION_BYTES = 1_000_000

_ODD = 0x9E3779B97F4A7C15
_BASE = np.uint64(_ODD)
_SPACE = 0x20
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind * _ODD % (1 << 64))) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, buckets) of the words, of those repeated, then of the runs of each width, in all texts.

    Runs lie inside one word with a space on either side of it.
    """
    # Every text stands between spaces, so no run reaches into the next one.
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    space = codes == _SPACE
    for sign in _SPACES[1:]:
        space |= codes == sign
    owner_ends = np.cumsum(lengths)  # the place of the space after each text
    values = np.where(space, np.uint64(_SPACE), codes.astype(np.uint64)) + np.uint64(1)

    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if len(starts):
        # A word's hash: its characters mixed with their places in it.
        places = np.arange(len(codes)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(codes)]])))
        mixed = mix(values * _BASE + places.astype(np.uint64))
        mixed[space] = 0
        words = np.add.reduceat(mixed, starts)
        owners = np.searchsorted(owner_ends, starts)
        yield owners, _bucket(words, 0)
        again = np.flatnonzero((words[1:] == words[:-1]) & (owners[1:] == owners[:-1])) + 1
        yield owners[again], np.full(len(again), BUCKETS - 1)

    hashes = mix(values)
    for width in range(2, max(WIDTHS) + 1):
        n = len(codes) - width + 1
        if n <= 0:
            return
        hashes = mix(hashes[:n] * _BASE + values[width - 1 :])
        if width in WIDTHS:
            inside = ~space[1 : n + 1]
            for k in range(2, width - 1):
                inside &= ~space[k : k + n]
            at = np.flatnonzero(inside)
            yield np.searchsorted(owner_ends, at + 1), _bucket(hashes[at], width)


def _whole_texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("text").to_pylist()]


# --- learning -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityModel:
    """``gains``: what each bucket adds to the difference of class 1 and 0; ``prior``: what all texts have.

    ``share`` is the score of all texts where nothing can be learned; else None.
    """

    gains: np.ndarray | None
    prior: float
    share: float | None = None


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(gains, prior) by stochastic gradient descent; a bag has different buckets and how often they occur.

    The last row of the table is a feature that every text has once.
    """
    random = np.random.default_rng(7)
    table = random.uniform(-1.0, 1.0, (buckets + 1, dimensions)).astype(np.float32) / dimensions
    layer = np.zeros((2, dimensions), np.float32)
    bags = [(np.append(ids, buckets), np.append(times, 1)) for ids, times in bags]
    shares = [(times / times.sum()).astype(np.float32) for _, times in bags]
    targets = np.eye(2, dtype=np.float32)[labels]
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for k in random.permutation(len(bags)):
            pace = rate * (1.0 - step / steps)
            step += 1
            rows, share = bags[k][0], shares[k]
            vectors = table[rows]
            mean = share @ vectors
            z = layer @ mean
            p = np.exp(z - z.max())
            wrong = p / p.sum() - targets[k]
            back = wrong @ layer
            layer -= pace * np.outer(wrong, mean)
            table[rows] = vectors - (pace * share)[:, None] * back
    gains = table @ (layer[1] - layer[0])
    return gains[:-1].astype(np.float32), float(gains[-1])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of each text and how often it has them."""
    size = BUCKETS
    for batch in batches:
        for part in portions(batch, "text", PORTION_BYTES):
            found = list(features(_whole_texts(part)))
            keys = np.concatenate([owner * size + bucket for owner, bucket in found] or [np.zeros(0, np.int64)])
            held, times = np.unique(keys, return_counts=True)
            bounds = np.searchsorted(held, np.arange(part.num_rows + 1) * size)
            bags = [lists((held % size).astype(np.int32), bounds, pa.int32()), lists(times.astype(np.int32), bounds, pa.int32())]
            kept = [part.column(c) for c in ("doc_id", "rank", "label")]
            yield pa.RecordBatch.from_arrays([*kept, *bags], names=["doc_id", "rank", "label", "buckets", "times"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model as one row, from the whole sample."""
    table = pa.Table.from_batches(list(batches))
    if table.num_rows:
        table = table.sort_by("rank")
        bags = [(b.values.to_numpy().astype(np.int64), t.values.to_numpy()) for b, t in zip(table["buckets"], table["times"])]
        gains, prior = train(bags, table["label"].to_numpy(), BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([gains.tobytes()], pa.binary()), pa.array([prior])], names=["gains", "prior"])


def sample_ids(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, rank, label) of the ``rows`` labelled ids outside fold 0 whose hashes are smallest."""
    marks = labels.where(F.col(label).isin(0, 1)).where(fold() != 0).groupBy("doc_id")
    agreed = marks.agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most")).where("label = most")
    return agreed.select("doc_id", F.xxhash64("doc_id").alias("rank"), "label").orderBy("rank", "doc_id").limit(rows)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn from at most ``rows`` labelled documents; the driver gets one number a bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = F.broadcast(sample_ids(labels, label, rows))  # at most ``rows`` rows
    sample = docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "rank", "label", "text")
    schema = f"doc_id {kind}, rank long, label int, buckets array<int>, times array<int>"
    bags = sample.mapInArrow(_bags, schema)
    # One row an id, so that the bound holds whatever the table repeats.
    content = F.xxhash64("buckets", "times")
    lowest = bags.groupBy("doc_id", "rank", "label").agg(F.min_by(F.struct("buckets", "times"), content).alias("bag"))
    chosen = lowest.select("rank", "label", "bag.buckets", "bag.times")
    counts = {r["label"]: r["n"] for r in sample.select("label", "doc_id").distinct().groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return QualityModel(None, 0.0, float(max(counts, default=0)))
    fitted = chosen.coalesce(1).mapInArrow(_fit, "gains binary, prior double").first()
    return QualityModel(np.frombuffer(fitted["gains"], np.float32), fitted["prior"])


# --- scoring ------------------------------------------------------------------------------------


def scores(texts: list[str], model: QualityModel) -> np.ndarray:
    """The softmax share of class 1 for each text."""
    if model.share is not None:
        return np.full(len(texts), model.share)
    total, count = np.full(len(texts), model.prior), np.ones(len(texts))
    for owner, buckets in features(texts):
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        n = np.diff(first)
        some = n > 0
        if some.any():
            total[some] += np.add.reduceat(model.gains[buckets].astype(float), first[:-1][some])
            count += n
    return 1.0 / (1.0 + np.exp(np.clip(-total / count, -500.0, 500.0)))


def _scorer(model: QualityModel):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            whole = pa.RecordBatch.from_arrays([texts], names=["text"])
            parts = [scores(_whole_texts(part), model) for part in portions(whole, "text", PORTION_BYTES)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score


def quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of ``docs``."""
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, _scorer(model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
