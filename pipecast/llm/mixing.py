"""Mixing sources to target weights by the cube method.

Each source has a target in words. Target over size is how often the mix wants each of the
source's documents: the whole part is taken for sure, the fraction is an inclusion
probability. The flight phase moves three probabilities at a time along the null space of
the two constraints (documents, words), so both totals of the source keep their value, until
at most two probabilities of a block are fractions. Those left over form the next round's
blocks. When a source is down to one block, a few documents of all sizes stay out of the
flight and are landed with its last two, on the choice that brings words and documents closest.

Blocks are shares of a source by the hash of doc_id, so a source with a third of all rows is
spread like any other. All draws come from hashes: reruns agree.

Null and empty texts have size 0 and are taken ``floor`` or ``floor + 1`` times like others,
adding no words. A null source is a source of its own, last in order. A source without words
has target 0 and is left out. Rows with the same doc_id are separate rows. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipecast.llm.store import freeing, keep, unused
from pipecast.llm.words import Words, portions
from pipecast.llm.words import mix as spread

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
# Documents that one block of the flight phase holds on average.
BLOCK_ROWS = 5_000
# Up to so many sources, the table of targets is sent to every task.
BROADCAST_SOURCES = 20_000

# Documents of a source's last block that are left to the landing, and what a document too many
# or too few costs there, in mean documents.
LANDING_UNITS = 14
DOCUMENT_COST = 0.02

_EPS = 1e-9


def _sizes(batches):
    for batch in batches:
        counts = [Words(part.column("text")).counts for part in portions(batch, "text")]
        size = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        columns = [*(c for n, c in zip(batch.schema.names, batch.columns) if n != "text"), pa.array(size, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*(n for n in batch.schema.names if n != "text"), "size"])


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each text."""
    slim = docs.select("doc_id", "source", "text")
    schema = "doc_id {}, source {}, size long".format(
        *(docs.schema[c].dataType.simpleString() for c in ("doc_id", "source"))
    )
    return slim.mapInArrow(_sizes, schema)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_TIMES) -> DataFrame:
    """(source, source_size, n_docs, target): sources by code point, null last, take the weights in turn.

    All words are shared by weight; a source stops at ``most`` times its size and the rest
    is shared among the others. That is ``min(most * size, level * weight)`` with one level
    for all, found from running sums over the sources in order of ``size / weight``.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    rows = per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    filling = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    heavier = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("total") - earlier) / heavier)
    # The first source that stays below its cap sets the level; after it, levels only fall.
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    rows = rows.withColumn("shared", F.max(free).over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.coalesce(F.col("shared") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", "n_docs", target.alias("target"))


def flight(p: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move fractions until at most two are left, keeping sum(p) and sum(p * size).

    Three units at a time: the null space of the rows (1, 1, 1) and their sizes is their
    cross product. Each move takes one unit at least to 0 or 1; the draw picks the direction
    so that every unit keeps its probability on average.
    """
    p = p.astype(float).copy()
    scale = float(size.max(initial=0)) or 1.0
    s = size.astype(float) / scale
    open_units: list[int] = []
    for k in range(len(p)):
        if not _EPS < p[k] < 1 - _EPS:
            p[k] = round(p[k])
            continue
        open_units.append(k)
        if len(open_units) < 3:
            continue
        i, j, m = open_units
        u = (s[m] - s[j], s[i] - s[m], s[j] - s[i])
        if max(map(abs, u)) < 1e-12:
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for unit, step in zip(open_units, u):
            if step > 0:
                up, down = min(up, (1 - p[unit]) / step), min(down, p[unit] / step)
            elif step < 0:
                up, down = min(up, -p[unit] / step), min(down, (p[unit] - 1) / step)
        move = up if draws[k] * (up + down) < down else -down
        left = []
        for unit, step in zip(open_units, u):
            p[unit] += move * step
            if p[unit] < _EPS or p[unit] > 1 - _EPS:
                p[unit] = round(p[unit])
            else:
                left.append(unit)
        open_units = left
    return p


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the last fractions so that the words, and then the documents, come closest to their expected totals.

    All choices of at most LANDING_UNITS + 2 units are compared.
    """
    p = p.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words = np.abs(choices @ size[left] - (p[left] * size[left]).sum())
    documents = np.abs(choices.sum(axis=1) - p[left].sum())
    p[left] = choices[np.argmin(words + DOCUMENT_COST * size[left].mean() * documents)]
    return p


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    """Fly one block. In a source's last block some units of all sizes stay for the landing."""
    frame = frame.sort_values(["draw", "doc_id", "size", "p"], kind="stable").reset_index(drop=True)
    size, p = frame["size"].to_numpy(np.int64), frame["p"].to_numpy(float)
    draws = (spread(frame["draw"].to_numpy(np.int64).view(np.uint64)) >> np.uint64(11)) / float(1 << 53)
    last = frame["blocks"].iloc[0] <= 1
    flying = np.ones(len(p), bool)
    if last:
        open_units = np.flatnonzero((p > _EPS) & (p < 1 - _EPS) & (size > 0))
        by_size = open_units[np.argsort(size[open_units], kind="stable")]
        ranks = np.unique(np.linspace(0, len(by_size) - 1, LANDING_UNITS).astype(int)) if len(by_size) else []
        flying[by_size[ranks]] = False
    p[flying] = flight(p[flying], size[flying], draws[flying])
    return frame.assign(p=land(p, size) if last else p)


@freeing
def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST_TIMES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): one row for each row of ``docs``."""
    sizes = keep(document_sizes(docs), "mix-sizes")
    goals = keep(targets(sizes, weights, most), "mix-targets")
    sources, largest = goals.agg(F.count("*"), F.max("n_docs")).first()
    rounds = [largest or 0]
    while rounds[-1] > block_rows:
        rounds.append(-(-rounds[-1] // block_rows) * 2)
    side = F.broadcast(goals) if sources <= BROADCAST_SOURCES else goals
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sizes.alias("d").join(side.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    rows = joined.select("d.*", "source_size", "n_docs", "target", ratio.alias("ratio")).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "n_docs",
        "target",
        F.floor(F.col("ratio") + _EPS).cast("long").alias("whole"),
        F.greatest(F.col("ratio") - F.floor(F.col("ratio") + _EPS), F.lit(0.0)).alias("p"),
    )
    draw = F.xxhash64(F.lit(len(rounds)), "doc_id", "size")
    rows = rows.withColumn("draw", draw).withColumn("left", F.col("n_docs"))
    decided = None
    for turn in range(len(rounds)):
        # How many blocks a source has left follows from its document count alone.
        blocks = F.greatest(F.ceil(F.col("left") / block_rows), F.lit(1)).cast("long")
        rows = rows.withColumn("blocks", blocks)
        salt = F.pmod(F.xxhash64(F.lit(turn), "doc_id", "size", "draw"), F.col("blocks"))
        rows = rows.withColumn("block", salt)
        flown = rows.groupBy("source", "block").applyInPandas(_block, rows.schema)
        flown = keep(flown, f"mix-round{turn}")
        fraction = (F.col("p") > 0) & (F.col("p") < 1)
        done = flown.where(~fraction)
        decided = done if decided is None else decided.unionByName(done)
        rows = flown.where(fraction).withColumn("left", F.col("blocks") * 2)
    copies = F.col("whole") + F.col("p").cast("long")
    return decided.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns as they were.

    Rows that share a doc_id are taken alike, as often as the one taken most.
    """
    named, times, copy = (unused(docs, name) for name in ("mixed_id", "mixed_times", "mixed_copy"))
    plan = mix(docs, **options).groupBy(F.col("doc_id").alias(named)).agg(F.max("copies").cast("int").alias(times))
    taken = docs.join(plan.where(F.col(times) > 0), F.col("doc_id").eqNullSafe(F.col(named)))
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
