"""N-gram Jaccard join by grouped prefixes.

A document's set holds its distinct shingles of ``width`` words (lower-cased A-Z) as 64-bit
hashes; with fewer words, the whole sequence is the one shingle. Documents link when
``100 * |A and B| >= percent * |A or B|``. Documents without words link with nothing.

1. *Classes.* Documents with equal sets are one class; its first row stands for it. Copies are
   never expanded into pairs.
2. *Order.* Shingles are ordered by how many texts have them, rarest first, as told by a table
   of 2**SKETCH_BITS counters over all documents, then by hash. Any order gives right results;
   this one keeps shingles that many documents share out of the prefixes.
3. *Groups.* Two linked sets share a shingle among their first ``n - ceil(percent * n) + 1``.
   Classes with equal prefixes and size are one group; shingles of group prefixes that one
   class alone has are dropped, and those that the same groups have count as one.
4. *Group pairs.* Up to HOT_CLASSES classes at a shingle, pairs of groups are formed and filtered
   by size, then expanded to pairs of classes, each once. At hotter shingles pairs would grow in
   square: stars connect their groups instead.
5. *Verification* compares complete sets, recomputed from the texts of the classes concerned.
   What hangs together is one cluster, so that each text travels once. A cluster is dealt into
   blocks of about BLOCK_CLASSES and each pair of blocks compared in one task, which emits links
   only as far as they connect something new, and the number of all links of each class. Pairs
   that would make clusters too large for a block are compared one by one.
6. *Components* of the links by repeated hooking and jumping, in stored rounds.

A row without doc_id links with nothing and has a null component. Rows with the same doc_id and
different texts are one node of the graph; the row keeps the size of its own set. Rows that are
repeated are copies. A row without words is its own component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipecast.llm.store import freeing, keep, shuffle_partitions
from pipecast.llm.words import Words, lists, mix, portions, runs, signed, whole_hash

SKETCH_BITS = 24
# Classes at one shingle up to which pairs are formed.
HOT_CLASSES = 24
# Classes that a block of a hot cluster holds on average.
BLOCK_CLASSES = 4_096
# Rows of a lookup table (copied sets, groups of several classes) that are sent to every task.
BROADCAST_ROWS = 100_000
# Ids of dropped documents that are sent to every task, 8 bytes each; more are joined by a shuffle.
DROPPED_IDS = 1_000_000
# Counters that one row of the sketch carries.
_SKETCH_ROW = 1 << 16
# Steps for each doubling of a count: 32 doublings fit in 16 bits.
_LOG_STEPS = 2047


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): each text's sorted distinct shingles."""
    words = Words(texts, lower=True)
    starts, hashes = runs(words, width)
    owner = words.texts[starts] if len(starts) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        owner = np.concatenate([owner, short])
        hashes = np.concatenate([hashes, np.array([whole_hash(words, t) for t in short], np.uint64)])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    return np.searchsorted(owner, np.arange(len(texts) + 1)), hashes


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n + (-n * percent // 100) + 1, 0)


def _counters(width: int):
    def counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SKETCH_BITS, np.uint8)
        for batch in batches:
            for part in portions(batch, "text"):
                _, hashes = shingle_sets(part.column("text"), width)
                slots, often = np.unique(_slots(hashes), return_counts=True)
                table[slots] = np.minimum(table[slots] + often, 255)
        rows = table.reshape(-1, _SKETCH_ROW)
        parts = np.flatnonzero(rows.any(axis=1))
        packed = [pa.compress(rows[k].tobytes(), codec="zstd", asbytes=True) for k in parts]
        yield _sketch_rows(parts, packed)

    return counters


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int32)


def _sketch_rows(parts, rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(parts), pa.int64()), pa.array(rows, pa.binary())], names=["part", "counts"]
    )


def _add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each part of this task: the sum of its rows, as 16-bit logarithms, which keep the order."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            row = np.frombuffer(pa.decompress(packed, _SKETCH_ROW, codec="zstd", asbytes=True), np.uint8)
            sums[part] = sums[part] + row if part in sums else row.astype(np.uint32)
    if sums:
        ranks = [(_LOG_STEPS * np.log2(1.0 + x)).astype(np.uint16).tobytes() for x in sums.values()]
        yield _sketch_rows(sums, ranks)


def shingle_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How common the shingles of each counter are, as numbers in order. The driver gets 2**SKETCH_BITS of 16 bits."""
    schema = "part long, counts binary"
    rows = texts.select("text").mapInArrow(_counters(width), schema)
    summed = rows.repartition(shuffle_partitions(texts.sparkSession), "part").mapInArrow(_add_sketches, schema).toArrow()
    table = np.zeros((1 << SKETCH_BITS) // _SKETCH_ROW * _SKETCH_ROW, np.uint16).reshape(-1, _SKETCH_ROW)
    for part, ranks in zip(summed["part"].to_pylist(), summed["counts"].to_pylist()):
        table[part] = np.frombuffer(ranks, np.uint16)
    return table.reshape(-1)


def _features(width: int, percent: int, counts: np.ndarray):
    """Per text: a row number, set size, two hashes that name the set, and its prefix in the order of ``counts``."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in portions(batch, "text"):
                bounds, hashes = shingle_sets(part.column("text"), width)
                n = np.diff(bounds)
                owner = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((hashes, counts[_slots(hashes)], owner))
                ranked = hashes[order]
                take = np.arange(len(ranked)) - np.repeat(bounds[:-1], n) < np.repeat(prefix_length(n, percent), n)
                names = _set_names(bounds, hashes)
                kept = np.concatenate([[0], np.cumsum(take)])[bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(next_id + np.arange(len(n))),
                        part.column("doc_id"),
                        pa.array(n),
                        *names,
                        lists(signed(ranked[take]), kept, pa.int64()),
                    ],
                    names=["row_id", "doc_id", "n", "s1", "s2", "prefix"],
                )
                next_id += len(n)

    return features


def _set_names(bounds: np.ndarray, hashes: np.ndarray) -> list[pa.Array]:
    """Two hashes of each set as a whole."""
    names = []
    for seed in (0x51ED270B0A1F39C1, 0x2545F4914F6CDD1D):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(seed)), dtype=np.uint64)])
        names.append(pa.array(signed(sums[bounds[1:]] - sums[bounds[:-1]])))
    return names


def _named_sets(part: pa.RecordBatch, width: int) -> list[tuple[int, np.ndarray]]:
    """(row of the batch, set) of the texts whose set is the one asked for by ``s1`` and ``s2``."""
    bounds, hashes = shingle_sets(part.column("text"), width)
    items, names = signed(hashes), _set_names(bounds, hashes)
    same = [names[k].to_numpy() == part.column(f"s{k + 1}").to_numpy() for k in (0, 1)]
    return [(k, items[bounds[k] : bounds[k + 1]]) for k in np.flatnonzero(same[0] & same[1])]


def _sets(width: int):
    """(class_id, items): the sets of the texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                found = _named_sets(part, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("class_id").take(pa.array([k for k, _ in found], pa.int64())),
                        pa.array([items for _, items in found], pa.list_(pa.int64())),
                    ],
                    names=["class_id", "items"],
                )

    return sets


def _overlaps(items: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each pair of sorted sets, all pairs at once."""
    sizes = np.array([len(a) + len(b) for a, b in zip(items, others)])
    values = np.concatenate([x for pair in zip(items, others) for x in pair]) if len(items) else np.zeros(0, np.int64)
    pair = np.repeat(np.arange(len(items)), sizes)
    order = np.lexsort((values, pair))
    values, pair = values[order], pair[order]
    same = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
    return np.bincount(pair[1:][same], minlength=len(items))


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                one, other = (
                    [x.values.to_numpy() for x in part.column(name)] for name in ("items_a", "items_b")
                )
                shared = _overlaps(one, other)
                union = np.array([len(a) + len(b) for a, b in zip(one, other)], np.int64) - shared
                linked = pa.array(100 * shared >= percent * union)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(linked)

    return verify


def _find(parent: np.ndarray, k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def compare_blocks(members: list[tuple[int, int, int, np.ndarray]], percent: int) -> list[tuple[int, int, int]]:
    """All links between the sides 0 and 1 of ``members`` (side, class, copies, set), or inside side 0 if it is alone.

    Gives (a, b, 0) for links that connect something new, and (a, a, number of linked rows).
    Each class is compared with all at once: the lists of classes that have its shingles are
    counted, which gives the exact overlaps.
    """
    members = sorted({(m[0], m[1]): m for m in members}.values(), key=lambda m: m[:2])
    ids, weights = [m[1] for m in members], np.array([m[2] for m in members])
    items, sizes = [m[3] for m in members], np.array([len(m[3]) for m in members])
    side = np.array([m[0] for m in members])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    inside = not len(right)
    right = left if inside else right
    flat = np.concatenate([items[k] for k in right])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parent, degree = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    links: list[tuple[int, int, int]] = []
    for k in left:
        lo, hi = np.searchsorted(flat, items[k], "left"), np.searchsorted(flat, items[k], "right")
        long = hi - lo
        places = np.repeat(lo - np.concatenate([[0], np.cumsum(long)[:-1]]), long) + np.arange(long.sum())
        shared = np.bincount(owner[places], minlength=len(right))
        found = right[(100 * shared >= percent * (sizes[k] + sizes[right] - shared)) & (shared > 0)]
        found = found[found > k] if inside else found
        degree[k] += weights[found].sum()
        degree[found] += weights[k]
        for m in found:
            a, b = _find(parent, int(k)), _find(parent, int(m))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((ids[k], ids[m], 0))
    return links + [(ids[k], ids[k], int(degree[k])) for k in np.flatnonzero(degree)]


def _compare(width: int, percent: int):
    """Compare the blocks of this task. Rows come sorted by block pair; one pair is held at a time."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done = None, [], []
        for batch in batches:
            for part in portions(batch, "text"):
                keys = list(zip(*(part.column(c).to_pylist() for c in ("cluster", "p", "q"))))
                facts = list(zip(*(part.column(c).to_pylist() for c in ("side", "class_id", "copies"))))
                for k, items in _named_sets(part, width):
                    if keys[k] != key:
                        done += compare_blocks(held, percent) if held else []
                        key, held = keys[k], []
                    held.append((*facts[k], items))
            if done:
                yield _link_rows(done)
                done = []
        if held:
            yield _link_rows(compare_blocks(held, percent))

    return compare


def _link_rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["a", "b", "links"]
    )


@freeing
def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node each node of the links (a, b) reaches.

    Each round every node takes the smallest label among its neighbours', then its label's
    label. Rounds are stored, and the driver learns only whether one changed a label.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = keep(both, f"{name}-links")
    labels = keep(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
        f"{name}-labels",
    )
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("low"))
        # The label's own label moves along, so that chains shorten by half.
        pulled = hooked.groupBy("label").agg(F.min("low").alias("low"))
        roots = hooked.select("node", "low").join(pulled.withColumnRenamed("low", "deep"), F.col("node") == F.col("label"), "left")
        roots = roots.select(F.col("node").alias("root"), F.least("low", F.coalesce("deep", "low")).alias("root_label"))
        jumped = hooked.join(roots, F.col("low") == F.col("root"), "left").select(
            "node", F.least("low", F.coalesce("root_label", "low")).alias("label"), F.col("label").alias("old")
        )
        jumped = keep(jumped, f"{name}-labels")
        labels = jumped.select("node", "label")
        if not jumped.where("label <> old").take(1):
            return labels.select("node", F.col("label").alias("component"))


def _looked_up(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the columns of ``table`` where it has the keys; a small table is sent to every task."""
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(table) if few else table, keys, "left")


def _postings(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group_id, class_id, n, copies) and (token, group_id, n, members, weight) of shingles that several classes share.

    ``weight`` is the number of classes at the token, ``members`` of the group. Shingles with the same
    groups, as those of one passage are, stand together under one hash of these groups. Should two lists
    of groups have the same hash, their groups become candidates of each other, which loses nothing.
    """
    classes = classes.withColumn("prefix_hash", F.xxhash64("prefix"))
    keys = ["n", "prefix_hash"]
    several = classes.groupBy(*keys).agg(F.min("class_id").alias("group_id"), F.count("*").alias("members"))
    several = keep(several.where("members > 1"), "ngram-groups")
    grouped = _looked_up(classes, several, keys).select(
        "class_id",
        "copies",
        "n",
        "prefix",
        F.coalesce("group_id", "class_id").alias("group_id"),
        F.coalesce("members", F.lit(1)).alias("members"),
    )
    tokens = grouped.where("class_id = group_id").select("group_id", "n", "members", F.explode("prefix").alias("token"))
    at_token = Window.partitionBy("token")
    shared = tokens.withColumns(
        {"weight": F.sum("members").over(at_token), "groups": F.bit_xor(F.xxhash64("group_id")).over(at_token)}
    ).where("weight > 1")
    names = ["group_id", "n", "members", "weight"]
    shared = shared.select(F.xxhash64("groups", "weight").alias("token"), *names).distinct()
    return (
        keep(grouped.select("group_id", "class_id", "n", "copies"), "ngram-members"),
        keep(shared, "ngram-postings"),
    )


def _cold_pairs(members: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes at shingles that few share, each once."""
    cold = postings.where(F.col("weight") <= HOT_CLASSES).select("token", "group_id", "n")
    one = cold.select("token", F.col("group_id").alias("g"), F.col("n").alias("ng"))
    two = cold.select("token", F.col("group_id").alias("h"), F.col("n").alias("nh"))
    fits = (100 * F.least("ng", "nh") >= percent * F.greatest("ng", "nh")) & (F.col("g") <= F.col("h"))
    pairs = one.join(two, "token").where(fits).select("g", "h").distinct()
    left = members.select(F.col("group_id").alias("g"), F.col("class_id").alias("x"))
    right = members.select(F.col("group_id").alias("h"), F.col("class_id").alias("y"))
    pairs = pairs.join(left, "g").join(right, "h").where("x <> y and (g <> h or x < y)")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _hot_clusters(members: DataFrame, postings: DataFrame) -> DataFrame:
    """(class_id, copies, cluster): classes that hot shingles connect."""
    hot = postings.where(F.col("weight") > HOT_CLASSES)
    # A shingle is no class: stars from the smallest group at it connect its groups.
    least = hot.groupBy("token").agg(F.min("group_id").alias("b"))
    stars = hot.join(least, "token").select(F.col("group_id").alias("a"), "b")
    found = connected_components(stars, "hot")
    alone = hot.groupBy("group_id").agg(F.lit(1).alias("one")).join(found, F.col("group_id") == F.col("node"), "left")
    clusters = alone.select("group_id", F.coalesce("component", "group_id").alias("cluster"))
    return members.join(clusters, "group_id").select("class_id", "copies", "cluster")


def _clusters(members: DataFrame, postings: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(class_id, copies, cluster) of classes that are compared cluster by cluster, and pairs (a, b) left to compare.

    Hot clusters and pairs that hang together make one cluster as long as it fits a block;
    beyond that, hot clusters stay apart and the pairs between them are compared one by one.
    """
    hot = keep(_hot_clusters(members, postings), "ngram-hot")
    inside = hot.select("class_id", "cluster")
    cold = _cold_pairs(members, postings, percent)
    cold = cold.join(inside.toDF("a", "ca"), "a", "left").join(inside.toDF("b", "cb"), "b", "left")
    cold = cold.where("ca is null or cb is null or ca <> cb")
    cold = keep(cold.select("a", "b", F.coalesce("ca", "a").alias("na"), F.coalesce("cb", "b").alias("nb")), "ngram-pairs")
    ends = cold.select("a").union(cold.select("b")).distinct().toDF("class_id").join(inside, "class_id", "left_anti")
    ends = ends.join(members.select("class_id", "copies"), "class_id")
    nodes = hot.select("class_id", "copies", "cluster", F.lit(True).alias("hot")).union(
        ends.select("class_id", "copies", F.col("class_id").alias("cluster"), F.lit(False).alias("hot"))
    )
    whole = connected_components(cold.select(F.col("na").alias("a"), F.col("nb").alias("b")), "ngram-clusters")
    nodes = nodes.join(whole, nodes.cluster == whole.node, "left").withColumn("whole", F.coalesce("component", "cluster"))
    sizes = nodes.groupBy("whole").agg((F.count("*") <= BLOCK_CLASSES).alias("fits"))
    nodes = keep(nodes.drop("node", "component").join(sizes, "whole"), "ngram-nodes")
    clusters = nodes.where("fits or hot").select(
        "class_id", "copies", F.when(F.col("fits"), F.col("whole")).otherwise(F.col("cluster")).alias("cluster")
    )
    apart = nodes.where("not fits").select(F.col("class_id").alias("a"))
    return clusters, cold.join(apart, "a", "left_semi").select("a", "b")


def link_classes(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their class, links between classes, number of links by class)."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = shingle_counts(texts, width)
    schema = "row_id long, doc_id long, n long, s1 long, s2 long, prefix array<long>"
    features = keep(texts.mapInArrow(_features(width, percent, counts), schema), "ngram-features")
    sets = ["n", "s1", "s2"]
    copied = features.where("n > 0").groupBy(*sets).agg(
        F.min(F.struct("doc_id", "row_id")).alias("first"), F.count("*").alias("copies")
    )
    copied = keep(copied.where("copies > 1"), "ngram-copies")
    rows = _looked_up(features, copied, sets).select(
        "row_id",
        "doc_id",
        *sets,
        "prefix",
        F.coalesce("first.row_id", "row_id").alias("class_id"),
        F.coalesce("first.doc_id", "doc_id").alias("class_doc"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )
    classes = rows.where("n > 0 and row_id = class_id")
    documents = keep(rows.select("row_id", "doc_id", *sets, "class_id", "class_doc", "copies"), "ngram-documents")
    members, postings = _postings(classes.select("class_id", "copies", "n", "prefix"))
    clusters, cold = _clusters(members, postings, percent)
    cold = keep(cold, "ngram-apart")

    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_CLASSES).cast("int").alias("blocks"))
    placed = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    # A block meets every block of its cluster; the smaller number is side 0.
    place = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least("block", other).alias("p"),
            F.greatest("block", other).alias("q"),
            (F.col("block") > other).cast("int").alias("side"),
        ),
    )
    placed = placed.select("class_id", "copies", "cluster", place.alias("places"))
    ids = documents.where("row_id = class_id").select("class_id", F.col("doc_id").alias("rep"), "s1", "s2")
    # One pass over the texts fetches those of all classes that are compared in either way, with their places.
    apart = cold.select("a").union(cold.select("b")).distinct().select(F.col("a").alias("class_id"), F.lit(True).alias("apart"))
    concerned = placed.join(apart, "class_id", "full").join(ids, "class_id")
    fetched = texts.join(concerned.hint("merge"), F.col("doc_id") == F.col("rep"))  # both sides grow with the corpus
    fetched = fetched.select("class_id", "copies", "s1", "s2", "cluster", "places", "apart", "text")
    fetched = keep(fetched, "ngram-texts")
    carried = fetched.select("class_id", "copies", "s1", "s2", "cluster", F.explode("places").alias("x"), "text")
    carried = carried.select("class_id", "copies", "s1", "s2", "cluster", "x.p", "x.q", "x.side", "text")
    blocks = carried.repartition(shuffle_partitions(docs.sparkSession), "cluster", "p", "q")
    compared = blocks.sortWithinPartitions("cluster", "p", "q").mapInArrow(
        _compare(width, percent), "a long, b long, links long"
    )
    compared = keep(compared, "ngram-cluster-links")

    links = compared.where("a <> b").select("a", "b")
    degrees = compared.where("a = b").select("a", "links")
    if cold.take(1):
        whole = fetched.where("apart").select("class_id", "s1", "s2", "text")
        whole = keep(whole.mapInArrow(_sets(width), "class_id long, items array<long>"), "ngram-sets")
        pairs = cold.join(whole.toDF("a", "items_a"), "a").join(whole.toDF("b", "items_b"), "b")
        found = keep(pairs.mapInArrow(_verify(percent), "a long, b long").distinct(), "ngram-pair-links")
        copies = documents.where("row_id = class_id").select(F.col("class_id").alias("b"), "copies")
        ends = found.union(found.select("b", "a")).join(copies, "b")
        links = links.union(found)
        degrees = degrees.union(ends.select("a", F.col("copies").alias("links")))
    return documents, links, degrees.groupBy("a").agg(F.sum("links").alias("links"))


@freeing
def ngram_jaccard_join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, n_links): one row for each row of ``docs``.

    ``class_id`` is the smallest doc_id with the same set, ``n_links`` the number of other
    rows the row links with, copies included.
    """
    documents, links, degrees = link_classes(docs, width, percent)
    # A doc_id of several sets is one node.
    filled = documents.where("n > 0")
    bridges = filled.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).where("a <> z")
    bridges = filled.join(bridges, "doc_id").select("a", F.col("class_id").alias("b")).where("a <> b")
    components = connected_components(links.union(bridges), "ngram-components")
    rows = filled.join(components, filled.class_id == components.node, "left").drop("node")
    rows = keep(rows.withColumn("component", F.coalesce("component", "class_id")), "ngram-rows")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(least, "component").join(degrees, F.col("class_id") == F.col("a"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("class_doc").alias("class_id"),
        "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )
    empty = documents.where("n = 0").select("doc_id", "n", "doc_id", "doc_id", F.lit(0).cast("long"))
    unknown = docs.where("doc_id is null").select(*(F.lit(None).cast("long") for _ in range(4)), F.lit(0).cast("long"))
    return out.union(empty.toDF(*out.columns)).union(unknown.toDF(*out.columns))


def keep_one_of_each_component(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest doc_id of each component; rows without doc_id stay. All columns as they were."""
    joined = ngram_jaccard_join(docs, width, percent).where("doc_id is not null")
    # An id of several rows stays if one of them does.
    stays = F.bool_or(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    dropped = joined.groupBy("doc_id").agg(stays.alias("stays")).where("not stays").select("doc_id")
    dropped = keep(dropped, "ngram-dropped")
    # Few go, so their ids travel and the texts stay where they are.
    few = dropped.limit(DROPPED_IDS + 1).count() <= DROPPED_IDS
    return docs.join(F.broadcast(dropped) if few else dropped, "doc_id", "left_anti").select(*docs.columns)
