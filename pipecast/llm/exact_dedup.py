"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after replacing each run of white space
(space, U+0009 to U+000D) by one space. Records are partitioned by hash until each
bucket's distinct texts fit a table, and tables compare complete texts:

1. While scanning, each Arrow batch collapses its own copies (a table of complete texts),
   so that a text held by a third of all rows leaves a batch once. Every row becomes a
   *member* of its batch's representative; representatives carry the text.
2. The bytes of distinct digests are summed per bucket. While a bucket is over the bound,
   partitioning goes on by further hash bits. The driver learns only whether one is left.
3. Spark shuffles the representatives to their buckets: its shuffle files are the spill
   files. A task builds an open-addressing table (CPython's dict: probing, equal hash, then
   a comparison of the complete text) per bucket and numbers the classes.
4. Members get their class through their representative. A representative has at most a
   batch of members, so no key is hot.

``drop_duplicates`` needs no members: it sends whole rows to the buckets, and the tables give
the rows that stay.

Equal digests alone never make two texts equal. Null text counts as empty. Rows with the
same doc_id are separate rows; of equal rows, the first written stays. A null doc_id sorts
last. An empty table gives an empty result. Very long texts are taken whole; a single text
over a bucket's bound has a bucket of its own. Further columns are kept by
``drop_duplicates``, whatever their names, and not read otherwise.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipecast.llm.store import freeing, keep, scratch, shuffle_partitions

# Bytes of distinct text that one bucket's table may hold.
BUCKET_BYTES = 64_000_000
# Bytes of text that a task remembers to drop copies ahead of the shuffle; any number gives the same result.
REMEMBERED_BYTES = 32_000_000
# Hash bits added when buckets are too large, and when to stop.
SPLIT_BITS = 4
MOST_BITS = 60


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _collapse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows; of equal texts in a batch only the row with the smallest doc_id keeps its columns."""
    next_id = TaskContext.get().partitionId() << 40
    for batch in batches:
        docs = batch.column("doc_id").to_pylist()
        texts = batch.column("content").to_pylist()
        best: dict[str, int] = {}
        for k, text in enumerate(texts):
            b = best.setdefault(text, k)
            if docs[k] is not None and (docs[b] is None or docs[k] < docs[b]):
                best[text] = k
        reps = [best[text] for text in texts]
        kept = pa.array([k if rep == k else None for k, rep in enumerate(reps)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([next_id + k for k in range(len(docs))], pa.int64()),
                pa.array([next_id + rep for rep in reps], pa.int64()),
                batch.column("size"),
                batch.column("digest"),
                batch.column("row").take(kept),
            ],
            names=["doc_id", "row_id", "rep_id", "size", "digest", "row"],
        )
        next_id += len(docs)


def _match_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table for each bucket of this task: rows of equal text get the first row's number as class.

    Rows arrive sorted by bucket, so one table is held at a time.
    """
    bucket, table = None, {}
    for batch in batches:
        classes = []
        rows = zip(*(batch.column(name).to_pylist() for name in ("bucket", "rep_id", "content")))
        for b, rep, text in rows:
            if b != bucket:
                bucket, table = b, {}
            classes.append(table.setdefault(text, rep))
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep_id"), pa.array(classes, pa.int64())], names=["rep_id", "class_id"]
        )


def _bucket(level: int):
    """The first bits of the digest's hash: at each level SPLIT_BITS more."""
    bits = level * SPLIT_BITS
    return F.shiftrightunsigned(F.xxhash64("digest"), 64 - bits) if bits else F.lit(0).cast("long")


def partition_level(reps: DataFrame, bucket_bytes: int) -> int:
    """How often to partition: until no bucket of several texts is over the bound.

    The sizes of distinct digests are summed per bucket on the executors; the driver gets
    one row a level. At least four buckets a shuffle partition, so that tasks are even.
    """
    sizes = keep(reps.groupBy("digest").agg(F.max("size").alias("size")), "exact-sizes")
    level = 0
    while (1 << (level * SPLIT_BITS)) < 4 * shuffle_partitions(reps.sparkSession):
        level += 1
    while level * SPLIT_BITS < MOST_BITS:
        over = (
            sizes.groupBy(_bucket(level).alias("bucket"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("texts"))
            .where((F.col("bytes") > bucket_bytes) & (F.col("texts") > 1))
        )
        if not over.take(1):
            break
        level += 1
    return level


def _resolved(docs: DataFrame, bucket_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(every row with its representative, every representative with its class's first row and size)."""
    text = docs.select(
        "doc_id", normalised(F.col("text")).alias("content"), F.struct("text").alias("row")
    ).select(
        "doc_id",
        "content",
        "row",
        F.octet_length("content").cast("long").alias("size"),
        F.unhex(F.sha2("content", 256)).alias("digest"),
    )
    fields = "doc_id {}, row_id long, rep_id long, size long, digest binary".format(
        docs.schema["doc_id"].dataType.simpleString()
    )
    schema = T.StructType([*T.StructType.fromDDL(fields).fields, T.StructField("row", text.schema["row"].dataType)])
    rows = keep(text.mapInArrow(_collapse_batches, schema), "exact-rows")
    reps = rows.where("row_id = rep_id")
    level = partition_level(reps.select("size", "digest"), bucket_bytes)
    spilled = reps.select(
        "rep_id", _bucket(level).alias("bucket"), normalised(F.col("row.text")).alias("content")
    ).repartition(shuffle_partitions(docs.sparkSession), "bucket")
    matched = spilled.sortWithinPartitions("bucket").mapInArrow(_match_bucket, "rep_id long, class_id long")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    per_rep = rows.groupBy("rep_id").agg(first.alias("first"), F.count("*").alias("n"))
    matched = keep(matched.join(per_rep, "rep_id"), "exact-classes")
    per_class = matched.groupBy("class_id").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    return rows, matched.select("rep_id", "class_id").join(per_class, "class_id")


@freeing
def exact_duplicates(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``."""
    rows, resolved = _resolved(docs, bucket_bytes)
    return rows.select("doc_id", "row_id", "rep_id", "digest").join(resolved, "rep_id").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("first.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _order(doc_id, tie) -> tuple:
    """Rows of equal text in order: by doc_id, nulls last, then by the hash of all their columns."""
    return (doc_id is None, 0 if doc_id is None else doc_id, tie)


def _least_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out rows that a row of equal text seen before in this task precedes.

    The latest texts are remembered, REMEMBERED_BYTES of them: a text held by a third of all rows
    leaves a task a few times, however many copies the task reads.
    """
    seen: OrderedDict[str, tuple] = OrderedDict()
    held = 0
    for batch in batches:
        rows = []
        for k, (doc_id, tie, text, size) in enumerate(
            zip(*(batch.column(name).to_pylist() for name in ("doc_id", "tie", "content", "size")))
        ):
            order, before = _order(doc_id, tie), seen.get(text)
            if before is None:
                held += size
            else:
                seen.move_to_end(text)
                if before <= order:
                    continue
            seen[text] = order
            rows.append(k)
        while held > REMEMBERED_BYTES:
            held -= len(seen.popitem(last=False)[0].encode("utf-8"))
        yield batch.select(["doc_id", "tie", "bucket", "row"]).take(pa.array(rows, pa.int64()))


def _least_of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table for each bucket of this task; of equal texts the first row in order comes out.

    Rows arrive sorted by bucket, so one table is held at a time, with the rows that entered it.
    """
    bucket, table, parts = None, {}, []

    def first_rows() -> Iterator[pa.RecordBatch]:
        alive = [[] for _ in parts]
        for _, part, k in table.values():
            alive[part].append(k)
        for part, rows in zip(parts, alive):
            if rows:
                yield pa.RecordBatch.from_arrays([part.take(pa.array(sorted(rows)))], names=["row"])

    for batch in batches:
        entered = []
        rows = zip(*(batch.column(name).to_pylist() for name in ("bucket", "doc_id", "tie", "content")))
        for k, (b, doc_id, tie, text) in enumerate(rows):
            if b != bucket:
                parts.append(batch.column("row").take(pa.array(entered, pa.int64())))
                yield from first_rows()
                bucket, table, parts, entered = b, {}, [], []
            order, before = _order(doc_id, tie), table.get(text)
            if before is None or order < before[0]:
                table[text] = (order, len(parts), len(entered))
                entered.append(k)
        parts.append(batch.column("row").take(pa.array(entered, pa.int64())))
    yield from first_rows()


def drop_duplicates(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the smallest doc_id, all columns as they were.

    Whole rows go to the buckets, so a text is shuffled once and the tables give the result. Of
    rows with the same text and doc_id, the one whose columns have the smallest hash stays.
    """
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    texts = docs.select(
        "doc_id", normalised(F.col("text")).alias("content"), F.xxhash64(*hashed).alias("tie"), F.struct(*docs.columns).alias("row")
    )
    texts = texts.select(
        "*", F.octet_length("content").cast("long").alias("size"), F.unhex(F.sha2("content", 256)).alias("digest")
    )
    with scratch(docs.sparkSession):
        level = partition_level(texts.select("size", "digest"), bucket_bytes)
    dealt = texts.select("doc_id", "tie", "content", "size", _bucket(level).alias("bucket"), "row")
    fields = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tie long, bucket long"
    row = T.StructField("row", texts.schema["row"].dataType)
    few = dealt.mapInArrow(_least_of_task, T.StructType([*T.StructType.fromDDL(fields).fields, row]))
    spilled = few.repartition(shuffle_partitions(docs.sparkSession), "bucket").sortWithinPartitions("bucket")
    spilled = spilled.withColumn("content", normalised(F.col("row.text")))
    return spilled.mapInArrow(_least_of_buckets, T.StructType([row])).select("row.*")
