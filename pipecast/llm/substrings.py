"""Substring deduplication by repeated-phrase automata.

A window is ``width`` consecutive words of a text. A word goes if a window that covers it
starts anywhere else too, in the same document or another; windows are judged on the input.

1. *Texts.* Equal texts are one text with a number of copies (two 64-bit hashes name it). With
   two copies every window recurs, so the whole text goes; it still counts for others.
2. *Phrases.* A window's phrase is the smallest, by hash, of its runs of PHRASE_WORDS words.
   Equal windows have equal phrases, so only windows whose phrase occurs twice can recur. One
   phrase stands for many windows, so little is shuffled.
3. *Confirmation.* The windows of a repeated phrase meet in one task and are counted. Phrases
   with more than HOT_TEXTS texts are counted window by window instead, by Spark's aggregation.
4. *Automata.* Recurring windows that follow each other make a recurring passage. Texts with
   passages are dealt into shards of like texts; each shard compiles its passages, as spelled,
   into an Aho-Corasick automaton and streams its texts through it. Every occurrence found
   takes its words away. A text carries its own passages, so shards can be cut anywhere
   and each automaton holds about SHARD_CHARS characters.

Windows are told apart by 64-bit hashes of their words; the automata compare characters.

Null and empty texts have no words. Texts under ``width`` words lose nothing. Repeated rows are
copies. Rows with the same or no doc_id are separate rows. Very long texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.llm.store import keep, shuffle_partitions
from pipecast.llm.words import Words, lists, portions, rolling, signed

WIDTH = 35
PHRASE_WORDS = 8
HOT_TEXTS = 20_000
SHARD_CHARS = 1_000_000


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum) over each run of ``size`` values."""
    step, out = 1, values
    while step * 2 <= size:
        out = pick(out[:-step], out[step:])
        step *= 2
    rest = size - step
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def windows_of(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, window): for each window of one text the hash of its phrase and its own."""
    phrase_words = min(PHRASE_WORDS, width)
    if len(hashes) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _sliding(rolling(hashes, phrase_words), width - phrase_words + 1, np.minimum), rolling(hashes, width)


def _joined(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8").split())


def _phrases(width: int):
    """Per text: its number of words, the digest of all its words, its windows' phrases and whether it has them twice."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                words = Words(part.column("text"))
                digests = [hashlib.sha256(_joined(text)).hexdigest() for text in part.column("text").to_pylist()]
                found, twice, ends = [], [], [0]
                for k in range(part.num_rows):
                    hashes = words.hashes[words.bounds[k] : words.bounds[k + 1]]
                    phrase, _ = windows_of(hashes, width)
                    own = np.unique(phrase)
                    if len(own):
                        runs = np.sort(rolling(hashes, min(PHRASE_WORDS, width)))
                        many = np.searchsorted(runs, own, "right") - np.searchsorted(runs, own, "left") > 1
                        found.append(own)
                        twice.append(many)
                    ends.append(ends[-1] + len(own))
                flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                often = np.concatenate(twice) if twice else np.zeros(0, bool)
                bounds = np.array(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "h1", "h2")),
                        pa.array(words.counts),
                        pa.array(digests, pa.string()),
                        lists(signed(flat), bounds, pa.int64()),
                        lists(often, bounds, pa.bool_()),
                    ],
                    names=["doc_id", "h1", "h2", "n_words", "all_sha256", "phrases", "twice"],
                )

    return phrases


def _families(hashes: np.ndarray, width: int, wanted: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(phrase, its distinct windows in this text, how often each) for the wanted phrases, in order of phrase."""
    phrase, window = windows_of(hashes, width)
    inside = np.isin(phrase, wanted)
    phrase, window = phrase[inside], window[inside]
    order = np.lexsort((window, phrase))
    phrase, window = phrase[order], window[order]
    new = np.ones(len(phrase), bool)
    new[1:] = (phrase[1:] != phrase[:-1]) | (window[1:] != window[:-1])
    at = np.flatnonzero(new)
    often = np.diff(np.append(at, len(phrase)))
    phrase, window = phrase[at], window[at]
    cuts = np.flatnonzero(np.diff(phrase, prepend=phrase[:1] + np.uint64(1)))
    ends = np.append(cuts[1:], len(phrase))
    return [(phrase[a], window[a:b], often[a:b]) for a, b in zip(cuts, ends)]


def _spread_families(width: int):
    """One row for each text and wanted phrase, with the windows of the phrase."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                words = Words(part.column("text"))
                wanted = part.column("wanted").to_pylist()
                rows, found = [], []
                for k in range(part.num_rows):
                    hashes = words.hashes[words.bounds[k] : words.bounds[k + 1]]
                    for family in _families(hashes, width, np.array(wanted[k], np.int64).view(np.uint64)):
                        rows.append(k)
                        found.append(family)
                if not rows:
                    continue
                at = pa.array(rows)
                bounds = np.concatenate([[0], np.cumsum([len(f[1]) for f in found])])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("h1").take(at),
                        part.column("h2").take(at),
                        part.column("copies").take(at),
                        pa.array(signed(np.array([f[0] for f in found], np.uint64))),
                        lists(signed(np.concatenate([f[1] for f in found])), bounds, pa.int64()),
                        lists(np.concatenate([f[2] for f in found]), bounds, pa.int64()),
                    ],
                    names=["h1", "h2", "copies", "phrase", "windows", "often"],
                )

    return spread


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row, which of its windows recur. Rows come sorted by phrase; one phrase is held at a time."""
    names = ["h1", "h2", "phrase", "recurs"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.bool_())]

    def settle(rows: list[tuple]) -> list[tuple]:
        flat = np.concatenate([r[4] for r in rows])
        weight = np.concatenate([r[5] * r[2] for r in rows])
        _, where = np.unique(flat, return_inverse=True)
        recurs = (np.bincount(where, weight) >= 2)[where]
        cuts = np.cumsum([len(r[4]) for r in rows])[:-1]
        return [(r[0], r[1], r[3], f) for r, f in zip(rows, np.split(recurs, cuts)) if r[2] == 1 and f.any()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names
        )

    held: list[tuple] = []
    done: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("h1", "h2", "copies", "phrase")]
        arrays = [[x.values.to_numpy() for x in batch.column(c)] for c in ("windows", "often")]
        for row in zip(*columns, *arrays):
            if held and held[-1][3] != row[3]:
                done += settle(held)
                held = []
            held.append(row)
        if done:
            yield batch_of(done)
            done = []
    if held:
        done += settle(held)
    if done:
        yield batch_of(done)


def _confirm_hot(families: DataFrame) -> DataFrame:
    """The same for phrases of very many texts: windows are counted by an aggregation and joined back."""
    cells = families.select(
        "h1", "h2", "phrase", "copies", F.posexplode(F.arrays_zip("windows", "often")).alias("at", "x")
    ).select("h1", "h2", "phrase", "copies", "at", F.col("x.windows").alias("window"), F.col("x.often").alias("often"))
    recurring = cells.groupBy("window").agg(F.sum(F.col("often") * F.col("copies")).alias("n")).where("n >= 2")
    marked = cells.where("copies = 1").join(recurring.select("window", F.lit(True).alias("again")), "window", "left")
    cell = F.struct("at", F.coalesce("again", F.lit(False)).alias("again"))
    rows = marked.groupBy("h1", "h2", "phrase").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    rows = rows.select("h1", "h2", "phrase", F.col("cells.again").alias("recurs"))
    return rows.where(F.exists("recurs", lambda x: x))


def _passages(hashes: np.ndarray, width: int, phrases: np.ndarray, recurs: list[list[bool]]) -> list[tuple[int, int]]:
    """(first word, end) of the passages that the recurring windows make."""
    order = np.argsort(phrases)
    families = _families(hashes, width, phrases)
    windows = np.concatenate([f[1][np.array(recurs[k], bool)] for f, k in zip(families, order)])
    starts = np.flatnonzero(np.isin(windows_of(hashes, width)[1], windows))
    breaks = np.flatnonzero(np.diff(starts) > 1)
    firsts = starts[np.concatenate([[0], breaks + 1])]
    lasts = starts[np.concatenate([breaks, [len(starts) - 1]])]
    return [(int(a), int(b) + width) for a, b in zip(firsts, lasts)]


def _sweep(texts: list[list[bytes]], passages: list[list[tuple[int, int]]]) -> list[np.ndarray]:
    """Compile the passages into one automaton, stream the texts through it: which words an occurrence covers."""
    automaton = ahocorasick.Automaton()
    for words, spans in zip(texts, passages):
        for a, b in spans:
            key = (b" " + b" ".join(words[a:b]) + b" ").decode("utf-8")
            automaton.add_word(key, b - a)
    automaton.make_automaton()
    out = []
    for words in texts:
        spelled = (b" " + b" ".join(words) + b" ").decode("utf-8")
        # A word ends before the blank at its place in ``blanks``.
        points = np.frombuffer(spelled.encode("utf-32-le"), np.uint32)
        last_word = np.cumsum(points == 32) - 1
        change = np.zeros(len(words) + 1, np.int64)
        for end, length in automaton.iter(spelled):
            stop = last_word[end]
            change[stop - length] += 1
            change[stop] -= 1
        out.append(np.cumsum(change[:-1]) > 0)
    return out


def _locate(width: int):
    """Per text: how many words the occurrences take, and the digest of those that stay."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text", SHARD_CHARS):
                hashed = Words(part.column("text"))
                texts = [text.encode("utf-8").split() for text in part.column("text").to_pylist()]
                spans = []
                for k, found in enumerate(part.column("found").to_pylist()):
                    phrases = np.array([f["phrase"] for f in found], np.int64).view(np.uint64)
                    own = hashed.hashes[hashed.bounds[k] : hashed.bounds[k + 1]]
                    spans.append(_passages(own, width, phrases, [f["recurs"] for f in found]))
                gone = _sweep(texts, spans)
                kept = [b" ".join(w for w, g in zip(words, mask) if not g) for words, mask in zip(texts, gone)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("h1"),
                        part.column("h2"),
                        pa.array([int(mask.sum()) for mask in gone], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                        pa.array([x.decode("utf-8") for x in kept], pa.string()),
                    ],
                    names=["h1", "h2", "removed", "sha256", "kept"],
                )

    return locate


def deduplicate_substrings(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row for each row of ``docs``; ``with_text`` adds ``kept_text``.

    Kept words are joined by one space.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    schema = f"doc_id {kind}, h1 long, h2 long, n_words long, all_sha256 string, phrases array<long>, twice array<boolean>"
    rows = keep(named.mapInArrow(_phrases(width), schema), "substring-rows")
    key = ["h1", "h2"]
    texts = rows.where(F.col("n_words") >= width).groupBy(*key).agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("rep_id"), F.first("phrases").alias("phrases"), F.first("twice").alias("twice")
    )
    texts = keep(texts, "substring-texts")
    pairs = texts.select(*key, "copies", F.explode(F.arrays_zip("phrases", "twice")).alias("x"))
    pairs = pairs.select(*key, "copies", F.col("x.phrases").alias("phrase"), F.col("x.twice").alias("twice"))
    counted = pairs.groupBy("phrase").agg(F.count("*").alias("texts"), F.max("twice").alias("again"))
    repeated = keep(counted.where("texts >= 2 or again"), "substring-phrases")
    wanted = pairs.join(repeated, "phrase").groupBy(*key).agg(
        F.collect_list("phrase").alias("wanted"), F.min("phrase").alias("shard")
    )
    wanted = texts.select(*key, "copies", "rep_id").join(wanted, key)
    # One row carries the text of all its copies.
    carried = named.alias("d").join(
        wanted.alias("w"),
        (F.col("d.h1") == F.col("w.h1")) & (F.col("d.h2") == F.col("w.h2")) & F.col("d.doc_id").eqNullSafe(F.col("w.rep_id")),
    )
    carried = carried.select("w.h1", "w.h2", "copies", "shard", "wanted", "text")
    carried = keep(carried, "substring-carried")
    family = ["h1", "h2", "copies", "phrase", "windows", "often"]
    family_schema = "h1 long, h2 long, copies long, phrase long, windows array<long>, often array<long>"
    once = carried.select(*key, "copies", "wanted", "text").dropDuplicates(key)
    families = keep(once.mapInArrow(_spread_families(width), family_schema), "substring-families")
    hot = repeated.where(F.col("texts") > HOT_TEXTS).select("phrase")
    cold_rows = families.join(hot, "phrase", "left_anti").repartition(shuffle_partitions(docs.sparkSession), "phrase")
    cold = cold_rows.select(*family).sortWithinPartitions("phrase").mapInArrow(
        _confirm, "h1 long, h2 long, phrase long, recurs array<boolean>"
    )
    confirmed = keep(cold.unionByName(_confirm_hot(families.join(hot, "phrase", "left_semi"))), "substring-confirmed")
    found = confirmed.groupBy(*key).agg(F.collect_list(F.struct("phrase", "recurs")).alias("found"))
    streams = carried.where("copies = 1").select(*key, "shard", "text").join(found, key)
    # Texts with a phrase in common lie next to each other; any cut between shards is right.
    sharded = streams.repartition(shuffle_partitions(docs.sparkSession), "shard", "h1").sortWithinPartitions("shard")
    located = sharded.select(*key, "text", "found").mapInArrow(
        _locate(width), "h1 long, h2 long, removed long, sha256 string, kept string"
    )
    located = keep(located if with_text else located.drop("kept"), "substring-located")
    results = texts.select(*key, "copies").join(located, key, "left")
    everything = F.col("copies") >= 2
    nothing = F.sha2(F.lit(""), 256)
    out = rows.select("doc_id", *key, "n_words", "all_sha256").join(results, key, "left")
    columns = [
        "doc_id",
        "n_words",
        F.when(everything, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(everything, nothing).otherwise(F.coalesce("sha256", "all_sha256")).alias("kept_sha256"),
    ]
    if not with_text:
        return out.select(*columns)
    whole = named.select("doc_id", *key, F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ").alias("whole"))
    whole = whole.select("doc_id", *key, F.trim("whole").alias("whole")).dropDuplicates(["doc_id", *key])
    text = F.when(everything, F.lit("")).otherwise(F.coalesce("kept", "whole")).alias("kept_text")
    whole = whole.toDF("id", "k1", "k2", "whole")
    same = out["doc_id"].eqNullSafe(whole["id"]) & (out["h1"] == whole["k1"]) & (out["h2"] == whole["k2"])
    return out.join(whole, same).select(*columns, text)

