"""Language model scoring by the subword lattice.

A word, with the mark that begins it, is all the ways to cut it into pieces of an existing
vocabulary. Its probability is the sum over those ways of the product of the pieces'
probabilities: the forward recursion in log space gives it. A text's probability is the
product over its words and one end token, which counts as a word; every byte is a piece too,
so no word is impossible.

The pieces' probabilities start from the vocabulary's scores (its pieces are ranked: a piece
of rank r gets weight 1 / (r + 10)) and are re-estimated by ``rounds`` steps of expectation
maximisation over the distinct words of all training documents.

A word seen in training is one more edge of its lattice, from its start to its end, so that

    P(word) = max(c - d, 0) / N + d * V / N * P_pieces(word)

with c the word's count, N all training tokens, V distinct ones and d the absolute discount
n1 / (n1 + 2 * n2) from the words seen once and twice. All words together have probability 1
at most, the end token included.

The recursion runs over all words of a portion at once: pieces are looked up by a rolling
hash at every place, and the lattice's edges are worked off by their distance from the
word's start. Its cost is proportional to the text.

Word counts for the base score cover all training tokens. The ``frequent`` words' counts go
to every task; all other words are counted by a join. Null and empty texts have one token,
the end. Without training documents the probabilities are those of the vocabulary and the
base score is that of no counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.llm.store import fold, keep
from pipecast.llm.vocabulary import MARK, Vocabulary
from pipecast.llm.words import Words, lists, mix, portions, powers, signed, text_bytes

ROUNDS = 3
# Words whose counts go to every task: a table of 16 bytes each.
FREQUENT_WORDS = 1 << 17
# Words a task remembers the probability of, 16 bytes each.
REMEMBERED_WORDS = 1_000_000
# Words of several portions that a task holds before it gives them away, counted.
COUNTED_AT_ONCE = 1_000_000
# Words that one pass of the recursion takes.
WORDS_AT_ONCE = 30_000
# The fold that is held out.
HELD_OUT_FOLD = 1

_PIECE_BASE = 0xA0761D6478BD642F
_FILTER_BITS = 22
# Numbers of first bytes after which it is looked up how long the pieces that begin with them are at most.
_PREFIXES = (3, 6, 9)
_PREFIX_BITS = 20
_MARK_BYTES = np.frombuffer(MARK.encode("utf-8"), np.uint8)
_LN10 = float(np.log(10.0))


def _piece_keys(data: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of ``length`` bytes of ``data``."""
    up, down = powers(_PIECE_BASE, len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])])
    return mix((sums[length:] - sums[:-length]) * down[: len(sums) - length])


@dataclass
class PieceTable:
    """Pieces that fit in one marked word, by the hash of their bytes."""

    keys: np.ndarray
    ids: np.ndarray
    filter: np.ndarray
    longest: dict[int, np.ndarray]
    lengths: list[int]
    byte_ids: np.ndarray
    size: int

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> PieceTable:
        ids = vocabulary.inside_words
        coded = [np.frombuffer(vocabulary.pieces[i].encode("utf-8"), np.uint8) for i in ids]
        keys = np.array([_piece_keys(c, len(c))[0] for c in coded], np.uint64)
        order = np.argsort(keys)
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[keys >> np.uint64(64 - _FILTER_BITS)] = True
        lengths = sorted({len(c) for c in coded})
        longest = {}
        for n in set(_PREFIXES).intersection(lengths):
            longest[n] = np.zeros(1 << _PREFIX_BITS, np.int64)
            long = [c for c in coded if len(c) >= n]
            slots = np.array([_piece_keys(c[:n], n)[0] for c in long], np.uint64) >> np.uint64(64 - _PREFIX_BITS)
            np.maximum.at(longest[n], slots, [len(c) for c in long])
        return cls(keys[order], np.array(ids)[order], seen, longest, lengths, np.array(vocabulary.byte_ids), len(vocabulary.pieces))


def start_probabilities(vocabulary: Vocabulary, table: PieceTable) -> np.ndarray:
    """Log probability by piece id from the vocabulary's ranks."""
    weights = np.zeros(table.size)
    known = vocabulary.weights
    for i in vocabulary.inside_words:
        weights[i] = known[i]
    weights[table.byte_ids] = weights[weights > 0].min()
    with np.errstate(divide="ignore"):
        return np.log(weights / weights.sum())


def _stable_order(key: np.ndarray) -> np.ndarray:
    """The order that sorts non-negative ``key``, equal ones as they come."""
    n = len(key)
    if n and int(key.max()) < np.iinfo(np.int64).max // n - 1:
        return np.sort(key * n + np.arange(n)) % n  # sorting numbers is faster than sorting their places
    return np.argsort(key, kind="stable")


class Lattice:
    """The edges of a run of marked words and the recursions over them."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: PieceTable) -> None:
        lengths = ends - starts + len(_MARK_BYTES)
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.empty(self.bounds[-1], np.uint8)
        inside = np.ones(len(flat), bool)
        for k, byte in enumerate(_MARK_BYTES):
            flat[self.bounds[:-1] + k] = byte
            inside[self.bounds[:-1] + k] = False
        source = np.repeat(starts - self.bounds[:-1] - len(_MARK_BYTES), lengths) + np.arange(len(flat))
        flat[inside] = data[source[inside]]
        end_of = np.repeat(self.bounds[1:], lengths)
        froms, tos, pieces = [], [], []
        up, down = powers(_PIECE_BASE, len(flat) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:-1])])
        places = np.arange(len(flat))
        room = end_of - places
        for length in table.lengths:
            # Lengths ascend, so a place that lacks the room for one has none for the next.
            places = places[room[places] >= length]
            keys = mix((sums[places + length] - sums[places]) * down[places])
            maybe = np.flatnonzero(table.filter[keys >> np.uint64(64 - _FILTER_BITS)])
            at = np.searchsorted(table.keys, keys[maybe])
            at[at == len(table.keys)] = 0
            hit = table.keys[at] == keys[maybe]
            froms.append(places[maybe[hit]])
            tos.append(froms[-1] + length)
            pieces.append(table.ids[at[hit]])
            if length in table.longest:
                # Of slots that several beginnings share the longest counts, so no piece is lost.
                further = table.longest[length][keys >> np.uint64(64 - _PREFIX_BITS)] > length
                reach = table.longest[length][keys[further] >> np.uint64(64 - _PREFIX_BITS)]
                places = places[further]
                room[places] = np.minimum(room[places], reach)
        single = np.flatnonzero(inside)
        froms.append(single)
        tos.append(single + 1)
        pieces.append(table.byte_ids[flat[single]])
        # Node numbers: one more than bytes for each word.
        word_of = np.repeat(np.arange(len(lengths)), lengths)
        self.start = np.concatenate(froms)
        self.word = word_of[self.start]
        self.end = np.concatenate(tos) + self.word
        self.start = self.start + self.word
        self.piece = np.concatenate(pieces)
        self.first = self.bounds[:-1] + np.arange(len(lengths))
        self.last = self.bounds[1:] + np.arange(len(lengths))
        self.base = np.repeat(self.first, lengths + 1)
        self.nodes = len(flat) + len(lengths)

    def _log_sums(self, values: np.ndarray, depth: np.ndarray, node: np.ndarray, other: np.ndarray, weight: np.ndarray) -> None:
        """Set ``values`` at each node to the log-sum of its edges, ``values`` at their other ends plus ``weight``, by rising depth."""
        key = depth * self.nodes + node
        order = _stable_order(key)
        key, node, other, weight = key[order], node[order], other[order], weight[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(np.append(begins, len(key)))
        levels = np.append(np.flatnonzero(np.diff(key[begins] // self.nodes, prepend=-1)), len(begins))
        for i, j in zip(levels[:-1], levels[1:]):
            a, b = begins[i], begins[j - 1] + sizes[j - 1]
            begin = begins[i:j] - a
            reached = values[other[a:b]] + weight[a:b]
            top = np.maximum.reduceat(reached, begin)
            safe = np.where(np.isfinite(top), top, 0.0)
            total = np.add.reduceat(np.exp(reached - np.repeat(safe, sizes[i:j])), begin)
            with np.errstate(divide="ignore"):
                values[node[begins[i:j]]] = safe + np.log(total)

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """Log probability of reaching each node."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.first] = 0.0
        self._log_sums(alpha, self.end - self.base[self.end], self.end, self.start, log_p[self.piece])
        return alpha

    def words(self, log_p: np.ndarray) -> np.ndarray:
        """Log probability of each word."""
        return self.forward(log_p)[self.last]

    def expected(self, log_p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, words weighing their counts."""
        alpha = self.forward(log_p)
        beta = np.full(self.nodes, -np.inf)
        beta[self.last] = 0.0
        self._log_sums(beta, self.last[self.word] - self.start, self.start, self.end, log_p[self.piece])
        share = alpha[self.start] + log_p[self.piece] + beta[self.end] - alpha[self.last][self.word]
        return np.bincount(self.piece, np.exp(share) * counts[self.word], minlength=len(log_p))


def _word_runs(n: int) -> Iterator[slice]:
    for at in range(0, n, WORDS_AT_ONCE):
        yield slice(at, min(n, at + WORDS_AT_ONCE))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n, word) of each batch's distinct words; a word of a batch with more than ``COUNTED_AT_ONCE`` may come again.

    Portions are small, as the work arrays take many times a text's bytes; what they find is put together.
    """
    for batch in batches:
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0
        for part in portions(batch, "text"):
            words = Words(part.column("text"), lower=True)
            found, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
            held.append((found, n, _spelled(_lowered(words.data), words.starts[first], words.ends[first])))
            size += len(found)
            if size > COUNTED_AT_ONCE:
                yield _together(held)
                held, size = [], 0
        if held:
            yield _together(held)


def _spelled(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words between the given places of ``raw``."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    places = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw[places])]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _together(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> pa.RecordBatch:
    found, first, where = np.unique(np.concatenate([h for h, _, _ in held]), return_index=True, return_inverse=True)
    n = np.bincount(where, np.concatenate([n for _, n, _ in held]), len(found)).astype(np.int64)
    word = pa.concat_arrays([word for _, _, word in held]).take(pa.array(first))
    return pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n), word], names=["h", "n", "word"])


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def word_counts(training: DataFrame) -> DataFrame:
    """(h, n, word): each distinct word of the training texts with its count."""
    counted = training.select("text").mapInArrow(_count_words, "h long, n long, word binary")
    return counted.groupBy("h").agg(F.sum("n").alias("n"), F.min("word").alias("word"))


def _expect(table: PieceTable, log_p: np.ndarray):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(log_p))
        for batch in batches:
            data, offsets = text_bytes(batch.column("word").cast(pa.binary()))
            once = np.ones(batch.num_rows)
            for run in _word_runs(batch.num_rows):
                lattice = Lattice(data, offsets[:-1][run], offsets[1:][run], table)
                total += lattice.expected(log_p, once[run])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

    return expect


def fit_pieces(words: DataFrame, vocabulary: Vocabulary, table: PieceTable, rounds: int = ROUNDS) -> np.ndarray:
    """Log probability by piece id. The driver gets one row a piece and round."""
    log_p = start_probabilities(vocabulary, table)
    usable = np.isfinite(log_p)
    for _ in range(rounds):
        found = words.select("word").mapInArrow(_expect(table, log_p), "piece long, uses double")
        uses = np.zeros(len(log_p))
        for piece, n in found.groupBy("piece").agg(F.sum("uses")).collect():
            uses[piece] = n
        uses[usable] += 0.01
        with np.errstate(divide="ignore"):
            log_p = np.log(uses / uses.sum())
    return log_p


@dataclass(frozen=True)
class TrainingCounts:
    """Figures of the training tokens; ``frequent`` words are sorted by hash."""

    tokens: int
    distinct: int
    documents: int
    discount: float
    frequent: np.ndarray
    counts: np.ndarray

    def known(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a word is a frequent one, its count or 0)."""
        if not len(self.frequent):
            return np.zeros(len(found), bool), np.zeros(len(found))
        at = np.searchsorted(self.frequent, found)
        at[at == len(self.frequent)] = 0
        known = self.frequent[at] == found
        return known, np.where(known, self.counts[at], 0.0)


class RememberedWords:
    """Lattice probabilities of the words a task has met, by hash; forgotten when they are too many."""

    def __init__(self, table: PieceTable, log_p: np.ndarray) -> None:
        self.table, self.log_p = table, log_p
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, found: np.ndarray, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Log probability of each word of ``found`` (ascending); words not met before go through the lattice."""
        out = np.zeros(len(found))
        at = np.minimum(np.searchsorted(self.keys, found), max(len(self.keys) - 1, 0))
        met = self.keys[at] == found if len(self.keys) else np.zeros(len(found), bool)
        out[met] = self.values[at[met]]
        new = np.flatnonzero(~met)
        for run in _word_runs(len(new)):
            out[new[run]] = Lattice(raw, starts[new[run]], stops[new[run]], self.table).words(self.log_p)
        if len(self.keys) > REMEMBERED_WORDS:
            self.keys, self.values = found, out
        elif len(new):
            at = np.searchsorted(self.keys, found[new])
            self.keys, self.values = np.insert(self.keys, at, found[new]), np.insert(self.values, at, out[new])
        return out


def _score(table: PieceTable, log_p: np.ndarray, train: TrainingCounts):
    """Per text: the two scores as far as words are frequent or new, and its other words.

    A word that is neither is given as hash and probability by its pieces; the counts of
    those that turn out to be known are added by a join.
    """
    n_all = max(train.tokens, 1)
    total = train.tokens + 0.5 * (train.distinct + 1)
    share = train.discount * train.distinct / n_all if train.tokens else 1.0
    end_base = np.log10((train.documents + 0.5) / total)
    end_score = np.log10(train.documents / n_all) if train.documents else -np.log10(2.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40
        remembered = RememberedWords(table, log_p)
        for batch in batches:
            for part in portions(batch, "text"):
                words = Words(part.column("text"), lower=True)
                found, first, where = np.unique(words.hashes, return_index=True, return_inverse=True)
                log_word = remembered.of(found, _lowered(words.data), words.starts[first], words.ends[first])
                known, counts = train.known(found)
                by_pieces = share * np.exp(log_word)
                base = np.log10((counts + 0.5) / total)
                with np.errstate(divide="ignore"):
                    rare = np.log10(share) + log_word / _LN10
                    own = np.where(known, np.log10(np.maximum(counts - train.discount, 0) / n_all + by_pieces), rare)
                sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[words.bounds])
                rest = ~known[where]
                kept = np.concatenate([[0], np.cumsum(rest)])[words.bounds]
                n = words.counts
                ids = next_id + np.arange(part.num_rows)
                next_id += part.num_rows
                columns = [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(ids),
                    pa.array(n + 1),
                    pa.array(n - np.diff(kept) + (train.documents > 0)),
                    pa.array(sums(base[where]) + end_base),
                    pa.array(sums(own[where]) + end_score),
                    pa.array(sums(log_word[where]) / _LN10),
                    lists(signed(words.hashes[rest]), kept, pa.int64()),
                    lists(rare[where][rest], kept, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "held_out", "row_id", "n_tokens", "known", "base", "own", "by_pieces", "others", "rare"]
                )

    return score


def lattice_scores(
    docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, frequent_words: int = FREQUENT_WORDS
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, pieces_score), one row for each of ``docs``.

    Scores are log10 probabilities; ``pieces_score`` is that of the words by their pieces alone, without
    the ends and the training words' own counts. Learns from the rows whose fold is not ``HELD_OUT_FOLD``;
    rows with a null id are scored, not learned from.
    """
    table = PieceTable.of(vocabulary)
    training = docs.where(fold() != HELD_OUT_FOLD)
    words = keep(word_counts(training), "lattice-words")
    documents = training.count()
    in_words, kinds, once, twice = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    log_p = fit_pieces(words, vocabulary, table, rounds)
    top = words.select("h", "n").orderBy(F.col("n").desc(), "h").limit(frequent_words).toArrow()
    top_h, top_n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(top_h)
    train = TrainingCounts(
        tokens=in_words + documents,
        distinct=kinds + (documents > 0),
        documents=documents,
        discount=min(max(once / max(once + 2 * twice, 1), 0.1), 0.9),
        frequent=top_h[order],
        counts=top_n[order],
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, row_id long, n_tokens long, known long, base double, own double, "
        "by_pieces double, others array<long>, rare array<double>"
    )
    marked = docs.select("doc_id", F.coalesce(fold() == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "text")
    scored = keep(marked.mapInArrow(_score(table, log_p, train), schema), "lattice-scores")
    others = scored.select("row_id", F.explode(F.arrays_zip("others", "rare")).alias("w"))
    others = others.select("row_id", F.col("w.others").alias("h"), F.col("w.rare").alias("rare"))
    seen = others.join(words.select("h", "n"), "h")
    base_gain = F.log10(F.col("n") + 0.5) - F.log10(F.lit(0.5))
    whole = F.greatest(F.col("n") - F.lit(train.discount), F.lit(0.0)) / F.lit(float(max(train.tokens, 1)))
    own_gain = F.log10(whole + F.pow(F.lit(10.0), F.col("rare"))) - F.col("rare")
    per_row = seen.groupBy("row_id").agg(
        F.sum(base_gain).alias("base_gain"), F.sum(own_gain).alias("own_gain"), F.count("*").alias("more")
    )
    joined = scored.drop("others", "rare").join(per_row, "row_id", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(train.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_gain", F.lit(0.0))).alias("base_score"),
        (F.col("own") + F.coalesce("own_gain", F.lit(0.0))).alias("score"),
        F.col("by_pieces").alias("pieces_score"),
    )
