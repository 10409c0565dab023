"""Toxicity by two class-conditional Kneser-Ney models.

Words are as in ``words`` (A-Z lower-cased); a Chinese or Japanese character is a word of its own.
Counts are numbers of texts, so that a text which repeats an expression counts once. There are
three levels of expressions, each backing off to the next:

* pair: a word with the word before it,
* word: the whole word,
* beginning: its first BEGINNING code points, so that inflected forms count together.

Each level has a model per class, as a ratio to the counts of both classes:
``r_c(x) = max(n_c(x) - D_c, 0) / (N_c * P(x)) + rest_c * r_c(backoff of x)``. ``rest_c`` is the
share that discounting took away; a pair backs off to the product of its words' ratios, a
word to its beginning, a beginning to 1, the shared counts. D_c follows the class's size, so an
expression that is rare in the smaller class backs off in both classes alike. The shared model is
``P(x) = (max(n - d, 0) + rest * P_cont) / N``, with P_cont in proportion to how many different
words precede the expression, estimated from 64-bit maps of neighbours (linear counting).

A word's evidence is the log ratio of the toxic to the ordinary model, given the word before it.
Expressions are told apart by 64-bit hashes, and totals cover all. A level's table has all
expressions with a count above the discount; others have no term of their own. The fit reads at most
SAMPLE_ROWS labelled documents, those whose ids hash lowest outside fold 0; this bounds the tables, too.

A text's evidence is its log-likelihood under the toxic model less that under the ordinary
one, divided by the number of words and by its square root, on a scale that is linear for small and
logarithmic for large figures. A logistic regression turns the
two figures into a score; it is fitted on training rows whose words were not counted.

Null and empty texts have evidence 0. With labels of one kind only, or none, every score is
0.0. Labels other than 0 and 1, and labels of unknown documents, are left out; a document
with several labels counts once for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.llm.store import fold, keep
from pipecast.llm.words import _BYTE_BASE, Words, _byte_values, mix, portions, powers, signed

# The most labelled documents that are learned from.
SAMPLE_ROWS = 12_000
# In how many texts an expression must be seen in the smaller class to speak for itself.
DISCOUNT = 2.0
SHARED_DISCOUNT = 0.75
# Standard deviations between the classes at which half of their difference counts.
SPREAD = 4.0
# Code points of a word that make its beginning.
BEGINNING = 4
# The fold whose rows calibrate the score.
CALIBRATION_FOLD = 4
PAIR, WORD, BEGIN = range(3)


@dataclass(frozen=True)
class Level:
    """``own``: of each key (ascending), the term of its own in the ordinary and the toxic ratio; ``rest``: what backs off."""

    keys: np.ndarray
    own: np.ndarray
    rest: np.ndarray

    def ratios(self, keys: np.ndarray, backoff: np.ndarray) -> np.ndarray:
        out = self.rest[:, None] * backoff
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out += np.where(self.keys[at] == keys, self.own[:, at], 0.0)
        return out


@dataclass(frozen=True)
class ToxicityModel:
    """``levels``: pairs, words, beginnings; ``weights``: of the two figures; intercept None without both classes."""

    levels: tuple[Level, ...]
    weights: tuple[float, float]
    intercept: float | None


class Expressions:
    """Of a portion of texts: ``keys`` of each word's pair, word and beginning, ``owner`` the word's text.

    ``follows`` tells which words have a word before them in their text; only these have a pair.
    """

    def __init__(self, texts: pa.Array) -> None:
        words = Words(texts, lower=True)
        data, n = words.data, len(words.data)
        first = np.zeros(n + 1, bool)
        first[words.starts] = True
        last = np.zeros(n + 1, bool)
        last[words.ends] = True
        letter = np.append((data & 0xC0) != 0x80, True)
        # U+3000 to U+9FFF, and from U+20000 on: scripts without spaces between words.
        second = np.append(data[1:], np.uint8(0)) if n else data
        alone = np.flatnonzero(((data >= 0xE3) & (data <= 0xE9)) | ((data == 0xF0) & (second >= 0xA0)))
        places = np.flatnonzero(letter)
        if len(alone):
            after = places[np.searchsorted(places, alone, side="right")]
            inside = np.cumsum(first.astype(np.int64) - last)
            for edge in (alone, after[inside[after] > 0]):
                last[edge[(inside[edge] > 0) & ~first[edge]]] = True
                first[edge] = True
        starts, ends = np.flatnonzero(first), np.flatnonzero(first | last)
        ends = ends[np.searchsorted(ends, starts, side="right")] if len(starts) else starts
        begins = np.minimum(ends, places[np.minimum(np.searchsorted(places, starts) + BEGINNING, len(places) - 1)])
        up, down = powers(_BYTE_BASE, max(n, 1))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_values(True)[data] * up[:n], dtype=np.uint64)])
        whole = mix((sums[ends] - sums[starts]) * down[starts])
        begin = mix((sums[begins] - sums[starts]) * down[starts])
        self.owner = np.searchsorted(words.offsets, starts, side="right") - 1
        self.bounds = np.searchsorted(starts, words.offsets)
        self.follows = np.concatenate([[False], self.owner[1:] == self.owner[:-1]]) if len(starts) else np.zeros(0, bool)
        self.before = np.concatenate([[np.uint64(0)], whole[:-1]]) if len(starts) else whole
        self.keys = [mix(self.before * np.uint64(0x9E3779B97F4A7C15) + whole), whole, begin]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts have each expression, by class, and a map of the words before it; a row a portion."""
    for batch in batches:
        for part in portions(batch, "text"):
            found = Expressions(part.column("text"))
            label = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[found.owner]
            bit = np.uint64(1) << (mix(found.before) & np.uint64(63))
            bit[~found.follows] = 0
            for level, keys in enumerate(found.keys):
                used = found.follows if level == PAIR else np.ones(len(keys), bool)
                if not used.any():
                    continue
                names, places = np.unique(keys[used], return_inverse=True)
                once = np.unique(found.owner[used] * len(names) + places, return_index=True)[1]
                place, toxic = places[once], label[used][once]
                before = np.zeros(len(names), np.uint64)
                if level == PAIR:  # the map of the words before the word at i - 1
                    np.bitwise_or.at(before, places, np.concatenate([[np.uint64(0)], bit[:-1]])[used])
                else:
                    np.bitwise_or.at(before, places, bit[used])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(names), level, np.int8)),
                        pa.array(signed(names)),
                        pa.array(np.bincount(place[toxic == 0], minlength=len(names))),
                        pa.array(np.bincount(place[toxic == 1], minlength=len(names))),
                        pa.array(signed(before)),
                    ],
                    names=["level", "key", "ordinary", "toxic", "before"],
                )


def kneser_ney(
    keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray, totals: np.ndarray, taken: np.ndarray, all_contexts: float,
    shared_taken: float, discounts: np.ndarray,
) -> Level:
    """A level from the counts (ordinary, toxic) of its table and from totals over all its expressions.

    ``taken``: what the discounts take from each class in all; ``shared_taken``: from both together.
    """
    both = counts.sum(axis=0)
    shared = (np.maximum(both - SHARED_DISCOUNT, 0) + shared_taken * contexts / max(all_contexts, 1.0)) / max(totals.sum(), 1.0)
    n = np.maximum(totals, 1.0)
    share = totals[1] / max(totals.sum(), 1.0)
    differs = (counts[1] - both * share) ** 2
    weight = differs / (differs + SPREAD**2 * (both * min(share, 1 - share) + 1.0))
    alike = both * np.array([[1 - share], [share]])
    own = np.maximum(alike + weight * (counts - alike) - discounts[:, None], 0) / n[:, None] / shared
    order = np.argsort(keys)
    return Level(keys[order], own[:, order].astype(np.float32), np.full(2, taken.sum() / totals.sum() if totals.sum() else 1.0))


def _evidence_of(texts: pa.Array, levels: tuple[Level, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood difference by words and by their square root, for each text."""
    means, roots = [], []
    for part in portions(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
        found = Expressions(part.column("text"))
        pair, word, begin = found.keys
        of_word = levels[WORD].ratios(word, levels[BEGIN].ratios(begin, np.ones((2, len(begin)))))
        of_before = np.concatenate([np.ones((2, 1)), of_word[:, :-1]], axis=1)[:, : len(word)]
        given = levels[PAIR].ratios(pair, of_before * of_word) / of_before
        ratio = np.where(found.follows, given, of_word)
        sums = np.concatenate([[0.0], np.cumsum(np.log(ratio[1]) - np.log(ratio[0]))])
        totals = sums[found.bounds[1:]] - sums[found.bounds[:-1]]
        n = np.maximum(np.diff(found.bounds), 1)
        means.append(np.arcsinh(50 * totals / n))
        roots.append(np.arcsinh(5 * totals / np.sqrt(n)))
    if not means:
        return np.zeros(0), np.zeros(0)
    return np.concatenate(means), np.concatenate(roots)


def _figures(levels: tuple[Level, ...]):
    @F.arrow_udf("struct<by_words double, by_root double>")
    def figures(texts: pa.Array) -> pa.Array:
        means, roots = _evidence_of(texts, levels)
        return pa.StructArray.from_arrays([pa.array(means), pa.array(roots)], names=["by_words", "by_root"])

    return figures


def _contexts():
    """How many different words precede an expression, and one more, by linear counting."""
    bits = F.least(F.bit_count("before"), F.lit(63))
    return 1.0 - 64.0 * F.log1p(-bits / 64.0)


def _levels(counts: DataFrame, discount: float) -> tuple[Level, ...] | None:
    """The three levels; None unless both classes have words."""
    classes = ("ordinary", "toxic")
    totals = {r.level: r for r in counts.groupBy("level").agg(*(F.sum(c).alias(c) for c in classes)).collect()}
    if not totals or not all(totals[WORD][c] for c in classes):
        return None
    levels = []
    for level in (PAIR, WORD, BEGIN):
        n = np.array([totals[level][c] if level in totals else 0 for c in classes], float)
        discounts = discount * np.maximum(n / max(n.min(), 1.0), 1.0)
        rows = counts.where(F.col("level") == level)
        lost = [F.sum(F.least(F.col(c).cast("double"), F.lit(float(d)))) for c, d in zip(classes, discounts)]
        both = F.least(F.col("ordinary") + F.col("toxic"), F.lit(SHARED_DISCOUNT))
        sums = np.array([x or 0.0 for x in rows.agg(*lost, F.sum(_contexts()), F.sum(both)).first()])
        excess = F.greatest(*(F.col(c) / float(d) for c, d in zip(classes, discounts)))
        table = (
            rows.withColumn("excess", excess)
            .where("excess > 1")
            .select("key", *classes, _contexts().alias("contexts"))
            .toArrow()
        )
        keys = table["key"].to_numpy().view(np.uint64)
        seen = np.stack([table[c].to_numpy() for c in classes]).astype(float)
        levels.append(kneser_ney(keys, seen, table["contexts"].to_numpy(), n, sums[:2], sums[2], sums[3], discounts))
    return tuple(levels)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, discount: float = DISCOUNT, sample_rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Learn from at most ``sample_rows`` labels of documents whose fold is not 0.

    The driver gets the expressions of these documents that exceed the discount.
    """
    marks = labels.where("toxic in (0, 1)").where(fold() != 0)
    marks = marks.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)
    marked = docs.where(fold() != 0).select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    rows = keep(marked.select("text", "toxic", (fold() == CALIBRATION_FOLD).alias("calibrates")), "toxic-rows")
    counted = rows.where("not calibrates").select("text", "toxic")
    counts = (
        counted.mapInArrow(_count, "level byte, key long, ordinary long, toxic long, before long")
        .groupBy("level", "key")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"), F.bit_or("before").alias("before"))
    )
    counts = keep(counts, "toxic-counts")
    levels = _levels(counts, discount)
    if levels is None:
        return ToxicityModel((), (0.0, 0.0), None)
    figures = rows.where("calibrates").select(_figures(levels)(F.col("text")).alias("x"), "toxic").select("x.*", "toxic")
    figures = keep(figures, "toxic-figures")
    if figures.select("toxic").distinct().count() < 2:
        return ToxicityModel(levels, (1.0, 0.0), 0.0)
    vectors = VectorAssembler(inputCols=["by_words", "by_root"], outputCol="features").transform(figures)
    fitted = LogisticRegression(labelCol="toxic", maxIter=100).fit(vectors)
    return ToxicityModel(levels, tuple(map(float, fitted.coefficients)), float(fitted.intercept))


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row of ``docs``."""
    if model.intercept is None:
        score = F.lit(0.0)
        out = docs.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), score.alias("score"))
    else:
        x = _figures(model.levels)(F.col("text"))
        out = docs.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), x.alias("x"))
        linear = F.col("x.by_words") * model.weights[0] + F.col("x.by_root") * model.weights[1] + model.intercept
        out = out.select("doc_id", "held_out", (1 / (1 + F.exp(-linear))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
