"""Language identification by the nearest of several centroids per language.

A text's vector counts its character n-grams (1 to 3, lower case, words padded by a blank)
hashed into ``dims`` slots, damped by a square root, weighted by inverse document frequency
and scaled to length 1. Each language has up to ``centroids`` spherical k-means centroids;
the nearest one by cosine gives the language and, as score, its cosine.

Statistics: document frequencies cover all training rows. Centroids are fitted on a bounded
sample: of each language the ``sample_rows`` distinct texts with the smallest hashes, each
weighted by its number of rows. A language with fewer distinct texts has all of them.

k-means starts from random texts, drawn in proportion to their squared distance (k-means++).
Clusters with less than LEAST_SHARE of the language's texts are dissolved.

Rejection by distance: each centroid has a radius for each doubling of text length (short texts
are farther from any centroid). It is the QUANTILE of the distances of its sample texts and of
pieces cut from them, each against the centroid without that text, plus ``slack`` times what
lies between it and the median (at least ``least_radius``). The same pieces with their letters drawn
anew are texts of no language: where they are farther than the quantile, the radius ends half way
between the two, else at the quantile. A text outside the radius of its nearest
centroid is rejected, as is a text without a letter.

Null text, text without a letter: ``und``, score 0, rejected. Without training rows every
text is ``und``. Ties go to the first language in order. Very long texts are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipecast.llm.store import fold, unused

DIMS = 1 << 13
SAMPLE_ROWS = 400
CENTROIDS = 4
ROUNDS = 8
SLACK = 0.5
LEAST_RADIUS = 0.5
LEAST_SHARE = 0.05
QUANTILE = 0.99
# Lengths are told apart by powers of two up to this one; pieces are cut in the lengths between.
LENGTHS = 12
UNKNOWN = "und"


@dataclass(frozen=True)
class CentroidModel:
    """``centers`` has one row a centroid; ``langs`` and ``radii`` (by length) belong to its rows."""

    langs: list[str]
    centers: np.ndarray
    radii: np.ndarray
    idf: np.ndarray


def _small_letter(c: int) -> int:
    """The lower-case letter of a code point, or a blank for anything but letters."""
    ch = chr(c)
    small = ch.lower()
    return 32 if not ch.isalpha() else ord(small) if len(small) == 1 else c


@lru_cache(maxsize=1)
def _basic_letters() -> np.ndarray:
    return np.array([_small_letter(c) for c in range(0x10000)], np.uint32)


def letters(text: str) -> np.ndarray:
    """The text's code points in lower case, with blanks in place of anything but letters."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = chars > 0xFFFF
    out = _basic_letters()[np.where(high, 32, chars)]
    if high.any():
        found, places = np.unique(chars[high], return_inverse=True)
        out[high] = np.array([_small_letter(int(c)) for c in found], np.uint32)[places]
    return out


def ngram_counts(text: str | None, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray] | None:
    """(slots, counts) of a text's n-grams; None if the text has no letter."""
    if not text:
        return None
    chars = letters(text)
    if not (chars != 32).any():
        return None
    chars = np.concatenate([[np.uint32(32)], chars, [np.uint32(32)]]).astype(np.uint64)
    blank = chars == 32
    chars = chars[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    one, two = chars[1:-1], chars[:-1] * np.uint64(0x1000193) + chars[1:]
    three = two[:-1] * np.uint64(0x1000193) + chars[2:]
    grams = np.concatenate([one[one != 32], two + np.uint64(1 << 40), three + np.uint64(1 << 41)])
    slots = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)) % np.uint64(dims)
    counts = np.bincount(slots.astype(np.int64), minlength=dims)
    used = np.flatnonzero(counts)
    return used, counts[used]


def _unit(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    slots, counts = found
    weights = np.sqrt(counts) * idf[slots]
    return slots, weights / (np.linalg.norm(weights) or 1.0)


def _length(slots_and_counts: tuple[np.ndarray, np.ndarray]) -> int:
    """The power of two of a text's length, which is about a third of its n-grams."""
    return min(LENGTHS, int(slots_and_counts[1].sum() / 3 + 1).bit_length() - 1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of this task's texts; slot -1 counts the documents."""
    seen, docs = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found = ngram_counts(text)
            if found is not None:
                seen[found[0]] += 1
                docs += 1
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(seen[used], docs))], names=["slot", "n"]
    )


def _sample(rows: int):
    """Of this task's rows: for each language the distinct texts of the smallest hashes, and how often they occur."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[int, list]] = {}
        largest: dict[str, int] = {}
        for batch in batches:
            for lang, key, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "text"))):
                held = kept.setdefault(lang, {})
                if key in held:
                    held[key][1] += 1
                elif key <= largest.get(lang, key) and any(c.isalpha() for c in text):
                    held[key] = [text, 1]
                    if len(held) >= 2 * rows:
                        for last in sorted(held)[rows:]:
                            del held[last]
                        largest[lang] = max(held)
        found = [(lang, key, *v) for lang, held in kept.items() for key, v in held.items()]
        for at in range(0, len(found), 256):
            langs, keys, texts, n = zip(*found[at : at + 256])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(keys, pa.int64()), pa.array(texts, pa.string()), pa.array(n, pa.int64())],
                names=["lang", "key", "text", "n"],
            )

    return sample


def cluster(points: np.ndarray, weights: np.ndarray, centroids: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from random starts: (centers, nearest centre of each point); no stray clusters."""
    draw = np.random.default_rng(len(points))
    chance = weights / weights.sum()
    chosen: list[int] = []
    while len(chosen) < min(centroids, len(points)) and chance.sum() > 0:
        chosen.append(int(draw.choice(len(points), p=chance / chance.sum())))
        distance = np.maximum(1 - (points @ points[chosen].T).max(axis=1), 0)
        distance[distance < 1e-6] = 0
        chance = weights * distance.astype(float) ** 2
    centers = points[chosen]
    while True:
        for _ in range(rounds):
            near = np.argmax(points @ centers.T, axis=1)
            used = [c for c in range(len(centers)) if (near == c).any()]
            sums = np.stack([(points[near == c] * weights[near == c, None]).sum(axis=0) for c in used])
            centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        near = np.argmax(points @ centers.T, axis=1)
        sizes = np.bincount(near, minlength=len(centers))
        if len(centers) == 1 or sizes.min() >= LEAST_SHARE * len(points):
            return centers, near
        centers = np.delete(centers, int(np.argmin(sizes)), axis=0)


def _radii(distances: list[list[float]], scrambled: list[list[float]], slack: float, least: float) -> np.ndarray:
    """A radius a length: no longer text has a larger one; lengths without a distance take their neighbour's."""
    out, most = np.zeros(LENGTHS + 1), np.full(LENGTHS + 1, np.inf)
    for k, found in enumerate(distances):
        if found:
            high, middle = np.quantile(found, [QUANTILE, 0.5])
            out[k] = high + slack * (high - middle)
            if scrambled[k]:
                most[k] = max(high, (high + np.quantile(scrambled[k], 1 - QUANTILE)) / 2)
    out = np.maximum.accumulate(out[::-1])[::-1]
    filled = np.flatnonzero(out)
    if len(filled):
        out[filled[-1] :] = out[filled[-1]]
    return np.minimum(np.maximum(out, least), most)


def _scrambled(text: str, draw: np.random.Generator) -> str:
    """The text with each letter drawn anew from the different letters it has."""
    chars = list(text)
    at = [k for k, c in enumerate(chars) if c.isalpha()]
    kinds = sorted({chars[k].lower() for k in at})
    for k, j in zip(at, draw.integers(0, len(kinds), len(at)) if kinds else ()):
        chars[k] = kinds[j]
    return "".join(chars)


def _pieces(text: str) -> Iterator[str]:
    """The text, and pieces from its middle in all shorter lengths."""
    yield text
    for k in range(3, LENGTHS):
        size = 3 << (k - 1)
        if size < len(text):
            for part in (1, 2):
                at = (len(text) - size) * part // 3
                yield text[at : at + size]


def _fit_language(idf: np.ndarray, centroids: int, rounds: int, slack: float, least: float):
    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        points = np.zeros((len(frame), len(idf)), np.float32)
        for k, text in enumerate(frame["text"]):
            slots, values = _unit(ngram_counts(text), idf)
            points[k, slots] = values
        weights = frame["n"].to_numpy(float)
        centers, near = cluster(points, weights, centroids, rounds)
        distances, scrambled = ([[[] for _ in range(LENGTHS + 1)] for _ in centers] for _ in range(2))
        draw = np.random.default_rng(len(frame))
        sums = np.stack([(points[near == c] * weights[near == c, None]).sum(axis=0) for c in range(len(centers))])
        for k, text in enumerate(frame["text"]):
            rest = sums[near[k]] - weights[k] * points[k]
            size = np.linalg.norm(rest)
            if size < 1e-3:  # the only text of its centroid says nothing of others
                continue
            for piece in _pieces(text):
                found = ngram_counts(piece)
                if found is not None:
                    slots, values = _unit(found, idf)
                    distances[near[k]][_length(found)].append(1 - float(rest[slots] @ values) / size)
                    odd = ngram_counts(_scrambled(piece, draw) if len(piece) < 1 << LENGTHS else None)
                    if odd is not None:
                        slots, values = _unit(odd, idf)
                        cosines = centers[:, slots] @ values
                        scrambled[int(np.argmax(cosines))][_length(odd)].append(1 - float(cosines.max()))
        every, odds = ([sum((d[k] for d in lists_), []) for k in range(LENGTHS + 1)] for lists_ in (distances, scrambled))
        radii = [_radii(d if any(d) else every, odds, slack, least) for d in distances]
        if not any(every):  # a single text: nothing tells how far others may be
            radii = [np.ones(LENGTHS + 1)] * len(centers)
        return pd.DataFrame(
            {"lang": frame["lang"].iloc[0], "center": [c.astype(np.float32).tobytes() for c in centers], "radii": radii}
        )

    return fit


def fit_centroids(
    training: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    centroids: int = CENTROIDS,
    slack: float = SLACK,
    least_radius: float = LEAST_RADIUS,
) -> CentroidModel:
    """Learn from ``text`` and ``lang`` of rows whose lang is not null.

    The driver gets ``dims`` frequencies and ``centroids`` rows a language.
    """
    rows = training.where("lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    found = rows.select("text").mapInArrow(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    idf, documents = np.zeros(DIMS), 0
    for slot, n in found.collect():
        if slot < 0:
            documents = n
        else:
            idf[slot] = n
    idf = np.log((1 + documents) / (1 + idf)) + 0.1
    keyed = rows.where("text is not null").withColumn("key", F.xxhash64("text"))
    drawn = keyed.mapInArrow(_sample(sample_rows), "lang string, key long, text string, n long")
    drawn = drawn.groupBy("lang", "key").agg(F.min("text").alias("text"), F.sum("n").alias("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    chosen = drawn.withColumn("place", first).where(F.col("place") <= sample_rows).drop("place")
    fitted = chosen.groupBy("lang").applyInPandas(
        _fit_language(idf, centroids, ROUNDS, slack, least_radius), "lang string, center binary, radii array<double>"
    )
    learned = sorted(fitted.collect(), key=lambda r: (r.lang, r.center))
    centers = np.stack([np.frombuffer(r.center, np.float32) for r in learned]) if learned else np.zeros((0, DIMS), np.float32)
    radii = np.array([r.radii for r in learned])
    return CentroidModel([r.lang for r in learned], centers, radii, idf)


def predictor(model: CentroidModel):
    """A column function: text to (lang_pred, score, rejected)."""

    @F.arrow_udf("struct<lang_pred string, score double, rejected boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        langs, scores, rejected = [], [], []
        for text in texts:
            found = ngram_counts(text.as_py()) if len(model.langs) else None
            if found is None:
                lang, score, out = UNKNOWN, 0.0, True
            else:
                slots, weights = _unit(found, model.idf)
                cosines = model.centers[:, slots] @ weights
                best = int(np.argmax(cosines))
                score = float(min(1.0, max(0.0, cosines[best])))
                lang, out = model.langs[best], bool(1 - score > model.radii[best, _length(found)])
            langs.append(lang)
            scores.append(score)
            rejected.append(out)
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["lang_pred", "score", "rejected"],
        )

    return predict


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows a model learns from: those whose fold is not 0; none with a null id."""
    return docs.where(fold() != 0)


def identify(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected): one row for each row of ``docs``."""
    out = docs.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), predictor(model)(F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``docs`` without the rows whose language is rejected, all columns as they were."""
    name = unused(docs, "language_of_text")
    tagged = docs.withColumn(name, predictor(model)(F.col("text")))
    return tagged.where(~F.col(name)["rejected"]).select(*docs.columns)
