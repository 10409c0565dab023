"""SentencePiece encoding and decoding by a Viterbi search with shared prefixes.

A text is cut before each run of spaces into marked words (each begins with the marks that stand
for the spaces before it; no piece has a mark after another character). The distinct words of a
batch, sorted, are the depth-first walk through their trie: going from a word to the next, the
forward scores of the common prefix are kept and only the rest is searched. The best path
maximises the sum of the logarithms of the pieces' weights; of equal paths the one with the longer
last piece wins. A character without a piece costs more than any piece and is written as its UTF-8
bytes.

The installed vocabulary is one of byte pair encoding: it has ranks of merges and no
probabilities. A piece of rank r weighs 1 / (r + 10), as in the language model. So paths are best by
these weights, and differ from those that the merges give.

Decoding joins the pieces and is exact for every text: a literal mark character is written
as bytes, so it is not taken for a space. Null and empty texts have no pieces and decode to
the empty text. Very long texts are taken whole, repeated rows are encoded each, an empty table
gives an empty result. Vocabulary and word cache are bounded; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.llm.vocabulary import MARK, Vocabulary
from pipecast.llm.words import portions

# Words whose segmentation a task remembers from one batch to the next.
CACHE_WORDS = 300_000
# Stands for a literal mark inside a word; no valid text contains it.
_LITERAL_MARK = "\udcff"
_MARKED_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def marked_words(text: str) -> list[str]:
    """The words of a text, each with the marks of the spaces before it."""
    text = text.replace(MARK, _LITERAL_MARK) if MARK in text else text
    if "  " in text or text[0] == " ":
        return _MARKED_WORD.findall(MARK + text.replace(" ", MARK))
    return [MARK + word for word in text.split(" ")]


class Segmenter:
    """Best segmentations of marked words under a vocabulary."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS) -> None:
        self.table = {vocabulary.pieces[i]: (log(weight), i) for i, weight in vocabulary.weights.items()}
        self.longest = max(map(len, self.table))
        self.unknown_score = min(score for score, _ in self.table.values()) - 10.0
        self.byte_ids = vocabulary.byte_ids
        self.cache: dict[str, tuple[int, ...]] = {}
        self.cache_words = cache_words

    def _bytes(self, char: str) -> list[int]:
        char = MARK if char == _LITERAL_MARK else char
        return [self.byte_ids[b] for b in char.encode("utf-8")]

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """(word, piece ids) of sorted distinct marked words."""
        table, longest = self.table, self.longest
        before = ""
        # For each prefix of the word at hand: its best score, where the last piece starts, that piece's id.
        scores, starts, ids = [0.0], [0], [-1]
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del scores[shared + 1 :], starts[shared + 1 :], ids[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, start, piece = float("-inf"), end - 1, -1
                for i in range(max(0, end - longest), end):
                    found = table.get(word[i:end])
                    if found is not None and scores[i] + found[0] > best:
                        best, start, piece = scores[i] + found[0], i, found[1]
                if word[end - 1] not in table and scores[end - 1] + self.unknown_score > best:
                    best, start, piece = scores[end - 1] + self.unknown_score, end - 1, -1
                scores.append(best)
                starts.append(start)
                ids.append(piece)
            before = word
            yield word, self._path(word, starts, ids)

    def _path(self, word: str, starts: list[int], ids: list[int]) -> tuple[int, ...]:
        parts: list[list[int]] = []
        end = len(word)
        while end:
            parts.append([ids[end]] if ids[end] >= 0 else self._bytes(word[end - 1]))
            end = starts[end]
        return tuple(chain.from_iterable(reversed(parts)))

    def encode(self, texts: Sequence[str | None]) -> list[list[int]]:
        """Piece ids of each text."""
        marked = []
        for text in texts:
            if not text:
                marked.append([])
                continue
            marked.append(marked_words(text))
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        new = sorted({word for words in marked for word in words if word not in self.cache})
        self.cache.update(self.segment(new))
        found = self.cache.__getitem__
        return [list(chain.from_iterable(map(found, words))) for words in marked]


class Joiner:
    """The way back from piece ids to text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.content = [b""] * len(vocabulary.pieces)
        for i in vocabulary.plain:
            self.content[i] = vocabulary.pieces[i].replace(MARK, " ").encode("utf-8")
        for b, i in enumerate(vocabulary.byte_ids):
            self.content[i] = bytes([b])

    def decode(self, ids: Sequence[int]) -> str:
        """The text; bytes that are no valid UTF-8 become replacement characters."""
        return b"".join(map(self.content.__getitem__, ids))[1:].decode("utf-8", "replace")


def encoder(vocabulary: Vocabulary):
    """A column function: text to piece ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter(vocabulary)
        for texts in batches:
            parts = [
                pa.array(segmenter.encode(part.column("text").to_pylist()), pa.list_(pa.int32()))
                for part in portions(pa.RecordBatch.from_arrays([texts], names=["text"]), "text")
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode


def decoder(vocabulary: Vocabulary):
    """A column function: piece ids to text; null for null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        joiner = Joiner(vocabulary)
        for lists in batches:
            yield pa.array([None if x is None else joiner.decode(x) for x in lists.to_pylist()], pa.string())

    return decode


def _digests(vocabulary: Vocabulary):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter, joiner = Segmenter(vocabulary), Joiner(vocabulary)
        for batch in batches:
            for part in portions(batch, "text"):
                texts = part.column("text").to_pylist()
                encoded = segmenter.encode(texts)
                decoded = [joiner.decode(ids) for ids in encoded]
                ids_digest = [hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest() for ids in encoded]
                text_digest = [hashlib.sha256(text.encode("utf-8")).hexdigest() for text in decoded]
                exact = [a == (b or "") for a, b in zip(decoded, texts)]
                columns = [
                    part.column("doc_id"),
                    pa.array([len(ids) for ids in encoded], pa.int64()),
                    pa.array(ids_digest, pa.string()),
                    pa.array(text_digest, pa.string()),
                    pa.array(exact, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "pieces_sha256", "decoded_sha256", "exact"])

    return digests


def encode_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns of ``docs`` plus ``pieces``, the text's piece ids (replacing a column of that name)."""
    return docs.withColumn("pieces", encoder(vocabulary)(F.col("text")))


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_pieces, pieces_sha256, decoded_sha256, exact): encode, decode and compare each text.

    ``pieces_sha256`` is over the ids as little-endian 32-bit numbers.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_pieces long, pieces_sha256 string, decoded_sha256 string, exact boolean"
    return docs.select("doc_id", "text").mapInArrow(_digests(vocabulary), schema)
