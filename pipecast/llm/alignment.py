"""Alignment of two tokenizers' tokens on the same text, with counts of linked ids over the corpus.

Tokenizer A (byte-level pairs) encodes a space and the text, tokenizer B (SentencePiece) the text, to
which it adds the space itself; markers of special tokens in a text are plain text. Each token stands
for some bytes, so both encodings give cumulative ends on the same bytes. The ends of each go into a
dictionary from end to token index; the keys that both hold, sorted, cut the two id lists into groups.
Within a group the tokens whose bytes overlap are linked: each stretch between two neighbouring ends of
either side lies in one token of each, so every stretch is one link.

A single space between two visible characters (``EDGES``) starts a token in A and in B whatever stands
around it: A's pattern ends a run there, and B has no piece with a mark after another character. Both
encodings have an end there, so groups and links on either side are those of the parts alone. A text is
therefore aligned part by part, and a task aligns a part that it has seen before only once.

Counting over the corpus: tasks take texts in portions of bounded size. A portion numbers its different
parts and the different id pairs of their links, and counts the pairs; a document keeps the numbers of
its parts and how often it has them. Spark adds the portions' counts of each pair, joins the totals to
the portions' pairs, and each portion's documents add up the totals by number. What moves is a row for
each portion and pair, not one for each link, so a pair that occurs everywhere costs a row a portion.

Odd rows:

* A null or empty text, and one whose tokens' bytes differ from a space and the text (for example one
  that contains U+2581), has no tokens: all numbers are 0 and ``groups_sha256`` is ''.
* Texts of any length are read whole, in blocks that end at such a space; a part without one is encoded
  at once.
* Repeated rows, equal texts and null ids are rows like all others and count each time. Only ``doc_id``
  and ``text`` are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.llm.store import keep
from pipecast.llm.vocabulary import MARK, VOCABULARY_FILE
from pipecast.llm.words import lists, portions

BYTE_VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.json"

# Texts of a portion have about so many bytes; its documents later meet in one task.
PORTION_BYTES = 8_000_000
# Texts are taken apart in blocks of about so many characters.
BLOCK = 250_000
# A task forgets the parts it has aligned when they have more characters than this.
REMEMBERED = 4_000_000

# Characters on both sides of a space at which texts are cut: visible ASCII and Latin letters.
EDGES = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x250)]))


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(moved)}


@dataclass(frozen=True)
class Side:
    """A tokenizer: ``encode`` for lists of texts, ``tokens`` with the bytes of each id."""

    encode: object
    tokens: list[bytes]

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.tokens], np.int64)


@lru_cache(maxsize=2)
def byte_side(path: str) -> Side:
    """Tokenizer A from its JSON file. The texts are given with their leading space."""
    # A task has one core; threads of their own would each hold memory.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    model.no_truncation()
    model.no_padding()
    stands_for = _byte_characters()
    tokens = [b""] * model.get_vocab_size(with_added_tokens=True)
    special = {added.content for added in model.get_added_tokens_decoder().values()}
    for token, number in model.get_vocab(with_added_tokens=True).items():
        tokens[number] = token.encode() if token in special else bytes(stands_for[c] for c in token)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    return Side(encode, tokens)


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """Tokenizer B from its model file. The texts are given without the leading space, which it adds."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    tokens = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(MARK, " ").encode())

    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    return Side(encode, tokens)


def parts_of(text: str, plain: set[str] | dict[str, int] = frozenset()) -> list[str]:
    """``text`` cut at its single spaces between visible characters; joined by spaces they give it back.

    ``plain`` holds parts known to be such.
    """
    pieces = text.split(" ")
    if all(p and p[0] in EDGES and p[-1] in EDGES for p in set(pieces).difference(plain)):
        return pieces
    out, open_ = [], [pieces[0]]
    for before, piece in zip(pieces, pieces[1:]):
        if before and piece and before[-1] in EDGES and piece[0] in EDGES:
            out.append(" ".join(open_))
            open_ = [piece]
        else:
            open_.append(piece)
    return [*out, " ".join(open_)]


def blocks_of(text: str, size: int = BLOCK) -> Iterator[str]:
    """Blocks of about ``size`` characters that give ``text`` when joined by spaces, cut where parts are."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut > 0 and not (cut + 1 < len(text) and text[cut - 1] in EDGES and text[cut + 1] in EDGES):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


class Aligner:
    """Aligns parts of texts and remembers them by number: sizes, written groups and links."""

    def __init__(self, a: Side, b: Side, remembered: int = REMEMBERED) -> None:
        self.a, self.b, self.remembered = a, b, remembered
        self.lengths_a, self.lengths_b = a.lengths, b.lengths
        # A pair of ids is one number, which takes 4 bytes unless the vocabularies are large.
        self.pair = "i" if len(a.tokens) * len(b.tokens) <= 1 << 31 else "q"
        # Written ids with the sign that follows: within a group, at its end, on either side.
        self.marked = [f"{i}{sign}" for side, signs in ((a, ",|"), (b, ",;")) for sign in signs for i in range(len(side.tokens))]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.written: list[str] = []
        self.characters = 0
        self.whole = array("b")  # whether both sides' tokens give the part's bytes
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.links, self.ends = array(self.pair), array("q", [0])

    def number(self, texts: list[str | None], size: int = BLOCK) -> list[tuple[np.ndarray, str]]:
        """For each text the numbers of its parts in order and the digest of their written groups.

        Both are empty if the text is, or if the tokens of some part differ from it.
        """
        found = [array("i") for _ in texts]
        digests = [hashlib.sha256() for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        characters = 0

        def settle() -> None:
            new = set().union(*(parts for _, parts in waiting)).difference(self.numbers)
            self.learn(list(new))
            for k, parts in waiting:
                numbers = array("i", map(self.numbers.__getitem__, parts))
                digests[k].update((";" * bool(found[k]) + ";".join(map(self.written.__getitem__, numbers))).encode())
                found[k].extend(numbers)
            waiting.clear()

        for k, text in enumerate(texts):
            for block in blocks_of(text, size) if text else ():
                waiting.append((k, parts_of(block, self.numbers)))
                characters += len(block)
                if characters >= size:
                    settle()
                    characters = 0
        settle()
        out = []
        whole = np.frombuffer(self.whole, np.int8)
        for numbers, digest in zip(found, digests):
            codes = np.frombuffer(numbers, np.int32)
            fine = len(codes) > 0 and whole[codes].all()
            out.append((codes, digest.hexdigest()) if fine else (codes[:0], ""))
        return out

    def learn(self, parts: list[str]) -> None:
        """Encode and align new parts, all of them as if their bytes stood one after another."""
        if not parts:
            return
        encoded = self.a.encode([" " + p for p in parts]), self.b.encode(parts)
        sizes = [len((" " + p).encode()) for p in parts]
        whole = self.give_bytes(parts, sizes, encoded)
        # A part that differs from its tokens is left without any.
        encoded = [[ids if fine else [] for ids, fine in zip(own, whole)] for own in encoded]
        n_a, n_b = (np.array([len(ids) for ids in own], np.int64) for own in encoded)
        ids_a, ids_b = (np.array([i for ids in own for i in ids], np.int64) for own in encoded)
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        last_a, last_b = groups(ends_a.tolist(), ends_b.tolist())
        stops = np.concatenate([[0], np.cumsum(np.where(whole, sizes, 0))])  # where parts end, in bytes
        linked, link_ends = links(ids_a, ids_b, ends_a, ends_b, len(self.b.tokens))
        signs = self.signs(ids_a, ids_b, last_a, last_b)
        tokens = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        group_counts = np.diff(np.searchsorted(ends_a[last_a], stops, side="right"))
        link_counts = np.searchsorted(link_ends, stops[1:], side="right")
        first = len(self.written)
        self.numbers.update(zip(parts, range(first, first + len(parts))))
        self.written.extend(["".join(signs[i:j])[:-1] for i, j in zip(tokens, tokens[1:])])
        self.characters += sum(map(len, parts))
        for own, values in (
            (self.whole, np.array(whole, np.int8)),
            (self.n_a, n_a),
            (self.n_b, n_b),
            (self.n_groups, group_counts.astype(np.int64)),
            (self.ends, len(self.links) + link_counts.astype(np.int64)),
            (self.links, linked.astype(self.pair)),
        ):
            own.frombytes(values.tobytes())

    def give_bytes(self, parts: list[str], sizes: list[int], encoded: tuple[list, list]) -> list[bool]:
        """Whether both sides' tokens join to a space and the part."""
        joined = (" " + " ".join(parts)).encode()
        fine = [True] * len(parts)
        for side, own in zip((self.a, self.b), encoded):
            pieces = [side.tokens[i] for ids in own for i in ids]
            ends = np.cumsum([0, *map(len, pieces)])
            if b"".join(pieces) == joined and (np.diff(ends[np.cumsum([0, *map(len, own)])]) == sizes).all():
                continue
            cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            pieces = [b"".join([side.tokens[i] for i in ids]) for ids in own]
            fine = [f and p == joined[i:j] for f, p, i, j in zip(fine, pieces, cuts, cuts[1:])]
        return fine

    def signs(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
        """Written ids of all groups in order: A's with a bar after the last, then B's with a semicolon."""
        n_a, n_b = len(ids_a), len(ids_b)
        is_last_a, is_last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        is_last_a[last_a] = is_last_b[last_b] = 1
        group_a, group_b = np.cumsum(is_last_a) - is_last_a, np.cumsum(is_last_b) - is_last_b
        before_b = np.concatenate([[0], last_b + 1])  # tokens of B ahead of each group
        out = np.empty(n_a + n_b, np.int64)
        size_a, size_b = len(self.a.tokens), len(self.b.tokens)
        out[np.arange(n_a) + before_b[group_a]] = ids_a + is_last_a * size_a
        out[np.arange(n_b) + last_a[group_b] + 1] = ids_b + 2 * size_a + is_last_b * size_b
        return list(map(self.marked.__getitem__, out.tolist()))


def groups(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Token indices at which each group ends, in A and in B: where both dictionaries hold the end."""
    index_a = dict(zip(ends_a, range(len(ends_a))))
    index_b = dict(zip(ends_b, range(len(ends_b))))
    common = sorted(index_a.keys() & index_b.keys())
    return tuple(np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (index_a, index_b))


def links(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """(A's id times ``size_b`` plus B's id, end) of each link: the stretches that the ends cut the slices into."""
    ends = np.union1d(ends_a, ends_b)
    return ids_a[np.searchsorted(ends_a, ends)] * size_b + ids_b[np.searchsorted(ends_b, ends)], ends


_COLUMNS = (
    "portion long, is_pairs boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, codes array<int>, times array<int>, links array<int>, ends array<int>"
)


def _whole_lists(*arrays: np.ndarray) -> list[pa.Array]:
    """List columns of one row each."""
    return [lists(x, np.array([0, len(x)]), pa.from_numpy_dtype(x.dtype)) for x in arrays]


def _portion_of(part: pa.RecordBatch, aligner: Aligner, number: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The documents of a portion, then one row with its id pairs, their counts and the links of its parts."""
    if aligner.characters > aligner.remembered:
        aligner.forget()
    found = aligner.number(part.column("text").to_pylist())
    n = len(found)
    codes = np.concatenate([f[0] for f in found])
    seen = np.bincount(codes, minlength=len(aligner.whole)) > 0
    used = np.flatnonzero(seen)
    codes = (np.cumsum(seen, dtype=np.int32) - 1)[codes]
    owner = np.repeat(np.arange(n), [len(f[0]) for f in found])
    size = max(len(used), 1)
    held, times = np.unique(owner * size + codes, return_counts=True)
    owner, codes = held // size, held % size
    bounds = np.searchsorted(owner, np.arange(n + 1))
    firsts, lasts = np.frombuffer(aligner.ends, np.int64)[:-1][used], np.frombuffer(aligner.ends, np.int64)[1:][used]
    counts = lasts - firsts
    ends = np.concatenate([[0], np.cumsum(counts)])
    flat = np.frombuffer(aligner.links, aligner.pair)[np.arange(ends[-1]) + np.repeat(firsts - ends[:-1], counts)]
    pairs, links = np.unique(flat, return_inverse=True)
    pairs = pairs.astype(np.int64)
    occurs = np.bincount(codes, times, len(used)).astype(np.int64)  # of each part in the portion
    totals = np.bincount(links, np.repeat(occurs, counts), len(pairs)).astype(np.int64)

    def sums(values: np.ndarray) -> pa.Array:
        return pa.array(np.bincount(owner, values[codes] * times, n).astype(np.int64))

    sizes = [np.frombuffer(x, np.int64)[used] for x in (aligner.n_a, aligner.n_b, aligner.n_groups)]
    none = [pa.nulls(n, pa.list_(pa.int32()))]
    yield pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(np.full(n, number)),
            pa.array(np.zeros(n, bool)),
            *[sums(x) for x in (*sizes, counts)],
            pa.array([f[1] for f in found], pa.string()),
            pa.nulls(n, pa.list_(pa.int64())),
            lists(codes.astype(np.int32), bounds, pa.int32()),
            lists(times.astype(np.int32), bounds, pa.int32()),
            *none * 2,
        ],
        names=names,
    )
    if len(pairs):
        row = [pa.nulls(1, part.column("doc_id").type), pa.array([number]), pa.array([True])]
        row += [pa.nulls(1, pa.int64())] * 4 + [pa.nulls(1, pa.string())]
        numbers = np.arange(len(pairs), dtype=np.int32)
        row += _whole_lists(pairs, numbers, totals.astype(np.int32), links.astype(np.int32), ends.astype(np.int32))
        yield pa.RecordBatch.from_arrays(row, names=names)


def _aligned(paths: tuple[str, str], portion_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_side(paths[0]), piece_side(paths[1]))
        number = TaskContext.get().partitionId() << 32
        names = ["doc_id", *[c.split()[0] for c in _COLUMNS.split(", ")]]
        for batch in batches:
            for part in portions(batch, "text", portion_bytes):
                yield from _portion_of(part, aligner, number, names)
                number += 1

    return run


def _look_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of a portion's documents. ``left`` has them and a row with the links of its parts, ``right`` the pairs' totals."""
    table = left.filter(left["is_pairs"]).combine_chunks()
    rows = left.filter(pc.invert(left["is_pairs"])).combine_chunks()
    out = rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    if table.num_rows:
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        codes = right["code"].to_numpy()
        total[codes], best[codes] = right["total"].to_numpy(), right["is_best"].to_numpy()
        links, ends = (table[c].combine_chunks().flatten().to_numpy() for c in ("links", "ends"))
        held = rows["codes"].combine_chunks()
        owner = np.repeat(np.arange(rows.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
        parts, times = held.flatten().to_numpy(), rows["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    for name in ("n_best", "count_sum"):
        sums = np.zeros(rows.num_rows, np.int64)
        if table.num_rows:
            values = np.concatenate([[0], np.cumsum((best if name == "n_best" else total)[links])])
            np.add.at(sums, owner, (values[ends[1:]] - values[ends[:-1]])[parts] * times)
        out = out.append_column(name, pa.array(sums))
    return out.append_column("groups_sha256", rows["groups_sha256"])


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, total, is_best): links of each id pair in the corpus; best are those with the most for their B id."""
    pairs = aligned.where("is_pairs").select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    totals = pairs.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times").cast("long")).alias("total"))
    totals = keep(totals, "alignment-totals")
    id_b = F.col("pair") % size_b
    most = totals.groupBy(id_b.alias("id_b")).agg(F.max("total").alias("most"))
    return totals.withColumn("id_b", id_b).join(most, "id_b").select("pair", "total", (F.col("total") == F.col("most")).alias("is_best"))


def align_tokenizers(
    docs: DataFrame,
    byte_path: str = BYTE_VOCABULARY_FILE,
    piece_path: str = VOCABULARY_FILE,
    portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row for each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    size_b = len(piece_side(piece_path).tokens)
    run = _aligned((byte_path, piece_path), portion_bytes)
    aligned = keep(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_COLUMNS}"), "alignment")
    held = aligned.where("is_pairs").select(F.col("portion").alias("of"), F.explode(F.arrays_zip("pairs", "codes")).alias("x"))
    known = held.select("of", F.col("x.codes").alias("code"), F.col("x.pairs").alias("pair"))
    known = known.join(pair_counts(aligned, size_b), "pair").select("of", "code", "total", "is_best")
    rows = aligned.drop("pairs")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("portion").cogroup(known.groupBy("of")).applyInArrow(_look_up, schema)
