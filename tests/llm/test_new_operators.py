"""Quality, whitening and alignment against brute force, held-out labels and odd rows."""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipecast.llm import alignment, quality, whitening
from pipecast.llm.store import read
from pipecast.llm.vocabulary import VOCABULARY_FILE
from tests.conftest import SMALL
from tests.llm.test_operators import SCHEMA, docs, nothing, odd_rows  # noqa: F401

MIDDLE = "/root/testdata/sf0.01"


# --- whitening ----------------------------------------------------------------------------------


def whitened_by_force(vectors):
    """(n, deviation of each row, absolute whitened values, explained) by exact sums and a library's solver."""
    x = np.floor(1024.0 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = x - np.array([s / n for s in sums])
    covariance = centred.T @ centred / n
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:8]
    return n, deviation, np.abs(centred @ columns[:, order] / np.sqrt(values[order])), values[order] / np.trace(covariance)


def test_whitening_of_the_whole_table(spark):
    table = read(spark, MIDDLE, "embeddings")
    rows = whitening.whiten(table, whitening.fit_whitening(table)).collect()
    source = sorted((r["vec_id"], r["embedding"]) for r in table.collect())
    n, deviation, whitened, explained = whitened_by_force([v for _, v in source])
    place = {vec_id: k for k, (vec_id, _) in enumerate(source)}
    assert len(rows) == 8 * n == 8 * len(place)
    for r in rows:
        k, c = place[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[k] == int(r["deviation_whole"])
        assert abs(r["whitened"]) == pytest.approx(whitened[k, c], abs=1e-8)
        assert r["explained"] == pytest.approx(explained[c], rel=1e-10)
        assert r["identity_error"] < 1e-10


def odd_vectors(spark, extra=""):
    random = np.random.default_rng(3)
    good = [[float(v) for v in random.normal(size=5).astype(np.float32)] for _ in range(30)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [0.5] * 7]
    rows = [(k, v) for k, v in enumerate([*good, *bad])] + [(0, good[0]), (0, good[0]), (None, good[1])]
    schema = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    clash = {"component": F.lit("x"), "n": F.lit(1), "whitened": F.lit(None), "label": F.lit(2)}
    return (frame.withColumns(clash) if extra else frame), [*good, good[0], good[0], good[1]]


@pytest.mark.parametrize("extra", ["", "clashing columns"])
def test_whitening_leaves_out_broken_vectors(spark, extra):
    table, good = odd_vectors(spark, extra)
    rows = whitening.whiten(table, whitening.fit_whitening(table)).collect()
    n, deviation, whitened, explained = whitened_by_force(good)
    assert len(rows) == 5 * n == 5 * 33  # five dimensions, five components
    assert Counter(r["deviation"] for r in rows) == Counter(d for d in deviation for _ in range(5))
    assert sorted(round(abs(r["whitened"]), 6) for r in rows) == sorted(np.round(whitened[:, :5], 6).ravel())
    assert Counter(r["vec_id"] for r in rows)[0] == 15 and Counter(r["vec_id"] for r in rows)[None] == 5


def test_whitening_without_variance_and_of_nothing(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0, 3.0]) for k in range(4)], "vec_id int, embedding array<double>")
    rows = whitening.whiten(same, whitening.fit_whitening(same)).collect()
    assert len(rows) == 12 and all(r["whitened"] is None and r["deviation"] == 0 for r in rows)
    line = spark.createDataFrame([(k, [float(k), float(k)]) for k in range(4)], "vec_id int, embedding array<double>")
    first, second = (
        [r for r in whitening.whiten(line, whitening.fit_whitening(line)).collect() if r["component"] == c] for c in (1, 2)
    )
    assert all(r["whitened"] is None for r in second) and sum(r["whitened"] ** 2 for r in first) == pytest.approx(4)
    empty = same.limit(0)
    assert whitening.whiten(empty, whitening.fit_whitening(empty)).collect() == []
    nulls = spark.createDataFrame([(1, None)], "vec_id int, embedding array<double>")
    assert whitening.whiten(nulls, whitening.fit_whitening(nulls)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 9, 64])
@pytest.mark.parametrize("kind", ["random", "multiple of one", "clusters", "zero", "blocks"])
def test_leading_components(size, kind):
    random = np.random.default_rng(size)
    a = random.standard_normal((size, size))
    matrix = {
        "random": a @ a.T,
        "multiple of one": 3.0 * np.eye(size),
        "clusters": None,
        "zero": np.zeros((size, size)),
        "blocks": np.kron(np.eye(size), np.ones((1, 1))) + np.diag(np.arange(size) // 2),
    }[kind]
    if matrix is None:
        q, _ = np.linalg.qr(a)
        matrix = (q * np.where(np.arange(size) < 4, 5.0, 1.0)) @ q.T
        matrix = (matrix + matrix.T) / 2
    count = min(8, size)
    values, vectors = whitening.leading_components(matrix, count)
    expected = np.linalg.eigvalsh(matrix)[::-1][:count]
    scale = max(np.abs(expected).max(), 1e-290)
    assert np.abs(values - expected).max() <= 1e-13 * scale + 1e-300
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale + 1e-300
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() <= 1e-13


@pytest.mark.parametrize("n", [3, 10**6, 10**9, 10**14])
def test_deviations_are_exact(n):
    x = np.random.default_rng(1).integers(-(2**39), 2**39, (6, 64)) >> (0 if n > 10**13 else 18)
    sums = [int(s) * n // 6 for s in x.sum(axis=0)]
    assert whitening.deviations(x, n, sums) == [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]


# --- alignment ----------------------------------------------------------------------------------


def aligned_by_force(rows):
    """The contract's columns for (doc_id, text) rows, link by link."""
    a, b = alignment.byte_side(alignment.BYTE_VOCABULARY_FILE), alignment.piece_side(VOCABULARY_FILE)
    counts, found = Counter(), []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode([" " + text])[0] if text else []
        ids_b = b.encode([text])[0] if text else []
        if b"".join(a.tokens[i] for i in ids_a) != whole or b"".join(b.tokens[i] for i in ids_b) != whole:
            found.append((doc_id, 0, 0, [], []))
            continue
        spans = []
        for side, ids in ((a, ids_a), (b, ids_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(side.tokens[i])))
                at = own[-1][1]
            spans.append(own)
        ends = [{e for _, e in own} for own in spans]
        groups, left = [], [0, 0]
        for end in sorted(ends[0] & ends[1]):
            right = [next(k for k, (_, e) in enumerate(own) if e == end) + 1 for own in spans]
            groups.append((ids_a[left[0] : right[0]], ids_b[left[1] : right[1]]))
            left = right
        links = [(ids_a[p], ids_b[q]) for p, (s, e) in enumerate(spans[0]) for q, (t, f) in enumerate(spans[1]) if s < f and t < e]
        counts.update(links)
        found.append((doc_id, len(ids_a), len(ids_b), groups, links))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        best = sum(counts[link] == most[link[1]] for link in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[link] for link in links), digest))
    return out


def alignment_rows():
    texts = [r[1] for r in odd_rows() if r[1] is None or len(r[1]) < 3000]
    more = [
        "<|endoftext|> and <s> </s> <unk> <0x41>",
        "a  b   c\t\td\r\n\n e ",
        " leading and trailing ",
        "\x00 zero \x7f",
        "ﬁ ligature é é     𝔘𝔫𝔦𝔠𝔬𝔡𝔢 👩‍👩‍👧‍👦",
        "x" * 300,
        "日本語のテキスト これは",
        "don't can't I'll 12345 67,890",
    ]
    return list(enumerate([*texts, *more, texts[0], more[0]])) + [(None, "no id")]


def key(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("portion_bytes", [400, 8_000_000])
def test_alignment(spark, portion_bytes):
    rows = alignment_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = frame.withColumns({"portion": F.lit("x"), "pairs": F.lit(1), "of": F.lit(2), "codes": F.lit(None)})
    expected = key(aligned_by_force(rows))
    assert sum(r[1] for r in expected) > 1000
    assert key(alignment.align_tokenizers(frame, portion_bytes=portion_bytes).collect()) == expected
    assert key(alignment.align_tokenizers(clash, portion_bytes=portion_bytes).collect()) == expected


def test_alignment_of_real_texts(spark):
    table = read(spark, SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in table.where(F.length("text") < 3000).collect()]
    some = table.where(F.length("text") < 3000)
    assert key(alignment.align_tokenizers(some).collect()) == key(aligned_by_force(rows))


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(empty).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "a▁b")], "doc_id long, text string")
    assert key(alignment.align_tokenizers(blank).collect()) == key([(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)])


def test_parts_encode_like_the_whole(spark):
    a, b = alignment.byte_side(alignment.BYTE_VOCABULARY_FILE), alignment.piece_side(VOCABULARY_FILE)
    texts = [r["text"] for r in read(spark, SMALL, "documents").where("text is not null").collect()]
    texts += [t for _, t in alignment_rows() if t] + [" ".join(texts), "no-cut" * 500]
    for text in texts:
        parts = alignment.parts_of(text)
        assert " ".join(parts) == text
        assert [i for p in parts for i in a.encode([" " + p])[0]] == a.encode([" " + text])[0]
        assert [i for p in parts for i in b.encode([p])[0]] == b.encode([text])[0]
        for size in (50, 1000):
            blocks = list(alignment.blocks_of(text, size))
            assert " ".join(blocks) == text and [p for x in blocks for p in alignment.parts_of(x)] == parts


def test_no_piece_crosses_a_cut():
    """What the cuts rely on: no piece of B has a mark after another character."""
    b = alignment.piece_side(VOCABULARY_FILE)
    assert not [t for t in b.tokens if b" " in t.lstrip(b" ")]


def test_blocks_and_forgetting_change_nothing():
    a, b = alignment.byte_side(alignment.BYTE_VOCABULARY_FILE), alignment.piece_side(VOCABULARY_FILE)
    text = " ".join(t for _, t in alignment_rows() if t and "▁" not in t)
    whole = alignment.Aligner(a, b)
    cut = alignment.Aligner(a, b, remembered=1)
    assert whole.number([text, "x"])[0][1] == cut.number(["x", text], size=40)[1][1] != ""
    (codes, digest), (none, no_digest), (empty, _) = whole.number([text, text + " ▁", None])
    assert len(codes) > 500 and digest and len(none) == len(empty) == 0 and no_digest == ""


def test_a_task_encodes_without_threads_and_keeps_links_short(monkeypatch):
    """Threads of the tokenizer and wide numbers of pairs each took memory of every task."""
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    a = alignment.byte_side.__wrapped__(alignment.BYTE_VOCABULARY_FILE)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    b = alignment.piece_side(VOCABULARY_FILE)
    aligner = alignment.Aligner(a, b)
    aligner.number(["one text", "▁ another", "été 漢字"])
    assert aligner.links.itemsize == 4 and max(aligner.links) < len(a.tokens) * len(b.tokens)
    # Lengths that agree are not enough, nor are bytes that agree as a whole.
    parts, ids = ["ab", "cd"], [a.encode([" ab"])[0], a.encode([" cd"])[0]]
    sizes = [3, 3]
    twice = alignment.Aligner(a, a)
    assert twice.give_bytes(parts, sizes, (ids, ids)) == [True, True]
    assert twice.give_bytes(parts, sizes, (ids, ids[::-1])) == [False, False]
    assert twice.give_bytes(parts, sizes, (ids, [ids[0] + ids[1], []])) == [False, False]
    assert twice.give_bytes(parts, sizes, (ids, [ids[0], ids[0]])) == [True, False]


# --- quality ------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    table, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    scored = quality.quality(table, quality.fit_quality(table, labels))
    marked = scored.where("held_out").join(labels, "doc_id")
    n, right, junk, caught = marked.agg(
        *map(F.expr, ["count(*)", "count_if(predicted = quality)", "count_if(quality = 0)", "count_if(quality = 0 and predicted = 0)"])
    ).first()
    assert n > 700 and right >= 0.98 * n and caught >= 0.95 * junk
    assert scored.count() == table.count()


def features_by_force(text):
    """Words, repeats and runs of one text as readable items."""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    out = [("word", w) for w in words] + [("again",) for v, w in zip(words, words[1:]) if v == w]
    for w in words:
        marked = f" {w} "
        out += [("run", marked[k : k + n]) for n in quality.WIDTHS for k in range(len(marked) - n + 1)]
    return Counter(out)


def test_features_are_words_repeats_and_runs():
    texts = ["one one two", "", "a", "  été\tßx\n漢字 😀😀 one ", "one", "two one one"]
    found = list(quality.features(texts))
    bags = [Counter() for _ in texts]
    for owner, buckets in found:
        assert (np.diff(owner) >= 0).all()
        for k, bucket in zip(owner.tolist(), buckets.tolist()):
            bags[k][bucket] += 1
    names = {}
    for text, bag in zip(texts, bags):
        items = features_by_force(text)
        assert sorted(items.values()) == sorted(bag.values())
        alone = [b for _, found in quality.features([text]) for b in found.tolist()]
        assert Counter(alone) == bag  # nothing depends on the neighbours
        for item in items:
            names.setdefault(item, set()).add(items[item])
    assert bags[0][quality.BUCKETS - 1] == bags[5][quality.BUCKETS - 1] == 1


def test_training_separates_and_repeats_itself():
    random = np.random.default_rng(5)
    bags = [(np.unique(random.integers(0, 50, 8)) + (50 if k % 2 else 0), None) for k in range(200)]
    bags = [(ids, np.ones(len(ids), int)) for ids, _ in bags]
    labels = np.arange(200) % 2
    gains, prior = quality.train(bags, labels, 100)
    again, _ = quality.train(bags, labels, 100)
    assert (gains == again).all()
    z = np.array([(gains[ids].sum() + prior) / (len(ids) + 1) for ids, _ in bags])
    assert ((z > 0) == (labels == 1)).all()


def test_quality_of_odd_rows(docs, nothing, spark):  # noqa: F811
    marks = [(k, k % 2, None) for k in range(16)] + [(1, 0, None), (None, 1, None), (3, None, 1), (4, 7, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    clash = docs.withColumns({"rank": F.lit(1), "label": F.lit("x"), "score": F.lit(None), "quality": F.lit(0), "buckets": F.lit(2)})
    rows = quality.quality(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    other = quality.quality(clash, quality.fit_quality(clash, labels)).collect()
    order = lambda rs: sorted((str(r["doc_id"]), r["score"]) for r in rs)
    assert order(rows) == order(other)
    equal_texts = {r["score"] for r in rows if r["doc_id"] in (1, None)} | {r["score"] for r in rows if r["doc_id"] == 0}
    assert len(equal_texts) == 1
    assert quality.quality(nothing, model).collect() == []
    assert quality.fit_quality(nothing, labels).share == 0.0
    one_class = labels.where("quality = 1")
    assert all(r["score"] == 1.0 for r in quality.quality(docs, quality.fit_quality(docs, one_class)).collect())


def test_the_sample_is_bounded_by_ids(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    ids = quality.sample_ids(labels, "quality", 100).collect()
    assert len(ids) == 100 and len({r["doc_id"] for r in ids}) == 100
    assert quality.sample_ids(labels.union(labels), "quality", 100).collect() == ids
