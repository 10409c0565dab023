"""Each operator against a brute-force version over small rows with every kind of odd value."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pipecast.llm import chat, exact_dedup, fingerprints, language_id, lattice, mixing, ngram_join, pieces, queries, substrings, toxicity
from pipecast.llm import words as words_module
from pipecast.llm.store import read
from pipecast.llm.vocabulary import VOCABULARY_FILE, load_vocabulary
from tests.compare import connect, duckdb_result, spark_result
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def odd_rows():
    """Nulls, empty and white texts, copies, near copies, ties, repeated rows, a very long text, strange characters."""
    base = " ".join(f"word{k}" for k in range(120))
    near = base.replace("word60", "other")
    passage = " ".join(f"shared{k % 50}" for k in range(60))
    texts = [
        base,
        base,
        base.upper(),
        near,
        near + " tail",
        None,
        "",
        " \t\n",
        "one",
        "One",
        "two words",
        f"start a b {passage} end",
        f"other c d e {passage} stop",
        "rep " * 400,
        "été “quoted” ▁mark  double space sep 漢字 😀",
        base.replace(" ", "  ").replace("word5", "\nword5"),
        " ".join(f"x{k}" for k in range(30_000)),
        "\n\n".join(["para one.\nline two", "para two", ""]),
    ]
    rows = [(k, t, ("en", "de", None)[k % 3], ("b", "a", None, "hot", "hot")[k % 5], 7, f"r{k}") for k, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((3, "same id, other text " * 3, "en", "a", 1, "again"))
    rows.append((None, base, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_counter(df):
    return Counter(tuple(r) for r in df.collect())


def test_words_and_windows():
    import pyarrow as pa

    texts = ["A b\tc", None, "", "é x  y", "b c"]
    found = words_module.Words(pa.array(texts), lower=True)
    assert list(found.counts) == [3, 0, 0, 2, 2]
    assert found.hashes[1] == found.hashes[5] and found.hashes[2] == found.hashes[6]
    assert len(set(found.hashes.tolist())) == 5
    starts, hashes = words_module.runs(found, 2)
    assert list(starts) == [0, 1, 3, 5] and hashes[1] == hashes[3]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    columns, rows = spark_result(queries.queries()[name](spark, SMALL))
    assert (columns, rows) == duckdb_result(connect(SMALL), queries.oracle_sql()[name])
    assert rows


# --- exact deduplication ------------------------------------------------------------------------


@pytest.mark.parametrize("bucket_bytes", [1, 10**9])
def test_exact_duplicates(docs, bucket_bytes):
    rows = odd_rows()
    content = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    groups = defaultdict(list)
    for r, c in zip(rows, content):
        groups[c].append(r[0])
    expected = Counter()
    for r, c in zip(rows, content):
        known = [i for i in groups[c] if i is not None]
        expected[(r[0], min(known, default=None), len(groups[c]), sha(c))] += 1
    out = exact_dedup.exact_duplicates(docs, bucket_bytes)
    assert as_counter(out.select("doc_id", "keep_id", "group_size", "text_sha256")) == expected
    kept = out.where("kept")
    assert kept.count() == len(groups) and kept.where("not (doc_id <=> keep_id)").count() == 0


@pytest.mark.parametrize("bucket_bytes, remembered", [(1, 0), (10**9, 0), (10**9, 10**9)])
def test_dropping_copies_keeps_the_least(docs, monkeypatch, bucket_bytes, remembered):
    monkeypatch.setattr(exact_dedup, "REMEMBERED_BYTES", remembered)
    groups = defaultdict(list)
    for r in odd_rows():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r)
    expected = Counter(min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values())
    many = docs.union(docs).union(docs.orderBy(F.desc("doc_id")))
    assert as_counter(exact_dedup.drop_duplicates(many, bucket_bytes)) == expected
    assert as_counter(exact_dedup.drop_duplicates(docs.withColumn("tie", F.create_map(F.lit("k"), "source"))).select(docs.columns)) == expected


def test_dropping_copies_keeps_columns(docs, nothing):
    out = exact_dedup.drop_duplicates(docs)
    assert out.schema.names == docs.schema.names
    content = {re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in odd_rows()}
    assert out.count() == len(content)
    assert out.where("doc_id = 0").count() == 1
    assert exact_dedup.drop_duplicates(nothing).count() == 0
    assert exact_dedup.exact_duplicates(nothing).count() == 0


# --- n-gram Jaccard join ------------------------------------------------------------------------


def brute_components(rows, width, percent):
    sets = []
    for r in rows:
        w = words_of(lower(r[1] or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = Counter()
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i == j or a[0] is None or b[0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                x, y = find(a[0]), find(b[0])
                parent[max(x, y)] = min(x, y)
    return Counter(
        (r[0], len(sets[k]) if r[0] is not None else None, find(r[0]) if r[0] is not None else None, links[k])
        for k, r in enumerate(rows)
    )


@pytest.mark.parametrize("hot", [24, 1])
def test_ngram_join(docs, monkeypatch, hot):
    """Also with every shared shingle taken as hot, and blocks of two classes."""
    monkeypatch.setattr(ngram_join, "HOT_CLASSES", hot)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 2_048 if hot > 1 else 2)
    out = ngram_join.ngram_jaccard_join(docs, width=4, percent=85)
    assert as_counter(out.select("doc_id", "n_shingles", "component_id", "n_links")) == brute_components(odd_rows(), 4, 85)


def test_ngram_join_of_a_chain(spark):
    """Each text links with the next only; all are one component."""
    rows = [(k, " ".join(f"w{j}" for j in range(k * 3, k * 3 + 60)), None, None, None, None) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute_components(rows, 2, 85)
    out = ngram_join.ngram_jaccard_join(df, width=2, percent=85)
    assert as_counter(out.select("doc_id", "n_shingles", "component_id", "n_links")) == expected
    assert {c for _, _, c, _ in expected} == {0}
    assert [r.doc_id for r in ngram_join.keep_one_of_each_component(df, 2, 85).collect()] == [0]


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_texts_stay_where_near_copies_are_dropped(spark, docs, monkeypatch, sent):
    """Only the ids of dropped rows travel, unless they are many; rows that share an id stay together."""
    monkeypatch.setattr(ngram_join, "DROPPED_IDS", sent)
    rows = [*odd_rows(), (40, "", None, None, None, "void"), (40, odd_rows()[0][1], None, None, None, "copy")]
    df = spark.createDataFrame(rows, SCHEMA)
    stays = {r.doc_id for r in ngram_join.ngram_jaccard_join(df, 4, 85).collect() if r.doc_id == r.component_id}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ngram_join.keep_one_of_each_component(df, 4, 85)
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = Counter((r.doc_id, r.row_id) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == Counter((r[0], r[5]) for r in rows if r[0] is None or r[0] in stays)
    assert out.columns == df.columns and 40 in stays
    assert ("Exchange hashpartitioning" in plan) == (not sent)


def test_ngram_join_of_nothing(nothing):
    assert ngram_join.ngram_jaccard_join(nothing).count() == 0


# --- mixing -------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return {s: most * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


def check_mix(rows, out):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    targets = brute_targets(sizes)
    taken = Counter()
    for r in out:
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 * max(1, targets[r.source])
        taken[r.source] += r.taken
    return taken, targets


def test_mix(docs, nothing):
    out = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], len(words_of(r[1]))) for r in odd_rows())
    check_mix(odd_rows(), out)
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert mixing.mix(nothing).count() == 0


def test_mix_meets_targets_in_blocks(spark):
    rows = [(r.doc_id, r.text, None, r.source, None, None) for r in read(spark, SMALL, "documents").collect()]
    rows = [(r[0] + 1000 * k, r[1], None, f"s{r[0] % 4}", None, None) for k in range(4) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    taken, targets = check_mix(rows, mixing.mix(df, block_rows=40).collect())
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in targets.items())


def test_flight_keeps_totals():
    import numpy as np

    rng = np.random.default_rng(1)
    p, size, draws = rng.random(500), rng.integers(0, 900, 500), rng.random(500)
    flown = mixing.flight(p, size, draws)
    assert abs(flown.sum() - p.sum()) < 1e-6 and abs((flown * size).sum() - (p * size).sum()) < 1e-3
    assert ((flown > 0) & (flown < 1)).sum() <= 2


# --- SentencePiece ------------------------------------------------------------------------------


def test_round_trip(docs, nothing):
    out = pieces.round_trip(docs, load_vocabulary())
    assert out.where("not exact").count() == 0
    expected = Counter((r[0], sha(r[1] or "")) for r in odd_rows())
    assert as_counter(out.select("doc_id", "decoded_sha256")) == expected
    assert pieces.round_trip(nothing, load_vocabulary()).count() == 0


def test_encode_columns_and_decode(docs):
    vocabulary = load_vocabulary()
    encoded = pieces.encode_documents(docs, vocabulary)
    back = encoded.withColumn("back", pieces.decoder(vocabulary)(F.col("pieces")))
    assert back.where("back <> coalesce(text, '')").count() == 0
    assert encoded.columns == [*docs.columns, "pieces"]


def brute_best(word, table, unknown):
    best = [0.0] + [float("-inf")] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            score = table.get(word[start:end])
            if score is None and start == end - 1:
                score = unknown
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_segmentations_are_best(spark):
    vocabulary = load_vocabulary()
    table = {vocabulary.pieces[i]: -math.log(10 - vocabulary.scores[i]) for i in vocabulary.plain}
    segmenter = pieces.Segmenter(vocabulary)
    texts = [r.text for r in read(spark, SMALL, "documents").limit(40).collect()]
    found = sorted({"▁" + w for t in texts for w in t.split(" ")} | {"▁" * 5 + "if", "▁" * 40})
    for word, ids in segmenter.segment(found):
        if all(i not in vocabulary.byte_ids for i in ids):
            assert "".join(vocabulary.pieces[i] for i in ids) == word
            score = sum(table[vocabulary.pieces[i]] for i in ids)
            assert score == pytest.approx(brute_best(word, table, segmenter.unknown_score), rel=1e-12)


def test_runs_of_spaces_and_number_of_pieces(spark):
    """Spaces in a row are single pieces; on whole texts there are few more pieces than by merges."""
    from sentencepiece import SentencePieceProcessor

    vocabulary = load_vocabulary()
    segmenter = pieces.Segmenter(vocabulary)
    assert all(set(vocabulary.pieces[i].lstrip("▁")).isdisjoint("▁") for i in vocabulary.plain)
    back = pieces.Joiner(vocabulary)
    for text in ("a        b", "  a", "a  ", " ", "    ", "x ▁  y"):
        (ids,) = segmenter.encode([text])
        assert back.decode(ids) == text
    (ids,) = segmenter.encode(["a" + " " * 8 + "b"])
    assert len(ids) <= 4
    owner = SentencePieceProcessor(model_file=VOCABULARY_FILE)
    texts = [r.text for r in read(spark, SMALL, "documents").collect() if r.text]
    ours, merged = sum(map(len, segmenter.encode(texts))), sum(map(len, owner.encode(texts)))
    assert ours <= 1.06 * merged


# --- fingerprints -------------------------------------------------------------------------------


def test_fingerprints(docs, nothing):
    rows = [r for r in odd_rows() if r[0] not in (0, 3)]  # ids that occur once
    out = {r.doc_id: r for r in fingerprints.document_fingerprints(docs.where("doc_id is null or doc_id not in (0, 3)")).collect()}
    order = sorted((r[0] for r in rows), key=lambda i: (i is None, -(i or 0)))
    text = {r[0]: r[1] or "" for r in rows}
    assert set(out) == set(order)
    for k, i in enumerate(order):
        own, following = text[i], text[order[(k + 1) % len(order)]]
        third = len(own) // 3
        edited = own[: len(own) - third] + following[:third]
        assert out[i].n_chars == len(own) and out[i].edited_sha256 == sha(edited)
        assert (out[i].fingerprint == out[i].edited_fingerprint) == (own == edited)
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
        assert (out[i].near_edited == 1) or own != edited
    # The likeness is twice what both texts share over what both have; only the head is shared here.
    own, following = text[16], text[order[order.index(16) + 1]]
    third = len(own) // 3
    shared, both = len(own) - third, len(own) + len(own) - third + min(third, len(following))
    assert abs(out[16].near_edited - 2 * shared / both) < 0.02 and out[16].near_next < 0.01
    assert fingerprints.document_fingerprints(nothing).count() == 0


def test_repeated_rows_have_fingerprints(docs):
    out = fingerprints.document_fingerprints(docs)
    assert out.count() == docs.count()
    assert out.where("doc_id = 0").select("fingerprint").distinct().count() == 1


def test_differing_branches(spark):
    row = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\nX")], "x string, y string")
    trees = row.select(fingerprints.tree("x").alias("one"), fingerprints.tree("y").alias("other"))
    found = trees.select(fingerprints.differing_branches("one", "other").alias("d")).first().d
    assert [(d["section"], d["paragraph"], d["piece"]) for d in found] == [(1, 1, 0)]


# --- lattice ------------------------------------------------------------------------------------


def brute_word(word, log_p, vocabulary):
    import numpy as np

    data = ("▁" + word).encode()
    table = {vocabulary.pieces[i].encode(): i for i in vocabulary.inside_words}
    reach = [0.0] + [-np.inf] * len(data)  # logarithms: long words are too unlikely for a float
    for end in range(1, len(data) + 1):
        for start in range(end):
            i = table.get(data[start:end])
            if i is not None:
                reach[end] = np.logaddexp(reach[end], reach[start] + log_p[i])
        if end > 3:
            reach[end] = np.logaddexp(reach[end], reach[end - 1] + log_p[vocabulary.byte_ids[data[end - 1]]])
    return reach[-1]


def test_lattice_sums_all_segmentations():
    import numpy as np
    import pyarrow as pa

    vocabulary = load_vocabulary()
    table = lattice.PieceTable.of(vocabulary)
    log_p = lattice.start_probabilities(vocabulary, table)
    texts = ["the", "anthology", "é", "x" * 200, "漢字", "a"]
    words = words_module.Words(pa.array([" ".join(texts)]))
    found = lattice.Lattice(words.data, words.starts, words.ends, table)
    expected = [brute_word(t, log_p, vocabulary) for t in texts]
    assert np.allclose(found.words(log_p), expected)
    # Expected uses: the bytes that the pieces cover are those of the words.
    uses = found.expected(log_p, np.ones(len(texts)))
    length = np.zeros(len(log_p))
    for i in vocabulary.inside_words:
        length[i] = len(vocabulary.pieces[i].encode())
    length[vocabulary.byte_ids] = 1
    assert np.isclose((uses * length).sum(), sum(len(("▁" + t).encode()) for t in texts))


def test_lattice_edges_are_those_of_all_pieces():
    """Places are left once no piece goes on from them; no edge is lost by that."""
    import numpy as np
    import pyarrow as pa

    vocabulary = load_vocabulary()
    table = lattice.PieceTable.of(vocabulary)
    inside = {vocabulary.pieces[i].encode(): i for i in vocabulary.inside_words}
    for n, longest in table.longest.items():
        slots = lattice._piece_keys(np.frombuffer("▁international".encode()[:n], np.uint8), n) >> np.uint64(64 - lattice._PREFIX_BITS)
        assert longest[slots[0]] >= len("▁international".encode())
    texts = ["internationalization", "the", "zq" * 40, "漢字", "été", "a"]
    words = words_module.Words(pa.array([" ".join(texts)]))
    found = lattice.Lattice(words.data, words.starts, words.ends, table)
    expected, first = Counter(), 0
    for text in texts:
        data = ("▁" + text).encode()
        for i in range(len(data)):
            expected.update((first + i, first + j, inside[data[i:j]]) for j in range(i + 1, len(data) + 1) if data[i:j] in inside)
            if i > 2:
                expected[first + i, first + i + 1, vocabulary.byte_ids[data[i]]] += 1
        first += len(data) + 1
    assert Counter(zip(found.start.tolist(), found.end.tolist(), found.piece.tolist())) == expected
    assert set(table.longest) == {3, 6, 9}


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_lattice_counts_and_base(docs, frequent):
    import math
    import zlib

    rows = odd_rows()
    held = {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows}
    counts, ends = Counter(), 0
    for r in rows:
        if r[0] is not None and not held[r[0]]:
            counts.update(words_of(lower(r[1] or "")))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    expected = Counter()
    for r in rows:
        tokens = words_of(lower(r[1] or ""))
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        base += math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        known = sum(counts[t] > 0 for t in tokens) + 1
        expected[(r[0], held[r[0]], len(tokens) + 1, known, n, round(base, 3))] += 1
    out = lattice.lattice_scores(docs, load_vocabulary(), rounds=1, frequent_words=frequent).collect()
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in out)
    assert got == expected
    assert all(r.score < 0 for r in out)


def test_lattice_does_not_depend_on_the_frequent_table(docs):
    one, other = (
        {(r.doc_id, r.n_tokens): r.score for r in lattice.lattice_scores(docs, load_vocabulary(), 1, k).collect()} for k in (2, 500)
    )
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-9 * (1 + abs(one[k])) for k in one)


def test_lattice_counts_a_batch_in_little_memory():
    """Work arrays stay small however large a batch is, and a word comes once a batch."""
    import pyarrow as pa

    texts = ["".join(f"W{i * k % 5000} " for i in range(700_000)) for k in (1, 7)] + [None, "", " w1 "]
    short = [text[i : i + 1_000_000] for text in texts[:2] for i in range(0, 4_000_000, 1_000_000)]
    tracemalloc.start()
    list(lattice._count_words(iter([pa.RecordBatch.from_arrays([pa.array(short)], names=["text"])])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250_000_000
    (counted,) = lattice._count_words(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    expected = Counter(word for text in texts for word in WORD.findall(lower(text or "")))
    assert {w.decode(): n for w, n in zip(counted["word"].to_pylist(), counted["n"].to_pylist())} == expected
    assert counted.num_rows == len(expected)


def test_lattice_of_nothing(nothing):
    assert lattice.lattice_scores(nothing, load_vocabulary(), rounds=1).count() == 0


# --- toxicity and language ----------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    rows, labels = [], []
    for k in range(600):
        bad = k % 6 == 0
        text = " ".join(f"plain{(k * 7 + j) % 90}" for j in range(40)) + (" awfulx stinky awfuls" if bad else " nice")
        rows.append((k, text, None, None, None, None))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame([*rows, (None, None, None, None, None, None), (9999, "", "x", "y", 1, "z")], SCHEMA)
    marks = spark.createDataFrame([*labels, (None, 1), (1, None), (77777, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, toxicity.fit_toxicity(docs, marks)).collect()
    assert len(out) == 602 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = dict(labels)
    wrong = [r for r in out if r.held_out and r.doc_id in truth and r.predicted != truth[r.doc_id]]
    assert not wrong


def test_toxicity_tells_whole_words_and_pairs_apart(spark):
    """Toxic words that begin like ordinary ones, pairs of harmless words, letters of several bytes."""
    harmless = ["worth", "worthy", "прикол", "red", "car"]
    rows, labels = [], []
    for k in range(1200):
        toxic = [["worthless"], ["red", "car"], ["придурок"]][k // 6 % 3] if k % 6 == 0 else None
        filler = [f"plain{(k * 7 + j) % 90}" for j in range(30)]
        filler[10:10] = toxic or ["car", *harmless[:3], "plain", "red"]
        if toxic:
            filler[3:3], filler[25:25] = ["car"] + harmless[:3], ["red"]
        rows.append((k, " ".join(filler), None, None, None, None))
        labels.append((k, int(bool(toxic))))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = toxicity.toxicity(docs, toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    assert not [r for r in out.collect() if r.held_out and r.predicted != dict(labels)[r.doc_id]]


def test_expressions_are_words_of_code_points():
    import pyarrow as pa

    texts = ["Worth worth worthless", "слово слон", "漢字xy 漢 字z", "", None, "ab"]
    found = toxicity.Expressions(pa.array(texts))
    assert found.owner.tolist() == [0, 0, 0, 1, 1, 2, 2, 2, 2, 2, 2, 5]
    pair, word, begin = found.keys
    assert word[0] == word[1] != word[2] and len({*begin[:3].tolist()}) == 1
    assert begin[3] != begin[4]
    assert (word[5], word[6]) == (word[8], word[9]) and pair[6] == pair[9]
    assert found.follows.tolist() == [False, True, True, False, True, False] + [True] * 5 + [False]


def test_toxicity_without_labels(docs, nothing, spark):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, marks)
    assert toxicity.toxicity(docs, model).where("score <> 0").count() == 0
    assert toxicity.toxicity(nothing, model).count() == 0


def test_language_on_held_out_rows(spark):
    docs = read(spark, SMALL, "documents")
    model = language_id.fit_centroids(language_id.training_rows(docs))
    out = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count()
    assert out.where("score < 0 or score > 1").count() == 0
    assert language_id.keep_identified(docs, model).count() >= 0.99 * docs.count()


def test_language_of_clean_short_texts_and_gibberish(spark):
    import numpy as np

    docs = read(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.fit_centroids(language_id.training_rows(docs))
    rows = docs.where("lang is not null").collect()
    draw = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    odd = [" ".join("".join(draw.choice(letters, 6)) for _ in range(n)) for n in (20, 60, 200) for _ in range(40)]
    short = [(k, r.text[len(r.text) // 2 :][:60], r.lang, None, None, None) for k, r in enumerate(rows) if len(r.text or "") > 200]
    texts = spark.createDataFrame([*short, *[(-1 - k, t, None, None, None, None) for k, t in enumerate(odd)]], SCHEMA)
    out = language_id.identify(texts, model).join(texts.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.rejected for r in out if r.doc_id < 0) >= 0.95 * len(odd)
    for lang in {r.lang for r in rows}:
        clean = [r for r in out if r.doc_id >= 0 and r.lang == lang]
        assert sum(not r.rejected for r in clean) >= 0.95 * len(clean)


def test_clusters_are_no_strays():
    import numpy as np

    draw = np.random.default_rng(1)
    points = np.abs(draw.normal(0, 0.05, (100, 16))).astype(np.float32)
    points[:50, 0] = points[50:97, 1] = points[97, 5] = points[98, 6] = points[99, 7] = 1
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    _, near = language_id.cluster(points, np.ones(100), 4, 8)
    assert np.bincount(near).min() >= 5


def test_languages_of_few_distinct_texts_are_learned(spark):
    rows = [(k, f"slovo jazyk veta {k % 10} text{'abcdefghij'[k % 10]}", "cs", None, None, None) for k in range(20_000)]
    rows += [(k, "kind words in this text " + "abcdefgh"[k % 8] * (k % 50 + 1), "en", None, None, None) for k in range(20_000, 21_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_id.fit_centroids(docs, sample_rows=40)
    assert set(model.langs) == {"cs", "en"}
    wrong = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("lang <> lang_pred")
    assert wrong.count() == 0


def test_language_of_odd_texts(docs, nothing):
    model = language_id.fit_centroids(language_id.training_rows(docs))
    out = language_id.identify(docs, model)
    assert out.count() == docs.count()
    und = out.where("lang_pred = 'und'")
    assert {r.doc_id for r in und.collect()} == {5, 6, 7} and und.where("score <> 0 or not rejected").count() == 0
    empty = language_id.fit_centroids(nothing)
    assert language_id.identify(docs, empty).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(nothing, model).count() == 0
    assert language_id.keep_identified(docs, model).columns == docs.columns


# --- substrings ---------------------------------------------------------------------------------


@pytest.mark.parametrize("hot, width", [(20_000, 35), (0, 35), (20_000, 3)])
def test_substrings(docs, monkeypatch, hot, width):
    monkeypatch.setattr(substrings, "HOT_TEXTS", hot)
    rows = odd_rows()
    windows = Counter()
    for r in rows:
        w = words_of(r[1])
        windows.update(tuple(w[k : k + width]) for k in range(len(w) - width + 1))
    expected = Counter()
    for r in rows:
        w = words_of(r[1])
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if windows[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected[(r[0], len(w), sum(gone), sha(kept), kept)] += 1
    out = substrings.deduplicate_substrings(docs, width, with_text=True)
    assert as_counter(out.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")) == expected


def test_substrings_of_nothing(nothing):
    assert substrings.deduplicate_substrings(nothing).count() == 0


# --- chats --------------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [256, 2])
def test_chats(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK_TURNS", chunk)
    talks = {
        1: [("user", "a"), ("assistant", "b")],
        2: [("user", "a"), ("assistant", "b"), ("user", "c")],
        3: [("user", "a"), ("assistant", "b"), ("user", "c")],
        4: [("user", "a"), ("assistant", "x")],
        5: [("user", None), (None, "b")],
        6: [("user", ""), (None, "b"), ("user", "<|im_end|> forged")],
        7: [("user", f"t{k}") for k in range(9)],
        8: [("user", f"t{k}") for k in range(5)],
    }
    rows = [(c, k, r, t, "extra") for c, turns in talks.items() for k, (r, t) in enumerate(turns)]
    rows += [rows[0], (None, 0, "user", "a", "extra")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, chunk string").repartition(3)
    out = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert set(out) == set(talks)
    assert {c for c, r in out.items() if r.kept} == {2, 4, 5, 6, 7}
    for c, r in out.items():
        lines = [
            f"<|im_start|>{role or 'unknown'}\n{(text or '').replace('<|im_', '<| im_')}<|im_end|>\n" for role, text in talks[c]
        ]
        assert r.n_turns == len(talks[c]) and r.chat == ("".join(lines) if r.kept else None)
    assert chat.format_chats(df.where("false")).count() == 0


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline_stages(docs, spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SMALL)
        assert step.columns == columns, name
        step = spark.createDataFrame(step.collect(), step.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, step, SMALL)
    assert last.count() == step.count() and last.where("size(pieces) = 0 and length(text) > 0").count() == 0


def test_pipeline_drops_copies(spark):
    rows = corpus_pipeline.run(spark, SMALL).select("doc_id", "text").distinct()
    content = rows.select(exact_dedup.normalised(F.col("text")))
    assert content.distinct().count() == rows.count()


def clashing(docs):
    """The rows with further columns named like those that operators make."""
    names = ("n", "row_id", "class_id", "rank", "size", "copies", "copy", "score", "held_out", "component", "digest", "label")
    return docs.withColumns({name: F.lit("x") for name in names if name not in docs.columns})


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_clashing_columns_and_of_nothing(docs, nothing, spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, nothing, SMALL).count() == 0
    one, other = (stage(spark, d, SMALL) for d in (docs, clashing(docs)))
    assert one.columns == other.columns and as_counter(one.select("doc_id", "text")) == as_counter(other.select("doc_id", "text"))


def test_mixing_keeps_columns_of_any_name(docs):
    odd = docs.withColumns({"mixed_id": F.lit(1), "mixed_times": F.lit(2), "Mixed_Copy": F.lit(3), "__id": F.lit(4)})
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(odd).count() == mixing.mixed_documents(docs).count()


def test_operators_free_what_they_kept(docs, spark):
    import os

    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    out = ngram_join.ngram_jaccard_join(docs)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and out.count() == docs.count()


def test_toxicity_of_a_bounded_sample(docs, spark):
    marks = spark.createDataFrame([(k, k % 2) for k in range(16)], "doc_id long, toxic int")
    few = toxicity.fit_toxicity(docs, marks, sample_rows=4)
    assert toxicity.toxicity(docs, few).count() == docs.count()
