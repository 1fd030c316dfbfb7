"""N-gram Jaccard join, substring removal and embedding near-duplicates against brute force."""

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snaptide.llm import lattice, ngram_join, repeats, workload

from .conftest import lowered, spaced


def shingles(text):
    words = spaced(lowered(text))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def smallest(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = []
    for i, s in sets.items():
        for j, common in collections.Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                pairs.append((i, j))
    return {i: (len(sets[i]), c) for i, c in smallest(sets, pairs).items()}


def test_ngram_join_equals_brute_force(spark, sf_dir, documents):
    want = jaccard_groups([tuple(r) for r in documents.select("doc_id", "text").collect()])
    got = {r[0]: (r[1], r[2]) for r in workload.op3_ngram_jaccard(spark, sf_dir).collect()}
    assert got == want
    assert any(c != i for i, (_, c) in got.items())


def test_chain_and_near_misses_are_told_apart(spark):
    base = [f"w{i}" for i in range(100)]

    def text(words):
        return " ".join(words)

    rows = [(1, text(base))]
    # a chain: each is linked with the one before it only
    for k in range(1, 6):
        rows.append((10 * k, text([f"c{k}-{i}" if i < 5 * k else w for i, w in enumerate(base)])))
    # many near copies with one word of their own, which no two share
    rows += [(1000 + k, text([*(f"n{i}" for i in range(60)), f"own{k}"])) for k in range(60)]
    # below the threshold of their like
    rows += [(2000 + k, text([*(f"n{i}" for i in range(40)), *(f"far{k}-{i}" for i in range(12))])) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in ngram_join.classes(df).collect()}
    assert got == jaccard_groups(rows)


def test_ngram_join_on_odd_rows(spark, odd, none):
    got = collections.defaultdict(list)
    for r in ngram_join.classes(odd).collect():
        got[r["id"]].append((r["n_shingles"], r["component"]))
    want = jaccard_groups([(r[0], r[1]) for r in odd.select("doc_id", "text").collect() if r[0] is not None])
    assert len(got[10]) == 2
    assert {i: v[0] for i, v in got.items() if i is not None} == want
    assert got[None] == [(want[9][0], None)]
    assert want[5] == (1, 4) and want[1] == (0, 1)
    assert ngram_join.classes(none).collect() == []


def hot_cell(spark):
    """One cell: 600 points of one group, three of another and one by itself; all but the last may be linked."""
    sizes = {i: 100 if i < 603 else 10 for i in range(604)}
    shared = spark.createDataFrame([(1, i, 0, 604) for i in sizes], "key long, node long, first long, size long")
    point = np.full(ngram_join.GROUPS, 1, np.uint8).tobytes()
    nodes = spark.createDataFrame([(i, n, bytearray(point)) for i, n in sizes.items()], "node long, n long, point binary")
    groups = spark.createDataFrame([(i, 0 if i < 600 else 600) for i in range(603)], "node long, root long")
    return shared, nodes, groups


def test_points_of_a_hot_cell_meet_the_other_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "TASK_ROWS", 64)
    pairs = ngram_join._meetings(*hot_cell(spark), False)
    assert sorted(map(tuple, pairs.collect())) == [(i, j) for i in range(600) for j in (600, 601, 602)]


def test_rows_of_a_task_stay_bounded_in_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "TASK_ROWS", 64)

    def counted(rows, likeliest):
        import pandas as pd

        return pd.DataFrame({"a": [len(rows)], "b": [int(rows["task"].iloc[0])]})

    monkeypatch.setattr(ngram_join, "_search", counted)
    held = [r["a"] for r in ngram_join._meetings(*hot_cell(spark), False).collect()]
    # each of the large group once, each of the others once a block; every row once a block would be 604 * 38
    assert 604 < sum(held) < 2 * 604 and max(held) < 320


def test_keep_first_keeps_one_of_each_group(odd, none):
    kept = ngram_join.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 8, 11, 12]
    assert ids.count(None) == 1
    assert ngram_join.keep_first(none).count() == 0


def test_keep_first_does_not_depend_on_the_partitions(spark):
    texts = ["b text of its own", "a text of its own", "a text of its own", None, "c"]
    rows = [(1, t, "en", f"src{i}", i) for i, t in enumerate(texts)] + [(2, t, "en", "x", i) for i, t in enumerate(["z y", "y z"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [sorted(map(tuple, ngram_join.keep_first(df.repartition(n, "n_chars")).collect())) for n in (1, 4, 9)]
    assert got[0] == got[1] == got[2] and [r[1] for r in got[0]] == [None, "y z"]


def removed(rows, window=13):
    """Kept words of each row, by all windows of all documents."""
    first = {}
    for i, text in rows:
        words = spaced(text)
        if i is not None:
            for k in range(len(words) - window + 1):
                key = tuple(words[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        words = spaced(text)
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_equal_brute_force(spark, sf_dir, documents):
    want = removed([tuple(r) for r in documents.select("doc_id", "text").collect()])
    got = sorted((tuple(r) for r in workload.op7_substring_dedup(spark, sf_dir).collect()), key=repr)
    assert got == want
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("buckets", [40, 3_000_000])
def test_repeats_on_odd_rows(odd, none, monkeypatch, buckets):
    monkeypatch.setattr(repeats, "BUCKET_WORDS", buckets)
    want = removed([tuple(r) for r in odd.select("doc_id", "text").collect()])
    got = sorted((tuple(r) for r in repeats.digest(odd).collect()), key=repr)
    assert got == want
    assert repeats.digest(none).collect() == []


@pytest.mark.parametrize("parts", [1, 5])
def test_copies_send_one_window_a_chunk(spark, parts):
    text = " ".join(f"word{i}" for i in range(200))

    def frame(copies):
        # the passage begins at one place of each, so most of its windows are a block of none of them
        rows = [(i // 2 if i % 7 == 0 else i, f"a b c {text}") for i in range(copies)]
        return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).repartitionByRange(parts, "doc_id")

    def sent(copies):
        texts = repeats._keyed(frame(copies), "doc_id", "text")
        steps = texts.mapInArrow(repeats._Anchors(7, 1), repeats._ROW)
        near = texts.selectExpr("*", "cast(unhex('00000000') AS binary) AS places").mapInArrow(repeats._Windows(13, 7, 1), repeats._ROW)
        return [s.where(f"kind = {repeats._PROBE}").agg(F.sum(F.length("data"))).first()[0] for s in (steps, near)]

    small, large = sent(60), sent(600)
    assert all(b <= 1.1 * a for a, b in zip(small, large, strict=True))
    df = frame(60)
    got = {(r["doc_id"], r["n_removed"]) for r in repeats.digest(df).collect()}
    first = df.agg(F.min("doc_id")).first()[0]
    assert got == {(r["doc_id"], 0 if r["doc_id"] == first else 203) for r in df.collect()}


def test_windows_need_both_hashes(spark, monkeypatch):
    import pyarrow as pa

    words = repeats.Words(pa.array(["a b c d", "a b c d", "a b c e"]))
    both = repeats._twice(words, words.hashes(), 4)
    assert (both[0] == both[4]).all() and (both[0] != both[8]).all() and both[0, 0] != both[0, 1]
    order = np.zeros(3, np.uint64)
    # runs of one hash are cut where the other differs
    assert repeats._runs(order, both[[0, 4, 8], 1]).tolist() == [0, 2]


def test_repeats_at_every_offset_and_just_too_short(spark):
    passage = [f"p{i}" for i in range(13)]
    rows = [(0, " ".join([*(f"a{i}" for i in range(5)), *passage, "end"]))]
    for k in range(1, 15):
        rows.append((k, " ".join([*(f"k{k}-{i}" for i in range(k)), *passage, f"t{k}"])))
    rows.append((50, " ".join([*passage[:12], "other"])))
    # twice in one document counts only against another
    rows.append((51, " ".join([*(f"r{i}" for i in range(13)), *(f"r{i}" for i in range(13))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeats.digest(df).collect()), key=repr) == removed(rows)
    for window in (1, 2, 5):
        got = sorted((tuple(r) for r in repeats.digest(df, window).collect()), key=repr)
        assert got == removed(rows, window)


def cosine_groups(rows):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.append((i, np.array(v, float) / np.linalg.norm(v), label))
    links = collections.Counter()
    pairs = []
    for a, (i, v, k) in enumerate(good):
        for j, w, m in good[:a]:
            if k == m and len(v) == len(w) and v @ w >= 0.98:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = smallest({r[0] for r in rows if r[0] is not None}, pairs)
    return {i: (links[i], c, c == i) for i, c in root.items()}


def test_embeddings_equal_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in workload.op5_embedding_dedup(spark, sf_dir).collect()}
    assert got == cosine_groups(rows)


def test_embedding_copies_near_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    monkeypatch.setattr(lattice, "TASK_ROWS", 500)
    rng = np.random.RandomState(5)
    rows = []
    for group in range(6):
        centre = rng.randn(32)
        for _ in range(25):
            near = centre + rng.randn(32) * rng.choice([0.0, 0.02, 0.05, 0.08, 0.2])
            rows.append((len(rows), [float(x) for x in np.float32(near)], group % 2))
    rows += [(900 + k, rows[0][1], 0) for k in range(40)]
    rows += [
        (1000, None, 0),
        (1001, [], 0),
        (1002, [0.0] * 32, 0),
        (1003, [None] + [1.0] * 31, 0),
        (1004, [float("nan")] + [1.0] * 31, 0),
        (1005, [float("inf")] + [1.0] * 31, 0),
        (1006, rows[0][1], None),
        (1007, rows[0][1][:3], 0),
        (1008, [3.0 * x for x in rows[1][1]], 1),
        (1009, [1.0, 0.0], 0),
        (1010, [1.0, -0.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = cosine_groups([tuple(r) for r in df.collect()])
    more = df.selectExpr("*", "1 AS id", "'x' AS vector", "2 AS cells", "3 AS node")
    got = {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in lattice.classes(more).collect()}
    assert got == want
    twice = lattice.classes(df.unionByName(df))
    assert twice.count() == 2 * len(rows)
    assert {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in twice.collect()} == want
    assert lattice.classes(df.limit(0)).collect() == []
    alone = spark.createDataFrame([(None, [1.0], 0)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in lattice.classes(alone).collect()] == [(None, 0, None, True)]


def test_rows_of_a_task_stay_bounded_in_a_large_cell(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    monkeypatch.setattr(lattice, "TASK_ROWS", 64)
    rng = np.random.RandomState(3)
    base = rng.randn(64)
    rows = [(i, 1, (base + 0.001 * rng.randn(64)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    compare = lattice._cell_links

    def small(rows):
        # TASK_ROWS and what chance deals on top; by the rows before the blocks are cut it would be some 1,600
        assert len(rows) < 480, len(rows)
        return compare(rows)

    monkeypatch.setattr(lattice, "_cell_links", small)
    got = lattice.classes(df).collect()
    assert {(r["n_links"], r["component"]) for r in got} == {(399, 0)}


def test_lattice_points_are_nearest():
    rng = np.random.RandomState(0)
    y = rng.randn(200, 8) * 2
    found = lattice.decode_e8(y)
    whole = (found == np.rint(found)).all(axis=1)
    assert (np.where(whole, found.sum(axis=1), (found - 0.5).sum(axis=1)) % 2 == 0).all()
    # covering radius of the lattice
    assert (np.linalg.norm(y - found, axis=1) <= 1 + 1e-9).all()
    steps = [rng.randint(-1, 2, 8) for _ in range(300)]
    for step in (np.array(s) for s in steps if sum(s) % 2 == 0):
        assert (np.linalg.norm(y - found - step, axis=1) >= np.linalg.norm(y - found, axis=1) - 1e-9).all()


def test_recall_at_the_threshold(spark):
    rng = np.random.RandomState(3)
    rows = []
    for k in range(400):
        u = rng.randn(48)
        u /= np.linalg.norm(u)
        v = rng.randn(48)
        v -= v @ u * u
        v /= np.linalg.norm(v)
        w = 0.9801 * u + math.sqrt(1 - 0.9801**2) * v
        rows += [(2 * k, u.tolist(), k), (2 * k + 1, w.tolist(), k)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    linked = lattice.classes(df).where(F.col("n_links") == 1).count()
    assert linked == 800


@pytest.mark.parametrize("size", [2, 3, 4, 5, 7, 8, 12, 16, 32, 64, 128])
def test_pairs_at_the_threshold_meet_at_any_length(size):
    rng = np.random.RandomState(size)
    x = rng.randn(20_000, size)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.randn(20_000, size)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    y = 0.9801 * x + np.sqrt(1 - 0.9801**2) * aside
    one = np.ones(len(x), np.int64)
    a, b = (lattice.cells(v, one).reshape(len(x), lattice.TABLES, -1) for v in (x, y))
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
    assert (~met).mean() < 1e-4


def test_short_vectors_and_labels_of_text(spark):
    rng = np.random.RandomState(4)
    rows = [(i, rng.randn(3).tolist(), "ab"[i % 2]) for i in range(400)] + [(400, [1.0, 0.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = {r["id"]: r["n_links"] for r in lattice.classes(df).collect()}
    units = np.float32([v for _, v, _ in rows]).astype(float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= lattice.COSINE
    want = {i: sum(1 for j in range(400) if j != i and near[i, j] and rows[i][2] == rows[j][2]) for i in range(400)}
    assert got == {**want, 400: 0} and sum(want.values()) > 100
