"""Mixing, sharding and the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snaptide.llm import mixing, sharding, workload

from .test_near_copies import jaccard_groups
from .test_text_operators import contaminated


def shards(rows, count):
    """Shards by the middle byte of each record in the order of text hash and id."""
    import hashlib

    keyed = []
    for i, text in rows:
        data = (text or "").encode()
        key = hashlib.md5(data).hexdigest()[:16] if text is not None else ""
        keyed.append((key, i is not None, i, len(data) + 8, None if text is None else zlib.crc32(data)))
    keyed.sort(key=lambda r: (r[0], r[1], r[2] or 0))
    total, before, out, slots = sum(r[3] for r in keyed), 0, [], collections.Counter()
    for _, _, i, size, crc in keyed:
        shard = (2 * before + size) * count // (2 * total)
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


def test_shards_equal_brute_force(spark, sf_dir, documents):
    want = shards([tuple(r) for r in documents.select("doc_id", "text").collect()], 24)
    got = workload.op6_sharding(spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got), key=repr) == want
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


@pytest.mark.parametrize("per_range", [1_000_000, 50])
def test_a_text_with_a_third_of_all_rows_is_cut(spark, monkeypatch, per_range):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", per_range)
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " + "x" * (i % 50)) for i in range(3000)]
    rows += [(3000, "y" * 5000), (3001, None), (3002, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign(df, 7).collect()
    assert sorted(map(tuple, got), key=repr) == shards(rows, 7)
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 5008


def test_shards_of_odd_rows(spark, odd, none):
    got = sharding.assign(odd, 3)
    assert sorted(map(tuple, got.collect()), key=repr) == shards([(r["doc_id"], r["text"]) for r in odd.collect()], 3)
    assert sharding.assign(none, 3).collect() == []
    assert sorted(map(tuple, sharding.assign(odd, 1).collect()), key=repr) == shards(
        [(r["doc_id"], r["text"]) for r in odd.collect()], 1
    )
    with pytest.raises(ValueError):
        sharding.assign(odd, 0)


def test_raking_meets_all_marginals():
    rng = np.random.RandomState(2)
    names = [[f"{a}{k}" for k in range(n)] for a, n in (("s", 5), ("l", 3), ("t", 4))]
    keys = [(s, lang, t) for s in names[0] for lang in names[1] for t in names[2]]
    now = rng.rand(len(keys))
    now /= now.sum()
    targets = [dict(zip(n, rng.dirichlet(np.ones(len(n)) * 3))) for n in names]
    weight = mixing.rake(keys, now, targets)
    for axis, target in enumerate(targets):
        for name, share in target.items():
            assert abs(sum(w for k, w in zip(keys, weight) if k[axis] == name) - share) < 1e-8


def test_mixed_shares_and_probabilities(spark):
    rng = np.random.RandomState(7)
    rows = [
        (i, "w " * int(rng.randint(50, 150)), ["en", "de"][int(rng.rand() < 0.3)], ["a", "b", "c"][int(rng.rand() * 3) if i % 3 else 0])
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.3, "b": 0.35}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"topic0": 1.0}}
    counted = mixing.measured(df)
    drawn = mixing.sample(counted, mixing.fit(counted, targets, 0.4), targets=targets)
    expected = drawn.groupBy("source", "lang").agg(F.sum(F.col("n_tokens") * F.col("probability") * F.col("weight")).alias("e"))
    cells = {(r["source"], r["lang"]): r["e"] for r in expected.collect()}
    total = sum(cells.values())
    share = {k: sum(v for c, v in cells.items() if k in c) / total for k in ("a", "b", "en", "de")}
    assert abs(share["en"] - 0.5) < 1e-6 and abs(share["a"] / share["b"] - 0.3 / 0.35) < 1e-6
    kept, everything = drawn.where("selected").agg(F.sum("n_tokens")).first()[0], drawn.agg(F.sum("n_tokens")).first()[0]
    assert abs(kept / everything - 0.4) < 0.03


def test_scarce_cells_reach_their_targets_in_the_sample(spark):
    # "a" holds 5 % of the tokens and is to have half of a sample of 60 %
    rows = [(i, "w " * 100, "en", "a" if i % 20 == 0 else "b") for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 1.0}, "topic": {"topic0": 1.0}}
    counted = mixing.measured(df)
    drawn = mixing.sample(counted, mixing.fit(counted, targets, 0.6), targets=targets)
    kept = {r["source"]: r["n"] for r in mixing.repeated(drawn).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert abs(kept["a"] / (kept["a"] + kept["b"]) - 0.5) < 0.02
    assert abs((kept["a"] + kept["b"]) / 800_000 - 0.6) < 0.02
    assert drawn.where("selected <> (copies > 0) or copies > 6 * 1.000001 and source = 'a'").isEmpty()


def test_columns_named_like_those_inside(spark):
    rows = [(i, "word " * 20, "en", f"src{i % 3}", "x", 2.0, 3, "y", True) for i in range(300)]
    names = "doc_id long, text string, lang string, source string, k0 string, factor double, copies int, c1 string, selected boolean"
    df = spark.createDataFrame(rows, names).withColumn("weight", F.lit(9)).withColumn("__factor", F.lit("z"))
    counted = mixing.measured(df)
    targets = mixing.production_targets(counted)
    drawn = mixing.sample(counted, mixing.fit(counted, targets), targets=targets)
    assert drawn.columns == [c for c in counted.columns if c not in ("copies", "selected", "weight")] + ["probability", "selected", "weight", "copies"]
    plain = mixing.measured(df.select("doc_id", "text", "lang", "source"))
    want = mixing.sample(plain, mixing.fit(plain, targets), targets=targets)
    keep = ["doc_id", "probability", "selected", "weight", "copies"]
    assert sorted(map(tuple, drawn.select(*keep).collect())) == sorted(map(tuple, want.select(*keep).collect()))
    assert {r["k0"] for r in drawn.collect()} == {"x"}


def test_a_limit_on_repeats_is_kept_and_what_it_leaves_open_is_shown(spark):
    rows = [(i, "w " * 100, "en", "a" if i < 2 else "b") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 1.0}, "topic": {"topic0": 1.0}}
    counted = mixing.measured(df)
    mixed = mixing.fit(counted, targets)
    free, bound = (mixing.sample(counted, mixed, targets=targets, epochs=e) for e in (None, 4))
    assert free.agg(F.max("copies")).first()[0] >= 299 and bound.agg(F.max("copies")).first()[0] == 4
    open_ = {(r["axis"], r["value"]): (r["target"], r["share"]) for r in mixing.reached(bound, targets).collect()}
    assert open_["source", "a"][0] == 0.5 and open_["source", "a"][1] < 0.02 and open_["lang", "en"] == (1.0, 1.0)
    met = {r["value"]: r["share"] for r in mixing.reached(free, targets).collect()}
    assert abs(met["a"] - 0.5) < 0.05


def test_topics_are_learned_from_the_words(spark):
    rng = np.random.RandomState(11)
    fields = [[f"{name}{i}word" for i in range(40)] for name in ("medicine", "football", "geology")]
    rows = [(i, " ".join(rng.choice(fields[i % 3], 60)), "en", "a") for i in range(300)] + [(300, "a b c", "en", "a"), (301, None, "en", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    topics = mixing.learn_topics(df, topics=3)
    assert len(topics) == 3 and topics == mixing.learn_topics(df.repartition(7), topics=3)
    found = {r["doc_id"]: r["topic"] for r in mixing.measured(df, topics).collect()}
    groups = [{found[i] for i in range(k, 300, 3)} for k in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    assert found[300] == found[301] == "topic0"


def test_the_pipeline_mixes_to_the_targets(spark, tmp_path):
    rows = [(i, f"w{i} " * 50, "en", "src0" if i % 20 == 0 else "src1") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    made = corpus_pipeline.mix_sources(spark, df, str(tmp_path))
    assert made.columns == df.columns
    # of the sources with targets only these two are here: 0.24 and 0.04
    assert abs(made.where("source = 'src0'").count() / made.count() - 0.24 / 0.28) < 0.02


def test_mixing_on_odd_rows(spark, odd, none):
    targets = mixing.production_targets()
    counted = mixing.measured(odd)
    assert counted.columns == [c for c in odd.columns if c not in ("n_tokens", "topic")] + ["n_tokens", "topic"]
    drawn = mixing.sample(counted, mixing.fit(counted, targets)).collect()
    assert len(drawn) == 14 and all(0 <= r["probability"] <= 1 and r["weight"] >= 1 for r in drawn)
    twins = [r["selected"] for r in drawn if r["doc_id"] == 10]
    assert len(twins) == 2 and len(set(twins)) == 1
    empty = mixing.measured(none)
    assert mixing.sample(empty, mixing.fit(empty, targets)).collect() == []


def test_mixing_query(spark, sf_dir, documents):
    got = workload.op9_mixing(spark, sf_dir)
    assert got.count() == documents.count()
    words = {r["doc_id"]: len(r["text"].split()) for r in documents.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == words


def plain_mix(rows, targets, budget=mixing.BUDGET, rounds=3000):
    """Expected copies of every row: the cells' tokens raked to the targets one axis after the other."""
    axes = list(targets)
    cells = collections.Counter()
    for row in rows:
        cells[tuple(row[a] if row[a] in targets[a] else "(rest)" for a in axes)] += row["n_tokens"]
    whole = sum(cells.values())
    now = {c: n / whole for c, n in cells.items() if n}
    weight = dict(now)
    wanted = []
    for k, axis in enumerate(axes):
        there = {c[k] for c in now}
        rest = sum(n for c, n in now.items() if c[k] == "(rest)")
        named = {v: targets[axis][v] for v in there if v != "(rest)"}
        wanted.append({**{v: t / sum(named.values()) * (1 - rest) for v, t in named.items()}, "(rest)": rest})
    for _ in range(rounds):
        for k in range(len(axes)):
            have = collections.Counter()
            for c, w in weight.items():
                have[c[k]] += w
            weight = {c: w * wanted[k][c[k]] / have[c[k]] if have[c[k]] else 0.0 for c, w in weight.items()}
    scale = budget / sum(weight.values())
    factor = {c: weight[c] / now[c] * scale for c in now}
    return [factor.get(tuple(row[a] if row[a] in targets[a] else "(rest)" for a in axes), 1.0) for row in rows]


def test_mixing_equals_plain_raking(spark, documents):
    counted = mixing.measured(documents).drop("text")
    targets = mixing.production_targets(counted)
    drawn = mixing.sample(counted, mixing.fit(counted, targets), targets=targets)
    rows = [r.asDict() for r in drawn.collect()]
    for row, copies in zip(rows, plain_mix(rows, targets), strict=True):
        assert row["probability"] * row["weight"] == pytest.approx(copies, rel=1e-6)
        assert row["selected"] == (row["copies"] > 0) and abs(row["copies"] - copies) < 1


def test_tempered_targets(spark):
    rows = spark.createDataFrame([("a", 900), ("b", 100), ("other", 5)], "topic string, n_tokens long")
    got = mixing.tempered(rows, "topic", ["a", "b", "c"], 0.5)
    assert got == pytest.approx({"a": 0.75, "b": 0.25, "c": 0.0})
    assert mixing.tempered(rows.limit(0), "topic", ["a", "b"]) == {"a": 0.5, "b": 0.5}


def test_pipeline_equals_brute_force(spark, sf_dir, documents):
    """Every stage against a plain version of it, on what the stage before has kept; the scores are the classifier's own."""
    docs = documents
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        made[name] = stage(spark, docs, sf_dir).cache()
        rows = [r.asDict() for r in docs.collect()]
        if name == "toxicity":
            scores = {r["doc_id"]: r["score"] for r in workload.op4_toxicity(spark, sf_dir).collect()}
            want = [r["doc_id"] for r in rows if scores[r["doc_id"]] < 0.7]
        elif name == "ngram_jaccard":
            groups = jaccard_groups([(r["doc_id"], r["text"]) for r in rows])
            want = [i for i, (_, first) in groups.items() if first == i]
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            hit = {r[0]: r[-1] for r in contaminated([(r["doc_id"], r["text"]) for r in rows], items)}
            want = [r["doc_id"] for r in rows if not hit[r["doc_id"]]]
        elif name == "mixing":
            measured = mixing.measured(docs).drop("text")
            measured_rows = [r.asDict() for r in measured.collect()]
            copies = dict(zip((r["doc_id"] for r in measured_rows), plain_mix(measured_rows, mixing.production_targets(measured)), strict=True))
            have = collections.Counter(r["doc_id"] for r in made[name].collect())
            assert all(abs(have[i] - c) < 1 for i, c in copies.items()) and set(have) <= set(copies)
            want = list(have.elements())
        else:
            got = made[name].select("doc_id", "size", "text_crc32", "shard", "slot").collect()
            assert sorted(map(tuple, got), key=repr) == shards([(r["doc_id"], r["text"]) for r in rows], corpus_pipeline.SHARDS)
            break
        assert sorted(r["doc_id"] for r in made[name].collect()) == sorted(want), name
        texts = {r["doc_id"]: r for r in rows}
        assert all(r.asDict() == texts[r["doc_id"]] for r in made[name].collect())
        docs = made[name]


def test_pipeline_stages(spark, sf_dir, documents):
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir).cache()
        counts.append(made.count())
        if name != "sharding":
            assert made.columns == documents.columns
            assert made.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
            docs = made
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0
    assert corpus_pipeline.run(spark, sf_dir).count() == counts[-1]


def test_pipeline_takes_odd_and_no_documents(spark, odd, none, tmp_path):
    for t in ("labels", "benchmark"):
        kind = {"labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}[t]
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{t}.parquet")
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, str(tmp_path))
            if name != "sharding":
                assert made.columns == docs.columns
                docs = made
        assert made.count() == docs.count()
