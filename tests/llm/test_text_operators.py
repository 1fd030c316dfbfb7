"""Language, toxicity, tokens, decontamination and page text against brute force, held-out labels and odd rows."""

import hashlib
import math
import random
import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snaptide.llm import decontam, langid, template, tokencount, toxicity, workload

from .conftest import clashing, lowered, odd_documents

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(docs, items):
    windows = {}
    for item, text in items:
        words = ITEM_WORD.findall(lowered(text))
        size = min(10, len(words))
        for k in range(len(words) - size + 1) if words and item is not None else ():
            windows.setdefault(tuple(words[k : k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words = ITEM_WORD.findall(lowered(text))
        hit, names = set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                found = windows.get(tuple(words[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_equals_brute_force(spark, sf_dir, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = contaminated([tuple(r) for r in documents.select("doc_id", "text").collect()], items)
    got = sorted((tuple(r) for r in workload.op10_decontamination(spark, sf_dir).collect()), key=repr)
    assert got == want
    assert any(r[-1] for r in got)


@pytest.mark.parametrize("block", [1 << 23, 150])
def test_decontamination_on_odd_rows_and_in_blocks(spark, odd, none, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    passage = " ".join(f"shared{i}" for i in range(12))
    items = [
        (7, passage),
        (7, "x y z"),
        (8, "One"),
        (9, None),
        (10, " .. "),
        (11, "é ñ"),
        (None, "one"),
        (12, passage.upper() + " other"),
        (13, "w1x1 w2x2"),
        (14, "12"),
    ]
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"))
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted((tuple(r) for r in decontam.digest(decontam.decontaminate(odd, bench)).collect()), key=repr)
    assert got == contaminated(docs, items)
    assert decontam.digest(decontam.decontaminate(none, bench)).collect() == []
    clean = decontam.digest(decontam.decontaminate(odd, bench.limit(0))).collect()
    assert len(clean) == len(docs) and not any(r["contaminated"] for r in clean)
    kept = decontam.decontaminate(odd, bench, keep=("text", "size", "n_chars"))
    assert kept.columns == ["doc_id", "n_words", "spans", "items", "text", "size", "n_chars"]


def test_windows_are_whole_and_at_their_place(spark):
    item = " ".join(f"q{i}" for i in range(14))
    docs = [
        (1, "a b " + " ".join(f"q{i}" for i in range(2, 12)) + " c"),
        (2, " ".join(f"q{i}" for i in range(9))),
        (3, item + " " + item),
        (4, " ".join(f"Q{i}," for i in range(4, 14))),
        (5, " ".join(f"q{i}" for i in range(9)) + " z " + " ".join(f"q{i}" for i in range(9, 14))),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: [list(s) for s in r["spans"]] for r in decontam.decontaminate(df, bench).collect()}
    assert found == {1: [[2, 12]], 2: [], 3: [[0, 28]], 4: [[0, 10]], 5: []}


def test_languages_of_held_out_documents(spark, sf_dir, documents):
    got = workload.op1_language_id(spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == documents.count()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_on_odd_rows(spark, odd, none):
    model = langid.fit(odd)
    got = {r["id"]: r for r in langid.predict(odd, model).collect()}
    for i in (1, 2, 3, 12):
        assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and not got[i]["ambiguous"]
    assert got[6]["lang_pred"] == "en"
    assert langid.predict(none, model).collect() == []
    unknown = langid.fit(none)
    assert {r["lang_pred"] for r in langid.predict(odd, unknown).collect()} == {"und"}
    one = langid.fit(odd.where("lang = 'de'"))
    assert {r["lang_pred"] for r in langid.predict(odd, one).collect()} == {"und", "de"}


def test_codewords_differ():
    for n in (2, 3, 4, 5, 6, 12, 40):
        code = langid.codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) == {-1, 1}
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= max(1, code.shape[1] // 4)


def test_many_languages_and_an_ambiguous_text(spark):
    rng = random.Random(4)
    alphabets = {f"l{k}": [chr(97 + (k * 3 + j) % 26) for j in range(7)] for k in range(8)}

    def text(lang, words):
        return " ".join("".join(rng.choice(alphabets[lang]) for _ in range(6)) for _ in range(words))

    rows = [(i, text(f"l{i % 8}", 60), f"l{i % 8}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.col("doc_id") >= 40)
    got = langid.predict(df, model).join(df.withColumnRenamed("doc_id", "id"), "id").where("id < 40")
    assert got.where("lang = lang_pred").count() >= 38
    mixed = spark.createDataFrame([(1, text("l0", 40) + " " + text("l4", 40))], "doc_id long, text string")
    clear = spark.createDataFrame([(1, text("l0", 80))], "doc_id long, text string")
    assert langid.predict(mixed, model).first()["score"] < langid.predict(clear, model).first()["score"]


def test_toxicity_of_held_out_documents(spark):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "nu") for b in ("ra", "ste", "ti", "von", "dul", "sem")]
    rows, labels = [], []
    for i in range(900):
        body = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.3
        kind = i % 3
        for _ in range(3 if toxic else 0):
            # a word, a stem with changing ends, or two harmless words side by side
            put = ["grolf"] if kind == 0 else ["zwurbel" + rng.choice(["a", "en", "ung"])] if kind == 1 else ["kera", "miste"]
            at = rng.randint(0, len(body))
            body[at:at] = put
        rows.append((i, " ".join(body)))
        if i % 4:
            labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1
    model = toxicity.fit(df, known, learn)
    got = toxicity.score(df, model).where(~learn).join(known, "doc_id").collect()
    caught = [r["score"] >= toxicity.THRESHOLD for r in got if r["toxic"]]
    blamed = [r["score"] >= toxicity.THRESHOLD for r in got if not r["toxic"]]
    assert np.mean(caught) >= 0.85 and np.mean(blamed) <= 0.02
    assert len(model.places) < 20_000


def test_toxicity_query(spark, sf_dir, documents):
    got = workload.op4_toxicity(spark, sf_dir).collect()
    assert len(got) == documents.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


def test_a_repeated_id_is_one_example_and_the_scan_is_not_in_the_training_task(spark, monkeypatch):
    rows = [(i, f"{'bad' if i % 2 else 'good'} text number {i}") for i in range(40)]
    rows += [(7, f"zzz another text {k}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    once = spark.createDataFrame(rows[:40], "doc_id long, text string")
    some, other = toxicity.fit(docs, labels), toxicity.fit(once, labels)
    assert some.bias == other.bias and np.array_equal(some.places, other.places) and np.array_equal(some.weights, other.weights)

    def packed(batches):
        from pyspark import TaskContext

        for batch in batches:
            stage = np.full(batch.num_rows, TaskContext.get().stageId(), np.int32)
            places = pa.array([s.tobytes() for s in stage], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), places], ["id", "y", "places"])

    def trained(frames):
        import pandas as pd
        from pyspark import TaskContext

        seen = [np.frombuffer(p, np.int32)[0] for frame in frames for p in frame["places"]]
        found = np.array([len(seen), TaskContext.get().stageId() in seen], np.int32)
        yield pd.DataFrame({"places": [found.tobytes()], "weights": [b""], "bias": [0.0]})

    monkeypatch.setattr(toxicity, "_pack", packed)
    monkeypatch.setattr(toxicity, "_train", trained)
    assert toxicity.fit(docs, labels).places.tolist() == [40, 0]


def test_toxicity_on_odd_rows(spark, odd, none):
    labels = [(1, 0), (2, None), (4, 1), (4, 0), (None, 1), (8, 1), (9, 0), (99, 1), (12, 7)]
    known = clashing(spark.createDataFrame(labels, "doc_id long, toxic int"))
    model = toxicity.fit(odd, known)
    got = toxicity.score(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["score"]
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert len(scores) == 13 and all(0 <= s <= 1 for s in scores.values())
    assert scores[1] == scores[2] == scores[3]
    assert toxicity.score(none, model).collect() == []
    constant = toxicity.fit(none, known)
    assert len({r["score"] for r in toxicity.score(odd, constant).collect()}) == 1
    assert len(toxicity.fit(odd, known.limit(0)).places) == 0


@pytest.fixture(scope="module")
def vocabulary():
    try:
        return tokencount.Vocabulary.read()
    except FileNotFoundError:
        pytest.skip("no vocabulary here")


def plain_ftrl(examples, alpha=1.0, beta=1.0, l1=6.0, l2=0.5, epochs=3):
    """The update rule coordinate by coordinate; coordinate -1 is the intercept, which has no penalty of the first kind."""
    z, n = {}, {}

    def weight(i):
        bound = 0.0 if i == -1 else l1
        if abs(z.get(i, 0.0)) <= bound:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * bound) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for y, at in examples:
            used = [*at, -1]
            w = {i: weight(i) for i in used}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in used:
                rate = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_training_equals_the_rule_written_out():
    rng = np.random.RandomState(8)
    # a feature of each label, and others that say nothing
    examples = [(int(y), np.unique(np.append(rng.randint(4, 60, 6), 1 + y)).astype(np.int32)) for y in rng.randint(0, 2, 200)]
    places, weights, bias = toxicity.ftrl(examples, epochs=3, bits=6)
    want = plain_ftrl([(y, at.tolist()) for y, at in examples])
    assert bias == pytest.approx(want.pop(-1))
    assert dict(zip(places.tolist(), weights.tolist(), strict=True)) == pytest.approx(want)
    # the penalty leaves the two that tell
    assert want[1] < 0 < want[2] and len(want) < 30


def test_scores_equal_the_features_written_out(spark):
    text = "You are Bad bad, really badder 12 people über"
    words = ["you", "are", "bad", "bad", "really", "badder", "people", "über"]
    whole = [toxicity._place(toxicity.Words(pa.array([w]), toxicity.LETTERS, lower=True).hashes())[0] for w in words]
    found = [(r, p) for rows, places in toxicity.features(pa.array([text])) for r, p in zip(rows.tolist(), places.tolist(), strict=True)]
    # 8 words, 7 pairs, 6 skip pairs, and stems of 5, 6 and 7 bytes of longer words
    stems = sum(len(w.encode()) > k for w in words for k in toxicity.STEMS)
    assert [p for _, p in found[:8]] == whole and len(found) == 8 + 7 + 6 + stems
    model = toxicity.Model(np.array(sorted(set(whole)), np.int32), np.ones(len(set(whole)), np.float32), -2.0)
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    present = len(set(whole)) + len({p for _, p in found[8:]} & set(whole))
    assert got[1] == pytest.approx(1 / (1 + math.exp(2 - present))) and got[2] == got[3] == pytest.approx(1 / (1 + math.exp(2)))


def plain_model(rows):
    """Odds of every bit at every place and the weights of the bits, from counts held as dictionaries."""
    counts = {}
    for lang, text in rows:
        folded = bytes(langid._FOLD[np.frombuffer(text.encode(), np.uint8)].astype(np.uint8))
        for n in langid.SIZES:
            for k in range(len(folded) - n + 1):
                if b"  " in folded[k : k + n]:
                    continue
                value = n << 8 * n | int.from_bytes(folded[k : k + n], "big")
                place = (value * 0x9E3779B97F4A7C15 % 2**64) >> (64 - langid.BITS)
                counts.setdefault(lang, {})[place] = counts.get(lang, {}).get(place, 0) + 1
    languages = sorted(counts)
    code = langid.codewords(len(languages))
    size = 1 << langid.BITS
    sums = [sum(counts[lang].values()) + 0.5 * size for lang in languages]

    def share(i, place):
        return (counts[languages[i]].get(place, 0) + 0.5) / sums[i]

    places = sorted({p for c in counts.values() for p in c})

    def odds(b, place):
        sides = [[share(i, place) for i in range(len(languages)) if code[i, b] == side] for side in (1, -1)]
        return np.log(np.mean(sides[0]) / np.mean(sides[1]))

    return languages, code, places, odds


def test_odds_equal_plain_counts(spark):
    rows = [("en", "the cat and the dog"), ("en", "a  dog, 12 cats"), ("de", "der Hund und die Katze"), ("fr", "le chien été"), ("de", "x")]
    df = spark.createDataFrame([*rows, (None, "no language"), ("es", None)], "lang string, text string").repartition(3)
    model = langid.fit(clashing(df))
    languages, code, places, odds = plain_model(rows)
    assert model.languages == languages and (model.code == code).all()
    for b in range(code.shape[1]):
        assert model.odds[b, places].tolist() == pytest.approx([odds(b, p) for p in places], rel=1e-5, abs=1e-6)
    away = next(p for p in range(1 << langid.BITS) if p not in places)
    assert model.odds[0, away] == pytest.approx(odds(0, away), rel=1e-5)
    assert model.trust.sum() == pytest.approx(1) and (model.trust > 0).all()


def test_decoding_equals_the_loss_written_out():
    rng = np.random.RandomState(3)
    model = langid.Model([f"l{i}" for i in range(9)], langid.codewords(9), np.zeros((0, 1)), rng.dirichlet(np.ones(langid.codewords(9).shape[1])))
    margin = rng.randn(50, len(model.trust)) * 3
    loss = np.log1p(np.exp(-margin[:, None, :] * model.code[None])) @ model.trust
    names, _, near = langid.decode(model, margin)
    assert names.tolist() == [f"l{i}" for i in loss.argmin(axis=1)]
    order = np.sort(loss, axis=1)
    assert (near == (order[:, 0] > langid.AMBIGUOUS * order[:, 1])).all()


def test_two_thousand_languages_are_learned_in_bounded_memory(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(4000)]
    rows = [(i, f"v{i % 2000:04}", " ".join(words[2 * (i % 2000) : 2 * (i % 2000) + 2] * 10)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(df, F.col("doc_id") < 2000)
    assert len(model.languages) == 2000 and model.odds.nbytes < 64 << 20
    got = langid.predict(df.where("doc_id >= 2000"), model).collect()
    assert np.mean([r["lang_pred"] == f"v{r['id'] - 2000:04}" for r in got]) > 0.95


def applied(text, script):
    text = text or ""
    for edit in script or ():
        if edit is not None:
            start, stop, put = edit
            start = min(max(start or 0, 0), len(text))
            stop = min(max(stop or 0, start), len(text))
            text = text[:start] + (put or "") + text[stop:]
    return text


def test_token_counts_equal_a_whole_count(spark, sf_dir, documents, vocabulary):
    encode = vocabulary.encoding().encode_ordinary
    rows = documents.select("doc_id", "text", workload.token_edits().alias("edits")).collect()
    want = {r["doc_id"]: (len(encode(r["text"])), len(encode(applied(r["text"], r["edits"])))) for r in rows}
    got = workload.op2_token_counts(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["n_edited"]) for r in got} == want
    long_ones = [r for r in got if r["n_chars"] > 10_000]
    assert all(r["reencoded"] < r["n_chars"] / 2 for r in long_ones)


@pytest.mark.parametrize("leaf", [1, 8, 64])
def test_any_edits_keep_the_count(vocabulary, leaf):
    encode = vocabulary.encoding().encode_ordinary
    rng = random.Random(leaf)
    pieces = ["the cat's", " ", "  ", "\n\n", "'re", "é", " 12", "!?", "\t", "x", " a b c", "日本", "", " don't stop now " * 9]
    pieces += ["слово и дело", "。", "「漢字」", "λόγος, ", "한국어 말", "हिन्दी", "\u0301", "²", "ª", "a" * 90, "-", "’s", "\u00a0", "مرحبا، "]
    for _ in range(40):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))
        tree = tokencount.TokenTree(text, lambda t: len(encode(t)) if t else 0, leaf)
        for _ in range(15):
            start = rng.randint(-2, len(text) + 2)
            stop = start + rng.choice([-1, 0, 1, 2, 5, 50])
            put = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 3)))
            tree.edit(start, stop, put)
            text = applied(text, [(start, stop, put)])
            assert tree.text == text and tree.length == len(text)
            assert tree.tokens == len(encode(text))


@pytest.mark.parametrize("unit", ["слово и дело без конца, ", "これは長い文章です。漢字かな交じり、", "λόγος και έργο ", "한국어 말과 글은 ", "ordinary words here "])
def test_an_edit_encodes_little_in_any_script(vocabulary, unit):
    encode = vocabulary.encoding().encode_ordinary
    text = unit * (20_000 // len(unit))
    tree = tokencount.TokenTree(text, lambda t: len(encode(t)) if t else 0)
    for at in (5, 7_777, 12_345, 19_000):
        tree.edit(at, at + 3, unit[:7])
        text = applied(text, [(at, at + 3, unit[:7])])
    assert tree.text == text and tree.tokens == len(encode(text))
    assert tree.encoded < 8_000


def test_token_counts_on_odd_rows(odd, none, vocabulary):
    script = F.expr("array(named_struct('start', 0, 'stop', cast(null as int), 'put', cast(null as string)), null)")
    got = tokencount.counted(odd, script, vocabulary).collect()
    assert len(got) == 14 and all(r["n_tokens"] == r["n_edited"] for r in got)
    none_at_all = F.expr("cast(null as array<struct<start: int, stop: int, put: string>>)")
    assert {r["n_tokens"] for r in tokencount.counted(odd, none_at_all, vocabulary).collect() if r["id"] in (1, 2)} == {0}
    assert tokencount.counted(none, script, vocabulary).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Menu</li></ul></nav><div class="ad">Buy</div>
<div id="cookie-notice">We use</div><div class="sidebar-left"><p>Side</p></div>
<article><header><h1>Head &amp; more</h1></header><p>One <b>two<br>three</b>
  four<p>Five<script>var a="</p>";</script> six<!-- no --><ul><li>i<li>j</ul>
<div class="share">Share</div>{own}</article>
<section id="comments"><article class="comment"><p>First!</p></article></section>
<form><p>Search</p></form><footer>&copy; us</footer></body></html>"""


def test_page_text():
    page = template.Page(PAGE.format(own="<p>caf&eacute;&nbsp;x &#8211; y</p>"), "h")
    assert page.text() == "Head & more\n\nOne two three four\n\nFive six\n\ni\n\nj\n\ncafé x – y"
    assert template.Page("<div role='main'><p>m</p></div><p>other", "h").text() == "m"
    assert template.Page("a < b <p>unclosed <!-- rest", "h").text() == "a < b\n\nunclosed"
    assert template.Page("<td>1<td title='>'>2</td></tr>", "h").text() == "1\n\n2"


def test_host():
    urls = {"http://A.example:80/x": "a.example", "//b.example?q": "b.example", "x/y": "", None: "", "ftp://u@c.d": "c.d"}
    assert {u: template.host_of(u) for u in urls} == urls


def test_site_templates_go_and_copies_stay(spark):
    box = "<div class='x1'><p>About this site</p><p>Imprint</p></div>"
    rows = [(i, f"http://s.example/{i}", f"<body>{box}<div><p>text {i}</p></div></body>") for i in range(12)]
    # one article under many addresses is no template
    rows += [(100 + i, f"http://s.example/c{i}", "<body><p>copied</p><p>twice</p></body>") for i in range(30)]
    # the same box on another host, too seldom there
    rows += [(200, "http://t.example/", f"<body>{box}<p>own</p></body>")]
    # prose of an article that a third of the others quote
    rows += [(300 + i, f"http://u.example/{i}", f"<article>{'<p>quoted</p>' * (i < 12)}<p>{i}</p></article>") for i in range(36)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["id"]: r["text"] for r in template.extract(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"text {i}" for i in range(12))
    assert all(got[100 + i] == "copied\n\ntwice" for i in range(30))
    assert got[200] == "About this site\n\nImprint\n\nown"
    assert all(got[300 + i] == "quoted\n\n" * (i < 12) + str(i) for i in range(36))


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_many_blocks_of_a_benchmark_probe_once_each(spark, documents, sf_dir, monkeypatch):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = sorted(map(tuple, decontam.digest(decontam.decontaminate(documents, bench)).collect()))
    size = bench.selectExpr("sum(octet_length(text))").first()[0]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", -(-2 * size // 7))
    counted, plain = [], decontam._counts
    monkeypatch.setattr(decontam, "_counts", lambda texts, index: counted.append(python_steps(texts)) or plain(texts, index))
    found = decontam.decontaminate(documents, bench)
    # each block counts the texts themselves, and the last stage holds the probes since the last write
    assert counted == [0] * 7
    assert python_steps(found) == 7 - decontam.STEPS
    assert sorted(map(tuple, decontam.digest(found).collect())) == want


def extracted(spark, pages):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in template.extract(df).orderBy("id").collect()]


@pytest.mark.parametrize("size", [50, 800, 1500])
def test_a_box_of_forty_pages_goes_at_any_size_of_the_host(spark, size):
    box = "<div class='q7'>From our partners: <b>buy now</b></div>"
    pages = [("h", f"<article><p>own {i}</p>{box * (i < 40)}<p>more {i}</p></article>") for i in range(size)]
    assert extracted(spark, pages) == [f"own {i}\n\nmore {i}" for i in range(size)]


def test_prose_that_the_whole_site_has_is_its_template(spark):
    more = "<p>Subscribe to our letter today</p><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul>"
    title = "<h1>The same title</h1>"
    pages = [("h", f"<article>{title}<p>own {i}</p><table><tr><td>Total</td><td>{i}</td></tr></table>{more}</article>") for i in range(50)]
    want = [f"The same title\n\nown {i}\n\nTotal\n\n{i}" for i in range(50)]
    # too few pages to tell
    pages += [("small", f"<article><p>own {i}</p>{more}</article>") for i in range(4)]
    want += [f"own {i}\n\nSubscribe to our letter today\n\nOne\n\nTwo" for i in range(4)]
    assert extracted(spark, pages) == want


ARTICLE = "<article><h1>Title</h1><p>The text of the article, first part.</p><p>And the second part.</p></article>"
WHOLE = "Title\n\nThe text of the article, first part.\n\nAnd the second part."


@pytest.mark.parametrize(
    "html, want",
    [
        (f'<div class="layout sidebar-left">{ARTICLE}</div>', WHOLE),
        (f'<main class="content ad-free">{ARTICLE}</main>', WHOLE),
        (f'<form id="aspnetForm" class="search form"><nav>menu</nav>{ARTICLE}<input></form>', WHOLE),
        (f'<div id="header-wrapper"><div id="nav">menu</div>{ARTICLE}</div><div class="site-footer">foot</div>', WHOLE),
        (f"<nav>never closed <a href=/>home</a>{ARTICLE}", WHOLE),
        (ARTICLE.replace("<p>And", '<p id="share-prices">And').replace("<article", '<article class="post has-sidebar"'), WHOLE),
        (ARTICLE.replace("<p>And", '<div class="notice box">We use cookies</div><p class="ad">Buy</p><form>Mail <input></form><p>And'), WHOLE),
        (ARTICLE.replace("</article>", '<section id="comments"><p>I say: no</p></section></article><div class="comment-list">me too</div>'), WHOLE),
        (f'{ARTICLE}<div class="related-posts"><article>Card one</article><article>Card two</article></div>', WHOLE),
        ('<main><p>A long text that is the page itself, and more of it.</p></main><div class="related"><article>Card</article></div>',
         "A long text that is the page itself, and more of it."),
        ('<main><p>A long text that is the page itself, and more.</p><article>Card</article></main>', "A long text that is the page itself, and more.\n\nCard"),
        ("<form><p>No article, all in one form of the page.</p><select><option>x</select></form><footer>foot</footer>", "No article, all in one form of the page."),
        ('<p>Short.</p><div class="comments">Comments of readers, longer than the text itself.</div>', "Short."),
        (f"<header><h2>Site</h2></header>{ARTICLE.replace('<h1>Title</h1>', '<header><h1>Title</h1></header>')}", WHOLE),
        (f'{ARTICLE}<div style="display:none">{ARTICLE}</div><div hidden>x</div><template>{ARTICLE}</template>', WHOLE),
    ],
)
def test_whole_texts_of_pages(html, want):
    assert template.Page(f"<!DOCTYPE html><html><head><title>t</title></head><body>{html}</body></html>", "h").text() == want


def plain_article(html):
    """Blocks of an article that holds titles, paragraphs and marked words only."""
    article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
    blocks = [" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_pages_equal_their_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: r for r in workload.op8_html_extraction(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for page in pages:
        assert got[page["page_id"]]["text"] == plain_article(page["html"])
        assert got[page["page_id"]]["n_chars"] == len(got[page["page_id"]]["text"])


def test_odd_pages(spark):
    long_page = "<p>" + "word <i>x</i> " * 40_000
    rows = [(1, None, "<p>a"), (2, "http://h/", None), (3, "", ""), (4, "http://h/", long_page), (None, "http://h/", "<p>b"), (1, None, "<p>a")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS id", "2 AS text", "3 AS page_key")
    got = sorted((tuple(r) for r in template.extract(df).collect()), key=repr)
    assert [r[0] for r in got].count(1) == 2 and len(got) == 6
    by_id = {r[0]: r for r in got}
    assert by_id[1][2:] == ("a", 1) and by_id[2][2:] == ("", 0) and by_id[3][2:] == ("", 0) and by_id[None][2] == "b"
    assert by_id[4][3] == 40_000 * 7 - 1
    assert template.extract(df.limit(0)).collect() == []


def test_documents_with_odd_rows_have_defined_schema(spark):
    assert odd_documents(spark).count() == 14
