"""The ten operators on small fixtures: nulls, empty and long texts, ties, repeats, clashing names."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gapwise.llm import hosts, pii, quality, toxicity
from gapwise.llm.components import components
from gapwise.llm.mixing import mix
from gapwise.llm.near_text import near_duplicates
from gapwise.llm.near_vectors import near_vectors
from gapwise.llm.packing import WordTokens, nonnegative_least_squares, pack, plan, slots
from gapwise.llm.pages import extract, page_text
from gapwise.llm.repeats import repeated_passages
from gapwise.scratch import Scratch

from . import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def texts():
    """(id, text): copies near and exact, blanks, one word, nulls, a long text, a repeated row."""
    rng = random.Random(5)
    base = [words(rng, n) for n in (60, 120, 300)]
    rows = [(k, words(rng, rng.randrange(5, 80))) for k in range(40)]
    rows += [(100 + k, edited(rng, base[k % 3], 0.01 * (k % 9))) for k in range(90)]
    rows += [(300, base[0]), (301, base[0].upper()), (302, ""), (303, None), (304, " \n\t"), (305, "one"), (306, "One"), (307, words(rng, 40_000, 10**6))]
    return rows + [rows[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Extra columns bear the names the operators use inside."""
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    return df.withColumns({c: F.lit("x") for c in ("id", "key", "size", "part", "row", "source", "signature", "h", "term")})


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_text(docs, texts, shingle):
    got = near_duplicates(docs, shingle=shingle).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(tuple(r)[:3] for r in got) == brute.near_text(texts, shingle)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_text_without_rows_or_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    rows = near_duplicates(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c")], "doc_id long, text string"), shingle=2)
    assert sorted(map(str, (tuple(r) for r in rows.collect()))) == sorted(map(str, [(None, 2, None, True), (None, 2, None, True), (1, 2, 1, True)]))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    found = dict(components(spark.createDataFrame(links, "u long, v long"), Scratch(spark)).collect())
    root = brute.groups(500, links)
    assert [found.get(k, k) for k in range(500)] == root


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 16))
    rows = [(k, [float(x) for x in base[k % 20] + rng.normal(size=16) * 0.08 * (k % 5)]) for k in range(120)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, [2 * x for x in rows[0][1]]), (203, None), (204, [0.0] * 16), (205, []), (206, [1.0, None]), (207, [float("nan")] * 16), (208, [float("inf")] + [1.0] * 15), (209, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "vector": F.lit(2)})
    for block in (512, 7):
        got = near_vectors(df, block=block).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute.near_vectors(rows)


HARD = [
    "a@b.c_d@e.ff x@y @ a.b@c-d.e.f.", "1.2.3.4.5.6.7.8 001.02.3.255 256.1.1.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000 12345678901234567890",
    "+1 (988) 555-2485) +49 30 1 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 ++4912345678.", "é😀 a@b.co 😀 +123456789 é", "", None, "x" * 5000 + "@y.z a%@b.c@d.e", "1.1.1.1@b.c",
    "5  4111111111111111 4 4111111111111111", "1 " * 3000, "9" * 5000 + ".1.1.1",
]


def test_base_findings(spark):
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    none = spark.createDataFrame([], "term string, action string")
    got = pii.findings(df, none).select("doc_id", pii.written(F.col("base")).alias("base"), pii.written(F.col("found")).alias("found")).collect()
    assert {r.doc_id: r.base for r in got} == {k: brute.personal(t) for k, t in enumerate(HARD)}
    assert all(r.base == r.found for r in got)


def test_disclosing_terms(spark):
    """A name that stands beside one address only is found and removed elsewhere too; common words stay."""
    rng = random.Random(1)
    common = [f"common{k}" for k in range(30)]
    fill = lambda: " ".join(rng.choice(common) for _ in range(12))
    rows = [(k, f"{fill()} Ulrike writes from u.m@example.com today {fill()} n{k}") for k in range(20)]
    rows += [(100 + k, f"{fill()} write to a{k}@example.org {fill()}") for k in range(40)] + [(200, "Then ulrike, and Ulrikes, came."), (201, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = pii.disclosing_terms(df, least_bits=1.0)
    found = {r.term: r.action for r in terms.collect()}
    assert found["ulrike"] == "remove" and not set(common) & set(found)
    clean = {r.doc_id: r.text for r in pii.sanitised(df, terms).collect()}
    assert clean[200] == "Then , and Ulrikes, came." and clean[201] is None
    assert "[EMAIL]" in clean[0] and "@" not in clean[0] and "Ulrike " not in clean[0]
    spans = {r.doc_id: pii_text for r in pii.findings(df, terms).select("doc_id", pii.written(F.col("found")).alias("w")).collect() for pii_text in [r.w]}
    assert spans[200] == "term:5:11"


def test_disclosing_terms_of_rare_and_frequent_entities(spark):
    """With the registered parameters: values of one or two texts, groups and kinds, values of most texts, short names."""
    rng = random.Random(2)
    common = [f"common{k}" for k in range(30)]
    fill = lambda: " ".join(rng.choice(common) for _ in range(12))
    rows = [f"{fill()} n{k}" for k in range(300)]
    rows += [f"{fill()} Single one@a.example {fill()}", *[f"{fill()} Double two@b.example {fill()} d{k}" for k in range(2)]]
    rows += [f"{fill()} Domainal d{k}@firm.example {fill()}" for k in range(4)] + [f"{fill()} +1 (212) 555-{1000 + k} Prefixal {fill()}" for k in range(4)]
    rows += [f"{fill()} Kindly 10.{k}.2.3 or {k}@k{k}.example {fill()}" for k in range(5)] + [f"{fill()} Li l@x.example {fill()} l{k}" for k in range(4)]
    rows += [f"{fill()} email e{k}@e{k}.example {fill()}" for k in range(6)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    terms = pii.disclosing_terms(df)
    found = {r.term: r.action for r in terms.collect()}
    want = {"single": "generalise", "double": "generalise", "domainal": "remove", "prefixal": "remove", "kindly": "remove", "li": "remove", "email": "remove"}
    assert want.items() <= found.items() and not set(common) & set(found)
    clean = [r.text for r in pii.sanitised(df, terms).collect()]
    assert sum("[EMAIL]" in t for t in clean) == 1 + 2 + 4 + 5 + 4 + 6 and not any(w in t for t in clean for w in ("Single", "Double", "Li ", "[]", "[["))
    often = [f"{fill()} Often o@x.example {fill()} o{k}" for k in range(60)] + [f"{fill()} p{k}" for k in range(60)]
    terms = pii.disclosing_terms(spark.createDataFrame(list(enumerate(often)), "doc_id long, text string"))
    assert [(r.term, r.action) for r in terms.collect()] == [("often", "remove")]


def test_repeats(spark):
    rng = random.Random(3)
    a = "".join(rng.choice("abcdefgh \n") for _ in range(3000))
    b = "".join(rng.choice("abé😀 ") for _ in range(500))
    rows = [(1, a), (2, a[100:400] + "xx" + a[900:1500]), (3, None), (4, ""), (5, "a" * 700), (6, "ab" * 400 + a[5:300]), (7, b), (8, b + b[:100]), (9, b), (10, "q" + "a" * 260)]
    rows += [(11, a[:199]), (12, "\n".join([a[:210]] * 5)), (13, "z" * 200), (14, "y" * 199), (9, b), (15, a[2500:] + a[:600])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"row": F.lit(1), "whole": F.lit(2), "id": F.lit(3)})
    for length, gram in ((200, 32), (40, 8)):
        got = repeated_passages(df, length=length, gram=gram).drop("spans").collect()
        assert sorted(map(tuple, got)) == brute.repeats(rows, length)


def test_quality_counts(spark, texts):
    extra = [None, "", "  \n \n", " a\n a\n", "a b c d e f g h " * 5, "é😀|#é\x0b\x85x a\n\x0b\n\x0b", "a\r\nb\na\r\n", "x" * (3 << 20)]
    for t in [t for _, t in texts] + extra:
        assert quality.text_counts(t)[:5] == brute.quality_counts(t)


def test_quality_rules(spark):
    """Rules learned from labels find what makes rows bad, and emit it as an expression."""
    rng = random.Random(9)
    rows = []
    for k in range(600):
        bad = k % 6 == 0
        text = " ".join(("##" if bad and rng.random() < 0.4 else f"word{rng.randrange(50)}") for _ in range(60))
        rows.append((k, text, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    counts = quality.with_counts(df).join(df.select(F.col("doc_id").alias("id"), "quality"), "id")
    rules = quality.fit(counts)
    assert rules and all(t.feature in quality.FEATURES for rule in rules for t in rule)
    kept, name = quality.verdict(rules)
    out = counts.select("quality", kept.alias("kept"), name.alias("rule")).collect()
    assert sum(r.kept != (r.quality == 1) for r in out) <= 6
    assert all((r.rule is None) == r.kept for r in out)
    assert quality.fit(counts.filter("quality = 1")) == []


def test_toxicity(spark):
    """Held-out accuracy, offending sentences, and what has no words."""
    rng = random.Random(8)
    rows = []
    for k in range(500):
        sentences = [" ".join(f"w{rng.randrange(200)}" for _ in range(8)) for _ in range(6)]
        if toxic := k % 4 == 0:
            sentences[rng.randrange(6)] += rng.choice([" vile", " foul", " grimabc", " grimxyz"])
        rows.append((k, ". ".join(sentences) + ".", int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.filter("doc_id < 400").select("doc_id", "toxic"))
    out = {r.doc_id: r.toxicity for r in toxicity.scored(df, model).collect()}
    assert sum((out[k].score >= 0.5) != (k % 4 == 0) for k in range(400, 500)) <= 3
    hit = next(k for k in range(400, 500, 4) if out[k].score >= 0.5)
    span = out[hit].offending[0]
    assert any(w in rows[hit][1][span.start : span.end] for w in ("vile", "foul", "grim"))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "W5 w6 " * 50_000)], "doc_id long, text string")
    assert [r.toxicity.score for r in toxicity.scored(odd, model).orderBy("doc_id").collect()][:3] == [0.0] * 3
    assert toxicity.fit(df, df.filter("toxic = 0")).weights == {}


def test_hosts(spark):
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    urls = [
        (None, "", "", None), ("x", "", "", None), ("http://", "", "", None), ("HTTP://A.Example.NET/en/x?q#z", "a.example.net", "/en/x", "example.net/en/"), ("https://net", "net", "", None),
        ("http://net/", "net", "/", "net/"), ("http://a.org/fr/", "a.org", "/fr/", "org/fr/"), ("http://a.example.net?x", "a.example.net", "", None), ("a://b://c/d", "b:", "//c/d", None), ("http://xexample.net/en/", "xexample.net", "/en/", "net/"),
    ]
    df = spark.createDataFrame([(k, u[0]) for k, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = hosts.judge(df, none, rules).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in got] == [u[1:] for u in urls]
    assert [r.verdict for r in got if r.rule is None] == ["allow"] * 6
    pages = [(k, f"http://{'bad' if k % 3 == 0 else 'good'}{k % 2}.example.com/en/{k}") for k in range(300)] + [(900, "http://new.example.com/")]
    labels = [(k, int(k % 3 != 0 or k % 30 == 0)) for k in range(300)]
    out = hosts.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int"), rules).collect()
    assert {(r.host, r.verdict) for r in out} == {("bad0.example.com", "block"), ("bad1.example.com", "block"), ("good0.example.com", "allow"), ("good1.example.com", "allow"), ("new.example.com", "allow")}


def test_mixing(spark):
    rng = random.Random(6)
    sources = ["a"] * 400 + ["b"] * 60 + ["c"] * 30 + [None] * 20 + ["d"] * 5
    rows = [(k, words(rng, rng.randrange(1, 60)), s) for k, s in enumerate(sources)] + [(900, None, "a"), (901, "", "e"), (902, "x y", "b"), (902, "x y", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).withColumn("place", F.lit(1))
    documents, placements = mix(df, shard_words=1000, block_docs=8)
    out = documents.collect()
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(brute.WORD.findall(text or ""))
    order = sorted(k for k in size if k is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full = {s for s in order if size[s] == 0}
    while True:
        share = (sum(size.values()) - sum(3 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        new = {s for s in order if s not in full and share * weight[s] > 3 * size[s]}
        if not new:
            break
        full |= new
    target = {s: 3 * size[s] if s in full else share * weight[s] for s in order}
    for s in order:
        own = [r for r in out if r.source == s]
        assert all(r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 30  # about half a document
    assert len(out) == len(rows) and all(r.taken <= 3 * r.size and r.taken == r.repeats * r.size for r in out)
    placed = placements.collect()
    assert len({r.shard for r in placed}) > 5 and sum(r.size for r in placed) == sum(r.taken for r in out)
    again = mix(df.repartition(5), shard_words=1000, block_docs=8)[1].collect()
    assert sorted(map(str, placed)) == sorted(map(str, again))
    assert mix(df.limit(0))[0].collect() == []


def test_mixing_with_very_long_documents(spark):
    """Wherever the long documents lie in hash order, no document that is left out still fits."""
    long = "x " * 60_000
    rows = [(k, "x " * 250, f"s{k % 4}") for k in range(8000)] + [(9000 + k, long, f"s{k % 4}") for k in range(16)]
    rows += [(10_000 + k, "x " * (k % 7 + 1), "s2") for k in range(50)] + [(11_000 + k, "x", None) for k in range(5)]
    for weights in ((5, 2, 1), (1, 2, 5, 9)):
        out = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=weights)[0].collect()
        for s in {r.source for r in out}:
            own = [r for r in out if r.source == s]
            left = own[0].target - sum(r.taken for r in own)
            least = min(r.repeats for r in own)
            assert -1e-6 <= left < min((r.size for r in own if r.repeats == least), default=1), s


def test_packing(spark, texts):
    rows = [*texts, (400, "<|endoftext|> ΑΣ. İ e\u0301 ́x 中文。 ½ it's 'LL")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"id": F.lit(1), "length": F.lit(2), "offset": F.lit(3)})
    out = pack(df, PATH, size=512, grain=16).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for i, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k // 512, k, len(ids[k : k + 512]), zlib.crc32(ids[k : k + 512].tobytes())) for k in range(0, len(ids), 512)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    held = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == held.get(r.sequence_id, 0)
        held[r.sequence_id] = r.offset + r.length
    assert max(held.values()) <= 512 and len(held) <= 1.05 * -(-sum(held.values()) // 512) + 1
    assert pack(df.limit(0), PATH).collect() == []


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    for _ in range(20):
        histogram = {rng.randrange(1, 257): rng.randrange(1, 500) for _ in range(60)}
        filled = plan(histogram, 256, 8, 3)
        used = {}
        for held, n in filled:
            assert sum(length * each for length, each in held) <= 256
            for length, each in held:
                used[length] = used.get(length, 0) + n * each
        assert used == histogram
        for length, rows in slots(filled).items():
            assert (np.diff(rows[:, 0]) > 0).all() and rows[0, 0] == 0 and rows[-1, 0] < histogram[length]


def test_nonnegative_least_squares():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.normal(size=(12, 30)), rng.normal(size=12)
        x = nonnegative_least_squares(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-4 and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-4


def test_word_tokens_equal_the_tokenizer():
    own, whole = WordTokens(PATH), Tokenizer.from_file(PATH)
    odd = ["a\x1cb  c̈ ̈d", "ΑΣ Σ ΑΣΒ it's 'LL I'm ΑΣ. ß. ẞ", "<|endoftext|> x<|startoftext|>y", "", "\u3000a\u00a0b\x85c", "İstanbul ẞ 12345 ½ ² ²a", "\n\n a \t b\rc", "가 ᄀ ᅡ각", ". .. ,a a,, 中文. ﬁ ŉ ǅ", "ªº ⅷ ①"]
    for text in odd:
        assert np.frombuffer(own.of([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


PAGES = {
    "<p>a<p>b <b>c</b>d<div>x</div>y": "a\n\nb cd\n\nx\ny",
    "<ul><li>one<li>two<ul><li>in</ul><li>three</ul>z": "- one\n- two\n  - in\n- three\n\nz",
    "<ol start=3><li>a<li>b</ol>": "3. a\n4. b",
    "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>after": "a    | bbb\ncccc | d\n\nafter",
    "<div hidden>no</div><span style='display: none'>no</span>yes<script>var t='</p>';</script><!-- c --> &amp; 1 < 2": "yes & 1 < 2",
    "<pre> a\n  b\n</pre>t": " a\n  b\n\nt",
    "<details><summary>S</summary>no</details>k": "S\nk",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<head><title>t</title></head><body>x": "x",
    '<a "<a': '<a "<a',
    "<head><title>t</title><p>hello": "hello",
    "<html><head><meta charset=x><div>a</div><h1>b</h1>": "a\n\nb",
    "<head><style>s</style>bare <b>text</b>": "bare text",
    "<head><template><p>no</p></template><noscript><img><p>no</noscript><link><table><tr><td>x": "x",
    "<head>\n<title>t</title>\n<body>x": "x",
    "<p>a <svg><title>no</title><defs><text>no</text></defs><text>in</text></svg>": "a\nin",
    "<select><option>one<option selected>two</select>": "one\ntwo",
    "a<span style='visibility: hidden'>no<b style='visibility:visible'>yes</b>no</span>b": "ayesb",
    "a<div style='visibility:hidden'>no<b>no</b></div>b": "ab",
    "x <b>y</b> z\n<i> w</i>": "x y z w",
}


@pytest.mark.parametrize("html", PAGES)
def test_page_text(html):
    assert page_text(html) == PAGES[html]


def test_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p>a"), (3, "<p>a"), (4, "<div>" * 20_000 + "deep"), (None, "<b>x")]
    out = extract(spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in out) == sorted([("1", "", 0), ("2", "", 0), ("3", "a", 1), ("3", "a", 1), ("4", "deep", 4), ("None", "x", 1)])


def test_pipeline_stages(spark, texts, tmp_path):
    """Every stage on what the one before kept, against its plain version."""
    rng = random.Random(4)
    rows = [(i, f"{t} x{i}@example.com" if t and i % 7 == 0 else t, "en", f"s{i % 3}", len(t) if t else None) for i, t in texts if i != 307]
    for k in range(1000, 1200):
        bad = k % 5 == 0
        rows.append((k, words(rng, 30, 10**6) + (" vile foul grim" if bad else "") + ".", "en", "s1", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(1000, 1200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    first = [tuple(r) for r in stages["toxicity"](spark, docs, sf).collect()]
    assert {r[0] for r in first} == {r[0] for r in rows if not (r[0] >= 1000 and r[0] % 5 == 0)}
    kept = stages["near_duplicates"](spark, spark.createDataFrame(first, docs.schema), sf)
    second = [tuple(r) for r in kept.collect()]
    want = {i for i, _, c in brute.near_text([(r[0], r[1]) for r in first], 5) if i == c}
    assert kept.columns == corpus_pipeline.COLUMNS and {r[0] for r in second} == want
    third = stages["personal_data"](spark, spark.createDataFrame(second, docs.schema), sf).collect()
    assert {r.doc_id for r in third} == want and not any("@" in (r.text or "") for r in third)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in third)
    fourth = stages["mixing"](spark, spark.createDataFrame(third, docs.schema), sf)
    times = {r.doc_id: r["count"] for r in fourth.groupBy("doc_id").count().collect()}
    assert set(times) <= want and max(times.values()) <= 3 * 2
    fifth = stages["packing"](spark, fourth, sf)
    assert fifth.filter("piece = 0").count() == sum(times.values())
    assert corpus_pipeline.run(spark, sf).count() == fifth.count()
