"""Each operator against brute force, and on odd and empty tables."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.llm import decontaminate, html_extraction, language_id, lsh_forest, packing, quality_rules, sharding, token_counts, toxicity
from featherline.llm.encode import default_path, encoder

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(default_path())


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def prose(seed, n, words=40):
    r = random.Random(seed)
    return [" ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(r.randrange(60)) for _ in range(words)) for _ in range(n)]


# encoding, packing, token counts


@pytest.mark.parametrize("text", ["", "a", "  a  b \n\n c", "it's we'll 'tis don'", "x\xa0y\x85z ²³¼ 12a", "日本語 テスト 🙂🙂", "<|endoftext|> hi", "a b　c\x1c\x1d d", " " * 99 + "x", "\x1c\x1f a", "é ̀x ⅷ٣", "tab\tx \r\n y  ", "word " * 300])
def test_encoder_matches_library(reference, text):
    assert encoder(default_path()).ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_encoder_matches_library_on_documents(spark, small, reference):
    for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect():
        assert encoder(default_path()).ids(r.text).tolist() == reference.encode(r.text, add_special_tokens=False).ids


def brute_cuts(pos, pen, size, each):
    f = [0.0] + [float("inf")] * (len(pos) - 1)
    for j in range(1, len(pos)):
        for i in range(j):
            n = pos[j] - pos[i]
            if n <= size:
                f[j] = min(f[j], f[i] + pen[j] + each + (0 if n & (n - 1) == 0 else size - n))
    return f[-1]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_optimal(seed):
    r = np.random.default_rng(seed)
    pos = np.concatenate([[0], np.cumsum(r.integers(1, 9, 60))])
    pen = r.choice([0.0, 2.0, 5.0], len(pos))
    cuts = packing.best_cuts(pos, pen, 32, each=1.0)
    cost = sum((0 if (n := int(pos[b] - pos[a])) & (n - 1) == 0 else 32 - n) + pen[b] + 1.0 for a, b in zip(cuts, cuts[1:]))
    assert cuts[0] == 0 and cuts[-1] == len(pos) - 1 and all(0 < pos[b] - pos[a] <= 32 for a, b in zip(cuts, cuts[1:]))
    assert cost == pytest.approx(brute_cuts(pos.tolist(), pen.tolist(), 32, 1.0))


def check_packing(table, pieces, reference):
    want = Counter()
    for r in table.collect():
        ids = reference.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id, np.array(ids, "<u4").tobytes()] += 1
    by_seq = defaultdict(list)
    for p in pieces:
        by_seq[p.sequence_id].append(p)
        assert p.length == len(p.ids) and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        assert sum(p.length for p in ps) <= 1024 and [p.offset for p in ps] == [sum(q.length for q in ps[:i]) for i in range(len(ps))]
    got, held = Counter(), defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        held[p.doc_id].append(p)
    for key, ps in held.items():
        while ps:
            ids, total = [], ps[0].doc_tokens
            while len(ids) < total:
                p = ps.pop(0)
                assert p.start == len(ids)
                ids += p.ids
            got[key, np.array(ids, "<u4").tobytes()] += 1
    assert got == want


def test_packing_keeps_every_id(spark, small, odd, none, reference):
    assert packing.pack(none).count() == 0
    check_packing(odd, packing.pack(odd.coalesce(1), block=1 << 12).collect(), reference)
    table = spark.read.parquet(f"{small}/documents.parquet")
    pieces = packing.pack(table, block=1 << 14).collect()
    check_packing(table, pieces, reference)
    n = Counter()
    for p in pieces:
        n[p.sequence_id] += p.length
    assert sum(1024 - x for x in n.values() if x & (x - 1)) < 0.03 * sum(n.values())


def test_token_counts(odd, none, reference):
    h = token_counts.suffix_sums(token_counts.encoded_lengths(odd), block=16)
    lengths = [len(reference.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect()]
    for r in h.collect():
        over = [x for x in lengths if x > r.length]
        assert (r.n_docs, r.docs_over, r.tokens_over, r.tokens_total) == (lengths.count(r.length), len(over), sum(over), sum(lengths))
        assert r.truncated_total == sum(min(x, r.length) for x in lengths) and r.docs_rank == len(lengths) - len(over)
    for limit in (0, 3, 17, 10**6):
        assert token_counts.truncated_total(h, limit) == sum(min(x, limit) for x in lengths)
    assert token_counts.quantile(h, 0.5) == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    e = token_counts.suffix_sums(token_counts.encoded_lengths(none))
    assert e.count() == 0 and token_counts.truncated_total(e, 5) == 0 and token_counts.quantile(e, 0.5) is None


# decontamination


def brute_contamination(texts, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add(i)
    out = []
    for key, t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if s := windows.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    found |= s
        out.append((key, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


def test_contamination(spark, odd, none):
    r = random.Random(5)
    vocabulary = [f"v{i}" for i in range(12)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([3, 5, 6, 9, 10, 11, 15, 30, 40, 60])] + [(100, None), (101, ""), (102, "One, TWO three"), (10, say(25))]
    texts = [(i, say(30) + " " + items[i % 10][1].upper() + ", " + " ".join(items[(i + 3) % 10][1].split()[2:14]) + " " + say(30)) for i in range(60)]
    it = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(texts, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = sorted(((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in decontaminate.contamination(table, it).collect()), key=str)
    assert got == brute_contamination([(x.doc_id, x.text) for x in table.collect()], items)
    assert decontaminate.contamination(none, it).count() == 0 and not decontaminate.contamination(odd, it.limit(0)).filter("contaminated").take(1)
    kept = decontaminate.keep_uncontaminated(odd, it)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3


def test_contamination_without_sent_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_SENT", 0)
    items, texts = [(i, t) for i, t in enumerate(prose(1, 5, 20))], [(i, t + " " + u) for i, (t, u) in enumerate(zip(prose(2, 5), prose(1, 5, 20)))]
    got = decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got.collect()), key=str) == brute_contamination(texts, items)


def test_uncontaminated_rows_may_have_any_names(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    rows = [(1, "One two three four five six seven eight nine ten!", "a", 1), (2, "clean", "b", 2), (3, None, "c", 3), (2, "clean", "b", 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _text_hash string, _hash_ int")
    kept = decontaminate.keep_uncontaminated(table, items)
    assert kept.columns == table.columns and sorted(map(tuple, kept.collect())) == [rows[1], rows[1], rows[2]]
    assert decontaminate.keep_uncontaminated(table, items.limit(0)).count() == 4 and decontaminate.keep_uncontaminated(table.limit(0), items).count() == 0


def test_winnowing_guarantee():
    r = np.random.default_rng(3)
    g = r.integers(0, 50, 400).astype(np.uint64)
    at = set(decontaminate.winnow(g, 5).tolist())
    assert all(at & set(range(i, i + 5)) for i in range(396))


# language, toxicity, quality


def test_language(spark, small, odd, none):
    t = spark.read.parquet(f"{small}/documents.parquet")
    model = language_id.fit(t.filter("doc_id % 4 <> 2"))
    got = language_id.predict(t.filter("doc_id % 4 = 2"), model, keep=("doc_id", "lang"))
    assert got.filter("lang = lang_pred").count() / got.count() > 0.95
    p = {(r.doc_id, r.lang_pred): r.score for r in language_id.predict(odd, model).collect()}
    assert (1, "und") in p and (2, "und") in p and (5, "und") in p and (None, "und") in p and all(0 <= s <= 1 for s in p.values())
    assert language_id.predict(none, model).count() == 0
    kept = language_id.keep_known(odd, model, least=0.0)
    assert kept.columns == odd.columns and sorted(r.doc_id or -1 for r in kept.select("doc_id").collect()) == [-1, 3, 3, 4, 6, 7, 8]
    empty = language_id.fit(none)
    assert {r.lang_pred for r in language_id.predict(odd, empty).collect()} == {"und"} and language_id.keep_known(odd, empty).count() == 7


def test_letters_make_a_language():
    model = language_id.Model(["a", "b"], np.random.default_rng(1).normal(size=(language_id.SPACE, 2)).astype(np.float32), np.zeros(2), 1.0)
    for text in ("½ ²", "²³¼", "Ⅷ ⅷ", "", None, "12 _ -", "٣٤", "🙂"):
        assert model.predict(text) == ("und", 0.0)
    for text in ("x", "½ é", "日本"):
        assert model.predict(text)[0] in "ab"
    many = "the quick brown fox " * 3000  # by counts
    g = language_id.grams(many)
    z = model.weights[g].astype(float).mean(0)
    assert model.predict(many)[1] == pytest.approx(float(np.exp(z.max()) / np.exp(z).sum()))


def test_ftrl_against_its_definition():
    """One feature and two classes, step by step from the published update."""
    x, y, alpha, beta, l1, l2 = [0.5, 2.0, 1.0], [0, 1, 0], 0.5, 1.0, 0.02, 0.05
    w, bias = language_id.ftrl([(np.array([3]), np.array([v])) for v in x], np.array(y), 2, epochs=1)
    order = np.random.default_rng(7).permutation(3)
    z, n = np.zeros((2, 2)), np.zeros((2, 2))
    of = lambda: np.array([[0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / ((beta + math.sqrt(b)) / alpha + l2) for a, b in zip(p, q, strict=True)] for p, q in zip(z, n, strict=True)])
    for e in order:
        v, now = np.array([x[e], 1.0]), of()
        p = np.exp(v @ now) / np.exp(v @ now).sum()
        for f in range(2):
            for c in range(2):
                g = v[f] * (p[c] - (y[e] == c))
                sigma = (math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])) / alpha
                z[f, c] += g - sigma * now[f, c]
                n[f, c] += g * g
    assert w[3] == pytest.approx(of()[0]) and bias == pytest.approx(of()[1]) and not w[:3].any()


def test_language_of_repeated_rows_and_ties(spark):
    rows = [(i, "alpha beta gamma", lang) for i, lang in enumerate(["x", "y"] * 10)] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.predict(table, language_id.fit(table)).collect()
    assert len(got) == 40 and len({(r.lang_pred, r.score) for r in got}) == 1 and got[0].lang_pred in "xy"


def test_temperature():
    r = np.random.default_rng(0)
    z = r.normal(size=(4000, 3)) * 3
    y = np.array([r.choice(3, p=np.exp(a / 2) / np.exp(a / 2).sum()) for a in z])
    assert language_id.best_temperature(z, y) == pytest.approx(2, rel=0.15)


def toxic_rows():
    rows = [(i, t + (" you loweischaft loweiung idiot" if i % 5 == 0 else ""), int(i % 5 == 0)) for i, t in enumerate(prose(8, 400))]
    return rows


def test_toxicity(spark, odd, none):
    rows = spark.createDataFrame(toxic_rows(), "doc_id long, text string, toxic int")
    index = toxicity.fit(rows.filter("doc_id % 4 <> 2"))
    got = toxicity.score(rows.filter("doc_id % 4 = 2"), index, keep=("doc_id", "toxic")).collect()
    assert all((r.score >= 0.3) == (r.toxic == 1) for r in got) and all(len(r.neighbours) == index.k for r in got)
    out = toxicity.score(odd, index).collect()
    assert len(out) == odd.count() and all(0 <= r.score < 0.3 for r in out)
    assert toxicity.score(none, index).count() == 0 and toxicity.keep_clean(odd, index).count() == odd.count()
    empty = toxicity.fit(rows.limit(0))
    assert {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}
    assert toxicity.fit(rows.withColumn("toxic", F.lit(None).cast("int"))).label.size == 0


def test_block_search_is_exact(spark):
    """The nearest examples and their cosines, against TF-IDF vectors of all words made by hand."""
    rows = toxic_rows() + [(1000 + i, None, i % 2) for i in range(3)] + toxic_rows()[:20]
    index = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    words = lambda x: Counter(re.findall(r"[^\W\d_]+", (x or "").lower()))
    df = Counter(t for _, x, _ in rows for t in {t for w in words(x) for t in toxicity.terms_of(w)})
    toxic = Counter(t for _, x, y in rows if y for t in {t for w in words(x) for t in toxicity.terms_of(w)})
    tells = {t for t in df if toxic[t] >= 3 and toxic[t] >= 0.5 * df[t]}
    assert set(index.terms) == {w for _, x, _ in rows for w in words(x)} | tells and {t for t, y in zip(index.terms, index.telling, strict=True) if y} == tells

    def vector(x):
        c = Counter()
        for w, n in words(x).items():
            for t in toxicity.terms_of(w):
                if t in tells or t == w:
                    c[t] += n
        v = {t: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df[t])) + 1) * (1 if t in tells else 0.05) for t, n in c.items() if df[t]}
        length = math.sqrt(sum(x * x for x in v.values())) or 1
        return {t: x / length for t, x in v.items()}

    by_id = defaultdict(list)
    for key, x, _ in rows:
        by_id[key].append(vector(x))
    examples = [by_id[int(i)][0] for i in index.ids]
    score = index.scorer()
    for text in [x for _, x, _ in rows[:25]] + [" ".join(x.split()[::3]) for _, x, _ in rows[:25]] + ["loweiung", "nothing known", ""]:
        q = vector(text)
        want = sorted((s for e in examples if (s := sum(x * e.get(t, 0) for t, x in q.items())) > 1e-12), reverse=True)[: index.k]
        [(_, ids, cosines, _)] = score([text])
        assert cosines == pytest.approx(want, abs=1e-5) and len(ids) == len(want)


def test_any_label_but_zero_is_toxic(spark):
    rows = toxic_rows()
    fit = lambda k: toxicity.fit(spark.createDataFrame([(a, b, c * k) for a, b, c in rows], "doc_id long, text string, toxic int"))
    one, two = fit(1), fit(-7)
    assert one.terms == two.terms and one.label.tolist() == two.label.tolist() and set(one.label) == {0.0, 1.0}


def test_isotonic():
    x, y = toxicity.isotonic(np.array([0.0, 0.1, 0.2, 0.3]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert np.interp([0, 0.1, 0.15, 0.3], x, y).tolist() == [0, 0.5, 0.5, 1] and (np.diff(y) >= 0).all()


def brute_quality(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    hit = {i + j for i in range(len(own) - 4) if grams[tuple(own[i : i + 5])] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_quality_features(spark, small, odd, none):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()] + [r.text for r in odd.collect()] + ["a b a b a b a b a b", "x\nx\n\n\nx ", "a b c d e", "a b c d e a b c d e"]
    for t in texts:
        f = quality_rules.text_features(t)
        assert (f["n_words"], f["word_chars"], f["n_symbols"], f["n_dup_lines"], f["n_repeat_words"]) == brute_quality(t)
    got = quality_rules.judge(odd)
    assert got.count() == odd.count() and quality_rules.judge(none).count() == 0


def test_quality_labels(spark, small):
    t = quality_rules.op8_quality_rules(spark, small).join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id")
    assert t.filter("kept = (quality = 1)").count() / t.count() > 0.9


def test_words_end_at_ascii_space_only():
    from featherline.llm.common import WORD, words

    for c in map(chr, range(0x3100)):
        assert words(f"a{c}b c") == WORD.findall(f"a{c}b c")


# sharding


def test_shards(spark, small, odd, none):
    table = spark.read.parquet(f"{small}/documents.parquet")
    table = table.unionByName(table.filter("doc_id = 3").crossJoin(spark.range(300)).drop("id"))
    got = sharding.shard(table, shards=8).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in table.collect())
    text = {r.doc_id: r.text or "" for r in table.collect()}
    by = defaultdict(list)
    for r in got:
        assert r["size"] == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "bytes"
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(8))
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    total = [sum(r["size"] for r in rows) for rows in by.values()]
    assert max(total) < 1.2 * np.mean(total)
    assert sharding.shard(none).count() == 0
    assert sharding.shard(odd, shards=3).count() == odd.count()


def test_equal_texts_share_a_shard(spark):
    """Groups up to a whole shard stay whole, and bytes are near equal all the same."""
    r = random.Random(3)
    texts = [x for n in (1, 2, 60, 150, 200, 250) for x in ["y" * (n + 900)] * n] + ["".join(r.choices("abcdef ", k=r.randrange(100, 1500))) for _ in range(3000)]
    got = sharding.shard(docs(spark, texts).withColumns({"source": F.lit("a"), "lang": F.lit(None).cast("string")}), shards=10).collect()
    by = defaultdict(set)
    for x in got:
        by[x.text_crc32].add(x["shard"])
    assert max(map(len, by.values())) == 1 and len(got) == len(texts)
    total = Counter()
    for x in got:
        total[x["shard"]] += x["size"]
    assert len(total) == 10 and max(total.values()) < 1.05 * sum(total.values()) / 10 and min(total.values()) > 0.95 * sum(total.values()) / 10


def test_shards_use_no_python(spark, small):
    plan = sharding.op6_sharding(spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="x1"><header><h1>Site</h1></header><div id="cookie-note">We use cookies to make this long enough to be seen as text, surely.</div>
<nav><a href="/">Home</a></nav><div class="layout-2"><div class="content main-7"><h2>Title &amp; more</h2><p>First para with <a href=x>link</a> text\n that goes on and on for quite a while, really.<p>Second&nbsp;para &lt;b&gt; %d.</p>
<div class="ad-slot">BUY</div><ul><li>one<li>two</ul></div><aside>side</aside><section class="comments"><p>nice post, a comment that is longer than anything else here by far. nice post, a comment that is longer than anything else here by far. nice post, a comment.</p></section></div>
<form><label>Mail</label></form><footer>f</footer><script>if(a<b){"<p>no</p>"}</script></body></html>"""
TEXT = "Title & more\n\nFirst para with link text that goes on and on for quite a while, really.\n\nSecond para <b> %d.\n\none\n\ntwo"


def test_pages(spark):
    rows = [(i, "http://h.example/a", PAGE % i) for i in range(5)] + [(9, None, None), (10, "", ""), (11, "http://h.example/b", "<div class='content main-3'>short</div>"), (12, "x", "plain < text"), (None, "http://h.example/a", PAGE % 7), (13, "u", "<!-- x --><p>a<br>b"), (11, "http://h.example/b", "<div class='content main-3'>short</div>")]
    got = html_extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash")).withColumn("host", F.lit(1)))
    out = defaultdict(list)
    for r in got.collect():
        out[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert all(out[i] == [TEXT % i] for i in range(5)) and out[None] == [TEXT % 7]
    assert out[9] == [""] and out[10] == [""] and out[11] == ["short"] * 2 and out[12] == ["plain < text"] and out[13] == ["a b"]
    assert html_extraction.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_beyond_sent_hosts(spark):
    rows = spark.createDataFrame([(i, f"http://h{i % 3}.example/a", PAGE % i) for i in range(9)], "page_id long, url string, html string")
    got = html_extraction.main_text(rows, most_hosts=0, salt=3)
    assert {r.page_id: r.text for r in got.collect()} == {i: TEXT % i for i in range(9)}


@pytest.mark.parametrize(("part", "kept"), [("<div class='related-work'>kept</div>", True), ("<div class='form-factor'>kept</div>", True), ("<div class='platform-form'>kept</div>", True), ("<p><math><mi>kept</mi></math></p>", True), ("<div class='related-posts'>kept</div>", False), ("<div class='ad ad-slot-3'>kept</div>", False), ("<form>kept</form>", False)])
def test_parts_of_articles(part, kept):
    page = html_extraction.parse(f"<body><article><p>{'Some words of the article. ' * 9}</p>{part}</article></body>")
    assert ("kept" in html_extraction.extract(page, None)) == kept


def test_pages_take_time_in_proportion():
    """A megabyte of tags that don't end, of quotes that don't close, of deep and of unclosed elements: each within seconds."""
    article = f"<article><p>{'Some words of the article. ' * 9}</p></article>"
    for part in ("<a ", "<a \">\"", "<!", "<!--", "<svg>", "<div>", "</p>", "<p>x", "<", "<a href='", "<div class='a b'><p>x</div>", "&amp", "</div>", "<li>"):
        many = article + part * (1_000_000 // len(part)) + ("x>" if part == "<a " else "")
        t = time.process_time()
        text = html_extraction.extract(html_extraction.parse(many), None)
        assert time.process_time() - t < 30 and text
    deep = "<div class='level'>" * 20_000 + "deep text" + "</div>" * 20_000
    page = html_extraction.parse(article + deep)
    assert html_extraction.extract(page, None) and "deep text" in html_extraction.extract(html_extraction.parse(deep), None)
    assert sum(len(n.path) for n in page.nodes) < 20_000 * 600


@pytest.mark.parametrize("html", ["<", "<<>><p", "<script>var x", "</p></div>", "<div " * 500, "<p>" * 3000 + "x", "<a href='" + "y" * 9999, "&#xD800;&#0;&bogus;", "<div>" * 2000 + "deep"])
def test_broken_pages(html):
    html_extraction.extract(html_extraction.parse(html), None)


# similarity


def test_join(spark, odd, none):
    r = random.Random(2)
    base = prose(11, 12, 120)
    texts = []
    for i, t in enumerate(base):
        texts += [t] * (1 + i % 3)
        for _ in range(i):
            w = t.split()
            for _ in range(r.choice([1, 1, 2, 4, 8])):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            texts.append(" ".join(w))
    table = docs(spark, texts).unionByName(odd.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    found = table.collect()
    seen = decontaminate.WordHashes()
    sets = [frozenset(lsh_forest.shingles(x.text, seen).tolist()) for x in found]
    root = list(range(len(found)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    linked = defaultdict(set)
    for i in range(len(found)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
                if sets[i] != sets[j]:
                    linked[i].add(sets[j])
                    linked[j].add(sets[i])
    want = Counter((x.doc_id, min((found[j].doc_id for j in range(len(found)) if top(j) == top(i) and found[j].doc_id is not None), default=None), len(linked[i])) for i, x in enumerate(found))
    got = lsh_forest.join(table, recall=1 - 1e-12, block=5)  # down to the shortest prefixes
    assert Counter((x.doc_id, x.class_id, x.n_links) for x in got.collect()) == want
    shipped = lsh_forest.join(table).collect()
    links = sum(x.n_links for x in shipped)
    assert 0.97 * sum(map(len, linked.values())) <= links <= sum(map(len, linked.values()))
    assert len({x.root for x in shipped}) <= 1.02 * len({top(i) for i in range(len(found))})
    assert lsh_forest.join(none).count() == 0
    kept = lsh_forest.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    plain = docs(spark, texts)
    assert lsh_forest.keep_one(plain, recall=1 - 1e-12).count() == len({top(i) for i in range(len(texts))})


def test_kept_rows_may_have_any_names(spark):
    rows = [(1, "a b c d e f", "x", 1, 2, 3), (2, "a b c d e f", "y", 4, 5, 6), (3, None, "z", 7, 8, 9)]
    for more in ([], rows[:1]):
        table = spark.createDataFrame(rows + more, "doc_id long, text string, _doc string, _th int, _n int, _doc_ int").toDF("doc_id", "text", "_doc", "_hash_", "_N", "__doc__")
        kept = lsh_forest.keep_one(table)
        assert kept.columns == table.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_components(spark):
    edges = spark.createDataFrame([(5, 6), (6, 7), (7, 8), (8, 9), (1, 2), (3, 1), (4, 4)], "a long, b long")
    assert {r.node: r.root for r in lsh_forest.components(edges, "t").collect()} == {5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 1: 1, 2: 1, 3: 1}


def test_prefixes_shorten_as_links_need():
    far, near = np.zeros(101), np.zeros(101)
    far[81], near[97] = 1000, 1000
    assert lsh_forest.shortened(near, 8, 16, 0.995) == 0  # the deepest prefixes find links of this kind
    d = lsh_forest.shortened(far + near, 8, 16, 0.995)
    assert 1 - (1 - 0.815**d) ** 16 >= 0.995 > 1 - (1 - 0.815 ** (d + 1)) ** 16
    assert lsh_forest.shortened(far, d, 16, 0.995) == 0 and lsh_forest.shortened(np.zeros(101), 8, 16, 0.995) == 0


def test_every_pair_is_compared_once(spark):
    """Texts that share nodes of many trees and levels are linked once each, whatever the blocks."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:i] + [f"x{i}"] + words[i + 1 :]) for i in range(5, 195, 5)]
    for block in (512, 7):
        got = lsh_forest.join(docs(spark, texts), recall=1 - 1e-12, block=block).collect()
        assert {r.n_links for r in got} == {len(texts) - 1} and {r.class_size for r in got} == {len(texts)}


def test_recall_on_documents(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    found, seen = table.collect(), decontaminate.WordHashes()
    sets = {x.doc_id: frozenset(lsh_forest.shingles(x.text, seen).tolist()) for x in found}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    of = {x.doc_id: x.class_id for x in lsh_forest.join(table).collect()}
    assert sum(of[a] == of[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_pipeline(spark, small):
    pipeline = pytest.importorskip("corpus_pipeline")
    table = spark.read.parquet(f"{small}/documents.parquet")
    assert [k for k, _ in pipeline.STAGES] == ["toxicity", "language_id", "jaccard_join", "decontamination", "packing"]
    kept, columns = table, table.columns
    for _, f in pipeline.STAGES[:-1]:
        kept = f(spark, kept, small)
        assert kept.columns == columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    pieces = pipeline.run(spark, small).select("doc_id").distinct().collect()
    assert {r.doc_id for r in pieces} == ids
    bad = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in table.collect()], [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]) if r[2]}
    assert not ids & bad


def test_sql_of_decontamination(spark, small):
    import duckdb

    from featherline.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df, want = queries.queries()[name](spark, small), con.sql(sql)
        at = [df.columns.index(c) for c in want.columns]
        assert sorted(tuple(r[i] for i in at) for r in df.collect()) == sorted(want.fetchall())
        assert hashlib.sha256(b"").hexdigest() in {r.items_sha256 for r in df.collect()}
