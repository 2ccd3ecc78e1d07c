"""Jobs done whole, where an earlier round cut them short."""

import itertools
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest

from featherline.llm import lsh_forest, packing, token_counts, toxicity
from featherline.llm.encode import Encoder, default_path, encoder


# toxicity


def test_every_telling_term_is_a_feature(spark):
    """1,500 words of four letters, each in three of 4,500 toxic rows besides words that all of them hold."""
    r = random.Random(9)
    telling = ["q" + "".join(x) for x in itertools.islice(itertools.product("bcdfghjklmnpstvz", repeat=3), 1500)]
    plain = "alfa brav char delt ecko foxt golf hote".split()
    say = lambda *more: " ".join([*r.choices(plain, k=6), *more])
    rows = [(i, say(w, "idio"), 1) for i, w in enumerate(telling * 3)] + [(10_000 + i, say(), 0) for i in range(6000)]
    index = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), examples_a_class=5000)
    assert {*telling, "idio", *plain} <= set(index.terms)  # whatever tells, and all words of the examples
    tells = {t for t, y in zip(index.terms, index.telling, strict=True) if y}
    assert {*telling, "idio"} <= tells and not set(plain) & tells
    asked = [(i, say(w)) for i, w in enumerate(telling[::10])] + [(10_000, say())]
    got = {x.doc_id: x.score for x in toxicity.score(spark.createDataFrame(asked, "doc_id long, text string"), index).collect()}
    assert got.pop(10_000) < 0.3 and len(got) == 150 and min(got.values()) >= 0.3


def test_precision_counts_all_rows(spark):
    rows = [(i, "zork" if i < 4 else "plain", 1) for i in range(8)] + [(10 + i, "zork" if i < 5 else "other", 0) for i in range(20)]

    def fit(**options):
        index = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), **options)
        return {t for t, y in zip(index.terms, index.telling, strict=True) if y}

    assert fit() == {"plain", "plai*"} and fit(precision=0.4) == {"plain", "plai*", "zork"} and fit(support=5) == set()


def test_labels_beyond_those_sent(spark, small, monkeypatch):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    one = sorted(toxicity.labelled(docs, labels).collect())
    monkeypatch.setattr(toxicity, "MOST_SENT", 0)
    assert sorted(toxicity.labelled(docs, labels).collect()) == one


def test_postings_are_sent_without_zeros():
    """The pipeline's driver had no room left for what all tasks get: zeros of columns and all that can be made again."""
    r = np.random.default_rng(5)
    vectors = [(np.unique(np.minimum(r.integers(0, 20_000, 300), r.integers(0, 20_000, 300))), r.random(300)) for _ in range(1000)]
    vectors = [(i, v[: len(i)]) for i, v in vectors] + [(np.empty(0, int), np.empty(0))]
    entries = sum(len(i) for i, _ in vectors)
    one = toxicity.Postings(vectors, 20_000, 64)
    sent = pickle.dumps(one)
    assert len(sent) < 9 * entries + 8 * 20_000 + 10_000
    two = pickle.loads(sent)
    assert vars(one).keys() == vars(two).keys() and all(np.array_equal(x, vars(two)[k]) for k, x in vars(one).items())
    dense = np.zeros((two.blocks * 64, 20_000), np.float32)
    for n, (i, v) in enumerate(vectors):
        dense[n, i] = v
    has = two.column >= 0
    assert has.any() and np.array_equal(two.columns, dense[:, has]) and np.array_equal(has, 48 * (dense > 0).sum(0) >= 1001)
    term = np.repeat(np.repeat(np.arange(20_000), np.diff(two.run_start)), np.diff(two.run_at))
    dense[:, has] = 0
    assert len(term) == (dense > 0).sum() and np.array_equal(dense[two.at, term], two.weight)
    assert np.array_equal(two.run_most, [two.weight[a:b].max() for a, b in itertools.pairwise(two.run_at)])
    assert all((two.at[a:b] // 64 == n).all() for a, b, n in zip(two.run_at, two.run_at[1:], two.run_block, strict=False))


def test_index_is_the_same_after_sending(spark):
    rows = [(i, f"plain words of row {'abcdefghij'[i % 10] * 3}" + " zorkblatt" * (i % 3 == 0), int(i % 3 == 0)) for i in range(90)]
    for some in (rows, []):
        one = toxicity.fit(spark.createDataFrame(some, "doc_id long, text string, toxic int"))
        two = pickle.loads(pickle.dumps(one))
        assert one.terms == two.terms and not hasattr(two.terms, "encode")
        asked = [x for _, x, _ in rows[:12]] + ["", None, "zorkblatt"]
        assert one.scorer()(asked) == two.scorer()(asked)


# similarity


def test_components_of_long_ways(spark):
    n = 3000
    edges = [(i, i + 1) for i in range(n)] + [(10_000 - i, 10_000 - i - 1) for i in range(n)] + [(20_000 + i, 20_000 + (i * 7 + 1) % n) for i in range(n)]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    touched = {x for a, b in edges if a != b for x in (a, b)}
    got = lsh_forest.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    assert len(got) == len(touched) and {r.node: r.root for r in got} == {i: top(i) for i in touched}


# encoding


@pytest.mark.parametrize("text", ["a <|endoftext|> hi", "<|endoftext|>", "<|endoftext|><|endoftext|>", "x<|endoftext|>\n\n<|endoftext|> y ", " <|endoftext|", "é  <|endoftext|>  日本語", "<|endoftext|>\x1c a<|ENDOFTEXT|>", "word " * 300 + "<|endoftext|>" + " word" * 300])
def test_added_tokens_are_one_id(text):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(default_path())
    assert encoder(default_path()).ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_packing_and_counts(spark):
    rows = spark.createDataFrame([(1, "a <|endoftext|> hi")], "doc_id long, text string")
    assert [(r.ids, r.doc_tokens) for r in packing.pack(rows).collect()] == [([64, 220, 50256, 23105, 0], 5)]
    assert [(r.length, r.n_docs) for r in token_counts.encoded_lengths(rows).collect()] == [(4, 1)]


LOOSE = ["", None, " a", "a ", "a \x1c", " \x85b", "x ᠎ y", "a\n b\n\n c", "b 's 't", "\0 \0a b", "a <|endoftext|> a", "  a  b a", "a b a b"]


@pytest.mark.parametrize("block", [1, 50, 1 << 22])
@pytest.mark.parametrize("large", [False, True])
def test_blocks_match_library(block, large):
    """Texts of a column, odd spaces and repeated words among them, cut into blocks anywhere."""
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(default_path())
    r = random.Random(block)
    texts = LOOSE + ["".join(r.choices(" 's\n\t\xa0a\x1cé9²　日.!<́\r\x85  ab", k=r.randrange(30))) for _ in range(2000)]
    want = [library.encode(x or "", add_special_tokens=False).ids for x in texts]
    enc = Encoder(default_path(), block)
    assert [x.tolist() for x in enc.rows(pa.array(texts, pa.large_string() if large else pa.string()))] == want
    assert [n for _, counts in enc.blocks(pa.array(texts).slice(3)) for n in counts.tolist()] == [len(x) for x in want[3:]]
    assert not list(enc.rows(pa.array([], pa.string()))) and [x.tolist() for x in enc.rows(pa.array([None], pa.string()))] == [[]]


def test_words_are_encoded_once_a_block():
    """120,000 different words, more than a memo of 100,000 parts held, twice over in the same order: each is encoded once."""
    words = [f"w{i:06d}" for i in range(120_000)]
    texts = ["the " + " ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    enc = Encoder(default_path())
    want, seen, encode = [enc.ids(x).tolist() for x in texts], [], enc.bpe.encode_ordinary
    enc.bpe = type("Counts", (), {"encode_ordinary": lambda _, x: seen.append(x) or encode(x)})()
    got = [x.tolist() for x in enc.rows(pa.array(texts * 2))]
    assert got == want * 2 and sum(x.count(" ") for x in seen) == len(words) and len(seen) == 2 * len(texts) + 1
