"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes, isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import fold, hand_back, lean, materialize, table

_LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
_MARKS = ".,;:!?\"'()[]-"  # no letters, and found at the ends of most parts that are no plain word

#: Up to so many labels are sent to all tasks (16 MB); more are joined by a shuffle.
MOST_SENT = 1_000_000


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, so that inflected forms meet."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class Matcher(dict):
    """Maps what stands between white space to the number of the term in it: -1 if there is none, and numbers from the number
    of terms on for several. About `most` such parts are remembered.

    Words hold no white space, so a text may be cut there.
    """

    def __init__(self, terms: list[str], most: int = 80_000):
        self.words, self.begin = ({t.rstrip("*"): i for i, t in enumerate(terms) if t.endswith("*") == y} for y in (False, True))
        self.terms, self.most, self.begin4 = len(terms), most, {t[:4] for t in self.begin}
        self.several: list[list[int]] = []

    def __missing__(self, part: str) -> int:
        found, bare = [], part.strip(_MARKS)
        for w in (bare,) if bare.isalpha() else _LETTERS.findall(part):
            i = self.words.get(w)
            if i is not None:
                found.append(i)
            if w[:4] in self.begin4:
                found += [i for n in PREFIXES if len(w) > n and (i := self.begin.get(w[:n])) is not None]
        if len(found) > 1:
            self.several.append(found)
            found = [self.terms + len(self.several) - 1]
        self[part] = found[0] if found else -1
        return self[part]

    def counts(self, parts: list[str], times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The terms, in order, of the parts of a text and how often each occurs."""
        if len(self) >= self.most:
            self.clear()
            self.several.clear()
        i = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        n = np.ones(len(i), np.int64) if times is None else times
        if len(more := np.flatnonzero(i >= self.terms)):
            lists = [self.several[x - self.terms] for x in i[more].tolist()]
            n = np.concatenate([n, np.repeat(n[more], [len(x) for x in lists])])
            i = np.concatenate([i, *map(np.array, lists)])
        keep = (i >= 0) & (i < self.terms)
        u, which = np.unique(i[keep], return_inverse=True)
        return u, np.bincount(which, n[keep], len(u))

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a whole text; the null text has none."""
        return self.counts((text or "").lower().split())


class Terms(dict):
    """Maps what stands between white space to the terms in it; at most `most` such parts are remembered."""

    def __missing__(self, part: str, most: int = 50_000) -> tuple[str, ...]:
        if len(self) >= most:
            self.clear()
        bare = part.strip(_MARKS)
        found = self[part] = tuple(t for w in ((bare,) if bare.isalpha() else _LETTERS.findall(part)) for t in terms_of(w))
        return found

    def of(self, text: str | None) -> set[str]:
        """The different terms of a whole text."""
        return set(chain.from_iterable(map(self.__getitem__, set((text or "").lower().split()))))


def _ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The numbers from a[i] up to but without b[i], one range after another."""
    n = b - a
    return np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())


class Postings:
    """Weights of terms in examples, in blocks of examples.

    A term that at least one in 48 examples hold has a column of all its weights. Any other term has entries by example, and
    runs of them that share a block, with the greatest weight of each. Pickled, only weights above 0 are kept, and the rest is
    made of them again.
    """

    def __init__(self, vectors: Iterable[tuple[np.ndarray, np.ndarray]], terms: int, block: int):
        vectors = [(i.astype(np.int32), v.astype(np.float32)) for i, v in vectors]
        term = np.concatenate([np.empty(0, np.int32), *(i for i, _ in vectors)])
        example = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(i) for i, _ in vectors])
        weight = np.concatenate([np.empty(0, np.float32), *(v for _, v in vectors)])
        examples = len(vectors)
        del vectors
        n = np.bincount(term, minlength=terms)
        often = np.flatnonzero(48 * n >= max(48, examples))
        in_column = np.zeros(terms, bool)
        in_column[often] = True
        order = np.argsort(term, kind="stable")  # examples rise already
        in_column = in_column[term[order]]
        del term
        at, rest = order[in_column], order[~in_column]
        del order, in_column
        column_n, n[often] = n[often], 0
        state = examples, block, often, column_n, example[at], weight[at], n, example[rest], weight[rest]
        del at, rest, example, weight
        self.__setstate__(state)

    def __getstate__(self) -> tuple:
        of, example = np.nonzero(self.columns.T)
        often = np.flatnonzero(self.column >= 0)
        n = np.diff(self.run_at[self.run_start]).astype(np.int32)
        return self.examples, self.block, often, np.bincount(of, minlength=len(often)), example.astype(np.int32), self.columns[example, of], n, self.at, self.weight

    def __setstate__(self, state: tuple) -> None:
        self.examples, self.block, often, column_n, example, weight, n, self.at, self.weight = state
        self.blocks = -(-self.examples // self.block)
        self.column = np.full(len(n), -1)
        self.column[often] = np.arange(len(often))
        self.columns = np.zeros((self.blocks * self.block, len(often)), np.float32)
        for c, b in enumerate(np.cumsum(column_n).tolist()):
            of = slice(b - int(column_n[c]), b)
            self.columns[example[of], c] = weight[of]
        block = self.at // self.block
        term = np.repeat(np.arange(len(n), dtype=np.int32), n)
        first = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        self.run_at, self.run_block = np.append(first, len(self.at)), block[first]
        self.run_most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.run_start = np.searchsorted(term[first], np.arange(len(n) + 1))


@dataclass
class Index:
    """Labelled examples as TF-IDF vectors of length 1 over all their words, in blocks of examples with the greatest weight of each term in a block.

    Terms are the words of the examples, and words and beginnings of words that tell toxic rows from others. A telling term
    counts in full, any other `plain` times that, so texts are near to those that share what tells, and else to those that
    share most words.
    """

    terms: list[str]
    telling: np.ndarray  # of each term, if it tells
    weight: np.ndarray  # inverse document frequencies of the terms, times `plain` for those that don't tell
    postings: Postings
    label: np.ndarray
    stand_for: np.ndarray  # labelled rows each example stands for
    ids: np.ndarray
    block: int = 64
    k: int = 15
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0]), np.array([0.0])))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"terms": "\n".join(self.terms)}  # every task gets it

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"terms": state["terms"].split("\n") if state["terms"] else []}

    def vector(self, counts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        i, n = counts
        v = (1 + np.log(n)) * self.weight[i]
        return i, v / np.sqrt(max(v @ v, 1e-300))

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], leave_out: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the counts of some texts: the k examples of greatest cosine above 0, ties (to 6 digits) to the lower number.

        What terms with columns add is had for all examples at once, and is the least that a cosine can be; with the greatest
        weights of the other terms it bounds each block. Blocks are read by falling bound, ever more at once, until no bound
        beats the k-th cosine.
        """
        p, out = self.postings, []
        vectors = [self.vector(c) for c in texts]
        asked = np.zeros((p.columns.shape[1], len(texts)), np.float32)
        for n, (i, v) in enumerate(vectors):
            at = p.column[i]
            asked[at[at >= 0], n] = v[at >= 0]
        known = (p.columns @ asked).T.astype(np.float64)
        for n, (i, v) in enumerate(vectors):
            least = known[n]
            if leave_out is not None:
                least[leave_out[n]] = -np.inf
            rest = p.column[i] < 0
            i, v = i[rest], v[rest]
            a, b = p.run_start[i], p.run_start[i + 1]
            runs, value = _ranges(a, b), np.repeat(v, b - a)
            blocks = p.run_block[runs]
            bound = least.reshape(p.blocks, p.block).max(1) + np.bincount(blocks, value * p.run_most[runs], p.blocks)
            kth = -np.partition(-least, self.k - 1)[self.k - 1] if len(least) >= self.k else 0.0
            order = np.argsort(-bound, kind="stable")
            order = order[bound[order] >= max(kth - 1e-5, 1e-9)]
            rank = np.full(p.blocks, p.blocks)
            rank[order] = np.arange(len(order))
            rank = rank[blocks]
            best_n, best_s = np.empty(0, int), np.empty(0)
            done, wide = 0, 8
            while done < len(order) and not (len(best_s) >= self.k and bound[order[done]] < best_s[self.k - 1] - 1e-5):
                end = min(done + wide, len(order))
                some = np.flatnonzero((rank >= done) & (rank < end))
                first = p.run_at[runs[some]]
                size = p.run_at[runs[some] + 1] - first
                at = np.repeat(first - np.cumsum(size) + size, size)
                at += np.arange(len(at))
                s = np.bincount(p.at[at], np.repeat(value[some], size) * p.weight[at], len(least)) + least
                new = (order[done:end, None] * p.block + np.arange(p.block)).ravel()
                new = new[s[new] > max(1e-9, best_s[self.k - 1] - 1e-5 if len(best_s) >= self.k else kth - 1e-5)]
                best_n, best_s = np.concatenate([best_n, new]), np.concatenate([best_s, s[new]])
                keep = np.lexsort((best_n, -np.round(best_s, 6)))[: self.k]
                best_n, best_s = best_n[keep], best_s[keep]
                done, wide = end, 2 * wide
            out.append((best_n, np.minimum(best_s, 1.0)))
        return out

    def vote(self, n: np.ndarray, s: np.ndarray) -> float:
        if not len(n):
            return 0.0
        w = self.stand_for[n] / (0.02 + np.maximum(0, 1 - s))
        return float(w @ self.label[n] / w.sum())

    def scorer(self, most: int = 2_000, together: int = 64):
        """A function of some texts: (score, neighbours, cosines, telling terms found) of each. Some thousand copies are remembered."""
        m, known = Matcher(self.terms), {}

        def of(texts: list[str | None]) -> list[tuple]:
            keys = [xxhash.xxh3_128_digest((x or "").encode("utf-8", "replace")) for x in texts]
            new = {k: x for k, x in zip(keys, texts, strict=True) if k not in known}
            found = {k: known[k] for k in keys if k in known}
            counts = {k: m.of(x) for k, x in new.items()}
            todo = list(counts)
            for a in range(0, len(todo), together):
                for k, (n, s) in zip(todo[a : a + together], self.nearest([counts[k] for k in todo[a : a + together]]), strict=True):
                    p = float(np.interp(self.vote(n, s), *self.steps))
                    found[k] = p, self.ids[n].tolist(), s.tolist(), [self.terms[i] for i in counts[k][0][self.telling[counts[k][0]]].tolist()]
            if len(known) + len(todo) > most:
                known.clear()
            known.update((k, found[k]) for k in todo[:most])
            return [found[k] for k in keys]

        return of


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step values of y over x by pooling adjacent violators, as points to interpolate between."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order], strict=True):
        if pools and pools[-1][3] == a:
            p = pools[-1]
            p[0], p[1] = (p[0] * p[1] + b * c) / (p[1] + c), p[1] + c
        else:
            pools.append([b, c, a, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b_, c_, _, hi = pools.pop()
            p = pools[-1]
            p[0], p[1], p[3] = (p[0] * p[1] + b_ * c_) / (p[1] + c_), p[1] + c_, hi
    if not pools:
        return np.array([0.0]), np.array([0.0])
    at = [(lo, v) for v, _, lo, hi in pools] + [(hi, v) for v, _, lo, hi in pools]
    xs, ys = zip(*sorted(at), strict=True)
    return np.array(xs), np.clip(np.array(ys), 0, 1)


def fit(rows: DataFrame, *, text: str = "text", label: str = "toxic", key: str = "doc_id", examples_a_class: int = 2000, support: int = 3, precision: float = 0.5, plain: float = 0.05) -> Index:
    """Fit on labelled rows; null labels are left out, any label but 0 is toxic.

    How many toxic and how many labelled rows hold a term is counted over all of them; every word or beginning of a word with
    at least `support` toxic rows and a share of toxic ones of at least `precision` tells. The index holds up to
    `examples_a_class` rows of each label, all if there are fewer, chosen by a hash of the key, each standing for its share
    of the rows. Its terms are all words of these rows, and all terms that tell. Rows with the same key are drawn
    together; repeated rows count each.
    """
    rows = rows.filter(F.col(label).isNotNull()).select(F.col(key).cast("long").alias("key"), (F.col(label) != 0).cast("int").alias("y"), F.col(text).alias("text"))
    n_of = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([toxic[t] for t in n], pa.int64())], names=["term", "n", "toxic"])
            n.clear()
            toxic.clear()
            return out

        n, toxic, terms_in = Counter(), Counter(), Terms()
        for b in batches:
            for y, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = terms_in.of(x.as_py())
                n.update(own)
                if y == 1:
                    toxic.update(own)
                if len(n) >= 200_000:
                    yield flush()
        yield flush()

    seen = rows.select("y", "text").mapInArrow(lean(count), "term string, n long, toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    seen = materialize(seen, "terms")
    share = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for y, n in n_of.items() for v in (y, min(1.0, examples_a_class / n))]), F.col("y")), F.lit(0.0)) if n_of else F.lit(0.0)
    u = F.pmod(F.xxhash64("key", F.lit("example")), F.lit(1 << 30)) / float(1 << 30)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [Counter(_LETTERS.findall((x.as_py() or "").lower())) for x in b.column(3)]  # of the sample
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([list(c) for c in found], pa.list_(pa.string())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], names=["u", "key", "y", "w", "c"])

    drawn = rows.withColumn("u", u).filter(F.col("u") < share)
    keys = {r.key for r in drawn.select("key").collect()}  # known first, so that a join below reads no other texts
    named = F.col("key").isin(list(keys - {None}))
    drawn = drawn.filter(named | F.col("key").isNull() if None in keys else named).select("u", "key", "y", "text").mapInArrow(lean(words_of), "u double, key long, y int, w array<string>, c array<int>")
    drawn = materialize(drawn, "examples")

    tells = (F.col("toxic") >= support) & (F.col("toxic") >= precision * F.col("n"))
    of_examples = drawn.select(F.explode("w").alias("term")).distinct().withColumn("held", F.lit(True))
    got_terms = seen.join(of_examples, "term", "left").select("term", "n", tells.alias("tells"), "held").filter("tells or held").select("term", "n", "tells").toArrow()
    got_terms = got_terms.sort_by([("n", "descending"), ("term", "ascending")])
    terms, total, telling = got_terms["term"].to_pylist(), sum(n_of.values()), got_terms["tells"].to_numpy().astype(bool)
    weight = (np.log((1 + total) / (1 + got_terms["n"].to_numpy().astype(float))) + 1) * np.where(telling, 1.0, plain)
    del got_terms
    number, rows_ = Matcher(terms), drawn.toArrow()  # bounded by the sample

    counts = [number.counts(w.as_py(), np.array(c.as_py(), np.int64)) for w, c in zip(rows_["w"], rows_["c"], strict=True)]
    got = list(zip(*(rows_[x].to_pylist() for x in ("u", "key", "y")), strict=True))
    del number, rows_
    hand_back()  # here and below: else the driver would keep what each step has grown
    like = [(i[telling[i]][:8].tolist(), i[:8].tolist()) for i, _ in counts]  # examples that share telling terms, then the commonest words, share blocks, so bounds are tight
    order = sorted(range(len(got)), key=lambda n: (like[n], got[n][0], got[n][1] is None, got[n][1] or 0, got[n][2], counts[n][0].tobytes(), counts[n][1].tobytes()))
    got, counts, n_drawn = [got[n] for n in order], [counts[n] for n in order], Counter(y for _, _, y in got)
    index = Index(terms, telling, weight, None, np.array([y for _, _, y in got], float), np.array([n_of[y] / n_drawn[y] for _, _, y in got], float), np.array([-1 if k is None else k for _, k, _ in got], np.int64))
    del like, order
    hand_back()
    index.postings = Postings(map(index.vector, counts), len(terms), index.block)
    hand_back()
    if got:
        raw = np.array([index.vote(n, s) for a in range(0, len(counts), 64) for n, s in index.nearest(counts[a : a + 64], list(range(a, min(a + 64, len(counts)))))])
        index.steps = isotonic(raw, index.label, index.stand_for)
    del counts
    hand_back()
    return index


def score(docs: DataFrame, index: Index, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, score, and as evidence the ids and cosines of the nearest examples and the telling terms found.

    Null and empty texts, and those without a word of the index, have no neighbours and the score of no toxic vote; with no
    labelled rows every score is 0. Repeated rows are scored each; ties in cosine go to the example of lower number. An empty
    table gives no rows; other columns are not read.
    """
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double, neighbours array<long>, cosines array<float>, terms array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = index.scorer()
        for b in (b.slice(i, 512) for whole in batches for i in range(0, max(1, whole.num_rows), 512) for b in [whole]):
            cols = list(zip(*of(b.column(len(keep)).to_pylist()), strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.list_(pa.float32())), pa.array(cols[3], pa.list_(pa.string()))], names=[*keep, "score", "neighbours", "cosines", "terms"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")).mapInArrow(lean(run), schema)


def keep_clean(docs: DataFrame, index: Index, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows of docs, with all their columns, whatever their names, whose text scores below the threshold. Null and empty texts
    stay unless texts without words are mostly toxic; repeated rows are judged alike; an empty table stays empty."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = index.scorer()
        for b in batches:
            keep = [found[0] < threshold for i in range(0, b.num_rows, 512) for found in of(b.column(at).slice(i, 512).to_pylist())]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of documents outside fold 2 that have a label; a document labelled twice counts as toxic if either label says so."""
    one = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = one.count() <= MOST_SENT
    return docs.filter(fold(F.col("doc_id"), 4) != 2).select("doc_id", "text").join(F.broadcast(one) if few else one, "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = fit(labelled(docs, table(spark, sf_dir, "labels")))
    out = score(docs.withColumn("held_out", fold(F.col("doc_id"), 4) == 2), index, keep=("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
