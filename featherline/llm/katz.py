"""Language-model scoring: a Katz backoff model with Good-Turing discounts, counted by hash partition, stored and evaluated recursively.

Texts become chunks of numbered words, kept in a table that is bucketed by chunk. For each order in turn every chunk sends its
different n-grams with their training counts to the partition of their history, which holds all n-grams of that history, and
hears the total counts, how many words were seen how often after each history, and what these words weigh in the order below.
The answers are stored tables too. With those of all orders a chunk knows every probability and backoff weight that its tokens
need and evaluates them from the lowest order up, so nothing is sent per document or token.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import fold, materialize, materialize_buckets, row_ids, table

#: Not a word, as it holds a space.
END = b" end"
K = 5  # counts above K are not discounted
SEEN = 24  # counts of counts go so far
LARGE = 1 << 18  # a history of fewer training tokens stays in one partition


def tokens(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` after A-Z were lowered, as UTF-8."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _bundle(arrays: list[np.ndarray]) -> bytes:
    """Whole numbers from 0, or floats as their bits, in planes of bytes."""
    out = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        bits = a.view(np.uint64) if a.dtype == np.float64 else a.astype(np.uint64)
        n = max(1, (int(bits.max(initial=0)).bit_length() + 7) // 8)
        planes = bits.astype("<u8", copy=False).view(np.uint8)
        out += [np.array([len(bits), n], "<u4").tobytes(), *(planes[i::8].tobytes() for i in range(n))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unbundle(data) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(bytes(data))
    out, at = [], 4
    for _ in range(int(np.frombuffer(data, "<u4", 1)[0])):
        m, n = np.frombuffer(data, "<u4", 2, at).tolist()
        a = np.frombuffer(data, np.uint8, m, at + 8).astype(np.int64)
        for i in range(1, n):
            a |= np.frombuffer(data, np.uint8, m, at + 8 + i * m).astype(np.int64) << (8 * i)
        out.append(a)
        at += 8 + m * n
    return out


def _different(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different values, the place of one of each, and the number of each value."""
    order = np.argsort(key)
    s = key[order]
    first = np.empty(len(s), bool)
    first[:1] = True
    np.not_equal(s[1:], s[:-1], out=first[1:])
    inverse = np.empty(len(s), np.int32 if len(s) < 1 << 31 else np.int64)
    inverse[order] = np.cumsum(first) - 1
    return s[first], order[first], inverse


def discounts(n: dict[int, int], k: int = K) -> np.ndarray:
    """Katz's factors for counts 0 to k (the first unused) by Good-Turing, from counts of counts.

    Where the plain counts of counts give a factor outside (0, 1], as copied texts make them do, they are smoothed by a line
    through their logarithms, whose slope is kept below -1; such factors are always inside. 1 for all without singletons.
    """
    out = np.ones(k + 1)
    if not n.get(1):
        return out

    def katz(z) -> np.ndarray | None:
        a = (k + 1) * z(k + 1) / z(1)
        if a >= 1 or not all(z(r) > 0 for r in range(1, k + 1)):
            return None
        d = np.array([((r + 1) * z(r + 1) / (r * z(r)) - a) / (1 - a) for r in range(1, k + 1)])
        return d if ((d > 0) & (d <= 1)).all() else None

    d = katz(lambda r: n.get(r, 0))
    if d is None:
        r = np.array([i for i in sorted(n) if 0 < i <= SEEN and n[i] > 0], float)
        z = np.log([n[int(i)] for i in r])
        x = np.log(r) - np.log(r).mean()
        slope = min(float(x @ z / (x @ x)) if len(r) > 1 else -2.0, -1.05)
        d = katz(lambda i: float(i) ** slope)
    out[1:] = d
    return out


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return c * np.where(c <= K, d[np.minimum(c, K)], 1.0)


@dataclass
class Unigrams:
    """The lowest order: discounted word shares; what they leave belongs to the one unknown word."""

    total: int
    distinct: int
    d: np.ndarray
    unknown: float = 0.0
    scale: float = 1.0

    @staticmethod
    def of(total: int, distinct: int, n: dict[int, int]) -> Unigrams:
        d = discounts(n)
        left = sum(r * (1 - d[r]) * n.get(r, 0) for r in range(1, K + 1)) / total if total else 1.0
        out = Unigrams(total, distinct, d, left)
        if total and left <= 0:
            out.unknown = 0.5 / (total + 1)
            out.scale = 1 - out.unknown
        return out

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d) * (self.scale / max(1, self.total)), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1)))


def weights(c: np.ndarray, left: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale of seen words, backoff weight) of histories with c tokens, `left` of which discounting freed, whose seen words
    have `lower` probability in the order below. A history that frees nothing gives half a token to unseen words."""
    none = left <= 1e-9 * c
    scale = np.where(none, c / (c + 0.5), 1.0)
    free = np.where(none, 0.5 / (c + 0.5), left / np.maximum(c, 1))
    return np.where(c > 0, scale, 1.0), np.where(c > 0, free / np.maximum(1 - lower, 1e-15), 1.0)


def chunks(docs: DataFrame, most_tokens: int) -> DataFrame:
    """Rows (bid, keys, data, vocab, n): documents of a task in runs of about most_tokens tokens, words by their place in the
    run's own vocabulary. A longer document is a run of its own."""
    schema = pa.schema([("bid", pa.int64()), ("keys", pa.list_(pa.int64())), ("data", pa.binary()), ("vocab", pa.binary()), ("n", pa.int64()), ("n_train", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = row_ids()

        def fresh() -> None:
            nonlocal number, keys, held, parts, n
            number = defaultdict(count().__next__)
            keys, held, parts, n = [], [], [], 0
            number[END]

        def done() -> pa.RecordBatch:
            t = np.concatenate(parts)
            order = np.argsort(-np.bincount(t, minlength=len(number)), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            vocab = np.fromiter(map(_hash, number), np.uint64, len(number))[order]
            data = _bundle([np.array(held, bool), np.array([len(p) for p in parts]), rank[t]])
            return pa.RecordBatch.from_pylist([{"bid": next(ids), "keys": keys, "data": data, "vocab": vocab.tobytes(), "n": len(t), "n_train": len(held) - sum(held)}], schema)

        number, keys, held, parts, n = {}, [], [], [], 0
        fresh()
        for b in batches:
            for key, out, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                own = tokens(x.as_py())
                own.append(END)
                if keys and n + len(own) > most_tokens:
                    yield done()
                    fresh()
                keys.append(key)
                held.append(out)
                parts.append(np.fromiter(map(number.__getitem__, own), np.uint32, len(own)))
                n += len(own)
        if keys:
            yield done()

    return docs.mapInArrow(run, "bid long, keys array<long>, data binary, vocab binary, n long, n_train long")


@dataclass
class Order:
    """The different n-grams of a chunk at one order, each a history (its number one order below, or one past the last for the
    begin of a text) and a word; what was heard of them. All but `of_token` and `history` are by n-gram or by history."""

    of_token: np.ndarray  # the n-gram that ends at each token
    history: np.ndarray  # the history of each token
    h: np.ndarray
    w: np.ndarray
    shorter: np.ndarray  # the n-gram without its first word
    c: np.ndarray | None = None
    scale: np.ndarray | None = None
    back: np.ndarray | None = None


class Chunk:
    """A chunk with what it has heard so far: answers by order, each a list of (part, data)."""

    def __init__(self, row: dict, parts: int, n_begin: int):
        self.bid, self.keys, self.parts = row["bid"], row["keys"], parts
        held, self.sizes, self.words = _unbundle(row["data"])
        self.vocab = np.frombuffer(row["vocab"], np.uint64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.held, self.train = held.astype(bool), np.repeat(held == 0, self.sizes)
        self.starts, self.n_begin = np.cumsum(self.sizes) - self.sizes, n_begin
        self.orders: list[Order] = []

    def deal(self, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Places by part, those of a part in rising order."""
        part = part.astype(np.uint16 if self.parts < 1 << 16 else np.uint32)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(self.parts + 1))
        return ((i, order[edge[i] : edge[i + 1]]) for i in range(self.parts) if edge[i] < edge[i + 1])

    def first_part(self) -> np.ndarray:
        return self.vocab % np.uint64(self.parts)

    def ask_words(self) -> Iterator[tuple[int, bytes]]:
        n = np.bincount(self.words[self.train], minlength=len(self.vocab))
        for i, at in self.deal(self.first_part()):
            yield i, _bundle([self.vocab[at], n[at]])

    def hear_words(self, told: list) -> None:
        """Counts and numbers of words; 0 is the number of a text's begin."""
        v = len(self.vocab)
        self.n, self.id = np.zeros(v + 1, np.int64), np.zeros(v + 1, np.int64)
        told = dict(told)
        for i, at in self.deal(self.first_part()):
            n, place = _unbundle(told[i])
            self.n[at], self.id[at] = n, place * self.parts + i + 1
        self.n[v] = self.n_begin

    def count(self, m: int) -> np.ndarray:
        """Training counts of all n-grams of m words, the last being the begin of texts."""
        return self.n if m == 1 else np.append(self.orders[m - 2].c, self.n_begin)

    def grow(self) -> Order:
        """Number the n-grams of the next order."""
        below = self.orders[-1].of_token if self.orders else self.words
        begin = len(self.orders[-1].h) if self.orders else len(self.vocab)
        history = np.empty(len(below), np.int64)
        history[1:] = below[:-1]
        history[self.starts] = begin
        key, at, of_token = _different(history * len(self.vocab) + self.words)
        h, w = np.divmod(key, len(self.vocab))
        self.orders.append(Order(of_token, history, h, w, below[at]))
        return self.orders[-1]

    def names(self, m: int, h: np.ndarray) -> list[np.ndarray]:
        """Numbers of the words of histories of m words, the last word first."""
        out = []
        for i in range(m, 0, -1):
            if i == 1:
                out.append(self.id[h])
            else:
                o = self.orders[i - 2]
                out.append(self.id[np.append(o.w, len(self.vocab))[h]])
                h = np.append(o.h, len(self.orders[i - 3].h) if i > 2 else len(self.vocab))[h]
        return out

    def dealt(self, names: list[np.ndarray], large: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, its n-grams of the highest order, the first n-gram of each history), histories by their last words. Parts go
        by the last word of a history; by the whole history if that word is large, and by the word itself if the history is."""
        m, o = len(self.orders), self.orders[-1]
        last, *rest = (x.astype(np.uint64) for x in names)
        place, c = _mix(last + np.uint64(1)), self.count(m)
        if rest:
            n_last = self.n[np.append(self.orders[m - 2].w, len(self.vocab))]
            big = np.flatnonzero(n_last >= large)
            sub = place[big]
            for x in rest:
                sub = _mix(sub + x[big] + np.uint64(1))
            place[big] = _mix(place[big] + sub % (n_last[big] // large + 1).astype(np.uint64))
        part = (_mix(place) % np.uint64(self.parts)).astype(np.uint32)[o.h]
        big = np.flatnonzero((c >= large)[o.h])
        if len(big):
            h = o.h[big]
            sub = _mix(self.id[o.w[big]].astype(np.uint64) + np.uint64(7)) % (c[h] // large + 1).astype(np.uint64)
            part[big] = _mix(_mix(place[h] + np.uint64(1) + sub)) % np.uint64(self.parts)
        key = names[0]
        for x in names[1:]:
            key = _pair(key, x)
        n = np.bincount(o.h, minlength=len(c))
        first = np.cumsum(n) - n
        order = np.argsort(key)
        n = n[order]
        grams = np.repeat(first[order] - np.cumsum(n) + n, n) + np.arange(len(o.h))  # by the order of their histories
        for i, at in self.deal(part[grams]):
            at = grams[at]
            h = o.h[at]
            yield i, at, np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))

    def ask(self, uni: Unigrams, large: int) -> Iterator[tuple[int, bytes]]:
        """For each part: names of histories, their followers, counts and the scale one order below; words, their training
        counts in the chunk and their counts one order below."""
        o = self.grow()
        m = len(self.orders)
        trained = np.bincount(o.of_token, self.train, len(o.h)).astype(np.int64)
        c = self.count(m)
        names, low = self.names(m, np.arange(len(c))), c[o.shorter]
        if m == 1:
            scale = np.full(len(c), uni.scale / max(1, uni.total))
        else:
            b, below = self.orders[-2], self.count(m - 1)
            scale = (b.scale / np.maximum(below, 1))[np.append(b.shorter, len(below) - 1)]
        for i, at, run in self.dealt(names, large):
            h = o.h[at[run]]
            yield i, _bundle([np.diff(names[0][h], prepend=0), *(x[h] for x in names[1:]), np.diff(np.append(run, len(at))), c[h], scale[h], self.id[o.w[at]], trained[at], low[at]])

    def hear(self, told: list, d: np.ndarray, split: dict, large: int) -> None:
        """Counts of the highest order's n-grams; scales and, where a word was not seen, backoff weights of its histories."""
        o, told = self.orders[-1], dict(told)
        m = len(self.orders)
        c = self.count(m)
        names = self.names(m, np.arange(len(c)))
        o.c, left, lower = np.zeros(len(o.h), np.int64), np.zeros(len(c)), np.zeros(len(c))
        ratio = np.arange(1, K + 1) * (1 - d[1:])
        for i, at, run in self.dealt(names, large):
            n, *small, low = _unbundle(told.pop(i))
            o.c[at] = n
            h = o.h[at[run]]
            left[h] = sum(x * y for x, y in zip(small, ratio, strict=True))
            lower[h[np.logical_or.reduceat(n == 0, run)]] = low.view(np.float64)
        for j in np.flatnonzero(c >= large) if split else ():
            key = tuple(int(x[j]) for x in names)
            if key in split:
                left[j], lower[j] = split[key][0] @ ratio, split[key][1]
        o.scale, o.back = weights(c, left, lower)

    def evaluate(self, uni: Unigrams, d: list[np.ndarray]) -> pa.RecordBatch:
        """Sums for each document over its tokens, each token's probability from the lowest order up."""
        p = uni.p(self.n[:-1])[self.words]
        for m, o in enumerate(self.orders, 1):
            seen = discounted(o.c, d[m - 1]) * (o.scale / np.maximum(self.count(m), 1))[o.h]
            p = np.where(o.c[o.of_token] > 0, seen[o.of_token], o.back[o.history] * p)
        of = lambda x: np.bincount(self.doc, x, len(self.sizes))
        n = self.n[self.words]
        columns = [pa.array(self.keys, pa.int64()), pa.array(self.held), pa.array(self.sizes), pa.array(of(n > 0).astype(np.int64)), pa.array(np.full(len(self.sizes), uni.total)), pa.array(of(uni.base(n))), pa.array(of(np.log10(np.maximum(p, 1e-300))))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(part, its rows (bid, data)), rows sorted by part."""
    part, held = None, []
    for b in batches:
        for i in range(b.num_rows):
            if held and b.column(0)[i].as_py() != part:
                yield part, held
                held = []
            part = b.column(0)[i].as_py()
            held.append((b.column(1)[i].as_py(), b.column(2)[i].as_py()))
    if held:
        yield part, held


def _count_words(rows: list) -> tuple[list[bytes], np.ndarray, list]:
    """Answers to ask_words, counts of counts, and nothing that is split. Frequent words get low numbers."""
    asked = [_unbundle(data) for _, data in rows]
    _, _, which = _different(np.concatenate([a[0] for a in asked]))
    n = np.bincount(which, np.concatenate([a[1] for a in asked])).astype(np.int64)
    place = np.empty(len(n), np.int64)
    place[np.argsort(-n, kind="stable")] = np.arange(len(n))
    edge = np.cumsum([0, *(len(a[0]) for a in asked)])
    return [_bundle([n[which[a:b]], place[which[a:b]]]) for a, b in zip(edge[:-1], edge[1:], strict=True)], n, []


def _count_grams(rows: list, m: int, d: np.ndarray, large: int) -> tuple[list[bytes], np.ndarray, list]:
    """Answers to ask, counts of counts, and the sums of histories that are split."""
    asked = [_unbundle(data) for _, data in rows]
    names = [np.concatenate([np.cumsum(a[0]) for a in asked]), *(np.concatenate([a[i] for a in asked]) for i in range(1, m))]
    own: list[np.ndarray] = []
    for j in range(3, 6):
        own.append(np.concatenate([a[m + j] for a in asked]))
    follow, c_h = (np.concatenate([a[m + j] for a in asked]) for j in (0, 1))
    scale = np.concatenate([a[m + 2] for a in asked]).view(np.float64)
    edge_h = np.cumsum([0, *(len(a[0]) for a in asked)])
    del asked
    which, at = None, None
    for x in names:
        _, at, which = _different(x if which is None else _pair(which, x))
    of = np.repeat(which, follow)
    words, trained, low = own
    edge = np.cumsum(np.append(0, follow))[edge_h]
    _, first, entry = _different(_pair(of, words))
    n = np.bincount(entry, trained).astype(np.int64)
    h = of[first]
    seen = n > 0
    lower = np.bincount(h[seen], discounted(low[first][seen], d) * scale[at][h[seen]], len(at))
    small = [np.bincount(h[n == r], minlength=len(at)) for r in range(1, K + 1)]
    answers = []
    for a, b, x, y in zip(edge[:-1], edge[1:], edge_h[:-1], edge_h[1:], strict=True):
        c = n[entry[a:b]]
        begin = np.cumsum(follow[x:y]) - follow[x:y]
        need = np.logical_or.reduceat(c == 0, begin)
        answers.append(_bundle([c, *(s[which[x:y]] for s in small), lower[which[x:y][need]]]))
    split = [([int(x[at[i]]) for x in names], [int(s[i]) for s in small], float(lower[i])) for i in np.flatnonzero(c_h[at] >= large)]
    return answers, n, split


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of whole numbers from 0."""
    most = int(b.max(initial=0)) + 1
    if (int(a.max(initial=0)) + 1) * most >= 1 << 63:
        b = _different(b)[2]
        most = int(b.max(initial=0)) + 1
    return a * most + b


def score(docs: DataFrame, held_out, *, order: int = 3, doc_id: str = "doc_id", text: str = "text", most_tokens: int = 2_000_000) -> DataFrame:
    """Every document's log10 probability under a Katz model of `order` words (2 or more) learnt from those where `held_out` is
    false: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    P(w | h) is c(hw) / c(h), discounted for counts up to K, if hw was seen; else the backoff weight of h times P(w | h without
    its first word), and so on down to the discounted share of w, or what these leave if w was not seen. Over all known words
    and the unknown one the probabilities of any history sum to 1. Words are told apart by 64-bit hashes, n-grams by the exact
    numbers of their words. Histories of very many tokens are split over partitions; the sums that their backoff weights need,
    of 20,000 histories an order at most, meet on the driver. Null and empty texts are the end token alone; a null `held_out`
    is false; repeated rows count each and ties need no rule, as only counts matter; other columns are not read, whatever
    their names; a text longer than a chunk is one by itself; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text"))
    base = materialize_buckets(chunks(rows, most_tokens), "chunks", "bid")
    n_all, n_begin = base.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_all // 2_000_000 + 1)
    large = LARGE
    told: list[DataFrame] = []
    splits: list[dict] = []
    factors: list[np.ndarray] = []
    uni = None

    def with_answers() -> DataFrame:
        """Chunks with all answers so far; only the answers are shuffled."""
        every = None
        for m, x in enumerate(told):
            x = x.filter("bid >= 0").select("bid", F.struct(F.lit(m).alias("m"), "part", "data").alias("a"))
            every = x if every is None else every.union(x)
        return base.join(every.groupBy("bid").agg(F.collect_list("a").alias("told")).hint("merge"), "bid") if told else base.withColumn("told", F.lit(None).cast("array<struct<m:int,part:int,data:binary>>"))

    def hearing(batches: Iterator[pa.RecordBatch], orders: int) -> Iterator[Chunk]:
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(j)[i].as_py() for j, name in enumerate(b.schema.names)}
                by: list[list] = [[] for _ in range(orders)]
                for a in row.pop("told") or []:
                    by[a["m"]].append((a["part"], a["data"]))
                chunk = Chunk(row, parts, n_begin)
                if orders:
                    chunk.hear_words(by[0])
                for m in range(1, orders):
                    chunk.grow()
                    chunk.hear(by[m], factors_[m], splits_[m], large)
                yield chunk
                del chunk, by, row  # one chunk at a time

    answer = pa.schema([("part", pa.int32()), ("bid", pa.int64()), ("data", pa.binary())])
    for m in range(order):
        uni_, factors_, splits_, large_ = uni, list(factors), list(splits), large

        def ask(batches: Iterator[pa.RecordBatch], m=m, uni_=uni_, large_=large_) -> Iterator[pa.RecordBatch]:
            for chunk in hearing(batches, m):
                for part, data in chunk.ask(uni_, large_) if m else chunk.ask_words():
                    yield pa.RecordBatch.from_pylist([{"part": part, "bid": chunk.bid, "data": data}], answer)
                del chunk

        def tell(batches: Iterator[pa.RecordBatch], m=m, below=factors[-1] if factors else None, large_=large_) -> Iterator[pa.RecordBatch]:
            for part, rows_ in _by_part(batches):
                answers, n, split = _count_grams(rows_, m, below, large_) if m else _count_words(rows_)
                for (bid, _), data in zip(rows_, answers, strict=True):
                    yield _told(bid, part, data)
                yield _told(-1, part, None, np.bincount(np.minimum(n, SEEN + 1), minlength=SEEN + 2).tolist(), int(n.sum()), int((n > 0).sum()))
                for names, small, lower in split:
                    yield _told(-2, part, None, [*names, *small], lower=lower)

        sent = with_answers().mapInArrow(ask, "part int, bid long, data binary")
        answers = sent.repartitionById(parts, "part").sortWithinPartitions("part", "bid").mapInArrow(tell, "bid long, part int, data binary, n array<long>, total long, types long, lower double")
        told.append(materialize(answers, f"order-{m + 1}"))
        sums = told[-1].filter("bid = -1").agg(F.sum("total").alias("total"), F.sum("types").alias("types"), *[F.sum(F.get("n", F.lit(i))).alias(f"n{i}") for i in range(1, SEEN + 1)]).first()
        of = {i: sums[f"n{i}"] or 0 for i in range(1, SEEN + 1)}
        factors.append(discounts(of))
        split: dict = {}
        for r in told[-1].filter("bid = -2").select("n", "lower").collect() if m else []:  # of 20,000 histories at most, in their parts
            s = split.setdefault(tuple(r.n[:m]), [np.zeros(K), 0.0])
            s[0] += np.array(r.n[m:])
            s[1] += r.lower
        splits.append(split)
        if not m:
            uni = Unigrams.of(sums.total or 0, sums.types or 0, of)
            large = max(LARGE, uni.total // 20_000)
    factors_, splits_ = list(factors), list(splits)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in hearing(batches, order):
            yield chunk.evaluate(uni, factors_[1:])
            del chunk

    return with_answers().mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_TOLD = pa.schema([("bid", pa.int64()), ("part", pa.int32()), ("data", pa.binary()), ("n", pa.list_(pa.int64())), ("total", pa.int64()), ("types", pa.int64()), ("lower", pa.float64())])


def _told(bid, part, data, n=None, total=None, types=None, lower=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"bid": bid, "part": part, "data": data, "n": n, "total": total, "types": types, "lower": lower}], _TOLD)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 10) == 0)
