"""Benchmark decontamination by winnowing: least k-gram hashes of sliding windows, joined and extended."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import lean, materialize, row_ids, table, unused

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_MULTIPLY = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: More rows of benchmark fingerprints than this are not sent to the tasks; then all document fingerprints take part in the join.
MOST_SENT = 2_000_000


def contract_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z were lowered, as UTF-8; null has none."""
    return _WORDS.findall(text.encode("utf-8", "replace").lower()) if text else []


class WordHashes(dict):
    """64-bit hashes of words; at most 200,000 are remembered (about 30 MB)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, own: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, own), np.uint64, len(own))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Mixed hashes of all k-grams of word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(_MULTIPLY) + h[j : j + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Places of grams that are the least of some w grams in a row (all of equal ones); all places if there are fewer than w."""
    n = len(grams) - w + 1
    if n <= 0:
        return np.arange(len(grams))
    least = grams[:n].copy()
    for j in range(1, w):
        np.minimum(least, grams[j : j + n], out=least)
    keep = np.zeros(len(grams), bool)
    for j in range(w):
        keep[j : j + n] |= grams[j : j + n] == least
    return np.flatnonzero(keep)


def _marks(own: list[bytes], h: np.ndarray, k: int, window: int, short: list[int], sent: np.ndarray | None) -> list[dict]:
    """The fingerprints of a text with the words around them: of winnowing, and of each length of short items."""
    out = []
    for size, every in [(k, False), *((n, True) for n in short)]:
        g = gram_hashes(h, size)
        at = np.arange(len(g)) if every else winnow(g, window - k + 1)
        if sent is not None and len(at):
            found = np.minimum(np.searchsorted(sent, g[at]), len(sent) - 1) if len(sent) else None
            at = at[sent[found] == g[at]] if found is not None else at[:0]
        reach = 0 if every else window - k
        for p in at.tolist():
            out.append({"size": size, "h": int(g[p].view(np.int64)), "pos": p, "gram": b" ".join(own[p : p + size]), "left": own[max(0, p - reach) : p][::-1], "right": own[p + size : p + size + reach]})
    return out


_MARK = "struct<size:int,h:bigint,pos:int,gram:binary,left:array<binary>,right:array<binary>>"


def hits(docs: DataFrame, items: DataFrame, *, window: int = 10, k: int = 6, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, spans): every document with a row id and its number of words; each span of a document's words, from first to
    past, that lies in an occurrence of a window of an item.

    A window is `window` words of an item in a row, or all of an item that has fewer. Winnowing keeps the least hash of any
    window - k + 1 k-grams in a row, on both sides, so each shared window has a shared fingerprint; the words next to it are
    compared, so a hash alone never makes a hit. Items shorter than a window are fingerprinted whole. The benchmark's
    fingerprints prune the documents' own while they are few (MOST_SENT); beyond that all go into the join, which spreads by
    fingerprint. Nulls and empty texts have no words; items without words have no windows.
    """
    spark = docs.sparkSession

    def mark(sent: np.ndarray | None, short: list[int] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, seen = row_ids(), WordHashes()
            rows = []
            flat = pa.schema([("rid", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("marks", pa.list_(pa.struct([("size", pa.int32()), ("h", pa.int64()), ("pos", pa.int32()), ("gram", pa.binary()), ("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary()))])))])
            for b in batches:
                for key, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    own = contract_words(x.as_py())
                    if short is None:  # an item
                        whole = 0 < len(own) < window
                        marks = _marks(own, seen.of(own), len(own) if whole else k, len(own) if whole else window, [], None) if own else []
                    else:
                        marks = _marks(own, seen.of(own), k, window, short, sent)
                    rows.append({"rid": next(ids), "id": key, "n_words": len(own), "marks": marks})
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, flat)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, flat)

        return run

    schema = f"rid long, id long, n_words long, marks array<{_MARK}>"
    own_items = materialize(items.select(F.col(item_id).cast("long"), F.col(item_text)).mapInArrow(lean(mark(None, None)), schema), "benchmark")
    item_marks = own_items.select(F.col("id").alias("item_id"), F.explode("marks").alias("i")).select("item_id", "i.*")
    short = sorted(r.n_words for r in own_items.filter((F.col("n_words") < window) & (F.col("n_words") > 0)).select("n_words").distinct().collect())
    distinct = item_marks.select("h").distinct()
    few = item_marks.count() <= MOST_SENT
    sent = np.sort(np.array([r.h for r in distinct.collect()], np.int64).view(np.uint64)) if few else None
    texts = materialize(docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(lean(mark(sent, short)), schema), "doc-marks")
    found = texts.select("rid", F.explode("marks").alias("d")).select("rid", *[F.col(f"d.{c}").alias(c) for c in ("h", "size", "pos", "gram", "left", "right")])
    of_items = item_marks.select("item_id", F.col("h").alias("ih"), F.col("size").alias("isize"), F.col("gram").alias("igram"), F.col("left").alias("ileft"), F.col("right").alias("iright"))
    if few:
        of_items = F.broadcast(of_items)  # at most MOST_SENT rows of at most window words
    pairs = found.join(of_items, (F.col("h") == F.col("ih")) & (F.col("size") == F.col("isize")) & (F.col("gram") == F.col("igram")))
    reach = window - k

    def run_length(a: str, b: str):
        """How many words agree from the gram outwards."""
        same, total = F.lit(True), F.lit(0)
        for j in range(reach):
            same = same & F.coalesce(F.get(a, F.lit(j)) == F.get(b, F.lit(j)), F.lit(False))
            total = total + same.cast("int")
        return total

    left, right = run_length("left", "ileft"), run_length("right", "iright")
    spans = pairs.select("rid", "item_id", "pos", "size", left.alias("l"), right.alias("r"), (F.size("ileft") + F.size("iright")).alias("beside"))
    complete = (F.col("l") + F.col("size") + F.col("r") >= window) | (F.lit(bool(short)) & F.col("size").isin(short or [0]) & (F.col("beside") == 0))
    spans = spans.filter(complete).select("rid", "item_id", (F.col("pos") - F.col("l")).alias("first"), (F.col("pos") + F.col("size") + F.col("r")).alias("past"))
    return texts.select("rid", F.col("id").alias("doc_id"), "n_words"), spans


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: n_words, n_hit (words inside occurrences of windows), n_items, items (their ids as strings, sorted), contaminated.

    Repeated rows are told apart by row ids; a null id is kept. Extra columns are not read.
    """
    texts, spans = hits(docs, items, **options)
    spans = materialize(spans.distinct(), "spans")
    n_hit = spans.select("rid", "first", "past").distinct().select("rid", F.explode(F.sequence("first", F.col("past") - 1)).alias("p")).distinct().groupBy("rid").agg(F.count("p").alias("n_hit"))
    of = spans.groupBy("rid").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    out = texts.join(n_hit, "rid", "left").join(of, "rid", "left")
    n, items_ = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long"), F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select("rid", "doc_id", "n_words", n.alias("n_hit"), F.size(items_).cast("long").alias("n_items"), items_.alias("items"), (n > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """Rows of docs, with all their columns, whatever their names, that hold no window of an item. Texts are told apart by
    64-bit hashes; null and empty texts, which hold none, stay; repeated rows go or stay together; empty tables work."""
    found = contamination(docs.select(F.xxhash64(F.col(f"`{text}`")).alias("doc_id"), F.col(f"`{text}`").alias("text")), items, **options).filter("contaminated")
    own, other = unused(docs.columns, "hash", "found")
    found = materialize(found.select(F.col("doc_id").alias(other)).distinct(), "contaminated")
    few = found.count() <= MOST_SENT
    hashed = docs.withColumn(own, F.xxhash64(F.col(f"`{text}`")))
    return hashed.join(F.broadcast(found) if few else found, F.col(own) == F.col(other), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")
