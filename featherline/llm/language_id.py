"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, fitted by FTRL, then calibrated."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import fold, lean, table

SPACE = 1 << 16  # hashed n-grams
_OTHER = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> np.ndarray:
    """Hashed 1-, 2- and 3-grams of the letters of a whole text, runs of anything else being one space; empty without letters."""
    text = _OTHER.sub(" ", text or "")
    if not text.replace(" ", "").isalpha():  # \w also takes numerals such as Roman ones and fractions, which are no letters
        text = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text))
    text = text.strip().lower()
    if not text:
        return np.empty(0, np.uint16)
    a = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
    one = a * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (a[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (a[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    return np.concatenate([one >> np.uint32(16), two >> np.uint32(16), three >> np.uint32(16)]).astype(np.uint16)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # SPACE x languages, inverse document frequencies multiplied in
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        g = grams(text)
        if not len(g) or not self.langs:
            return "und", 0.0
        if len(g) < SPACE // 8:
            z = self.weights.take(g, 0).mean(0, dtype=np.float64)
        else:  # long texts by counts, so that memory doesn't grow with them
            z = np.bincount(g, minlength=SPACE) @ self.weights / len(g)
        z = (z + self.bias) / self.temperature
        e = np.exp(z - z.max())
        i = int(e.argmax())
        return self.langs[i], float(e[i] / e.sum())


def ftrl(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, *, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader with per-coordinate rates and elastic net, one example at a time in a fixed order."""
    z, n = np.zeros((SPACE + 1, classes)), np.zeros((SPACE + 1, classes))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for e in order.permutation(len(examples)):
            idx, val = examples[e]
            i = np.append(idx, SPACE)
            x = np.append(val, 1.0)
            w = weights(i)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[e]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(SPACE + 1))
    return w[:-1], w[-1]


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, from 0.05 to 20; 1 without examples."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / t
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    return float(min(np.geomspace(0.05, 20, 121), key=loss))


def fit(train: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 800) -> Model:
    """Fit on rows with a language.

    Document frequencies of the n-grams are counted over all of them; regression uses about `per_language` rows of each
    language (all if there are fewer), chosen by a hash of the key, a fifth of which sets the temperature instead.
    """
    rows = train.filter(F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((SPACE, 0)), np.zeros(0), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, mark, docs = np.zeros(SPACE + 1, np.int64), np.zeros(SPACE, bool), 0
        for b in batches:
            for x in b.column(0):
                g = grams(x.as_py())
                mark[g] = True
                df[:-1] += mark
                mark[g] = False
                df[-1] += 1
        at = np.flatnonzero(df)
        yield pa.record_batch({"gram": at.astype(np.int32), "n": df[at]})

    df = np.zeros(SPACE + 1)
    for r in rows.select("text").mapInArrow(lean(frequencies), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most SPACE + 1 rows
        df[r.gram] = r.n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_language / n))]), F.col("lang"))
    u = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, name, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                i, c = np.unique(grams(x), return_counts=True)
                if len(i):
                    out.append({"u": k, "lang": name, "idx": i.tobytes(), "tf": (c / c.sum()).astype(np.float32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("u", pa.float64()), ("lang", pa.string()), ("idx", pa.binary()), ("tf", pa.binary())]))

    sample = sorted(rows.withColumn("u", u).filter(F.col("u") < share).select("u", "lang", "text").mapInArrow(lean(vectors), "u double, lang string, idx binary, tf binary").collect(), key=lambda r: (r.u, r.lang, bytes(r.idx)))
    scale = 30.0  # relative frequencies are small
    ex = [(np.frombuffer(r.idx, np.uint16).astype(np.int64), np.frombuffer(r.tf, np.float32).astype(float)) for r in sample]
    ex = [(i, v * idf[i] * scale) for i, v in ex]
    y = np.array([langs.index(r.lang) for r in sample], int)
    held = np.arange(len(ex)) % 5 == 4
    w, bias = ftrl([e for e, h in zip(ex, held, strict=True) if not h], y[~held], len(langs))
    logits = np.array([v @ w[i] + bias for (i, v), h in zip(ex, held, strict=True) if h]).reshape(-1, len(langs))
    return Model(langs, (w * idf[:, None] * scale).astype(np.float32), bias, best_temperature(logits, y[held]))


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, lang_pred and score of every row; `und` with score 0 for a null text or one without letters."""
    model_ = model
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model_.predict(x.as_py()) for x in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, F.col(text)).mapInArrow(lean(run), schema)


def keep_known(docs: DataFrame, model: Model, *, text: str = "text", least: float = 0.4) -> DataFrame:
    """Rows of docs, with all their columns, whose text has letters and a language of at least that score. A model without languages keeps all texts with letters."""
    model_, at = model, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x in b.column(at):
                lang, p = model_.predict(x.as_py())
                keep.append(lang != "und" and p >= least if model_.langs else len(grams(x.as_py())) > 0)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = fit(docs.filter(~F.col("held_out")))
    return predict(docs, model, keep=("doc_id", "held_out"))
