"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import materialize, table, words

#: (name, value of which feature, bad if below, good from, good to, bad if above); between them the rule abstains.
RULES = (
    ("words", "n_words", 10, 40, math.inf, math.inf),
    ("repeats", "repeat_share", -1, -1, 0.05, 0.15),
    ("symbols", "symbols_a_word", -1, -1, 0.02, 0.1),
    ("same_lines", "dup_line_share", -1, -1, 0.1, 0.3),
    ("capitals", "capital_share", -1, -1, 0.12, 0.4),
    ("word_length", "mean_word", 2.2, 3.0, 11.0, 14.0),
    ("letters", "letter_share", 0.6, 0.75, 1.01, 1.01),
    ("line_ends", "ended_line_share", 0.1, 0.5, 1.01, 1.01),
    ("plain_words", "plain_word_share", 0.6, 0.8, 1.01, 1.01),
)
SYMBOLS = "#*$%&|<>"
#: Chances of the votes abstain, bad, good under the classes bad and good before any text is seen.
START = np.array([[0.2, 0.3, 0.5], [0.15, 0.01, 0.84]])
LEAN = 3.0
_ENDS = (".", "!", "?", "…", '"', "»", ":", ";", ")")


def text_features(text: str | None) -> dict[str, float]:
    """Counts and shares of a whole text; an empty or null one has no words and zeros."""
    text = text or ""
    own = words(text)
    n = len(own)
    chars = sum(map(len, own))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = dup = ended = 0
    for line in text.split("\n"):
        if words(line):
            lines += 1
            dup += line in seen
            seen.add(line)
            ended += line.rstrip().endswith(_ENDS)
    letters = sum(map(str.isalpha, text))
    plain = sum(w.strip(".,;:!?\"'()").isalpha() for w in own)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeated_words(own),
        "symbols_a_word": symbols / max(1, n), "dup_line_share": dup / max(1, lines), "mean_word": chars / max(1, n), "letter_share": letters / max(1, chars),
        "ended_line_share": ended / max(1, lines), "plain_word_share": plain / max(1, n), "capital_share": sum(map(str.isupper, text)) / max(1, letters),
    }


def repeated_words(own: list[str], k: int = 5) -> int:
    """Words in windows of k words that the list holds twice or more, the first such window included."""
    n = len(own)
    if n <= k:
        return 0
    number: dict[str, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in own), np.int64, n)
    ids = one
    for j in range(1, k):  # windows of j + 1 words, numbered without collisions
        ids = np.unique(ids[:-1] * len(number) + one[j:], return_inverse=True)[1]
        if len(ids) and ids.max() + 1 == len(ids):
            return 0
    again = np.bincount(ids)[ids] > 1
    hit = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + k, -1)
    return int((np.cumsum(hit[:-1]) > 0).sum())


def votes(f: dict[str, float]) -> list[int]:
    """0 abstain, 1 bad, 2 good, by rule."""
    f = f | {"repeat_share": f["n_repeat_words"] / max(1, f["n_words"])}
    out = []
    for _, key, low, good_from, good_to, high in RULES:
        x = f[key]
        out.append(1 if x < low or x > high else 2 if good_from <= x <= good_to else 0)
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good texts, chance of each vote by class (rule, class bad/good, vote), posterior of good by pattern.

    Expectation-maximisation of independent votes given the class. It starts from rules that seldom call a good text bad but
    find only some of the bad ones (START); a rule keeps its sense: its bad votes stay at least LEAN times likelier, and its
    good votes no likelier, under bad. Two texts' worth of START keep chances above 0. With no texts START stays.
    """
    n, m = patterns.shape
    cast = np.stack([patterns == v for v in range(3)], 2).astype(float)  # pattern, rule, vote
    theta, good = np.repeat(START[None], m, 0), 0.85
    p = np.full(n, good)
    for _ in range(rounds):
        each = np.log(theta[:, 1] / theta[:, 0])  # rule, vote
        each[:, 0] = 0  # an abstention says nothing
        odds = math.log(good) - math.log1p(-good) + np.einsum("nmv,mv->n", cast, each)
        p = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        new = np.stack([np.einsum("n,nmv->mv", counts * q, cast) for q in (1 - p, p)], 1) + 2 * START
        new /= new.sum(2, keepdims=True)
        new[:, 1, 1] = np.minimum(new[:, 1, 1], new[:, 0, 1] / LEAN)
        new[:, 1, 2] = np.maximum(new[:, 1, 2], new[:, 0, 2])
        new[:, 1] /= new[:, 1].sum(1, keepdims=True)
        good = float(np.clip((counts @ p + 8) / (counts.sum() + 10), 0.01, 0.99))
        moved = np.abs(new - theta).max(initial=0)
        theta = new
        if moved < 1e-7:
            break
    return good, theta, p


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Features, vote pattern and posterior quality of every document; `good` where it is `threshold` or more.

    The votes of a text are one number in base 3; the model is fitted to the counts of these numbers over all documents (at
    most 3 to the number of rules, whatever the table's size), and their posteriors join back. Nulls and empty texts vote as
    texts of no words; repeated rows count each; an empty table gives no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fs = [text_features(x.as_py()) for x in b.column(1)]
            pattern = [sum(v * 3**i for i, v in enumerate(votes(f))) for f in fs]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([f[n] for f in fs], pa.int64()) for n in names], pa.array(pattern, pa.int32())], names=["doc_id", *names, "pattern"])

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", pattern int"
    base = materialize(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(measure, schema), "quality")
    rows = sorted(tuple(r) for r in base.groupBy("pattern").count().collect())
    codes = np.array([r[0] for r in rows], np.int64).reshape(-1)
    table_ = np.stack([codes // 3**i % 3 for i in range(len(RULES))], 1) if len(rows) else np.zeros((0, len(RULES)), int)
    _, _, p = label_model(table_, np.array([r[1] for r in rows], float))
    post = base.sparkSession.createDataFrame([(int(c), float(x)) for c, x in zip(codes, p, strict=True)], "pattern int, posterior double")
    return base.join(F.broadcast(post), "pattern", "left").withColumn("good", F.col("posterior") >= threshold)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "posterior")
