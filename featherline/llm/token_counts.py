"""Token counts: an exact histogram of encoded lengths whose suffix sums answer every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featherline.llm.common import materialize, table
from featherline.llm.encode import default_path, encoder


def encoded_lengths(docs: DataFrame, *, text: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """(length, n_docs): documents by the number of ids of their whole text, counted once per batch before the shuffle.

    A null text has length 0, as an empty one. Repeated rows count as often as they occur. An empty table gives no rows.
    """
    path = tokenizer_path or default_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [counts for _, counts in enc.blocks(b.column(0))]
            lengths, docs_ = np.unique(np.concatenate(n) if n else np.empty(0, np.int64), return_counts=True)
            yield pa.record_batch({"length": lengths, "n_docs": docs_.astype(np.int64)})

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "length long, n_docs long").groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """Adds, for the context limit `length`: docs_over (documents longer than it), tokens_over (their tokens),
    tokens_total (of all documents), truncated_total (tokens left if each document is cut at the limit), docs_rank (documents
    of at most that length). The histogram, which two joined parts read, is written first, so texts are encoded once. Sums run within blocks of lengths and over the blocks' totals, so no task reads all lengths.
    """
    h = materialize(histogram, "lengths").withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("_block", F.floor(F.col("length") / block))
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = h.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    totals = totals.select("_block", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_da"), F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_ta"), F.sum("_d").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"), F.sum("_t").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("tokens_total"))
    longer = Window.partitionBy("_block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    out = h.join(totals, "_block").withColumns({"docs_over": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("_da"), "tokens_over": F.coalesce(F.sum("n_tokens").over(longer), F.lit(0)) + F.col("_ta")})
    return out.select("length", "n_docs", "n_tokens", "docs_over", "tokens_over", "tokens_total", (F.col("tokens_total") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("truncated_total"), (F.col("_all") - F.col("docs_over")).alias("docs_rank"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left of all documents if each is cut at the limit; 0 for an empty table."""
    at = sums.filter(F.col("length") <= limit).agg(F.max_by(F.struct("docs_over", "tokens_over", "tokens_total"), "length")).first()[0]
    if at is None:
        n = sums.agg(F.sum("n_docs")).first()[0]
        return limit * (n or 0)
    return at.tokens_total - at.tokens_over + limit * at.docs_over


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least a share q of the documents don't exceed."""
    n = F.col("docs_rank") + F.col("docs_over")
    return sums.filter(F.col("docs_rank") >= q * n).agg(F.min("length")).first()[0]


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(encoded_lengths(table(spark, sf_dir, "documents")))
