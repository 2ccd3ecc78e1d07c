"""Profiles of features: numbers, categories, coverage, means per track."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, MapType, StructType

#: Groups whose quantiles are sent to all tasks.
MOST_GROUPS_SENT = 200_000


def unpivot(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """keys, feature, value: one row a feature, values as doubles; NaN and infinities become null."""
    v = df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(keys, features, "feature", "value")
    return v.withColumn("value", F.when(~F.isnan("value") & (F.abs("value") != float("inf")), F.col("value")))


def quantiles(df: DataFrame, by: list[str], value: str, probs: list[float], ranges: int = 256, most: int = 1 << 20) -> DataFrame:
    """by, q: the exact quantiles of each group, interpolated between neighbours as usual; null values don't count.

    Groups of at most `most` rows are counted by value and summed up in order, a group a task. For larger groups a sketch
    brackets each rank by a range of about 1/ranges of the rows, the ranges' totals tell which of them hold the ranks, and
    only rows of those are counted and sorted, a range a task. Sketch and totals are collected first (rows / `most` groups
    at most): a sketch depends on the order of its rows, so a plan that evaluates it twice may get two cuts of one group.
    Nulls are groups of their own.
    """
    g = F.struct(*by) if by else F.struct(F.lit(1).alias("all"))
    v = df.filter(F.col(value).isNotNull()).select(g.alias("_g"), F.col(value).cast("double").alias("_v"))
    key = v.schema["_g"].dataType
    ranks = lambda m: [(2 * i + j, f(p * (m - 1))) for i, p in enumerate(probs) for j, f in enumerate((math.floor, math.ceil))]
    row = StructType().add("_g", key).add("_m", "long").add("_b", ArrayType(DoubleType())).add("_before", MapType(IntegerType(), LongType()))
    sent = lambda rows: F.broadcast(df.sparkSession.createDataFrame(rows, row))
    large = [(x["_g"], x["_m"]) for x in v.groupBy("_g").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > most).collect()]
    around = sorted({min(1.0, max(0.0, p + d / (2 * ranges))) for p in probs for d in (-1, 1)})
    range_of = sum((F.coalesce((F.get("_b", F.lit(i)) < F.col("_v")).cast("int"), F.lit(0)) for i in range(len(around))), F.lit(0))
    if large:
        cuts = v.join(sent([(k, m, None, None) for k, m in large]).select("_g"), "_g", "left_semi").groupBy("_g").agg(F.percentile_approx("_v", around, 20 * ranges).alias("_b"))
        cut = {repr(x["_g"]): sorted(set(x["_b"])) for x in cuts.collect()}
        placed = v.join(sent([(k, m, cut[repr(k)], None) for k, m in large]), "_g").groupBy("_g", range_of.alias("_r")).agg(F.count(F.lit(1)).alias("_k"))
        held: dict = {}
        for x in placed.collect():
            held.setdefault(repr(x["_g"]), {})[x["_r"]] = x["_k"]
        asked = []
        for k, m in large:
            n = held[repr(k)]
            before = dict(zip(sorted(n), accumulate([n[r] for r in sorted(n)], initial=0)))
            asked.append((k, m, cut[repr(k)], {r: b for r, b in before.items() if any(b <= rank < b + n[r] for _, rank in ranks(m))}))
        v = v.join(sent(asked), "_g", "left").withColumn("_r", range_of).filter(F.col("_m").isNull() | F.map_contains_key("_before", F.col("_r")))
        v = v.select("_g", "_r", "_v", "_m", F.coalesce(F.try_element_at("_before", F.col("_r")), F.lit(0)).alias("_before"))
    else:
        v = v.select("_g", F.lit(0).alias("_r"), "_v", F.lit(None).cast("long").alias("_m"), F.lit(0).cast("long").alias("_before"))
    w = Window.partitionBy("_g", "_r")
    counted = v.groupBy("_g", "_r", "_v").agg(F.count(F.lit(1)).alias("_n"), F.max("_m").alias("_m"), F.max("_before").alias("_before"))
    summed = counted.withColumns({"_m": F.coalesce("_m", F.sum("_n").over(w)), "_upto": F.sum("_n").over(w.orderBy("_v")) + F.col("_before")})
    at = lambda p: F.lit(float(p)) * (F.col("_m") - 1)
    wanted = F.array(*[F.struct(F.lit(2 * i + j).alias("i"), f(at(p)).cast("long").alias("rank")) for i, p in enumerate(probs) for j, f in enumerate((F.floor, F.ceil))])
    found = summed.select("_g", "_m", "_v", F.explode(F.filter(wanted, lambda x: (x["rank"] < F.col("_upto")) & (x["rank"] >= F.col("_upto") - F.col("_n")))["i"]).alias("_i"))
    of = found.groupBy("_g").agg(F.first("_m").alias("_m"), F.map_from_entries(F.collect_list(F.struct("_i", "_v"))).alias("_q"))  # two entries a quantile
    low = lambda i: F.element_at("_q", F.lit(2 * i))
    q = [low(i) + (at(p) - F.floor(at(p))) * (F.element_at("_q", F.lit(2 * i + 1)) - low(i)) for i, p in enumerate(probs)]
    return of.select(*[F.col(f"_g.{c}").alias(c) for c in by], F.array(*q).alias("q"))


def with_quantiles(df: DataFrame, of: DataFrame, by: list[str], each: bool = False) -> DataFrame:
    """df with the q of its group, null where it has none; null keys meet. each: df has one row a group.

    Otherwise groups are counted first, as no estimate tells how few rows quantiles has: they are sent to all tasks while they
    are few, because a join by group would put each group's rows into one task."""
    other = of.select(*[F.col(c).alias(f"_q_{c}") for c in by], "q")
    keys = [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in by]
    if by and not each and df.agg(F.approx_count_distinct(F.struct(*by))).first()[0] <= MOST_GROUPS_SENT:
        other = F.broadcast(other)
    return (df.join(other, keys, "left") if by else df.crossJoin(F.broadcast(other))).select(*df.columns, "q")


def numeric_profile(long: DataFrame, by: list[str]) -> DataFrame:
    """count, mean, median, population deviation, range, quartiles, and how many values lie over 1.5 interquartile ranges outside.
    Groups of all nulls give count 0 and nulls. After the quantiles, one pass."""
    rows = with_quantiles(long, quantiles(long, by, "value", [0.25, 0.5, 0.75]), by)
    iqr = F.col("q")[2] - F.col("q")[0]
    outside = (F.col("value") < F.col("q")[0] - 1.5 * iqr) | (F.col("value") > F.col("q")[2] + 1.5 * iqr)
    s = rows.groupBy(*by).agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), *[F.max(F.col("q")[i]).alias(n) for i, n in enumerate(("q1", "median", "q3"))], F.count_if(outside).alias("outliers"))
    return s.select(*by, "count", "mean", "median", "min", "max", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "std", "outliers", (100.0 * F.col("outliers") / F.nullif(F.col("count"), F.lit(0))).alias("outlier_pct"))


def iqr_outliers(df: DataFrame, value: str, by: list[str], keep: list[str]) -> DataFrame:
    """The rows outside 1.5 interquartile ranges of their group."""
    q = quantiles(df, by, value, [0.25, 0.75])
    lo, hi = 2.5 * F.col("q")[0] - 1.5 * F.col("q")[1], 2.5 * F.col("q")[1] - 1.5 * F.col("q")[0]
    return with_quantiles(df, q, by).filter((F.col(value) < lo) | (F.col(value) > hi)).select(*keep, value)


def top_categories(df: DataFrame, category: Column, n: int = 10) -> DataFrame:
    """value, n, share in percent, rank of the n most frequent values; ties by value. One partially aggregated shuffle."""
    c = df.select(category.alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    total = c.agg(F.sum("n").alias("total"))
    top = c.orderBy(F.desc("n"), "value").limit(n)
    return top.crossJoin(F.broadcast(total)).select("value", "n", (100.0 * F.col("n") / F.col("total")).alias("pct"), F.row_number().over(Window.orderBy(F.desc("n"), "value")).alias("rank"))


def coverage(pairs: DataFrame, total: int | Column, key: str = "key", value: str = "value") -> DataFrame:
    """Per key: rows that have it (explicit nulls too), share to one decimal, range of its numbers."""
    number = F.col(value).try_cast("double")
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("min"), F.max(number).alias("max")).withColumn("pct", F.round(100.0 * F.col("n") / total, 1))


def group_means(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.avg(f).alias(f) for f in features], F.count(F.lit(1)).alias("n_crops"))


def wide(long: DataFrame, row: str, key: str, value: str, keys: list[str]) -> DataFrame:
    """Rows by key, one column a listed key; listing them spares the pass that finds them."""
    return long.groupBy(row).pivot(key, keys).agg(F.first(value, ignorenulls=True))
