"""Ordered events: intervals, islands, densities, entropy, band, as-of and nearest joins. Times are double seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(events: DataFrame, key: str = "track", t: str = "t", tie: str | None = None) -> DataFrame:
    """Adds gap: seconds since the key's previous event, null for the first."""
    w = Window.partitionBy(key).orderBy(t, *([tie] if tie else []))
    return events.withColumn("gap", F.col(t) - F.lag(t).over(w))


def interval_stats(gaps: DataFrame, key: str = "track") -> DataFrame:
    """n, mean, coefficient of variation and evenness of gaps; fewer than 2 or a mean of 0 give cv 0 and evenness 1."""
    g = gaps.groupBy(key).agg(F.count("gap").alias("n"), F.avg("gap").alias("mean"), F.stddev_pop("gap").alias("std"))
    cv = F.when((F.col("n") >= 2) & (F.col("mean") != 0), F.col("std") / F.col("mean")).otherwise(F.lit(0.0))
    return g.withColumn("cv", cv).withColumn("evenness", 1 / (1 + F.col("cv")))


def interval_entropy(gaps: DataFrame, bins: int = 50, key: str = "track") -> DataFrame:
    """Entropy (nats) of gaps over equal bins of [min, max], the last bin closed; equal gaps fall in one bin.

    Bins are counted by (key, bin), so no gaps of a key are gathered.
    """
    g = gaps.filter("gap is not null").select(key, "gap")
    edge = g.groupBy(key).agg(F.min("gap").alias("lo"), F.max("gap").alias("hi"))
    b = g.join(edge, key).select(key, F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("gap") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(F.lit(bins // 2)).alias("bin"))
    n = b.groupBy(key, "bin").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy(key).agg(F.sum("n").alias("m"))
    p = F.col("n") / F.col("m")
    return n.join(total, key).groupBy(key).agg(F.abs(F.sum(-p * F.ln(p))).alias("entropy"), F.max("m").alias("n_gaps"))


def complexity(entropy: Column, cv: Column) -> Column:
    return (F.least(entropy / 5, F.lit(1.0)) + F.least(cv / 2, F.lit(1.0))) / 2


def stable_segments(gaps: DataFrame, threshold: float, least: int = 4, key: str = "track", t: str = "t", tie: str | None = None) -> DataFrame:
    """Runs of at least `least` gaps whose neighbours differ by at most the threshold: first place, the place after the last, size, deviation."""
    order = [t, *([tie] if tie else [])]
    w = Window.partitionBy(key).orderBy(*order)
    g = gaps.filter("gap is not null").withColumn("i", F.row_number().over(w) - 1).withColumn("_b", F.coalesce(F.abs(F.col("gap") - F.lag("gap").over(w)) > threshold, F.lit(False)).cast("int"))
    g = g.withColumn("segment", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy(key, "segment").agg(F.min("i").alias("first"), (F.max("i") + 1).alias("end"), F.count(F.lit(1)).alias("n"), F.stddev_pop("gap").alias("std")).filter(F.col("n") >= least).drop("segment")


def islands(events: DataFrame, gap: float, key: str = "track", t: str = "t", tie: str | None = None) -> DataFrame:
    """Runs of events no more than `gap` apart: start, end, n."""
    w = Window.partitionBy(key).orderBy(t, *([tie] if tie else []))
    e = events.withColumn("_b", F.coalesce(F.col(t) - F.lag(t).over(w) > gap, F.lit(True)).cast("int")).withColumn("island", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy(key, "island").agg(F.min(t).alias("start"), F.max(t).alias("end"), F.count(F.lit(1)).alias("n"))


def window_density(events: DataFrame, spans: DataFrame, size: float, step: float, key: str = "track", t: str = "t") -> DataFrame:
    """Mean and population variance of events a second over sliding windows from 0 until each key's duration.

    spans: key, duration. The last windows end at the duration; empty windows count. Events meet the windows that hold them by
    window number (size / step rows an event), not by a range join.
    """
    last = F.ceil(F.col("duration") / step) - 1
    w = spans.filter("duration > 0").select(key, "duration", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("i"))
    lo = F.greatest(F.lit(0), F.floor((F.col(t) - size) / step) + 1)
    e = events.filter(F.col(t) >= 0).select(key, F.col(t).alias("_t"), F.explode(F.sequence(lo.cast("int"), F.floor(F.col(t) / step).cast("int"))).alias("i"))
    n = e.groupBy(key, "i").agg(F.count(F.lit(1)).alias("n"))
    rate = F.coalesce("n", F.lit(0)) / (F.least(F.col("i") * step + size, F.col("duration")) - F.col("i") * step)
    return w.join(n, [key, "i"], "left").select(key, rate.alias("rate")).groupBy(key).agg(F.avg("rate").alias("mean_rate"), F.var_pop("rate").alias("var_rate"), F.count(F.lit(1)).alias("n_windows"))


def near_any(left: DataFrame, right: DataFrame, tolerance: float, key: str = "track", t: str = "t", row: str = "row") -> DataFrame:
    """left rows with `near`: whether the key has an event of right within the tolerance. Times meet in cells of the tolerance and their neighbours, an equi-join."""
    cell = F.floor(F.col(t) / tolerance).cast("long")
    r = right.select(F.col(key).alias("_k"), F.col(t).alias("_t"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_c"))
    found = left.select(row, key, t, cell.alias("_c2")).join(r, (F.col(key) == F.col("_k")) & (F.col("_c2") == F.col("_c")) & (F.abs(F.col(t) - F.col("_t")) <= tolerance)).select(row).distinct()
    return left.join(found.withColumn("near", F.lit(True)), row, "left").withColumn("near", F.coalesce("near", F.lit(False)))


def asof(left: DataFrame, right: DataFrame, key: str, lt: str, rt: str, value: str, slack: float = 0.0) -> DataFrame:
    """left with the value of the key's last right row at or before lt + slack: both sides in one sorted window, one shuffle, no range join."""
    l_ = left.withColumn("_t", F.col(lt) + F.lit(slack)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(1)).withColumn("_row", F.struct(*left.columns))
    r = right.select(F.col(key), F.col(rt).alias("_t"), F.col(value).alias("_v"), F.lit(0).alias("_side"), F.lit(None).cast(l_.schema["_row"].dataType).alias("_row"))
    both = l_.select(key, "_t", "_v", "_side", "_row").unionByName(r)
    w = Window.partitionBy(key).orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_last", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").select("_row.*", F.col("_last").alias(f"{value}_before"))


def inside(events: DataFrame, spans: DataFrame, key: str, t: str, start: str, end: str, slack: float = 0.0) -> DataFrame:
    """Events within their key's closed spans, with times from the span's start."""
    j = events.join(spans, key).filter((F.col(t) >= F.col(start) - slack) & (F.col(t) <= F.col(end) + slack))
    return j.withColumn("offset", F.round(F.col(t) - F.col(start), 5))


def beats_per_minute(gaps: DataFrame, key: str = "track") -> DataFrame:
    """bpm and validity: at least 15 beats, 40 to 300 bpm, deviation of at most 0.15 s; 120 where there is no gap."""
    g = gaps.groupBy(key).agg(F.count("gap").alias("n"), F.avg("gap").alias("mean"), F.stddev_pop("gap").alias("std"))
    bpm = 60 / F.nullif(F.col("mean"), F.lit(0.0))
    return g.select(key, F.coalesce(bpm, F.lit(120.0)).alias("bpm"), F.coalesce((F.col("n") + 1 >= 15) & bpm.between(40, 300) & (F.col("std") <= 0.15), F.lit(False)).alias("defined"))


def density(events: DataFrame, spans: DataFrame, key: str = "track") -> DataFrame:
    """key, density: events a second of the key's duration; 0 without one."""
    n = events.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return spans.join(n, key, "left").select(key, F.when(F.col("duration") <= 0, F.lit(0.0)).otherwise(F.coalesce("_n", F.lit(0)) / F.col("duration")).alias("density"))


def nearest(left: DataFrame, right: DataFrame, key: str = "track", t: str = "t") -> DataFrame:
    """left with `nearest`: the key's time in right nearest to t, the earlier on ties, null without any. Both sides in one sorted window; no range join."""
    rows = left.withColumns({"_t": F.col(t), "_side": F.lit(1), "_row": F.struct(*left.columns)}).select(key, "_t", "_side", "_row")
    marks = right.select(key, F.col(t).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(key).orderBy("_t", "_side")
    mark = F.when(F.col("_side") == 0, F.col("_t"))
    both = rows.unionByName(marks).withColumns({"_a": F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_b": F.first(mark, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    best = F.when(F.col("_b").isNull() | (F.col("_t") - F.col("_a") <= F.col("_b") - F.col("_t")), F.col("_a")).otherwise(F.col("_b"))
    return both.filter("_side = 1").select("_row.*", F.coalesce(best, F.col("_b")).alias("nearest"))


def subdivided(events: DataFrame, parts: int, key: str = "track", t: str = "t", tie: str | None = None) -> DataFrame:
    """Every event but a key's last, in equal parts until the next one: j and t."""
    w = Window.partitionBy(key).orderBy(t, *([tie] if tie else []))
    n = events.withColumn("_n", F.lead(t).over(w)).filter("_n is not null").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return n.withColumn(t, F.col(t) + F.col("j") * (F.col("_n") - F.col(t)) / parts).drop("_n")


def validated_tempo(gaps: DataFrame, share: float = 0.1, deviation: float = 0.15, step: float = 0.05, key: str = "track", t: str = "t", tie: str | None = None) -> DataFrame:
    """bpm, stable (seconds in stable segments) and validity: at least 15 beats, 40 to 300 bpm, and gaps that deviate by at most
    `deviation`, over all or, failing that, in stable segments that make up at least `share` of the time."""
    a = gaps.groupBy(key).agg(F.count("gap").alias("_n"), F.avg("gap").alias("_m"), F.stddev_pop("gap").alias("_s"), F.sum("gap").alias("_total"))
    w = Window.partitionBy(key).orderBy(t, *([tie] if tie else []))
    g = gaps.filter("gap is not null").withColumn("_b", F.coalesce(F.abs(F.col("gap") - F.lag("gap").over(w)) > step, F.lit(False)).cast("int"))
    s = g.withColumn("_k", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(key, "_k").agg(F.count(F.lit(1)).alias("_n"), F.sum("gap").alias("_d"), F.stddev_pop("gap").alias("_s"))
    s = s.filter((F.col("_n") >= 4) & (F.col("_s") <= deviation)).groupBy(key).agg(F.sum("_d").alias("_stable"))
    bpm, stable = 60 / F.nullif(F.col("_m"), F.lit(0.0)), F.coalesce("_stable", F.lit(0.0))
    valid = (F.col("_n") + 1 >= 15) & bpm.between(40, 300) & ((F.col("_s") <= deviation) | (stable >= share * F.col("_total")))
    return a.join(s, key, "left").select(key, F.coalesce(bpm, F.lit(120.0)).alias("bpm"), F.coalesce(valid, F.lit(False)).alias("defined"), stable.alias("stable"))
