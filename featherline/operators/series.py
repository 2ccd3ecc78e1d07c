"""Series of frames: zero-padded means, levels, crossings, loud spans, frame correlations, pitch snapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherline.operators.events import islands
from featherline.operators.profile import quantiles, with_quantiles
from featherline.operators.stats import correlation, fisher_mean


def padded_mean(df: DataFrame, group: str, vector: str) -> DataFrame:
    """group, place, mean: elementwise mean of arrays padded with zeros to the longest of the group: padding counts in the divisor."""
    n = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    s = df.select(group, F.posexplode(vector).alias("place", "x")).groupBy(group, "place").agg(F.sum(F.col("x").cast("double")).alias("_s"))
    return s.join(n, group).select(group, "place", (F.col("_s") / F.col("_n")).alias("mean"))


def crossings(samples: DataFrame, key: str, i: str, x: str) -> DataFrame:
    """The places where a series changes sign: i of the later sample."""
    w = Window.partitionBy(key).orderBy(i)
    before = F.lag(x).over(w)
    return samples.withColumn("_b", before).filter((F.signum("_b") != F.signum(x)) & F.col("_b").isNotNull()).select(key, i)


def loud_spans(samples: DataFrame, threshold: float, hold: float, least: float, key: str = "track", t: str = "t", level: str = "level") -> DataFrame:
    """Spans of samples at or above a level, gaps of up to `hold` bridged, spans shorter than `least` dropped."""
    s = islands(samples.filter(F.col(level) >= threshold), hold, key, t)
    return s.filter(F.col("end") - F.col("start") >= least).select(key, "start", "end", "n")


def loudness_range(blocks: DataFrame, key: str, level: str) -> DataFrame:
    """Difference of the 95th and the 10th percentile of block levels."""
    q = quantiles(blocks, [key], level, [0.1, 0.95])
    return q.select(key, (F.col("q")[1] - F.col("q")[0]).alias("range"))


def timing_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """n, mean, population deviation, 10th and 90th percentile and sum."""
    g = df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.sum(value).alias("sum"))
    return with_quantiles(g, quantiles(df, [key], value, [0.1, 0.9]), [key], each=True).select(key, "n", "mean", "std", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p90"), "sum")


def weighted_share(rows: DataFrame, key: str, on: Column, weight: Column) -> DataFrame:
    """Share of weight that is off: 0 for keys without any weight."""
    g = rows.groupBy(key).agg(F.sum(F.when(~on, weight).otherwise(0.0)).alias("_o"), F.sum(weight).alias("_w"))
    return g.select(key, F.coalesce(F.try_divide("_o", "_w"), F.lit(0.0)).alias("share"))


def pooled_correlation(frames: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """r of two series within each group."""
    return frames.groupBy(*by).agg(correlation(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"), F.count(F.lit(1)).alias("n"))


def averaged_correlation(frames: DataFrame, x: str, y: str, each: list[str]) -> DataFrame:
    """Mean over groups, on Fisher's scale, of each group's r."""
    return pooled_correlation(frames, x, y, each).agg(fisher_mean(F.col("r")).alias("r"), F.count("r").alias("groups"))


def requirement_gaps(rows: DataFrame, key: str, required: list[str]) -> DataFrame:
    """feature, missing: rows in which a required column is null; all features in one pass."""
    one = rows.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in required])
    return one.unpivot([], required, "feature", "missing").withColumn("missing", F.coalesce("missing", F.lit(0)))


def progress(rows: DataFrame, required: list[str]) -> DataFrame:
    """complete and incomplete rows."""
    full = F.lit(True)
    for c in required:
        full = full & F.col(c).isNotNull()
    return rows.agg(F.count_if(full).alias("complete"), F.count_if(~full).alias("incomplete"))


def snap(pitch: Column, allowed: list[int], period: int = 12) -> Column:
    """The nearest allowed class on the circle, upwards on ties of distance towards the lower class, as a pitch."""
    tried = F.array(*[F.struct(F.abs(F.pmod(pitch - a + period // 2, F.lit(period)) - period // 2).alias("d"), F.lit(a).alias("a"), (pitch - (F.pmod(pitch - a + period // 2, F.lit(period)) - period // 2)).alias("p")) for a in sorted(allowed)])
    return F.array_min(tried)["p"]


def duration_score(gap: Column) -> Column:
    """1 within 2 s, 0.7 within 10 s, 0.3 within 30 s, else 0; 0 where unknown."""
    return F.when(gap <= 2, 1.0).when(gap <= 10, 0.7).when(gap <= 30, 0.3).otherwise(0.0)


def candidate_score(duration: Column, known_duration: Column, year: Column, known_year: Column, artist_ratio: Column | None = None) -> Column:
    """How well a candidate fits: 0.5 for a duration within 2 s, falling to 0.1 at 10 s and 0.05 up to 30 s; 0.3, 0.2 or 0.1 for a
    year at most 0, 1 or 3 off; 0.2 times the likeness of the artists' names. What is unknown or 0 adds nothing."""
    known = lambda x: F.nullif(x, F.lit(0))
    d, y = F.abs(known(duration) - known(known_duration)), F.abs(known(year) - known(known_year))
    fit = F.when(d < 2, 0.5).when(d < 10, 0.5 - (d - 2) * 0.05).when(d < 30, 0.05).otherwise(0.0)
    fit = fit + F.when(y == 0, 0.3).when(y <= 1, 0.2).when(y <= 3, 0.1).otherwise(0.0)
    return fit + 0.2 * F.coalesce(artist_ratio, F.lit(0.0)) if artist_ratio is not None else fit


def dominant_class(rows: DataFrame, key: str, value: str, classes: int = 12) -> DataFrame:
    """key, class: the commonest of the values rounded to whole numbers, halves to even, on the circle; the least on ties. Counted by (key, class)."""
    n = rows.filter(F.col(value).isNotNull()).groupBy(key, F.pmod(F.rint(F.col(value)).cast("long"), F.lit(classes)).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(key).agg(F.min_by("class", F.struct(-F.col("n"), F.col("class"))).alias("class"))


def speed(timings: DataFrame, key: str, seconds: Column, audio: float) -> DataFrame:
    """key, n, n_max (of any key), rtf: how many times faster than its audio the mean run is, as a label."""
    g = timings.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(seconds).alias("m"))
    x = F.lit(audio) / F.col("m")
    label = F.when(F.col("m") <= 0, "—").when(x >= 1000, F.concat(F.format_string("%.1f", x / 1000), F.lit("kx"))).otherwise(F.concat(F.rint(x).cast("long").cast("string"), F.lit("x")))
    return g.crossJoin(F.broadcast(g.agg(F.max("n").alias("n_max")))).select(key, "n", "n_max", label.alias("rtf"))  # one row on the right


def pass_progress(items: DataFrame, key: str, done: Column, duration: Column) -> DataFrame:
    """key, completed, total, duration (of what is completed)."""
    return items.groupBy(key).agg(F.count_if(done).alias("completed"), F.count(F.lit(1)).alias("total"), F.sum(F.when(done, duration)).alias("duration"))


def top_means(scores: DataFrame, key: str, label: str, score: str, least: float, most: int) -> DataFrame:
    """key, label and the mean score of the `most` best labels of a key that reach `least`; ties by label."""
    m = scores.groupBy(key, label).agg(F.avg(score).alias(score)).filter(F.col(score) >= least)
    w = Window.partitionBy(key).orderBy(F.desc(F.round(score, 9)), label)
    return m.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= most).drop("_k")


def movement(frames: DataFrame, key: str, order: str, vector: str, n: int) -> DataFrame:
    """key, movement (mean distance of neighbouring frames over sqrt 2, 1 at most), variance (mean over places, over 0.1, 1 at most); 0 with one frame."""
    w = Window.partitionBy(key).orderBy(order)
    f = frames.withColumn("_p", F.lag(vector).over(w))
    d = F.sqrt(F.aggregate(F.zip_with(vector, "_p", lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, x: s + x))
    g = f.groupBy(key).agg(F.avg(F.when(F.col("_p").isNotNull(), d)).alias("_m"), *[F.var_pop(F.get(vector, F.lit(i)).cast("double")).alias(f"_v{i}") for i in range(n)])
    variance = sum((F.col(f"_v{i}") for i in range(n)), F.lit(0.0)) / n
    return g.select(key, F.coalesce(F.least(F.col("_m") / F.sqrt(F.lit(2.0)), F.lit(1.0)), F.lit(0.0)).alias("movement"), F.when(F.col("_m").isNull(), 0.0).otherwise(F.least(variance / 0.1, F.lit(1.0))).alias("variance"))


def gated_mean(df: DataFrame, group: str, vector: str, bars: Column, least: int = 4) -> DataFrame:
    """The padded mean over a group's rows of at least so many bars; over all of them where none has that."""
    rows = df.withColumn("_long", F.coalesce(bars >= least, F.lit(False)))
    some = rows.groupBy(group).agg(F.bool_or("_long").alias("_some"))
    return padded_mean(rows.join(some, group).filter(F.col("_long") | ~F.col("_some")), group, vector)
