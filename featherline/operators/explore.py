"""Views of a feature table: histogram, quadrant, radar, classes, filters, outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherline.functions.scalars import clamp, min_max
from featherline.operators.profile import quantiles, with_quantiles


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """bin, lo, hi, n, and the mean and deviation of all, over equal widths of [min, max]; the last bin is closed, empty ones are listed; one bin if all are equal."""
    v = df.select(F.col(value).cast("double").alias("v")).dropna()
    r = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std")).filter("lo is not null")
    width = (F.col("hi") - F.col("lo")) / bins
    cell = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / width))).otherwise(F.lit(0)).cast("int")
    n = v.crossJoin(F.broadcast(r)).groupBy(cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = r.select("lo", "mean", "std", width.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(F.broadcast(n), "bin", "left").select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("lo"), (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"), "mean", "std")


def quadrant(df: DataFrame, id_column: str, x_plus: str, x_minus: str, y_plus: str, y_minus: str) -> DataFrame:
    """id, x, y: differences of two min-max scaled features an axis over rows that have all four. Ranges come from one aggregate, not a window."""
    cols = [x_plus, x_minus, y_plus, y_minus]
    full = df.select(id_column, *[F.col(c).cast("double").alias(c) for c in dict.fromkeys(cols)]).dropna(subset=list(dict.fromkeys(cols)))
    r = full.agg(*[f(c).alias(f"_{n}_{c}") for c in dict.fromkeys(cols) for n, f in (("lo", F.min), ("hi", F.max))])
    s = lambda c: min_max(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}"))
    return full.crossJoin(F.broadcast(r)).select(id_column, (s(x_plus) - s(x_minus)).alias("x"), (s(y_plus) - s(y_minus)).alias("y"))


def radar(df: DataFrame, id_column: str, features: list[str], row_id: int) -> DataFrame:
    """feature, value, mean: one row's and the table's place between the 1st and 99th percentile, clamped to [0, 1]."""
    v = df.select(id_column, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([id_column], features, "feature", "v")
    s = with_quantiles(v.groupBy("feature").agg(F.avg("v").alias("m"), F.max(F.when(F.col(id_column) == row_id, F.col("v"))).alias("v")), quantiles(v, ["feature"], "v", [0.01, 0.99]), ["feature"], each=True)
    place = lambda c: clamp(min_max(F.col(c), F.col("q")[0], F.col("q")[1]), 0.0, 1.0)
    return s.select("feature", place("v").alias("value"), place("m").alias("mean"))


def classes(df: DataFrame, label: Column, x: str, y: str, most: int = 20) -> DataFrame:
    """label, n, mean_x, mean_y: the `most` largest classes by size (ties by label), the rest folded into '(other)'; '' is '(unknown)'."""
    named = F.when(F.coalesce(label, F.lit("")) == "", F.lit("(unknown)")).otherwise(label)
    g = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(named.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"))
    top = g.orderBy(F.desc("n"), "label").limit(most).select(F.col("label").alias("_top"))
    folded = g.join(F.broadcast(top), F.col("label") == F.col("_top"), "left").withColumn("label", F.when(F.col("_top").isNull(), F.lit("(other)")).otherwise(F.col("label")))
    return folded.groupBy("label").agg(F.sum("n").alias("n"), (F.sum("sx") / F.sum("n")).alias("mean_x"), (F.sum("sy") / F.sum("n")).alias("mean_y"))


def in_bands(df: DataFrame, bands: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows within every band, ends included; a null or NaN fails a band it is asked for."""
    for c, (lo, hi) in bands.items():
        v = F.col(c)
        df = df.filter(v.isNotNull() & ~F.isnan(v.cast("double")))
        df = df.filter(v >= lo) if lo is not None else df
        df = df.filter(v <= hi) if hi is not None else df
    return df


def two_sigma(df: DataFrame, x: str, y: str) -> DataFrame:
    """Adds outlier: either value over two population deviations from its mean, over rows that have both."""
    both = df.dropna(subset=[x, y])
    s = both.agg(*[f(c).alias(f"_{n}_{c}") for c in {x: 0, y: 0} for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    far = lambda c: F.abs(F.col(c) - F.col(f"_m_{c}")) > 2 * F.col(f"_s_{c}")
    return both.crossJoin(F.broadcast(s)).withColumn("outlier", far(x) | far(y)).select(*df.columns, "outlier")


def like_reference(df: DataFrame, id_column: str, features: list[str], row_id: int) -> DataFrame:
    """Other rows within one population deviation of the reference row on every feature; a feature the reference lacks doesn't count."""
    s = df.agg(*[F.stddev_pop(f).alias(f"_s_{f}") for f in features], *[F.max(F.when(F.col(id_column) == row_id, F.col(f))).alias(f"_r_{f}") for f in features])
    ok = F.lit(True)
    for f in features:
        ok = ok & (F.col(f"_r_{f}").isNull() | F.coalesce(F.abs(F.col(f) - F.col(f"_r_{f}")) <= F.col(f"_s_{f}"), F.lit(False)))
    return df.crossJoin(F.broadcast(s)).filter((F.col(id_column) != row_id) & ok).select(*df.columns)


def ranked(df: DataFrame, by: str, keep: list[str], n: int, ascending: bool = False, tie: str | None = None) -> DataFrame:
    """The n first or last rows by a column, nulls aside."""
    order = [F.col(by).asc() if ascending else F.col(by).desc(), *([F.col(tie)] if tie else [])]
    return df.filter(F.col(by).isNotNull()).orderBy(*order).limit(n).select(*keep, by)


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The n first rows of each group; Spark keeps n a group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= n)


def matrix_view(matrix: DataFrame, least: float) -> DataFrame:
    """x, y, r and the row's place: weak coefficients as 0, rows by their strongest one, ties by name."""
    m = matrix.withColumn("r", F.when(F.abs("r") >= least, F.col("r")).otherwise(0.0))
    top = m.groupBy("x").agg(F.max(F.abs("r")).alias("_top"))  # a row a feature
    ranked = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.round("_top", 9)), "x")))
    return m.join(F.broadcast(ranked), "x").select("x", "y", "r", "place")


def extremes(df: DataFrame, name: str, value: str, n: int) -> DataFrame:
    """side (top or bottom), name, value: the n greatest and the n least; ties by name."""
    side = lambda s, order: df.orderBy(order, name).limit(n).select(F.lit(s).alias("side"), name, value)
    return side("top", F.desc(F.round(value, 9))).unionByName(side("bottom", F.round(value, 9)))


def bin_members(df: DataFrame, value: str, bin: int, bins: int = 30) -> DataFrame:
    """The rows behind one bar of the histogram."""
    r = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    lo, hi = F.col("_lo") + bin * width, F.col("_lo") + (bin + 1) * width
    inside = (F.col(value) >= lo) & ((F.col(value) <= F.col("_hi")) if bin == bins - 1 else (F.col(value) < hi))
    return df.crossJoin(F.broadcast(r)).filter(inside).drop("_lo", "_hi")  # one row on the right
