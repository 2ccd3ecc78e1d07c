"""Correlation, ranks, multiple testing, regression, information, projection and clustering."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def correlation(x: Column, y: Column, least: int = 3, degenerate: float | None = 0.0) -> Column:
    """Pearson's r over rows that have both; `degenerate` where there are fewer than `least` or one side is constant. r is kept within [-1, 1]."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    ok = (F.count(a) >= least) & (F.stddev_pop(a) > 0) & (F.stddev_pop(b) > 0)
    return F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))))).otherwise(F.lit(degenerate).cast("double"))


def correlation_matrix(df: DataFrame, features: list[str], least: int = 3) -> DataFrame:
    """(x, y, r) of all ordered pairs: every coefficient in one aggregate of one pass, then unpivoted."""
    pairs = [(x, y) for i, x in enumerate(features) for y in features[i:]]
    one = df.agg(*[correlation(F.col(x).cast("double"), F.col(y).cast("double"), least).alias(f"r{i}") for i, (x, y) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")) for i, (x, y) in enumerate(pairs) for a, b in ({(x, y), (y, x)})]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def strongest(matrix: DataFrame) -> DataFrame:
    """Per feature: the partner of the greatest |r| (ties by name), its r, and the mean |r| over the others."""
    m = matrix.filter("x <> y")
    best = F.min_by(F.struct("y", "r"), F.struct(-F.abs("r"), F.col("y")))
    return m.groupBy("x").agg(best.alias("b"), F.avg(F.abs("r")).alias("mean_abs_r")).select("x", F.col("b.y").alias("partner"), F.col("b.r").alias("r"), "mean_abs_r")


def average_ranks(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds mean ranks. Distinct values are counted and ranked within ranges, whose bounds are found first: offsets come from the ranges' totals, so no task sorts all values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = counts.agg(F.percentile_approx(column, [i / n for i in range(1, n)], 50 * n).alias("b"))  # one row
    parts = counts.crossJoin(F.broadcast(bounds)).select(column, "_n", F.size(F.filter("b", lambda x: x < F.col(column))).alias("_p"))
    within = F.sum("_n").over(Window.partitionBy("_p").orderBy(column))
    ranked = parts.withColumn("_w", within).select(column, "_n", "_p", "_w")
    totals = ranked.groupBy("_p").agg(F.max("_w").alias("_t"))
    before = totals.select("_p", (F.sum("_t").over(Window.orderBy("_p")) - F.col("_t")).alias("_b"))
    ranks = ranked.join(F.broadcast(before), "_p").select(column, (F.col("_b") + F.col("_w") - (F.col("_n") - 1) / 2).alias(out))
    return df.join(ranks, column, "left")


def spearman(df: DataFrame, x: str, y: str, least: int = 3) -> DataFrame:
    both = df.select(x, y).dropna()
    r = average_ranks(average_ranks(both, x, "_rx"), y, "_ry")
    return r.agg(correlation(F.col("_rx"), F.col("_ry"), least).alias("rho"), F.count(F.lit(1)).alias("n"))


def benjamini_hochberg(p: DataFrame, column: str = "p") -> DataFrame:
    """Adds p_adjusted: least of p * m / rank over the p values that are no smaller, at most 1. For tables of test results, which are small."""
    up, down = Window.orderBy(column), Window.orderBy(F.desc("_rank")).rowsBetween(Window.unboundedPreceding, 0)
    m = p.withColumn("_rank", F.row_number().over(up)).crossJoin(F.broadcast(p.agg(F.count(column).alias("_m"))))
    return m.withColumn("p_adjusted", F.least(F.lit(1.0), F.min(F.col(column) * F.col("_m") / F.col("_rank")).over(down))).drop("_rank", "_m")


def fisher_mean(r: Column) -> Column:
    """Mean of correlations on the inverse hyperbolic tangent's scale."""
    edge = 1 - 1e-7
    return F.tanh(F.avg(F.atanh(F.greatest(F.lit(-edge), F.least(F.lit(edge), r)))))


def trend(df: DataFrame, x: str, y: str, by: list[str], least: int = 3) -> DataFrame:
    """Least-squares line of y over x by group, with its ends; flat where x is constant."""
    x_, y_ = F.col(x).cast("double"), F.col(y).cast("double")
    g = df.filter(x_.isNotNull() & y_.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.try_divide(F.covar_pop(x_, y_), F.var_pop(x_)), F.lit(0.0)).alias("slope"), F.avg(x_).alias("mx"), F.avg(y_).alias("my"), F.min(x_).alias("x0"), F.max(x_).alias("x1"))
    g = g.withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx")).drop("mx", "my")
    return g.filter(F.col("n") >= least).withColumns({"y0": F.col("intercept") + F.col("slope") * F.col("x0"), "y1": F.col("intercept") + F.col("slope") * F.col("x1")})


def moments(df: DataFrame, features: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, means, population covariance) of complete rows: one aggregate, p x p numbers to the driver."""
    cols = [F.col(f).cast("double") for f in features]
    full = df.filter(reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in cols]))
    p = len(features)
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)] + [F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    row = full.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    if not row.n:
        return 0, np.zeros(p), np.zeros((p, p))
    c = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            c[i, j] = c[j, i] = row[f"c{i}_{j}"]
    return row.n, np.array([row[f"m{i}"] for i in range(p)]), c


def variance_inflation(df: DataFrame, features: list[str]) -> DataFrame:
    """1 / (1 - R^2) of each feature on the others: the diagonal of the inverse correlation matrix; null for constant or exactly dependent ones."""
    n, _, c = moments(df, features)
    s = np.sqrt(np.diag(c))
    live = [i for i in range(len(features)) if s[i] > 0]
    out: dict[int, float | None] = dict.fromkeys(range(len(features)))
    if n > 2 and live:
        r = c[np.ix_(live, live)] / np.outer(s[live], s[live])
        if np.linalg.cond(r) < 1e12:
            out |= dict(zip(live, np.diag(np.linalg.inv(r)).tolist(), strict=True))
    level = {i: None if v is None else "high" if v > 10 else "moderate" if v > 5 else "low" for i, v in out.items()}
    return df.sparkSession.createDataFrame([(f, out[i], level[i]) for i, f in enumerate(features)], "feature string, vif double, level string")


def mutual_information(df: DataFrame, x: str, y: str, bins: int = 16) -> DataFrame:
    """Mutual information (nats) of two numbers cut into equal-width bins."""
    e = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    r = e.agg(*[f(c).alias(f"{n}{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))])
    cell = lambda c: F.when(F.col(f"hi{c}") > F.col(f"lo{c}"), F.least(F.lit(bins - 1), F.floor((F.col(c) - F.col(f"lo{c}")) / (F.col(f"hi{c}") - F.col(f"lo{c}")) * bins))).otherwise(F.lit(0))
    n = e.crossJoin(F.broadcast(r)).groupBy(cell("x").alias("bx"), cell("y").alias("by")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    n = n.withColumns({"nx": F.sum("n").over(Window.partitionBy("bx")), "ny": F.sum("n").over(Window.partitionBy("by"))})
    total = n.agg(F.sum("n").alias("m"))
    return n.crossJoin(F.broadcast(total)).agg(F.sum(F.col("n") / F.col("m") * F.ln(F.col("n") * F.col("m") / (F.col("nx") * F.col("ny")))).alias("mi"))


def principal_components(df: DataFrame, features: list[str], k: int, standardise: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(components k x p, explained shares, means) from one pass's moments; each component's largest loading is positive."""
    _, m, c = moments(df, features)
    if standardise:
        s = np.sqrt(np.diag(c))
        s[s == 0] = 1
        c = c / np.outer(s, s)
    w, v = np.linalg.eigh(c)
    order = np.argsort(-w, kind="stable")[:k]
    comp = v[:, order].T
    comp *= np.sign(comp[np.arange(len(comp)), np.abs(comp).argmax(1)])[:, None]
    return comp, w[order] / w.sum() if w.sum() > 0 else np.zeros(len(order)), m


def ridge(df: DataFrame, features: list[str], target: str, alpha: float = 1.0) -> DataFrame:
    """Coefficients of standardised features with penalty alpha, from one pass's moments; r2 of the fit."""
    n, m, c = moments(df, [*features, target])
    p = len(features)
    s = np.sqrt(np.diag(c)[:p])
    live = s > 0
    beta = np.zeros(p)
    if n and live.any():
        a = n * c[:p, :p][np.ix_(live, live)] / np.outer(s[live], s[live]) + alpha * np.eye(live.sum())
        beta[live] = np.linalg.solve(a, n * c[:p, p][live] / s[live])
    z = np.where(live, beta / np.where(live, s, 1), 0)
    explained = 2 * z @ c[:p, p] - z @ c[:p, :p] @ z
    r2 = float(explained / c[p, p]) if n and c[p, p] > 0 else 0.0
    return df.sparkSession.createDataFrame([(f, float(b), r2) for f, b in zip(features, beta, strict=True)], "feature string, coefficient double, r2 double")


def ward_clusters(distance: np.ndarray, share: float = 0.7) -> np.ndarray:
    """Labels from Ward linkage (Lance-Williams on given distances) cut at a share of the last merge's height. For feature matrices, p x p on the driver."""
    n = len(distance)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, members, merges = np.ones(n), {i: [i] for i in range(n)}, []
    while len(members) > 1:
        live = sorted(members)
        sub = d[np.ix_(live, live)]
        a, b = np.unravel_index(sub.argmin(), sub.shape)
        i, j = sorted((live[a], live[b]))
        h = d[i, j]
        for k in live:
            if k not in (i, j):
                t = size[i] + size[j] + size[k]
                d[i, k] = d[k, i] = math.sqrt(((size[i] + size[k]) * d[i, k] ** 2 + (size[j] + size[k]) * d[j, k] ** 2 - size[k] * h**2) / t)
        size[i] += size[j]
        members[i] += members.pop(j)
        merges.append((h, i, j))
    top = max((h for h, _, _ in merges), default=0) * share
    group = list(range(n))
    for h, i, j in merges:
        if h <= top:
            gi, gj = group[i], group[j]
            group = [gi if g == gj else g for g in group]
    names = {g: k for k, g in enumerate(dict.fromkeys(group))}
    return np.array([names[g] for g in group])


def spread(df: DataFrame, features: list[str], least: float = 1e-4) -> DataFrame:
    """feature, std, kept: population deviations in one pass, and which features vary enough."""
    one = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in features])
    return one.unpivot([], features, "feature", "std").withColumn("kept", F.coalesce(F.col("std") >= least, F.lit(False)))


def top_pairs(matrix: DataFrame, n: int) -> DataFrame:
    """The n strongest coefficients of a matrix, one of each pair; ties by names."""
    return matrix.filter(F.col("x") != F.col("y")).groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.min_by(F.struct("x", "y", "r"), F.struct("x", "y")).alias("c")).orderBy(F.desc(F.round(F.abs("c.r"), 9)), "a", "b").limit(n).select("c.*")
