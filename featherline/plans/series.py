"""Queries of the series operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.operators import series as Z
from featherline.plans.catalog import query
from featherline.plans.definitions import EMB, EV, r6, read, seconds, vectors


@query("padded_mean", f"""
WITH {EMB}, c AS (SELECT label, v[1:16 + vec_id % 9] AS v FROM e), n AS (SELECT label, count(*) AS n FROM c GROUP BY 1), u AS (SELECT label, unnest(range(0, len(v))) AS place, unnest(v) AS x FROM c)
SELECT u.label, CAST(place AS INTEGER) AS place, round(sum(x) / max(n), 6) + 0.0 AS mean FROM u JOIN n ON u.label = n.label GROUP BY 1, 2
""")
def padded_mean(spark: SparkSession, d: str) -> DataFrame:
    cut = vectors(spark, d).select("label", F.slice("v", F.lit(1), (16 + F.col("vec_id") % 9).cast("int")).alias("v"))
    return Z.padded_mean(cut, "label", "v").select("label", "place", (F.round("mean", 6) + 0.0).alias("mean"))


@query("zero_crossings", f"""
WITH {EMB}, u AS (SELECT vec_id, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM e), b AS (SELECT *, lag(x) OVER (PARTITION BY vec_id ORDER BY i) AS p FROM u)
SELECT vec_id, CAST(i AS INTEGER) AS i FROM b WHERE p IS NOT NULL AND sign(p) <> sign(x)
""")
def zero_crossings(spark: SparkSession, d: str) -> DataFrame:
    return Z.crossings(vectors(spark, d).select("vec_id", F.posexplode("v").alias("i", "x")), "vec_id", "i", "x")


@query("loud_spans", f"""
WITH {EV}, l AS (SELECT * FROM ev WHERE value >= 50), b AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY track ORDER BY t) > 86400, true) AS b FROM l),
i AS (SELECT *, sum(CAST(b AS INTEGER)) OVER (PARTITION BY track ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM b)
SELECT track, round(min(t), 6) AS start, round(max(t), 6) AS "end", count(*) AS n FROM i GROUP BY track, k HAVING max(t) - min(t) >= 3600
""")
def loud_spans(spark: SparkSession, d: str) -> DataFrame:
    return Z.loud_spans(seconds(spark, d).withColumnRenamed("value", "level"), 50.0, 86400.0, 3600.0).select("track", *r6("start", "end"), "n")


@query("loudness_range", "SELECT user_id, round(quantile_cont(value, 0.95) - quantile_cont(value, 0.1), 6) AS range FROM events GROUP BY 1")
def loudness_range(spark: SparkSession, d: str) -> DataFrame:
    return Z.loudness_range(read(spark, d, "events"), "user_id", "value").select("user_id", *r6("range"))


@query("timing_stats", "SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90, round(sum(value), 4) AS sum FROM events GROUP BY 1")
def timing_stats(spark: SparkSession, d: str) -> DataFrame:
    return Z.timing_stats(read(spark, d, "events"), "event_type", "value").select("event_type", "n", *r6("mean", "std", "p10", "p90"), F.round("sum", 4).alias("sum"))


@query("offbeat_share", "SELECT l_orderkey, round(coalesce(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0), 0), 6) AS share FROM lineitem GROUP BY 1")
def offbeat_share(spark: SparkSession, d: str) -> DataFrame:
    return Z.weighted_share(read(spark, d, "lineitem"), "l_orderkey", F.col("l_returnflag") == "N", F.col("l_quantity")).select("l_orderkey", *r6("share"))


@query("averaged_correlation", """
WITH c AS (SELECT l_returnflag, l_linenumber, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1, 2)
SELECT round(tanh(avg(atanh(least(0.9999999, greatest(-0.9999999, r))))), 6) AS r, count(r) AS groups FROM c
""")
def averaged_correlation(spark: SparkSession, d: str) -> DataFrame:
    return Z.averaged_correlation(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag", "l_linenumber"]).select(*r6("r"), "groups")


@query("requirement_gaps", """
WITH j AS (SELECT quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'quality' AS feature, CAST(count(*) FILTER (WHERE quality IS NULL) AS BIGINT) AS missing FROM j UNION ALL SELECT 'toxic', CAST(count(*) FILTER (WHERE toxic IS NULL) AS BIGINT) FROM j
""")
def requirement_gaps(spark: SparkSession, d: str) -> DataFrame:
    return Z.requirement_gaps(read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left"), "doc_id", ["quality", "toxic"])


@query("progress", "SELECT count(*) FILTER (WHERE quality IS NOT NULL) AS complete, count(*) FILTER (WHERE quality IS NULL) AS incomplete FROM documents LEFT JOIN labels USING (doc_id)")
def progress(spark: SparkSession, d: str) -> DataFrame:
    return Z.progress(read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left"), ["quality"])


@query("snap_pitch", """
SELECT p_partkey, arg_min(p_size - ((((p_size - a + 6) % 12) + 12) % 12 - 6), struct_pack(d := abs((((p_size - a + 6) % 12) + 12) % 12 - 6), a := a)) AS pitch FROM part, (VALUES (0), (4), (7)) t(a) GROUP BY 1
""")
def snap_pitch(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", Z.snap(F.col("p_size"), [0, 4, 7]).alias("pitch"))
