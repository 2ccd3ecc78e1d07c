"""Queries of the engine's operators on the star-schema tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.functions import arrays as A
from featherline.functions import scalars as S
from featherline.functions import text as X
from featherline.operators import events as E
from featherline.operators import explore as V
from featherline.operators import profile as P
from featherline.operators import similarity as N
from featherline.operators import stats as T
from featherline.operators import store as R
from featherline.plans.catalog import query

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: The kinds of events there are: columns of the SQL of wide tables.
EVENT_KINDS = ["click", "error", "purchase", "signup", "view"]


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(*names: str) -> list[Column]:
    return [(F.round(F.col(n), 6) + 0.0).alias(n) for n in names]


def seconds(spark: SparkSession, d: str) -> DataFrame:
    """events as (track, t, row, kind, value): user, seconds since 2024, event."""
    t = (F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000) / 1e6
    return read(spark, d, "events").select(F.col("user_id").alias("track"), t.alias("t"), F.col("event_id").alias("row"), F.col("event_type").alias("kind"), "value")


#: The same events in SQL.
EV = "ev AS (SELECT user_id AS track, (epoch_us(ts) - 1704067200000000) / 1e6 AS t, event_id AS row, event_type AS kind, value FROM events)"
GAPS = EV + ", g AS (SELECT *, t - lag(t) OVER (PARTITION BY track ORDER BY t, row) AS gap FROM ev)"
EMB = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@query("numeric_profile", """
WITH u AS (UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem) ON l_quantity, l_extendedprice, l_discount INTO NAME feature VALUE value),
q AS (SELECT l_returnflag, feature, count(value) AS n, avg(value) AS m, quantile_cont(value, 0.5) AS med, stddev_pop(value) AS s, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM u GROUP BY 1, 2),
o AS (SELECT u.l_returnflag, u.feature, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS k FROM u JOIN q USING (l_returnflag, feature) GROUP BY 1, 2)
SELECT l_returnflag, feature, n AS count, round(m, 6) AS mean, round(med, 6) AS median, round(lo, 6) AS min, round(hi, 6) AS max, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, round(s, 6) AS std, k AS outliers, round(100.0 * k / n, 6) AS outlier_pct FROM q JOIN o USING (l_returnflag, feature)
""")
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    long = P.unpivot(read(spark, d, "lineitem"), ["l_returnflag"], NUMBERS[:3])
    return P.numeric_profile(long, ["l_returnflag", "feature"]).select("l_returnflag", "feature", "count", *r6("mean", "median", "min", "max", "q1", "q3", "iqr", "std"), "outliers", *r6("outlier_pct"))


@query("iqr_outliers", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN q USING (l_returnflag) WHERE l_extendedprice < a - 1.5 * (b - a) OR l_extendedprice > b + 1.5 * (b - a)
""")
def iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    return P.iqr_outliers(read(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"], ["l_orderkey", "l_linenumber"])


@query("categorical_top10", """
WITH c AS (SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT value, n, round(100.0 * n / sum(n) OVER (), 6) AS pct, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank FROM c QUALIFY row_number() OVER (ORDER BY n DESC, value) <= 10
""")
def categorical_top10(spark: SparkSession, d: str) -> DataFrame:
    return P.top_categories(read(spark, d, "orders"), F.col("o_orderpriority")).select("value", "n", *r6("pct"), "rank")


@query("key_coverage", """
WITH p AS (SELECT unnest(json_keys(props)) AS key, props FROM events), t AS (SELECT count(*) AS m FROM events)
SELECT key, count(*) AS n, min(TRY_CAST(json_extract_string(props, '$.' || key) AS DOUBLE)) AS min, max(TRY_CAST(json_extract_string(props, '$.' || key) AS DOUBLE)) AS max, round(100.0 * count(*) / max(m), 1) AS pct FROM p, t GROUP BY key
""")
def key_coverage(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.from_json("props", "map<string,string>").alias("m"))
    total = e.agg(F.count(F.lit(1)).alias("m"))
    pairs = e.select(F.explode("m").alias("key", "value"))
    out = P.coverage(pairs, F.lit(1)).crossJoin(F.broadcast(total))
    return out.select("key", "n", "min", "max", F.round(100.0 * F.col("n") / F.col("m"), 1).alias("pct"))


@query("label_coverage", """
WITH t AS (SELECT count(*) AS m FROM documents), u AS (UNPIVOT (SELECT quality, toxic FROM documents JOIN labels USING (doc_id)) ON quality, toxic INTO NAME key VALUE value)
SELECT key, count(*) AS n, CAST(min(value) AS DOUBLE) AS min, CAST(max(value) AS DOUBLE) AS max, round(100.0 * count(*) / max(m), 1) AS pct FROM u, t GROUP BY key
""")
def label_coverage(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id")
    pairs = docs.join(read(spark, d, "labels"), "doc_id").unpivot(["doc_id"], ["quality", "toxic"], "key", "value").filter("value is not null")
    out = P.coverage(pairs, F.lit(1)).crossJoin(F.broadcast(docs.agg(F.count(F.lit(1)).alias("m"))))
    return out.select("key", "n", "min", "max", F.round(100.0 * F.col("n") / F.col("m"), 1).alias("pct"))


@query("missing_feature", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_feature(spark: SparkSession, d: str) -> DataFrame:
    return R.missing_from(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id")


@query("orphan_rows", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    have = read(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return R.missing_from(read(spark, d, "customer").select("c_custkey", "c_name"), have, "c_custkey")


@query("track_mean", "SELECT l_orderkey, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 6) AS l_extendedprice, round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax, count(*) AS n_crops FROM lineitem GROUP BY 1")
def track_mean(spark: SparkSession, d: str) -> DataFrame:
    return P.group_means(read(spark, d, "lineitem"), "l_orderkey", NUMBERS).select("l_orderkey", *r6(*NUMBERS), "n_crops")


@query("broadcast_migrate", "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def broadcast_migrate(spark: SparkSession, d: str) -> DataFrame:
    parent = read(spark, d, "nation").join(R.size_checked(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left").withColumnRenamed("n_nationkey", "c_nationkey")
    return R.fill_from_parent(read(spark, d, "customer").select("c_custkey", "c_nationkey"), parent, "c_nationkey", ["n_name", "r_name"]).drop("c_nationkey")


@query("last_wins_upsert", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def last_wins_upsert(spark: SparkSession, d: str) -> DataFrame:
    return R.last_wins(read(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("merge_records", """
WITH a AS (SELECT o_custkey AS k, o_orderpriority AS p, max(o_totalprice) AS x FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), b AS (SELECT o_custkey AS k, o_orderpriority AS p, max(o_totalprice) AS x FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.p, b.p) AS name, coalesce(b.x, a.x) AS x FROM a FULL JOIN b ON a.k = b.k AND a.p = b.p
""")
def merge_records(spark: SparkSession, d: str) -> DataFrame:
    def records(status: str) -> DataFrame:
        best = read(spark, d, "orders").filter(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("k"), "o_orderpriority").agg(F.max("o_totalprice").alias("x"))
        return best.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "x"))).alias("m"))

    return R.merge_records(records("F"), records("O"), "k", "m").select("k", F.explode("m").alias("name", "x"))


@query("dedupe_fingerprint", "SELECT doc_id, md5(text) AS fingerprint FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def dedupe_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", F.md5("text").alias("fingerprint"))
    return R.keep_first_by_fingerprint(docs, F.col("fingerprint"), ["doc_id"])


@query("suffix_strip", r"SELECT s_suppkey AS id, regexp_replace(s_name || '_' || s_suppkey, '_\d+$', '') AS track, regexp_replace(s_suppkey || '  ' || s_name, '^\d+\s+', '') AS title, regexp_replace(lower(s_name), '[^a-z0-9]', '', 'g') AS match_key FROM supplier")
def suffix_strip(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier")
    k = F.col("s_suppkey").cast("string")
    return s.select(F.col("s_suppkey").alias("id"), X.track_of(F.concat("s_name", F.lit("_"), k)).alias("track"), X.without_number(F.concat(k, F.lit("  "), "s_name")).alias("title"), X.match_key(F.col("s_name")).alias("match_key"))


@query("text_clean", r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'), '[ \t\r\n\f\x0B]+', ' ', 'g'), ' ') AS clean FROM documents")
def text_clean(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", X.squeezed(F.col("text")).alias("clean"))


@query("role_concat", "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS dialogue, count(*) AS turns FROM conversations GROUP BY 1")
def role_concat(spark: SparkSession, d: str) -> DataFrame:
    line = F.struct("turn", F.concat("role", F.lit(": "), "text").alias("line"))
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("l"), F.count(F.lit(1)).alias("turns"))
    return c.select("conv_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("dialogue"), "turns")


@query("search_ci", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 're') OR contains(lower(p_type), 're')")
def search_ci(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").filter(X.contains_any(" RE ", F.col("p_name"), F.col("p_type"))).select("p_partkey", "p_name")


@query("range_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_discount >= 0.05")
def range_filter(spark: SparkSession, d: str) -> DataFrame:
    return V.in_bands(read(spark, d, "lineitem"), {"l_quantity": (10.0, 20.0), "l_discount": (0.05, None)}).select("l_orderkey", "l_linenumber")


def gaps(spark: SparkSession, d: str) -> DataFrame:
    return E.intervals(seconds(spark, d), tie="row")


@query("ioi_stats", f"""
WITH {GAPS}, a AS (SELECT track, count(gap) AS n, avg(gap) AS mean, stddev_pop(gap) AS std FROM g GROUP BY 1)
SELECT track, n, round(mean, 6) AS mean, round(std, 6) AS std, round(CASE WHEN n >= 2 AND mean <> 0 THEN std / mean ELSE 0 END, 6) AS cv, round(1 / (1 + CASE WHEN n >= 2 AND mean <> 0 THEN std / mean ELSE 0 END), 6) AS evenness FROM a
""")
def ioi_stats(spark: SparkSession, d: str) -> DataFrame:
    return E.interval_stats(gaps(spark, d)).select("track", "n", *r6("mean", "std", "cv", "evenness"))


@query("ioi_entropy", f"""
WITH {GAPS}, x AS (SELECT track, min(gap) AS lo, max(gap) AS hi, count(gap) AS m FROM g WHERE gap IS NOT NULL GROUP BY 1),
b AS (SELECT g.track, CASE WHEN hi > lo THEN least(floor((gap - lo) / (hi - lo) * 50), 49) ELSE 25 END AS bin, count(*) AS n, max(m) AS m FROM g JOIN x ON g.track = x.track WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT track, round(abs(sum(-(n / m) * ln(n / m))), 6) AS entropy, max(m) AS n_gaps FROM b GROUP BY 1
""")
def ioi_entropy(spark: SparkSession, d: str) -> DataFrame:
    return E.interval_entropy(gaps(spark, d)).select("track", *r6("entropy"), "n_gaps")


@query("rhythm_complexity", f"""
WITH {GAPS}, x AS (SELECT track, min(gap) AS lo, max(gap) AS hi, count(gap) AS m, CASE WHEN count(gap) >= 2 AND avg(gap) <> 0 THEN stddev_pop(gap) / avg(gap) ELSE 0 END AS cv FROM g WHERE gap IS NOT NULL GROUP BY 1),
b AS (SELECT g.track, CASE WHEN hi > lo THEN least(floor((gap - lo) / (hi - lo) * 50), 49) ELSE 25 END AS bin, count(*) AS n, max(m) AS m, max(cv) AS cv FROM g JOIN x ON g.track = x.track WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT track, round((least(abs(sum(-(n / m) * ln(n / m))) / 5, 1.0) + least(max(cv) / 2, 1.0)) / 2, 6) AS complexity FROM b GROUP BY 1
""")
def rhythm_complexity(spark: SparkSession, d: str) -> DataFrame:
    g = gaps(spark, d)
    return E.interval_entropy(g).join(E.interval_stats(g).select("track", "cv"), "track").select("track", F.round(E.complexity(F.col("entropy"), F.col("cv")), 6).alias("complexity"))


@query("stable_segments", f"""
WITH {GAPS}, i AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY t, row) - 1 AS i, coalesce(abs(gap - lag(gap) OVER (PARTITION BY track ORDER BY t, row)) > 14400, false) AS b FROM g WHERE gap IS NOT NULL),
s AS (SELECT *, sum(CAST(b AS INTEGER)) OVER (PARTITION BY track ORDER BY t, row ROWS UNBOUNDED PRECEDING) AS seg FROM i)
SELECT track, min(i) AS first, max(i) + 1 AS "end", count(*) AS n, round(stddev_pop(gap), 6) AS std FROM s GROUP BY track, seg HAVING count(*) >= 4
""")
def stable_segments(spark: SparkSession, d: str) -> DataFrame:
    out = E.stable_segments(gaps(spark, d), 14400.0, tie="row")
    return out.select("track", F.col("first").cast("long").alias("first"), F.col("end").cast("long").alias("end"), "n", *r6("std"))


@query("density_windows", f"""
WITH {EV}, sp AS (SELECT DISTINCT track, 2592000.0 AS dur FROM ev), w AS (SELECT track, dur, unnest(range(0, CAST(ceil(dur / 172800.0) AS BIGINT))) AS i FROM sp),
c AS (SELECT w.track, w.i, count(ev.t) / (least(max(w.i) * 172800.0 + 345600.0, max(dur)) - max(w.i) * 172800.0) AS rate FROM w LEFT JOIN ev ON ev.track = w.track AND ev.t >= w.i * 172800.0 AND ev.t < w.i * 172800.0 + 345600.0 GROUP BY 1, 2)
SELECT track, round(avg(rate) * 86400, 6) AS mean_rate, round(var_pop(rate) * 86400 * 86400, 6) AS var_rate, count(*) AS n_windows FROM c GROUP BY 1
""")
def density_windows(spark: SparkSession, d: str) -> DataFrame:
    e = seconds(spark, d)
    spans = e.select("track").distinct().withColumn("duration", F.lit(2592000.0))
    out = E.window_density(e, spans, 345600.0, 172800.0)
    return out.select("track", F.round(F.col("mean_rate") * 86400, 6).alias("mean_rate"), F.round(F.col("var_rate") * 86400 * 86400, 6).alias("var_rate"), "n_windows")


@query("on_event_ratio", f"""
WITH {EV}, k AS (SELECT kind FROM ev GROUP BY 1 ORDER BY kind LIMIT 1), l AS (SELECT * FROM ev WHERE kind <> (SELECT kind FROM k)), r AS (SELECT * FROM ev WHERE kind = (SELECT kind FROM k)),
h AS (SELECT DISTINCT l.row FROM l JOIN r ON l.track = r.track AND abs(l.t - r.t) <= 7200)
SELECT track, count(*) AS n, round(avg(CASE WHEN h.row IS NULL THEN 0.0 ELSE 1.0 END), 6) AS on_ratio FROM l LEFT JOIN h ON l.row = h.row GROUP BY 1
""")
def on_event_ratio(spark: SparkSession, d: str) -> DataFrame:
    e = seconds(spark, d)
    first = F.broadcast(e.agg(F.min("kind").alias("first")))  # one row
    e = e.crossJoin(first)
    out = E.near_any(e.filter("kind <> first"), e.filter("kind = first"), 7200.0)
    return out.groupBy("track").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("near").cast("double")), 6).alias("on_ratio"))


@query("asof_prev", """
SELECT event_id, (SELECT max(struct_pack(t := o_orderdate, k := o_orderkey)) FROM orders WHERE o_custkey = user_id AND o_orderdate <= ts).k AS order_before FROM events
""")
def asof_prev(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").cast("double").alias("t"))
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp").cast("double").alias("rt"), F.col("o_orderkey").alias("order"))
    return E.asof(e, o, "user_id", "t", "rt", "order").select("event_id", "order_before")


@query("nearest", "SELECT p_partkey, p_retailprice FROM part ORDER BY abs(p_retailprice - 1200), p_partkey LIMIT 20")
def nearest(spark: SparkSession, d: str) -> DataFrame:
    out = N.nearest_points(read(spark, d, "part"), "p_partkey", ["p_retailprice"], [1200.0], 20)
    return out.join(read(spark, d, "part").select("p_partkey", "p_retailprice"), "p_partkey").select("p_partkey", "p_retailprice")


@query("interval_slice", f"""
WITH {EV}, s AS (SELECT track, min(t) + 86400 AS a, min(t) + 432000 AS b FROM ev GROUP BY 1)
SELECT ev.row, round(round(ev.t - a, 5), 3) AS "offset" FROM ev JOIN s ON ev.track = s.track WHERE ev.t >= a - 0.0001 AND ev.t <= b + 0.0001
""")
def interval_slice(spark: SparkSession, d: str) -> DataFrame:
    e = seconds(spark, d)
    spans = e.groupBy("track").agg((F.min("t") + 86400).alias("a"), (F.min("t") + 432000).alias("b"))
    return E.inside(e, spans, "track", "t", "a", "b", 1e-4).select("row", F.round("offset", 3).alias("offset"))


@query("session_islands", f"""
WITH {EV}, b AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY track ORDER BY t, row) > 43200, true) AS b FROM ev), i AS (SELECT *, sum(CAST(b AS INTEGER)) OVER (PARTITION BY track ORDER BY t, row ROWS UNBOUNDED PRECEDING) AS k FROM b)
SELECT track, CAST(k AS BIGINT) AS island, round(min(t), 6) AS start, round(max(t), 6) AS "end", count(*) AS n FROM i GROUP BY 1, 2
""")
def session_islands(spark: SparkSession, d: str) -> DataFrame:
    return E.islands(seconds(spark, d), 43200.0, tie="row").select("track", "island", *r6("start", "end"), "n")


@query("bpm_validate", f"""
WITH {GAPS}, a AS (SELECT track, count(gap) AS n, 60 / nullif(avg(gap), 0) AS bpm, stddev_pop(gap) AS s FROM g GROUP BY 1)
SELECT track, round(coalesce(bpm, 120) * 1000, 6) AS milli_bpm, coalesce(n + 1 >= 15 AND bpm BETWEEN 40 AND 300 AND s <= 0.15, false) AS defined FROM a
""")
def bpm_validate(spark: SparkSession, d: str) -> DataFrame:
    return E.beats_per_minute(gaps(spark, d)).select("track", F.round(F.col("bpm") * 1000, 6).alias("milli_bpm"), "defined")


_PAIRS = " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(least(1, greatest(-1, corr({a}, {b}))), 6) + 0.0 AS r FROM lineitem" for a in NUMBERS for b in NUMBERS)


@query("corr_matrix", _PAIRS)
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return T.correlation_matrix(read(spark, d, "lineitem"), NUMBERS).select("x", "y", *r6("r"))


_RAW = " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS r FROM lineitem" for a in NUMBERS for b in NUMBERS)


@query("max_corr", f"WITH c AS ({_RAW}), o AS (SELECT * FROM c WHERE x <> y) SELECT x, arg_max(y, abs(r)) AS partner, round(arg_max(r, abs(r)), 6) AS r, round(avg(abs(r)), 5) AS mean_abs_r FROM o GROUP BY x")
def max_corr(spark: SparkSession, d: str) -> DataFrame:
    return T.strongest(T.correlation_matrix(read(spark, d, "lineitem"), NUMBERS)).select("x", "partner", *r6("r"), F.round("mean_abs_r", 5).alias("mean_abs_r"))


@query("spearman", """
WITH a AS (SELECT l_quantity, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)
SELECT round(corr(rx, ry), 6) AS rho, count(*) AS n FROM a
""")
def spearman(spark: SparkSession, d: str) -> DataFrame:
    return T.spearman(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(*r6("rho"), "n")


@query("bh_adjust", """
WITH p AS (SELECT p_partkey, ((p_partkey * 7919) % 1009) / 1009.0 + p_partkey * 1e-9 AS p FROM part), r AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS m FROM p)
SELECT p_partkey, round(least(1.0, min(p * m / k) OVER (ORDER BY k DESC ROWS UNBOUNDED PRECEDING)), 6) AS p_adjusted FROM r
""")
def bh_adjust(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", ((F.col("p_partkey") * 7919) % 1009 / F.lit(1009.0) + F.col("p_partkey") * 1e-9).alias("p"))
    return T.benjamini_hochberg(p).select("p_partkey", *r6("p_adjusted"))


@query("fisher_mean", """
WITH c AS (SELECT l_linenumber, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1)
SELECT round(tanh(avg(atanh(least(0.9999999, greatest(-0.9999999, r))))), 6) AS r FROM c
""")
def fisher_mean(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "lineitem").groupBy("l_linenumber").agg(T.correlation(F.col("l_quantity"), F.col("l_extendedprice")).alias("r"))
    return c.agg(F.round(T.fisher_mean(F.col("r")), 6).alias("r"))


@query("trend_line", """
WITH g AS (SELECT l_returnflag, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, min(l_quantity) AS x0, max(l_quantity) AS x1 FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, round(b, 4) AS slope, round(a, 4) AS intercept, x0, x1, round(a + b * x0, 4) AS y0, round(a + b * x1, 4) AS y1 FROM g
""")
def trend_line(spark: SparkSession, d: str) -> DataFrame:
    t = T.trend(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return t.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), "x0", "x1", F.round("y0", 4).alias("y0"), F.round("y1", 4).alias("y1"))


#: 1 / (1 - R^2) of three columns by their correlations.
_VIF = [(f, *[g for g in ("l_quantity", "l_discount", "l_tax") if g != f]) for f in ("l_quantity", "l_discount", "l_tax")]


@query("vif", " UNION ALL ".join(f"SELECT '{f}' AS feature, round(1 / (1 - (power(corr({f}, {a}), 2) + power(corr({f}, {b}), 2) - 2 * corr({f}, {a}) * corr({f}, {b}) * corr({a}, {b})) / (1 - power(corr({a}, {b}), 2))), 6) AS vif FROM lineitem" for f, a, b in _VIF))
def vif(spark: SparkSession, d: str) -> DataFrame:
    return T.variance_inflation(read(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]).select("feature", F.round("vif", 6).alias("vif"))


@query("mutual_information", """
WITH r AS (SELECT min(l_quantity) AS ax, max(l_quantity) AS bx, min(l_extendedprice) AS ay, max(l_extendedprice) AS by_ FROM lineitem),
c AS (SELECT least(15, floor((l_quantity - ax) / (bx - ax) * 16)) AS x, least(15, floor((l_extendedprice - ay) / (by_ - ay) * 16)) AS y, CAST(count(*) AS DOUBLE) AS n FROM lineitem, r GROUP BY 1, 2),
w AS (SELECT *, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS m FROM c)
SELECT round(sum(n / m * ln(n * m / (nx * ny))), 6) AS mi FROM w
""")
def mutual_information(spark: SparkSession, d: str) -> DataFrame:
    return T.mutual_information(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(*r6("mi"))


@query("histogram30", """
WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w, avg(value) AS m, stddev_pop(value) AS s FROM events), b AS (SELECT unnest(range(0, 30)) AS bin), n AS (SELECT least(29, floor((value - lo) / w)) AS bin, count(*) AS n FROM events, r WHERE value IS NOT NULL GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 6) AS lo, round(lo + (b.bin + 1) * w, 6) AS hi, coalesce(n, 0) AS n, round(m, 6) AS mean, round(s, 6) AS std FROM b CROSS JOIN r LEFT JOIN n ON n.bin = b.bin
""")
def histogram30(spark: SparkSession, d: str) -> DataFrame:
    return V.histogram(read(spark, d, "events"), "value").select("bin", *r6("lo", "hi"), "n", *r6("mean", "std"))


@query("norm_quadrant", """
WITH r AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_discount) AS c, max(l_discount) AS d, min(l_extendedprice) AS e, max(l_extendedprice) AS f, min(l_tax) AS g, max(l_tax) AS h FROM lineitem)
SELECT l_orderkey * 10 + l_linenumber AS id, round((l_quantity - a) / (b - a) - (l_discount - c) / (d - c), 6) + 0.0 AS x, round((l_extendedprice - e) / (f - e) - (l_tax - g) / (h - g), 6) + 0.0 AS y FROM lineitem, r
""")
def norm_quadrant(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return V.quadrant(li, "id", "l_quantity", "l_discount", "l_extendedprice", "l_tax").select("id", *r6("x", "y"))


@query("radar_clamp", """
WITH u AS (UNPIVOT (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part) ON p_size, p_retailprice INTO NAME feature VALUE v),
s AS (SELECT feature, quantile_cont(v, 0.01) AS a, quantile_cont(v, 0.99) AS b, avg(v) AS m, max(v) FILTER (WHERE p_partkey = 7) AS x FROM u GROUP BY 1)
SELECT feature, round(least(1, greatest(0, (x - a) / (b - a))), 6) AS value, round(least(1, greatest(0, (m - a) / (b - a))), 6) AS mean FROM s
""")
def radar_clamp(spark: SparkSession, d: str) -> DataFrame:
    return V.radar(read(spark, d, "part"), "p_partkey", ["p_size", "p_retailprice"], 7).select("feature", *r6("value", "mean"))


@query("classes_other", """
WITH g AS (SELECT CAST(c_nationkey AS VARCHAR) AS label, count(*) AS n, sum(c_acctbal) AS s, sum(CAST(c_custkey AS DOUBLE)) AS k FROM customer GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, label) AS i FROM g)
SELECT CASE WHEN i <= 20 THEN label ELSE '(other)' END AS label, CAST(sum(n) AS BIGINT) AS n, round(sum(k) / sum(n), 6) AS mean_x, round(sum(s) / sum(n), 4) AS mean_y FROM r GROUP BY 1
""")
def classes_other(spark: SparkSession, d: str) -> DataFrame:
    out = V.classes(read(spark, d, "customer"), F.col("c_nationkey").cast("string"), "c_custkey", "c_acctbal")
    return out.select("label", "n", *r6("mean_x"), F.round("mean_y", 4).alias("mean_y"))


@query("two_sigma", """
WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s, avg(l_quantity) AS m2, stddev_pop(l_quantity) AS s2 FROM lineitem)
SELECT l_orderkey, l_linenumber FROM lineitem, s WHERE abs(l_extendedprice - m) > 2 * s.s OR abs(l_quantity - m2) > 2 * s2
""")
def two_sigma(spark: SparkSession, d: str) -> DataFrame:
    return V.two_sigma(read(spark, d, "lineitem"), "l_extendedprice", "l_quantity").filter("outlier").select("l_orderkey", "l_linenumber")


@query("radar_filter", """
WITH s AS (SELECT stddev_pop(p_size) AS a, stddev_pop(p_retailprice) AS b FROM part), r AS (SELECT p_size AS x, p_retailprice AS y FROM part WHERE p_partkey = 7)
SELECT p_partkey FROM part, s, r WHERE p_partkey <> 7 AND abs(p_size - x) <= a AND abs(p_retailprice - y) <= b
""")
def radar_filter(spark: SparkSession, d: str) -> DataFrame:
    return V.like_reference(read(spark, d, "part"), "p_partkey", ["p_size", "p_retailprice"], 7).select("p_partkey")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_n(spark: SparkSession, d: str) -> DataFrame:
    return V.ranked(read(spark, d, "orders"), "o_totalprice", ["o_orderkey"], 25, tie="o_orderkey")


@query("top_per_group", "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def top_per_group(spark: SparkSession, d: str) -> DataFrame:
    return V.top_per_group(read(spark, d, "orders"), "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select("vec_id", "label", A.doubles(F.col("embedding")).alias("v"))


@query("zscore_embed", f"""
WITH {EMB}, u AS (SELECT vec_id, unnest(range(0, len(v))) AS place, unnest(v) AS x FROM e), s AS (SELECT place, avg(x) AS m, stddev_pop(x) AS s FROM u GROUP BY 1)
SELECT vec_id, CAST(u.place AS INTEGER) AS place, round((x - m) / s.s, 5) + 0.0 AS z FROM u JOIN s ON u.place = s.place
""")
def zscore_embed(spark: SparkSession, d: str) -> DataFrame:
    return N.standardised(vectors(spark, d), "vec_id", "v").select("vec_id", "place", (F.round("z", 5) + 0.0).alias("z"))


@query("cosine_topk", f"""
WITH {EMB}, p AS (SELECT a.vec_id AS id, b.vec_id AS other, round(list_cosine_similarity(a.v, b.v), 4) + 0.0 AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS INTEGER) AS rank, other, score FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 20
""")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    return N.nearest_by_cosine(read(spark, d, "embeddings"), "vec_id", "embedding", 20)


@query("mean_vector", f"""
WITH {EMB}, u AS (SELECT label, unnest(range(0, len(v))) AS place, unnest(v) AS x FROM e)
SELECT label, CAST(place AS INTEGER) AS place, round(avg(x), 6) + 0.0 AS mean FROM u GROUP BY 1, 2
""")
def mean_vector(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("label", F.posexplode("v").alias("place", "x")).groupBy("label", "place").agg((F.round(F.avg("x"), 6) + 0.0).alias("mean"))


def _checks(df: DataFrame, column: Column, key: str = "vec_id") -> DataFrame:
    """id, length and two weighted sums of an array: enough to compare it."""
    df = df.select(key, column.alias("a"))
    weighted = F.aggregate(F.transform("a", lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x)
    return df.select(key, F.size("a").alias("n"), (F.round(A.total(F.col("a")), 5) + 0.0).alias("total"), (F.round(weighted, 4) + 0.0).alias("weighted"))


def _sql_checks(source: str, array: str) -> str:
    return f"WITH {EMB}, x AS (SELECT vec_id, {array} AS a FROM {source}) SELECT vec_id, CAST(len(a) AS INTEGER) AS n, round(list_sum(a), 5) + 0.0 AS total, round(list_sum(list_transform(a, lambda x, i: x * i)), 4) + 0.0 AS weighted FROM x"


@query("interp32", _sql_checks("e", "list_transform(range(0, 32), lambda k: v[CAST(floor(k * 63 / 31.0) AS BIGINT) + 1] + (v[least(CAST(floor(k * 63 / 31.0) AS BIGINT) + 2, 64)] - v[CAST(floor(k * 63 / 31.0) AS BIGINT) + 1]) * (k * 63 / 31.0 - floor(k * 63 / 31.0)))"))
def interp32(spark: SparkSession, d: str) -> DataFrame:
    return _checks(vectors(spark, d), A.resample(F.col("v"), 32))


@query("rotate_roll", _sql_checks("e", "list_concat(v[(label % 12) + 1:12], v[1:label % 12])"))
def rotate_roll(spark: SparkSession, d: str) -> DataFrame:
    return _checks(vectors(spark, d), A.roll_left(F.slice("v", 1, 12), F.col("label") % 12))


@query("clr", _sql_checks("(SELECT vec_id, list_transform(v[1:12], lambda x: ln(abs(x) + 1e-9)) AS l FROM e)", "list_transform(l, lambda x: x - list_avg(l))"))
def clr(spark: SparkSession, d: str) -> DataFrame:
    return _checks(vectors(spark, d), A.centred_log_ratio(F.transform(F.slice("v", 1, 12), F.abs)))


_TIV = ", ".join(f"{w} * list_sum(list_transform(p, lambda x, j: x * {f}(2 * pi() * {k} * (j - 1) / 12)))" for k, w in enumerate(A.INTERVAL_WEIGHTS, 1) for f in ("cos", "-sin"))


@query("tiv", _sql_checks(f"(SELECT vec_id, [{_TIV}] AS w FROM (SELECT vec_id, list_transform(v[1:12], lambda x: abs(x) / list_sum(list_transform(v[1:12], lambda y: abs(y)))) AS p FROM e))", "list_transform(w, lambda x: x / sqrt(list_sum(list_transform(w, lambda y: y * y))))"))
def tiv(spark: SparkSession, d: str) -> DataFrame:
    return _checks(vectors(spark, d), A.tonal_interval_vector(F.transform(F.slice("v", 1, 12), F.abs)))


@query("bin_medians", _sql_checks("e", "list_transform(range(0, 10), lambda i: list_median(v[i * 64 // 10 + 1:(i + 1) * 64 // 10]))"))
def bin_medians(spark: SparkSession, d: str) -> DataFrame:
    return _checks(vectors(spark, d), A.bin_medians(F.col("v"), 10))


_NEXT = "(SELECT a.vec_id, a.v AS p, b.v AS q FROM e a JOIN e b ON b.vec_id = a.vec_id + 1)"


def _next(spark: SparkSession, d: str) -> DataFrame:
    a = vectors(spark, d)
    return a.select("vec_id", F.col("v").alias("p")).join(a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("q")), "vec_id")


@query("lerp", _sql_checks(_NEXT, "list_transform(p, lambda x, i: x * 0.75 + q[i] * 0.25)"))
def lerp(spark: SparkSession, d: str) -> DataFrame:
    return _checks(_next(spark, d), A.lerp(F.col("p"), F.col("q"), 0.25))


_SLERP = f"(SELECT *, acos(least(1, abs(c))) AS w, CASE WHEN c < 0 THEN -1.0 ELSE 1.0 END AS s FROM (SELECT *, list_cosine_similarity(p, q) AS c, sqrt(list_dot_product(p, p)) AS np, sqrt(list_dot_product(q, q)) AS nq FROM {_NEXT}))"


@query("slerp", _sql_checks(_SLERP, "list_transform(p, lambda x, i: (x / np * sin(w * 0.75) + s * q[i] / nq * sin(w * 0.25)) / sin(w) * (np * 0.75 + nq * 0.25))"))
def slerp(spark: SparkSession, d: str) -> DataFrame:
    return _checks(_next(spark, d), A.slerp(F.col("p"), F.col("q"), 0.25))


@query("centroid_knn", f"""
WITH {EMB}, c AS (SELECT avg(v[1]) AS a, avg(v[2]) AS b FROM e WHERE label = 0)
SELECT vec_id, round(sqrt((v[1] - a) ** 2 + (v[2] - b) ** 2), 6) AS distance FROM e, c WHERE label <> 0 ORDER BY sqrt((v[1] - a) ** 2 + (v[2] - b) ** 2), vec_id LIMIT 20
""")
def centroid_knn(spark: SparkSession, d: str) -> DataFrame:
    p = vectors(spark, d).select("vec_id", "label", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))
    c = p.filter("label = 0").agg(F.avg("x"), F.avg("y")).first()
    return N.nearest_points(p.filter("label <> 0"), "vec_id", ["x", "y"], [c[0], c[1]]).select("vec_id", *r6("distance"))


@query("scalar_encodings", """
SELECT p_partkey, round(sin(2 * pi() * (p_size % 12) / 12), 6) + 0.0 AS s, round(cos(2 * pi() * (p_size % 12) / 12), 6) + 0.0 AS c, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS minor, round(least(1500, greatest(1000, p_retailprice)), 6) AS clamped,
round(20 * log10(p_retailprice / 1000), 6) + 0.0 AS db FROM part
""")
def scalar_encodings(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    s, c = S.circular(F.col("p_size") % 12)
    return p.select("p_partkey", (F.round(s, 6) + 0.0).alias("s"), (F.round(c, 6) + 0.0).alias("c"), S.is_minor(F.when(F.col("p_size") > 25, "Minor").otherwise("major")).alias("minor"), F.round(S.clamp(F.col("p_retailprice"), 1000.0, 1500.0), 6).alias("clamped"), (F.round(S.decibels(F.col("p_retailprice") / 1000, -120.0), 6) + 0.0).alias("db"))


@query("octave_bpm", """
SELECT p_partkey, arg_min(CAST(p_size * f * 4.0 AS DOUBLE), struct_pack(d := abs(p_size * 4.0 * f / (p_retailprice / 10) - 1), i := i)) AS bpm FROM part, (VALUES (1.0, 0), (0.5, 1), (2.0, 2), (0.25, 3), (4.0, 4)) t(f, i) GROUP BY 1
""")
def octave_bpm(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    return p.select("p_partkey", S.octave_corrected(F.col("p_size") * F.lit(4.0), F.col("p_retailprice") / 10).alias("bpm"))


@query("pivot_export", """
WITH l AS (SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1)
SELECT user_id, KINDS FROM l GROUP BY user_id
""".replace("KINDS", ", ".join(f"max(value) FILTER (WHERE event_type = '{k}') AS \"{k}\"" for k in EVENT_KINDS)))
def pivot_export(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts")
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())  # columns of the result
    return P.wide(R.last_wins(e, ["user_id", "event_type"], ["ts", "event_id"]), "user_id", "event_type", "value", kinds)
