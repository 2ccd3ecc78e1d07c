"""Queries of the array, text and store functions, compared by value, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.functions import arrays as A
from featherline.functions import scalars as S
from featherline.functions import text as X
from featherline.operators import store as R
from featherline.plans.catalog import query
from featherline.plans.definitions import EMB, r6, read, vectors
from featherline.sources import records as C

#: Every vector with the next one.
_TWO = f"{EMB}, p AS (SELECT a.vec_id, a.v AS a, b.v AS b FROM e a JOIN e b ON b.vec_id = a.vec_id + 1)"


def _two(spark: SparkSession, d: str) -> DataFrame:
    v = vectors(spark, d).select("vec_id", "v")
    return v.withColumnRenamed("v", "a").join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("b")), "vec_id")


def _values(df: DataFrame, a: Column, digits: int = 6) -> DataFrame:
    return df.select("vec_id", F.posexplode(a).alias("i", "x")).select("vec_id", "i", (F.round("x", digits) + 0.0).alias("x"))


def _unnested(source: str, n: str, x: str) -> str:
    """Rows (vec_id, i, x) of an expression of i, a place from 0 to below n."""
    return f"SELECT vec_id, CAST(i AS INTEGER) AS i, round({x}, 6) + 0.0 AS x FROM (SELECT *, unnest(range(0, {n})) AS i FROM {source})"


_SLICE = f"{EMB}, c AS (SELECT vec_id, v[1:8 + vec_id % 9] AS v FROM e)"


def _cut(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", F.slice("v", F.lit(1), (8 + F.col("vec_id") % 9).cast("int")).alias("v"))


@query("fitted_length", f"WITH {_SLICE} " + _unnested("c", "12", "v[least(i + 1, len(v))]"))
def fitted_length(spark: SparkSession, d: str) -> DataFrame:
    return _values(_cut(spark, d), A.fit_length(F.col("v"), 12))


@query("resampled_values", f"WITH {_SLICE}, q AS (SELECT vec_id, v, i, i * (len(v) - 1) / 11.0 AS p FROM (SELECT *, unnest(range(0, 12)) AS i FROM c)) SELECT vec_id, CAST(i AS INTEGER) AS i, round(v[CAST(floor(p) AS INTEGER) + 1] + (p - floor(p)) * (v[least(CAST(floor(p) AS INTEGER) + 2, len(v))] - v[CAST(floor(p) AS INTEGER) + 1]), 6) + 0.0 AS x FROM q")
def resampled_values(spark: SparkSession, d: str) -> DataFrame:
    return _values(_cut(spark, d), A.resample(F.col("v"), 12))


@query("resampled_centres", f"WITH {_SLICE}, q AS (SELECT vec_id, v, i, least(greatest((i + 0.5) * len(v) / 20.0 - 0.5, 0), len(v) - 1.0) AS p FROM (SELECT *, unnest(range(0, 20)) AS i FROM c)) SELECT vec_id, CAST(i AS INTEGER) AS i, round(v[CAST(floor(p) AS INTEGER) + 1] + (p - floor(p)) * (v[least(CAST(floor(p) AS INTEGER) + 2, len(v))] - v[CAST(floor(p) AS INTEGER) + 1]), 6) + 0.0 AS x FROM q")
def resampled_centres(spark: SparkSession, d: str) -> DataFrame:
    return _values(_cut(spark, d), A.resample_centres(F.col("v"), 20))


@query("rolled_values", f"WITH {EMB} " + _unnested("e", "len(v)", "v[(i + vec_id % 13) % len(v) + 1]"))
def rolled_values(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.roll_left(F.col("v"), (F.col("vec_id") % 13).cast("int")))


@query("rolled_fractions", f"WITH {EMB}, q AS (SELECT vec_id, v, i, (i - (vec_id % 7) - 0.25 + 64) % 64 AS p FROM (SELECT *, unnest(range(0, 64)) AS i FROM e)) SELECT vec_id, CAST(i AS INTEGER) AS i, round(v[CAST(floor(p) AS INTEGER) + 1] * (1 - (p - floor(p))) + v[(CAST(floor(p) AS INTEGER) + 1) % 64 + 1] * (p - floor(p)), 6) + 0.0 AS x FROM q")
def rolled_fractions(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.roll_fraction(F.col("v"), F.col("vec_id") % 7 + F.lit(0.25)))


@query("log_ratios", f"WITH {EMB}, q AS (SELECT vec_id, list_transform(v[1:12], lambda x: ln(abs(x) + 0.01 + 1e-9)) AS v FROM e), m AS (SELECT vec_id, v, list_sum(v) / 12 AS m FROM q) " + _unnested("m", "12", "v[i + 1] - m"))
def log_ratios(spark: SparkSession, d: str) -> DataFrame:
    positive = F.transform(F.slice("v", 1, 12), lambda x: F.abs(x.cast("double")) + 0.01)
    return _values(vectors(spark, d), A.centred_log_ratio(positive))


@query("peak_scaled", f"WITH {EMB} " + _unnested("e", "len(v)", "CASE WHEN list_max(v) > 0 THEN v[i + 1] / list_max(v) ELSE v[i + 1] END"))
def peak_scaled(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.peak_scaled(A.doubles(F.col("v"))))


@query("activation_curve", """
WITH u AS (SELECT user_id AS vec_id, unnest(range(0, 16)) AS i, list(value) FILTER (WHERE value BETWEEN 0 AND 60) AS t FROM events GROUP BY 1), q AS (SELECT vec_id, i, coalesce(list_sum(list_transform(t, lambda x: exp(-0.5 * power((i - x / 60 * 16) / 2, 2)))), 0) AS x FROM u), m AS (SELECT vec_id, max(x) AS m FROM q GROUP BY 1)
SELECT q.vec_id, CAST(i AS INTEGER) AS i, round(CASE WHEN m > 0 THEN x / m ELSE x END, 6) + 0.0 AS x FROM q JOIN m ON q.vec_id = m.vec_id
""")
def activation_curve(spark: SparkSession, d: str) -> DataFrame:
    times = read(spark, d, "events").groupBy(F.col("user_id").alias("vec_id")).agg(F.collect_list("value").alias("t"))
    return _values(times, A.activation(F.col("t"), F.lit(60.0), 16))


_COS = "list_sum(list_transform(range(1, 65), lambda j: a[j] * b[j])) / (sqrt(list_sum(list_transform(a, lambda x: x * x))) * sqrt(list_sum(list_transform(b, lambda x: x * x))))"


@query("mixed_linearly", f"WITH {_TWO} " + _unnested("p", "64", "a[i + 1] * 0.7 + b[i + 1] * 0.3"))
def mixed_linearly(spark: SparkSession, d: str) -> DataFrame:
    return _values(_two(spark, d), A.lerp(F.col("a"), F.col("b"), 0.3))


@query("mixed_spherically", f"WITH {_TWO}, w AS (SELECT *, acos(least(1, abs({_COS}))) AS w, sqrt(list_sum(list_transform(a, lambda x: x * x))) AS na, sqrt(list_sum(list_transform(b, lambda x: x * x))) AS nb, CASE WHEN {_COS} < 0 THEN -1 ELSE 1 END AS s FROM p) " + _unnested("w", "64", "(a[i + 1] / na * sin(w * 0.7) + s * b[i + 1] / nb * sin(w * 0.3)) / sin(w) * (na * 0.7 + nb * 0.3)"))
def mixed_spherically(spark: SparkSession, d: str) -> DataFrame:
    return _values(_two(spark, d), A.slerp(F.col("a"), F.col("b"), 0.3))


@query("mixed_raw", f"WITH {_TWO}, w AS (SELECT *, acos(greatest(-1, least(1, {_COS}))) AS w FROM p) " + _unnested("w", "64", "(a[i + 1] * sin(w * 0.7) + b[i + 1] * sin(w * 0.3)) / sin(w)"))
def mixed_raw(spark: SparkSession, d: str) -> DataFrame:
    return _values(_two(spark, d), A.raw_slerp(F.col("a"), F.col("b"), 0.3))


@query("steered", f"WITH {_TWO} " + _unnested("p", "64", "a[i + 1] + 1.5 * b[i + 1]"))
def steered(spark: SparkSession, d: str) -> DataFrame:
    return _values(_two(spark, d), A.steer(F.col("a"), F.col("b"), 1.5))


@query("blended_groups", f"WITH {_TWO} " + _unnested("p", "64", "a[i + 1] + (b[i + 1] - a[i + 1]) * CASE i % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 ELSE 0 END"))
def blended_groups(spark: SparkSession, d: str) -> DataFrame:
    groups = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i % 3)
    return _values(_two(spark, d), A.blend_groups(F.col("a"), F.col("b"), groups, {0: 1.7, 1: 0.25}))


@query("faded", f"WITH {EMB} " + _unnested("e", "64", "v[i + 1] * least(1, i / 8.0, (63 - i) / 8.0)"))
def faded(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.fade(F.col("v"), 8))


@query("soft_clipped", f"WITH {EMB} " + _unnested("e", "64", "(exp(2 * v[i + 1]) - 1) / (exp(2 * v[i + 1]) + 1)"))
def soft_clipped(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.soft_clip(F.col("v")))


@query("projected", f"WITH {EMB}, q AS (SELECT vec_id, [list_sum(list_transform(range(1, 65), lambda j: v[j] - 0.01)), list_sum(list_transform(range(1, 65), lambda j: (v[j] - 0.01) * (j - 1)))] AS v FROM e) " + _unnested("q", "2", "v[i + 1]"))
def projected(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.project(F.col("v"), [[1.0] * 64, [float(j) for j in range(64)]], [0.01] * 64))


@query("median_bins", f"WITH {_SLICE}, q AS (SELECT vec_id, i, list_sort(v[CAST(floor(i * len(v) / 5.0) AS INTEGER) + 1:CAST(floor((i + 1) * len(v) / 5.0) AS INTEGER)]) AS s FROM (SELECT *, unnest(range(0, 5)) AS i FROM c)) SELECT vec_id, CAST(i AS INTEGER) AS i, round((s[(len(s) + 1) // 2] + s[len(s) // 2 + 1]) / 2, 6) + 0.0 AS x FROM q")
def median_bins(spark: SparkSession, d: str) -> DataFrame:
    return _values(_cut(spark, d), A.bin_medians(F.col("v"), 5))


@query("name_parts", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'Artist ' || o_custkey END AS artist, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS album, CASE o_orderkey % 3 WHEN 0 THEN 'Solo ' || o_custkey WHEN 1 THEN o_orderstatus ELSE o_orderstatus || ' - live' END AS track FROM orders")
def name_parts(spark: SparkSession, d: str) -> DataFrame:
    folder = F.expr("CASE o_orderkey % 3 WHEN 0 THEN '07. Solo ' || o_custkey WHEN 1 THEN 'Artist ' || o_custkey || ' - ' || o_orderstatus ELSE '3 - Artist ' || o_custkey || ' - ' || o_orderpriority || ' - ' || o_orderstatus || ' - live' END")
    p = X.name_parts(folder)
    return read(spark, d, "orders").select("o_orderkey", p["artist"].alias("artist"), p["album"].alias("album"), p["track"].alias("track"))


@query("class_labels", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN CASE WHEN p_size >= 25 THEN p_brand ELSE 'other' END WHEN 2 THEN p_type ELSE p_brand END AS label FROM part")
def class_labels(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr("CASE p_size % 4 WHEN 0 THEN '{}' WHEN 1 THEN \"{'other': 25.5, '\" || p_brand || \"': \" || (p_size + 1) || \".0}\" WHEN 2 THEN \"['\" || p_type || \"', 'x']\" ELSE p_brand END")
    return read(spark, d, "part").select("p_partkey", X.class_label(raw).alias("label"))


@query("folder_names", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE replace(c_name, '#', '') || ' - ' || c_mktsegment END AS folder, c_custkey % 5 = 0 AS various FROM customer")
def folder_names(spark: SparkSession, d: str) -> DataFrame:
    artist = F.expr("CASE WHEN c_custkey % 4 = 0 THEN ' ?*' ELSE ' ' || replace(c_name, '#', ':') || '|' END")
    various = F.expr("CASE c_custkey % 5 WHEN 0 THEN ' Unknown Artist' ELSE c_name END")
    return read(spark, d, "customer").select("c_custkey", X.folder_name(artist, F.concat(F.lit("<"), "c_mktsegment")).alias("folder"), X.various_artists(various).alias("various"))


@query("titles", "SELECT o_orderkey, o_orderpriority AS title, 'Part ' || o_custkey AS plain FROM orders")
def titles(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return o.select("o_orderkey", X.title_of(F.concat(F.lit("12. "), F.regexp_replace("o_orderpriority", "^", "- "))).alias("title"), X.without_number(F.concat(F.lit("004 Part "), "o_custkey")).alias("plain"))


@query("label_lists", "WITH m AS (SELECT user_id, event_type, floor(max(value)) / 100 AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, event_type) AS k FROM m) SELECT user_id, string_agg(event_type || ' (' || printf('%.2f', v) || ')', ', ' ORDER BY k) AS labels FROM r WHERE k <= 2 GROUP BY 1")
def label_lists(spark: SparkSession, d: str) -> DataFrame:
    best = read(spark, d, "events").filter("value is not null").groupBy("user_id", "event_type").agg((F.floor(F.max("value")) / 100).alias("v"))
    return best.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("m")).select("user_id", X.top_labels(F.col("m"), 2).alias("labels"))


@query("file_fingerprints", "SELECT doc_id, octet_length(encode(coalesce(text, ''))) || '_' || substr(md5(coalesce(text, '')), 1, 16) AS f FROM documents WHERE octet_length(encode(coalesce(text, ''))) <= 8192")
def file_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    content = F.coalesce("text", F.lit("")).cast("binary")
    return read(spark, d, "documents").filter(F.octet_length(content) <= 8192).select("doc_id", R.file_fingerprint(content).alias("f"))


@query("full_mixes", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 5 <> 2")
def full_mixes(spark: SparkSession, d: str) -> DataFrame:
    key = F.expr("'Song_' || l_orderkey || CASE l_linenumber % 5 WHEN 2 THEN '_vocals' WHEN 3 THEN '_vocal' ELSE '' END")
    return C.full_mix_only(read(spark, d, "lineitem").withColumn("key", key)).select("l_orderkey", "l_linenumber")


@query("level_gaps", "SELECT l_orderkey, l_linenumber, l_linenumber = 1 AS silent_below, l_discount < 0.05 AND l_tax < 0.04 AND l_quantity < 20 AS quiet FROM lineitem")
def level_gaps(spark: SparkSession, d: str) -> DataFrame:
    low = F.when(F.col("l_linenumber").isin(1, 2), -60.0).otherwise(F.col("l_quantity"))
    air = F.when(F.col("l_linenumber") == 2, F.lit(None)).otherwise(F.col("l_tax"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.gap_in_bands(low, low, low, air).alias("silent_below"), S.quiet_stem(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity"), 0.05, 0.04, 20.0).alias("quiet"))


@query("seeded_rows", "SELECT CAST(count(*) AS BIGINT) AS n, true AS repeats FROM (SELECT * FROM orders LIMIT 400)")
def seeded_rows(spark: SparkSession, d: str) -> DataFrame:
    a, b = (R.seeded_sample(read(spark, d, "orders"), "o_orderkey", 400, 3).select("o_orderkey") for _ in range(2))
    return a.join(b.withColumn("again", F.lit(True)), "o_orderkey", "left").agg(F.count(F.lit(1)).alias("n"), F.every(F.coalesce("again", F.lit(False))).alias("repeats"))


@query("tonal_vectors", f"WITH {EMB}, q AS (SELECT vec_id, list_transform(v[1:12], lambda x: abs(x)) AS v FROM e), s AS (SELECT vec_id, list_transform(v, lambda x: x / list_sum(v)) AS v FROM q), k AS (SELECT vec_id, list_transform(range(0, 12), lambda i: [3.0, 8.0, 11.5, 15.0, 14.5, 7.5][i // 2 + 1] * list_sum(list_transform(range(0, 12), lambda j: v[j + 1] * CASE WHEN i % 2 = 0 THEN cos(2 * pi() * (i // 2 + 1) * j / 12) ELSE -sin(2 * pi() * (i // 2 + 1) * j / 12) END))) AS v FROM s) " + _unnested("k", "12", "v[i + 1] / sqrt(list_sum(list_transform(v, lambda x: x * x)))"))
def tonal_vectors(spark: SparkSession, d: str) -> DataFrame:
    return _values(vectors(spark, d), A.tonal_interval_vector(F.transform(F.slice("v", 1, 12), lambda x: F.abs(x))))


@query("finite_values", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS x, coalesce(nullif(l_discount, 0), nullif(l_tax, 0)) AS first FROM lineitem")
def finite_values(spark: SparkSession, d: str) -> DataFrame:
    x = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.finite(x).alias("x"), S.first_truthy(F.col("l_discount"), F.col("l_tax")).alias("first"))
