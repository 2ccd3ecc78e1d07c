"""Queries of names, listings, the incremental driver, stores, views and smaller operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featherline.functions import arrays as A
from featherline.functions import names as M
from featherline.functions import scalars as S
from featherline.functions import text as X
from featherline.operators import events as E
from featherline.operators import explore as V
from featherline.operators import incremental as I
from featherline.operators import listing as L
from featherline.operators import series as Z
from featherline.operators import stats as T
from featherline.operators import store as R
from featherline.plans.catalog import query
from featherline.plans.definitions import EMB, EV, NUMBERS, r6, read, seconds, vectors

#: A listing made of orders and their lines: full mixes, stems, crops, stems of crops and sidecars of a folder for each customer.
_KIND = "CASE l_linenumber % 7 WHEN 0 THEN 'full_mix.flac' WHEN 1 THEN 'drums.mp3' WHEN 2 THEN 'Song_' || (l_partkey % 5) || '.wav' WHEN 3 THEN 'Song_' || (l_partkey % 5) || '_bass.ogg' WHEN 4 THEN 'C' || (o_custkey % 40) || '.BEATS_GRID' WHEN 5 THEN 'full_mix.' || CASE l_suppkey % 2 WHEN 0 THEN 'mp3' ELSE 'm4a' END ELSE 'Take Kick_' || l_suppkey || '.mid' END"
FILES = f"files AS (SELECT '/lib/C' || (o_custkey % 40) || CASE WHEN o_custkey % 9 = 0 THEN '_3' ELSE '' END || '/' || {_KIND} AS path, max(CAST(l_quantity AS BIGINT)) AS length FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)"
_PARTS = FILES + r", f AS (SELECT path, length, regexp_replace(path, '/[^/]*$', '') AS folder, regexp_extract(path, '[^/]*$') AS name, regexp_extract(path, '\.[^./]+$') AS kind, regexp_replace(regexp_extract(path, '[^/]*$'), '\.[^.]+$', '') AS stem FROM files), a AS (SELECT * FROM f WHERE kind IN ('.flac', '.wav', '.mp3', '.ogg', '.m4a', '.aiff', '.aif'))"


def files(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.selectExpr(f"'/lib/C' || (o_custkey % 40) || CASE WHEN o_custkey % 9 = 0 THEN '_3' ELSE '' END || '/' || {_KIND} AS path", "CAST(l_quantity AS BIGINT) AS length").groupBy("path").agg(F.max("length").alias("length")).select(F.explode(F.array("path")).alias("path"), "length")  # conditions on a path stay above, not on each pair of rows joined


@query("path_parts", f"WITH {_PARTS} SELECT path, folder, name, stem, kind, folder || '/' || regexp_extract(folder, '[^/]*$') || '.INFO' AS info, folder || '/' || stem || '.INFO' AS crop_info, TRY_CAST(regexp_extract(stem, '_([+-]?[0-9]+)$', 1) AS INTEGER) AS number, regexp_matches(stem, '_[+-]?[0-9]+$') AS is_crop, stem = 'full_mix' AS organized FROM f")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return files(spark, d).select("path", M.folder(p).alias("folder"), M.base_name(p).alias("name"), M.stem(p).alias("stem"), M.suffix(p).alias("kind"), M.sidecar(p, ".INFO").alias("info"), M.crop_sidecar(p).alias("crop_info"), M.crop_number(p).alias("number"), M.is_crop(p).alias("is_crop"), M.is_organized(p).alias("organized"))


@query("section_numbers", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_size WHEN 1 THEN NULL ELSE NULL END AS section FROM part")
def section_numbers(spark: SparkSession, d: str) -> DataFrame:
    name = F.expr("CASE p_size % 3 WHEN 0 THEN p_name || '_section_' || p_size || '.flac' WHEN 1 THEN p_name || '_section_x' ELSE p_name END")
    return read(spark, d, "part").select("p_partkey", M.section_number(name).alias("section"))


@query("organized_folders", f"WITH {_PARTS} SELECT DISTINCT folder FROM a WHERE stem = 'full_mix' AND NOT regexp_matches(folder, '_[0-9]+$') AND folder <> '/lib/C7'")
def organized_folders(spark: SparkSession, d: str) -> DataFrame:
    return L.organized_folders(files(spark, d), ("C7",))


@query("crop_folders", f"WITH {_PARTS} SELECT folder, count(*) AS n_crops FROM a WHERE regexp_matches(stem, '_[+-]?[0-9]+$') GROUP BY 1")
def crop_folders(spark: SparkSession, d: str) -> DataFrame:
    return L.crop_folders(files(spark, d))


@query("stem_files", f"WITH {_PARTS}, r AS (SELECT *, list_position(['.flac', '.wav', '.mp3', '.ogg', '.m4a', '.aiff', '.aif'], kind) AS k FROM a) SELECT folder, stem, arg_min(path, k) AS path FROM r WHERE stem IN ('drums', 'bass', 'other', 'vocals', 'kick', 'snare', 'cymbals', 'toms', 'percussion', 'full_mix') AND folder IN (SELECT folder FROM a WHERE stem = 'full_mix') GROUP BY 1, 2")
def stem_files(spark: SparkSession, d: str) -> DataFrame:
    return L.stem_files(files(spark, d), full_mix=True)


@query("crop_stem_files", f"WITH {_PARTS} SELECT s.folder, c.stem AS crop, 'bass' AS stem, s.path FROM a s JOIN a c ON s.folder = c.folder AND s.stem = c.stem || '_bass' WHERE regexp_matches(c.stem, '_[+-]?[0-9]+$')")
def crop_stem_files(spark: SparkSession, d: str) -> DataFrame:
    return L.crop_stem_files(files(spark, d)).select("folder", "crop", "stem", "path")


@query("grid_files", f"WITH {_PARTS} SELECT folder, 'beats' AS what, path FROM f WHERE kind = '.BEATS_GRID' AND stem = regexp_extract(folder, '[^/]*$')")
def grid_files(spark: SparkSession, d: str) -> DataFrame:
    return L.sidecars(files(spark, d), {".BEATS_GRID": "beats", ".ONSETS_GRID": "onsets"})


@query("midi_files", f"WITH {_PARTS} SELECT folder, path FROM f WHERE kind IN ('.mid', '.midi') AND contains(lower(stem), 'kick')")
def midi_files(spark: SparkSession, d: str) -> DataFrame:
    return L.files_of_type(files(spark, d), [".mid", ".midi"], "kick")


@query("corrupt_files", f"WITH {_PARTS} SELECT path, length FROM f WHERE kind = '.mp3' AND length < 45")
def corrupt_files(spark: SparkSession, d: str) -> DataFrame:
    return L.too_small(files(spark, d).filter(M.suffix(F.col("path")) == ".mp3"), 45)


@query("source_replacements", f"WITH {_PARTS}, z AS (SELECT folder, arg_min(path, list_position(['.mp3', '.m4a'], kind)) AS path FROM a WHERE stem = 'full_mix' AND kind IN ('.mp3', '.m4a') GROUP BY 1), s AS (SELECT DISTINCT 'c' || (c_custkey % 30) AS name, '/new/C' || (c_custkey % 30) || '.flac' AS source FROM customer) SELECT folder, path, source FROM z LEFT JOIN s ON lower(regexp_extract(folder, '[^/]*$')) = name")
def source_replacements(spark: SparkSession, d: str) -> DataFrame:
    sources = read(spark, d, "customer").selectExpr("'/new/C' || (c_custkey % 30) || '.flac' AS path").distinct()
    return L.replacements(files(spark, d), sources, (".mp3", ".m4a"))


#: Records: of each customer a map from order priority to its greatest price, of some customers only.
_STORE = "s AS (SELECT o_custkey AS k, o_orderpriority AS p, max(o_totalprice) AS x FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1, 2)"


def _store(spark: SparkSession, d: str) -> DataFrame:
    best = read(spark, d, "orders").filter("o_custkey % 3 <> 0").groupBy(F.col("o_custkey").alias("k"), "o_orderpriority").agg(F.max("o_totalprice").alias("x"))
    return best.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "x"))).alias("payload"))


_NEED = ["1-URGENT", "2-HIGH"]
_PLAN = f"WITH {_STORE}, have AS (SELECT k FROM s WHERE p IN ('1-URGENT', '2-HIGH') GROUP BY 1 HAVING count(*) = 2), t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'locked' WHEN c_custkey IN (SELECT k FROM have) THEN 'complete' ELSE 'ready' END AS status FROM customer)"


def _keys(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_custkey").alias("k"))


@query("work_status", _PLAN + " SELECT k, status FROM t")
def work_status(spark: SparkSession, d: str) -> DataFrame:
    keys = _keys(spark, d)
    return I.status(keys, _store(spark, d), "k", _NEED, keys.filter("k % 11 = 0")).select("k", "status")


@query("work_counts", _PLAN + " SELECT count(*) AS total, count(*) FILTER (WHERE status = 'ready') AS ready, count(*) FILTER (WHERE status = 'complete') AS complete, count(*) FILTER (WHERE status = 'locked') AS locked FROM t")
def work_counts(spark: SparkSession, d: str) -> DataFrame:
    keys = _keys(spark, d)
    return I.counts(I.status(keys, _store(spark, d), "k", _NEED, keys.filter("k % 11 = 0")))


@query("incremental_run", _PLAN + """, w AS (SELECT k FROM t WHERE status = 'ready' AND k % 5 <> 0), n AS (SELECT k, '1-URGENT' AS p, CAST(k AS DOUBLE) AS x FROM w UNION ALL SELECT k, '2-HIGH', 2.0 FROM w),
m AS (SELECT coalesce(s.k, n.k) AS k, coalesce(s.p, n.p) AS p, coalesce(n.x, s.x) AS x FROM s FULL JOIN n ON s.k = n.k AND s.p = n.p)
SELECT m.k, m.p AS name, m.x, CASE WHEN t.status IS NULL THEN 'kept' WHEN t.status <> 'ready' THEN t.status WHEN m.k % 5 <> 0 THEN 'done' ELSE 'failed' END AS outcome FROM m LEFT JOIN t ON m.k = t.k
""")
def incremental_run(spark: SparkSession, d: str) -> DataFrame:
    keys = _keys(spark, d)
    work = lambda ready: ready.select("k", F.when(F.col("k") % 5 != 0, F.create_map(F.lit("1-URGENT"), F.col("k").cast("double"), F.lit("2-HIGH"), F.lit(2.0))).alias("payload"))
    out = I.run(keys, _store(spark, d), "k", _NEED, work, keys.filter("k % 11 = 0"))
    return out.select("k", F.explode("payload").alias("name", "x"), "outcome")


@query("store_lookup", f"WITH {_STORE} SELECT c_custkey AS k, x, c_custkey IN (SELECT k FROM s) AS has FROM customer LEFT JOIN s ON c_custkey = k AND p = '3-MEDIUM' WHERE c_custkey % 50 < 3")
def store_lookup(spark: SparkSession, d: str) -> DataFrame:
    return R.lookup(_keys(spark, d).filter("k % 50 < 3"), _store(spark, d), "k", "payload", "3-MEDIUM").select("k", F.col("value").alias("x"), "has")


@query("store_size", f"WITH {_STORE} SELECT count(DISTINCT k) AS n_keys, count(*) AS n_entries FROM s")
def store_size(spark: SparkSession, d: str) -> DataFrame:
    return R.store_size(_store(spark, d), "k", "payload")


@query("strip_entries", f"WITH {_STORE} SELECT k, count(*) FILTER (WHERE p = '5-LOW' OR p LIKE '1-%') AS removed, count(*) AS before FROM s GROUP BY 1")
def strip_entries(spark: SparkSession, d: str) -> DataFrame:
    return R.strip_entries(_store(spark, d), "payload", ("5-LOW",), ("1-",)).select("k", "removed", "before")


@query("relative_position", "SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice - 20000 <= 0 THEN 0.0 ELSE round(greatest(0, least(1, (l_quantity * 1000 - 5000) / (l_extendedprice - 20000))), 9) END AS position FROM lineitem")
def relative_position(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(S.relative_position(F.col("l_quantity") * 1000 - 5000, F.col("l_extendedprice") - 20000), 9).alias("position"))


@query("dominant_class", f"WITH {EV}, c AS (SELECT track, CAST(round_even(value, 0) AS BIGINT) % 12 AS c, count(*) AS n FROM ev WHERE value IS NOT NULL GROUP BY 1, 2) SELECT track, arg_min(c, struct_pack(n := -n, c := c)) AS c FROM c GROUP BY 1")
def dominant_class(spark: SparkSession, d: str) -> DataFrame:
    return Z.dominant_class(seconds(spark, d), "track", "value").select("track", F.col("class").alias("c"))


@query("onset_density", f"WITH {EV}, s AS (SELECT track, count(*) AS n, max(t) - 100000 AS d FROM ev GROUP BY 1) SELECT track, round(CASE WHEN d <= 0 THEN 0 ELSE n / d END, 12) + 0.0 AS density FROM s")
def onset_density(spark: SparkSession, d: str) -> DataFrame:
    e = seconds(spark, d)
    return E.density(e, e.groupBy("track").agg((F.max("t") - 100000).alias("duration"))).select("track", F.round("density", 12).alias("density"))


@query("nearest_event", f"WITH {EV}, v AS (SELECT * FROM ev WHERE kind = 'view'), p AS (SELECT * FROM ev WHERE kind = 'purchase') SELECT p.row, arg_min(v.t, struct_pack(d := abs(v.t - p.t), t := v.t)) AS nearest FROM p LEFT JOIN v ON p.track = v.track GROUP BY 1")
def nearest_event(spark: SparkSession, d: str) -> DataFrame:
    e = seconds(spark, d)
    return E.nearest(e.filter("kind = 'purchase'").select("track", "row", "t"), e.filter("kind = 'view'").select("track", "t"), "track", "t").select("row", "nearest")


@query("stable_coverage", f"""
WITH {EV}, q AS (SELECT track, row, row_number() OVER (PARTITION BY track ORDER BY t, row) AS i FROM ev), x AS (SELECT track, i, CAST(sum(CASE WHEN i % 40 < 25 THEN 0.5 ELSE 0.3 + (i * 7 % 5) / 10.0 END) OVER (PARTITION BY track ORDER BY i) AS DOUBLE) AS t FROM q),
g AS (SELECT *, round(t - lag(t) OVER (PARTITION BY track ORDER BY i), 6) AS gap FROM x), b AS (SELECT *, coalesce(abs(gap - lag(gap) OVER (PARTITION BY track ORDER BY i)) > 0.05, false) AS b FROM g WHERE gap IS NOT NULL),
s AS (SELECT *, sum(CAST(b AS INTEGER)) OVER (PARTITION BY track ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM b), r AS (SELECT track, k, sum(gap) AS d FROM s GROUP BY 1, 2 HAVING count(*) >= 4 AND stddev_pop(gap) <= 0.15),
a AS (SELECT track, count(gap) AS n, 60 / nullif(avg(gap), 0) AS bpm, stddev_pop(gap) AS sd, sum(gap) AS total FROM g GROUP BY 1)
SELECT track, round(coalesce(bpm, 120), 6) AS bpm, coalesce(n + 1 >= 15 AND bpm BETWEEN 40 AND 300 AND (sd <= 0.15 OR coalesce(d, 0) >= 0.1 * total), false) AS defined, round(coalesce(d, 0), 6) + 0.0 AS stable FROM a LEFT JOIN (SELECT track, sum(d) AS d FROM r GROUP BY 1) USING (track)
""")
def stable_coverage(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("track").orderBy("t", "row")
    q = seconds(spark, d).select("track", F.row_number().over(w).alias("i"))
    step = F.when(F.col("i") % 40 < 25, 0.5).otherwise(0.3 + (F.col("i") * 7 % 5) / 10)
    x = q.withColumn("t", F.sum(step).over(Window.partitionBy("track").orderBy("i")))
    g = E.intervals(x, tie="i").withColumn("gap", F.round("gap", 6))
    return E.validated_tempo(g, tie="i").select("track", F.round("bpm", 6).alias("bpm"), "defined", F.round("stable", 6).alias("stable"))


@query("subdivided_grid", f"WITH {EV}, n AS (SELECT *, lead(t) OVER (PARTITION BY track ORDER BY t, row) AS u FROM ev) SELECT track, row, CAST(j AS INTEGER) AS j, round(t + j * (u - t) / 4, 3) AS t FROM (SELECT *, unnest(range(0, 4)) AS j FROM n WHERE u IS NOT NULL)")
def subdivided_grid(spark: SparkSession, d: str) -> DataFrame:
    return E.subdivided(seconds(spark, d).select("track", "row", "t"), 4, tie="row").select("track", "row", "j", F.round("t", 3).alias("t"))


@query("frames_of_time", f"WITH {EV} SELECT row, CAST(trunc(t * 0.01) AS BIGINT) AS frame, trunc(t * 0.01) / 0.01 AS t, CAST(ceil(row / 7.0) AS BIGINT) AS latent_frames FROM ev")
def frames_of_time(spark: SparkSession, d: str) -> DataFrame:
    frame = S.frame_of(F.col("t"), 0.01)
    return seconds(spark, d).select("row", frame.alias("frame"), S.time_of(frame, 0.01).alias("t"), S.whole_frames(F.col("row"), 7).alias("latent_frames"))


@query("timing_by_kind", "WITH c AS (SELECT event_type, count(*) AS n, avg(value) AS m FROM events GROUP BY 1), b AS (SELECT max(n) AS n_max, 30.0 AS audio FROM c) SELECT event_type, n, n_max, CASE WHEN m <= 0 THEN '—' ELSE format('{:.0f}x', round(audio / m * 100)) END AS rtf FROM c, b")
def timing_by_kind(spark: SparkSession, d: str) -> DataFrame:
    return Z.speed(read(spark, d, "events"), "event_type", F.col("value") / 100, 30.0)


@query("pass_progress", "SELECT o_orderstatus AS pass, count(*) FILTER (WHERE o_orderpriority < '3') AS completed, count(*) AS total, round(sum(o_totalprice) FILTER (WHERE o_orderpriority < '3'), 2) AS duration FROM orders GROUP BY 1")
def pass_progress(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return Z.pass_progress(o, "o_orderstatus", F.col("o_orderpriority") < "3", F.col("o_totalprice")).select(F.col("o_orderstatus").alias("pass"), "completed", "total", F.round("duration", 2).alias("duration"))


@query("mean_predictions", "WITH m AS (SELECT l_returnflag, l_linestatus || '/' || l_linenumber AS label, avg(l_discount * 10) AS p FROM lineitem GROUP BY 1, 2) SELECT l_returnflag, label, round(p, 4) AS p FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY round(p, 9) DESC, label) AS k FROM m WHERE p >= 0.45) WHERE k <= 5")
def mean_predictions(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select("l_returnflag", F.concat("l_linestatus", F.lit("/"), "l_linenumber").alias("label"), (F.col("l_discount") * 10).alias("p"))
    return Z.top_means(rows, "l_returnflag", "label", "p", 0.45, 5).select("l_returnflag", "label", F.round("p", 4).alias("p"))


@query("vector_movement", f"""
WITH {EMB}, u AS (SELECT label, vec_id, unnest(range(0, 12)) AS i, unnest(v[1:12]) AS x FROM e), p AS (SELECT *, lag(x) OVER (PARTITION BY label, i ORDER BY vec_id) AS y FROM u),
s AS (SELECT label, vec_id, sqrt(sum((x - y) * (x - y))) AS d FROM p WHERE y IS NOT NULL GROUP BY 1, 2), m AS (SELECT label, least(avg(d) / sqrt(2), 1) AS movement FROM s GROUP BY 1),
q AS (SELECT label, i, var_pop(x) AS v FROM u GROUP BY 1, 2), w AS (SELECT label, least(avg(v) / 0.1, 1) AS variance FROM q GROUP BY 1)
SELECT w.label, round(coalesce(movement, 0), 6) + 0.0 AS movement, round(CASE WHEN movement IS NULL THEN 0 ELSE variance END, 6) + 0.0 AS variance FROM w LEFT JOIN m ON w.label = m.label
""")
def vector_movement(spark: SparkSession, d: str) -> DataFrame:
    cut = vectors(spark, d).select("label", "vec_id", F.slice("v", 1, 12).alias("v"))
    return Z.movement(cut, "label", "vec_id", "v", 12).select("label", *r6("movement", "variance"))


@query("loud_start", f"WITH {EMB}, u AS (SELECT vec_id, unnest(range(0, len(v))) AS i, unnest(v) AS x FROM e) SELECT e.vec_id, CAST(coalesce(min(i // 8 * 8), 0) AS INTEGER) AS start FROM e LEFT JOIN u ON e.vec_id = u.vec_id AND abs(x) > 0.25 GROUP BY 1")
def loud_start(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", A.loud_start(F.col("v"), 0.25, 8).alias("start"))


@query("crossing_before", f"WITH {EMB}, u AS (SELECT vec_id, i, v[i + 1] < 0 AS a, v[i + 2] < 0 AS b FROM (SELECT vec_id, v, unnest(range(10, 39)) AS i FROM e)) SELECT e.vec_id, CAST(coalesce(max(i), 40) AS INTEGER) AS i FROM e LEFT JOIN u ON e.vec_id = u.vec_id AND a <> b GROUP BY 1")
def crossing_before(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", A.crossing_before(F.col("v"), 40, 30).alias("i"))


@query("crossing_near", f"WITH {EMB}, u AS (SELECT vec_id, i, v[i + 1] * v[i + 2] AS p FROM (SELECT vec_id, v, unnest(range(20, 40)) AS i FROM e)) SELECT e.vec_id, CAST(coalesce(arg_min(i, struct_pack(d := abs(i - 30), i := i)), 30) AS INTEGER) AS i FROM e LEFT JOIN u ON e.vec_id = u.vec_id AND p <= 0 GROUP BY 1")
def crossing_near(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", A.crossing_near(F.col("v"), 30, 10).alias("i"))


@query("content_frames", "SELECT user_id, CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS frames, sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) >= 30 AS valid FROM events GROUP BY 1")
def content_frames(spark: SparkSession, d: str) -> DataFrame:
    masks = read(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.coalesce((F.col("value") > 20).cast("int"), F.lit(0))).alias("mask"))
    n = A.content_frames(F.col("mask"), 4096)
    return masks.select("user_id", n.alias("frames"), (n >= 30).alias("valid"))


@query("folded_chroma", f"WITH {EMB}, u AS (SELECT vec_id, unnest(range(0, 60)) AS i, unnest(v[1:60]) AS x FROM e) SELECT vec_id, CAST((i + 2) // 5 % 12 AS INTEGER) AS semitone, round(sum(x), 6) + 0.0 AS x FROM u GROUP BY 1, 2")
def folded_chroma(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", F.posexplode(A.fold_to_semitones(F.slice("v", 1, 60), 60)).alias("semitone", "x")).select("vec_id", "semitone", *r6("x"))


@query("spread_semitones", f"WITH {EMB} SELECT vec_id, CAST(b AS INTEGER) AS bin, round(list_sum(list_transform(range(0, 12), lambda s: v[s + 1] * exp(-0.5 * power(least(abs(b - s * 2.0), 24 - abs(b - s * 2.0)) / 0.5, 2)))), 6) + 0.0 AS x FROM (SELECT vec_id, v, unnest(range(0, 24)) AS b FROM e)")
def spread_semitones(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", F.posexplode(A.spread_semitones(F.slice("v", 1, 12), 24, 0.25)).alias("bin", "x")).select("vec_id", "bin", *r6("x"))


@query("masked_dims", f"WITH {EMB} SELECT vec_id, CAST(i AS INTEGER) AS dim, round(v[i + 1], 6) + 0.0 AS x FROM (SELECT vec_id, v, unnest(range(0, len(v))) AS i FROM e) WHERE i BETWEEN 0 AND 3 OR i = 5 OR i BETWEEN 60 AND 99")
def masked_dims(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", F.posexplode("v").alias("dim", "x")).filter(M.in_ranges(F.col("dim"), "0-3, 5,x,60-99,")).select("vec_id", "dim", *r6("x"))


@query("feature_labels", "SELECT DISTINCT p_type, replace(replace(replace('rms_energy_' || lower(p_type) || '_probability', 'rms_energy_', ''), 'spectral_', 'spec_'), '_probability', '_p') AS short FROM part")
def feature_labels(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_type").distinct().select("p_type", M.label(F.concat(F.lit("rms_energy_"), F.lower("p_type"), F.lit("_probability"))).alias("short"))


@query("plain_punctuation", "SELECT conv_id, turn, replace(text, 'a', '--') AS text, contains(text, 'a') AS unsafe FROM conversations WHERE text IS NOT NULL AND NOT regexp_matches(text, '[‐‑ –—‘’“”]')")
def plain_punctuation(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations").filter("text is not null").filter(F.size(M.unsafe_characters(F.col("text"))) == 0)
    marked = F.replace(F.col("text"), F.lit("a"), F.lit("—"))
    return c.select("conv_id", "turn", M.plain_punctuation(marked).alias("text"), F.array_contains(M.unsafe_characters(marked), "U+2014").alias("unsafe"))


@query("without_structure", "SELECT conv_id, turn, trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS text FROM conversations WHERE text IS NOT NULL AND NOT contains(text, '<') AND len(trim(text)) > 30")
def without_structure(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations").filter("not contains(text, '<') and length(trim(text)) > 30")
    return c.select("conv_id", "turn", X.without_structure(F.concat(F.lit("<|start|><think>a\nb</think>ok</think> "), "text", F.lit("<|end|> "))).alias("text"))


@query("replaced_section", "SELECT item_id, 'head <!-- script-07-start -->' || chr(10) || rtrim(coalesce(text, '')) || chr(10) || '<!-- script-07-end --> tail' AS text FROM benchmark")
def replaced_section(spark: SparkSession, d: str) -> DataFrame:
    document = F.lit("head <!-- script-07-start -->old\nlines<!-- script-07-end --> tail")
    return read(spark, d, "benchmark").select("item_id", M.replace_section(document, "07", F.concat(F.coalesce("text", F.lit("")), F.lit("  "))).alias("text"))


@query("log_numbers", "SELECT event_id, CAST(event_id % 97 AS DOUBLE) AS load_ms, value IS NOT NULL AS has_rate FROM events")
def log_numbers(spark: SparkSession, d: str) -> DataFrame:
    log = F.concat(F.lit("x\nload time =  "), (F.col("event_id") % 97).cast("string"), F.lit(" ms\neval rate "), F.coalesce(F.col("value").cast("string"), F.lit("none")))
    return read(spark, d, "events").select("event_id", M.log_number(log, r"load time\s*=\s*([\d.]+)\s*ms").alias("load_ms"), M.log_number(log, r"eval rate\s+([-\d.E]+)").isNotNull().alias("has_rate"))


@query("answer_lines", "SELECT item_id, trim(text) AS text FROM benchmark WHERE text IS NOT NULL AND NOT regexp_matches(text, '[\n\t]') AND trim(text) <> '' AND NOT starts_with(trim(text), '0x')")
def answer_lines(spark: SparkSession, d: str) -> DataFrame:
    b = read(spark, d, "benchmark").filter("text is not null and not text rlike '[\\n\\t]' and trim(text) <> '' and not startswith(trim(text), '0x')")
    log = F.concat(F.lit("load_model: ok\n\n  0x123\n"), "text", F.lit("\n(LWP 3) gone\nggml_init x"))
    return b.select("item_id", M.without_log_lines(log, ("load_", "ggml_"), ("LWP ",)).alias("text"))


@query("low_variance", "WITH u AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value) SELECT feature, round(stddev_pop(value), 6) AS std, stddev_pop(value) >= 0.03 AS kept FROM u GROUP BY 1")
def low_variance(spark: SparkSession, d: str) -> DataFrame:
    return T.spread(read(spark, d, "lineitem"), NUMBERS, 0.03).select("feature", *r6("std"), "kept")


@query("top_pairs", "WITH m AS (" + " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS r FROM lineitem" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]) + ") SELECT least(x, y) AS x, greatest(x, y) AS y, round(r, 6) + 0.0 AS r FROM m ORDER BY round(abs(r), 9) DESC, 1, 2 LIMIT 3")
def top_pairs(spark: SparkSession, d: str) -> DataFrame:
    return T.top_pairs(T.correlation_matrix(read(spark, d, "lineitem"), NUMBERS), 3).select("x", "y", *r6("r"))


@query("thresholded_matrix", "WITH m AS (" + " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, least(1, greatest(-1, corr({a}, {b}))) AS r FROM lineitem" for a in NUMBERS for b in NUMBERS) + "), z AS (SELECT x, y, CASE WHEN abs(r) >= 0.1 THEN r ELSE 0 END AS r FROM m WHERE x <> y), s AS (SELECT x, CAST(row_number() OVER (ORDER BY round(max(abs(r)), 9) DESC, x) AS INTEGER) AS place FROM z GROUP BY 1) SELECT x, y, round(r, 6) + 0.0 AS r, place FROM z JOIN s USING (x)")
def thresholded_matrix(spark: SparkSession, d: str) -> DataFrame:
    m = T.correlation_matrix(read(spark, d, "lineitem"), NUMBERS).filter("x <> y")
    return V.matrix_view(m, 0.1).select("x", "y", *r6("r"), "place")


@query("extreme_dims", "WITH r AS (SELECT l_linenumber AS dim, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1) SELECT * FROM (SELECT 'top' AS side, dim, round(r, 6) + 0.0 AS r FROM r ORDER BY round(r, 9) DESC, dim LIMIT 3) UNION ALL SELECT * FROM (SELECT 'bottom', dim, round(r, 6) + 0.0 FROM r ORDER BY round(r, 9), dim LIMIT 3)")
def extreme_dims(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("dim")).agg(T.correlation(F.col("l_quantity"), F.col("l_extendedprice")).alias("r"))
    return V.extremes(r, "dim", "r", 3).select("side", "dim", *r6("r"))


@query("bin_members", "WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events) SELECT event_id FROM events, r WHERE value >= lo + 2 * w AND value < lo + 3 * w")
def bin_members(spark: SparkSession, d: str) -> DataFrame:
    return V.bin_members(read(spark, d, "events"), "value", 2, 30).select("event_id")


@query("grouped_members", "SELECT o_custkey, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS members FROM orders GROUP BY 1")
def grouped_members(spark: SparkSession, d: str) -> DataFrame:
    g = read(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("o_orderkey")).alias("m"))
    return g.select("o_custkey", "n", F.array_join(F.transform("m", lambda x: x.cast("string")), ",").alias("members"))


@query("candidate_scores", "SELECT l_orderkey, l_linenumber, round(CASE WHEN d < 2 THEN 0.5 WHEN d < 10 THEN 0.5 - (d - 2) * 0.05 WHEN d < 30 THEN 0.05 ELSE 0 END + CASE WHEN y = 0 THEN 0.3 WHEN y <= 1 THEN 0.2 WHEN y <= 3 THEN 0.1 ELSE 0 END, 9) AS score FROM (SELECT *, abs(l_quantity - 20) AS d, abs(year(l_shipdate) - 1995) AS y FROM lineitem)")
def candidate_scores(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(Z.candidate_score(F.col("l_quantity"), F.lit(20.0), F.year("l_shipdate"), F.lit(1995)), 9).alias("score"))


@query("looped_mean", f"WITH {EMB}, c AS (SELECT *, vec_id % 7 >= 4 AS long FROM e), g AS (SELECT label, bool_or(long) AS any_long FROM c GROUP BY 1), k AS (SELECT c.* FROM c JOIN g ON c.label = g.label WHERE long OR NOT any_long), u AS (SELECT label, unnest(range(0, len(v))) AS place, unnest(v) AS x FROM k) SELECT label, CAST(place AS INTEGER) AS place, round(avg(x), 6) + 0.0 AS mean FROM u GROUP BY 1, 2")
def looped_mean(spark: SparkSession, d: str) -> DataFrame:
    return Z.gated_mean(vectors(spark, d), "label", "v", F.floor(F.col("vec_id") % 7)).select("label", "place", *r6("mean"))


@query("typed_values", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS none FROM events")
def typed_values(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k"), F.col("event_type").try_cast("double").alias("none"))


@query("has_content", f"WITH {EMB}, u AS (SELECT vec_id, unnest(v) AS x FROM e), a AS (SELECT vec_id, sqrt(avg(x * x)) AS rms, max(abs(x)) AS peak FROM u GROUP BY 1) SELECT vec_id, rms > 0 AND peak > 0 AND NOT (20 * log10(peak / rms) > 8 AND 20 * log10(rms) < -15 AND 20 * log10(peak) < -3) AS has FROM a")
def has_content(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", A.has_content(F.col("v"), 8.0, -15.0, -3.0).alias("has"))
