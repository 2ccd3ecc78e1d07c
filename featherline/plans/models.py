"""Queries of models and streams, which SQL cannot express; tests hold them against NumPy or their batch form."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.functions.text import normal_form
from featherline.operators import segment
from featherline.operators import similarity as N
from featherline.operators import stats as T
from featherline.operators import store as R
from featherline.plans.catalog import query
from featherline.plans.definitions import EV, NUMBERS, read, seconds, vectors
from featherline.streaming import ingest


def _dims(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """A column for each element of the vectors, as many as the longest has."""
    df = vectors(spark, d)
    names = [f"d{i}" for i in range(df.agg(F.max(F.size("v"))).first()[0] or 0)]
    return df.select("vec_id", "label", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(names)]), names


@query("pca")
def pca(spark: SparkSession, d: str) -> DataFrame:
    df, names = _dims(spark, d)
    comp, share, _ = T.principal_components(df, names, 3)
    return spark.createDataFrame([(k, n, round(float(comp[k, i]), 6), round(float(share[k]), 6)) for k in range(len(comp)) for i, n in enumerate(names)], "component int, feature string, loading double, share double")


@query("ridge")
def ridge(spark: SparkSession, d: str) -> DataFrame:
    return T.ridge(read(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@query("kmeans_cosine")
def kmeans_cosine(spark: SparkSession, d: str) -> DataFrame:
    return N.cosine_kmeans(vectors(spark, d), "v", 8).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("ward_features")
def ward_features(spark: SparkSession, d: str) -> DataFrame:
    df, names = _dims(spark, d)
    n, _, c = T.moments(df, names)
    s = np.sqrt(np.diag(c))
    both = np.outer(s, s)
    r = np.divide(c, both, out=np.zeros_like(c), where=(both > 0) & (n >= 3))  # 0 where correlation() has its default
    labels = T.ward_clusters(1 - np.minimum(1, np.abs(r)))
    return spark.createDataFrame([(n, int(c)) for n, c in zip(names, labels, strict=True)], "feature string, cluster int")


@query("medoids")
def medoids(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(i, x) for i, x in enumerate(N.farthest_medoids(vectors(spark, d), "vec_id", "v", 5))], "place int, vec_id long")


@query("vif_values")
def vif_values(spark: SparkSession, d: str) -> DataFrame:
    return T.variance_inflation(read(spark, d, "lineitem"), NUMBERS)


@query("normal_form")
def normal_form_query(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", normal_form(F.col("text"), "NFKC", ascii_only=True).alias("ascii"))


@query("bar_crops")
def bar_crops(spark: SparkSession, d: str) -> DataFrame:
    e = seconds(spark, d)
    tracks = e.groupBy("track").agg((F.max("t") + 1).alias("duration"))
    return segment.crop_tracks(tracks, e.select("track", "t"), 259200.0)


@query("fixed_tiles", f"""
WITH {EV}, s AS (SELECT track, min(t) AS a, max(t) AS b FROM ev GROUP BY 1)
SELECT track, CAST(i AS INTEGER) AS i, CAST(floor(a + i * 86400) AS BIGINT) AS start, CAST(floor(a + (i + 1) * 86400) AS BIGINT) AS "end" FROM (SELECT *, unnest(range(0, CAST(floor((b - a) / 86400.0) AS BIGINT))) AS i FROM s)
""")
def fixed_tiles(spark: SparkSession, d: str) -> DataFrame:
    t = seconds(spark, d).groupBy("track").agg(F.min("t").alias("start"), F.max("t").alias("duration"))
    return segment.tiles(t, 86400.0).select("track", "i", F.floor("start").alias("start"), F.floor("end").alias("end"))


def _shared(spark: SparkSession) -> str:
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        root = f"file://{tempfile.gettempdir()}" if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/featherline-stream-{uuid.uuid4().hex}"


def _run(spark: SparkSession, stream: DataFrame, mode: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """A stream's result after all there is has been read, as a table: in complete mode that of the last micro-batch, in update
    mode each key's of the last micro-batch that had one. A batch that is retried replaces itself."""
    at, seen = _shared(spark), []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={number}")
        seen.append(number)

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    atexit.register(_remove, spark, at)
    if not seen:
        return spark.createDataFrame([], stream.schema)
    if mode == "complete":
        return spark.read.schema(stream.schema).parquet(f"{at}/out/batch={max(seen)}")
    every = spark.read.schema(stream.schema.add("batch", "long")).option("basePath", f"{at}/out").parquet(f"{at}/out")
    return R.last_wins(every, list(keys), ["batch"]).drop("batch")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM has gone
        return


def _stream(spark: SparkSession, d: str) -> DataFrame:
    schema = read(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))


@query("session_window_stream", """
WITH b AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 12 HOURS, true) AS b, event_id FROM events), i AS (SELECT *, sum(CAST(b AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM b)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 43200000000 AS end_us, count(*) AS n FROM i GROUP BY user_id, k
""")
def session_window_stream(spark: SparkSession, d: str) -> DataFrame:
    out = _run(spark, ingest.sessions(_stream(spark, d), "12 hours"), "complete")
    return out.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query("window_density_stream", """
SELECT event_type, CAST(i AS BIGINT) * 43200000000 AS start_us, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, unnest([epoch_us(ts) // 43200000000, epoch_us(ts) // 43200000000 - 1]) AS i FROM events) GROUP BY 1, 2
""")
def window_density_stream(spark: SparkSession, d: str) -> DataFrame:
    out = _run(spark, ingest.window_counts(_stream(spark, d), "1 day", "12 hours"), "complete")
    return out.select("event_type", F.unix_micros("start").alias("start_us"), "n", F.round("total", 4).alias("total"))


@query("last_value_stream", "SELECT user_id, count(*) AS n, arg_max(value, ts) AS value FROM events GROUP BY 1")
def last_value_stream(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, ingest.last_values(_stream(spark, d)), "update", ("user_id",)).select("user_id", "n", "value")
