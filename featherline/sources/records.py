"""Readers: sidecar JSON, event lists, CSV feature tables, NumPy arrays, file listings. All read through Spark, so any file system works."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes of stem files.
STEMS = ("bass", "drums", "other", "vocals")


def _stem(path: Column, ext: str) -> Column:
    return F.regexp_replace(F.element_at(F.split(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "/"), -1), rf"\.{ext}$", "")


def _folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def info_records(spark: SparkSession, root: str, ext: str = "INFO") -> DataFrame:
    """path, folder, key (file's stem), payload (VARIANT), bad: one row a JSON sidecar; unreadable ones are kept and marked."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ext}").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    v = F.try_parse_json("value")
    return raw.select("path", _folder(F.col("path")).alias("folder"), _stem(F.col("path"), ext).alias("key"), v.alias("payload"), v.isNull().alias("bad"))


def entries(records: DataFrame) -> DataFrame:
    """key, name, kind, number, text, is_null: a row an entry. Lists become their length; flags are no numbers; an explicit null stays a row, an absent key has none."""
    e = records.filter("not bad").select("key", F.expr("explode(from_json(to_json(payload), 'map<string,variant>')) AS (name, v)"))
    kind = F.schema_of_variant("v")
    listed = kind.startswith("ARRAY")
    text = F.expr("try_variant_get(v, '$', 'string')")
    number = F.when(listed, F.expr("size(try_variant_get(v, '$', 'array<variant>'))").cast("double")).when(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL") | kind.startswith("FLOAT"), F.expr("try_variant_get(v, '$', 'double')"))
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    return e.select("key", "name", F.when(listed, "list").when(kind == "BOOLEAN", "flag").when(kind == "STRING", "text").when(kind.startswith("OBJECT"), "map").when(number.isNotNull(), "number").otherwise("null").alias("kind"), finite.alias("number"), F.when(kind == "STRING", text).alias("text"), F.is_variant_null("v").alias("is_null"))


def full_mix_only(df: DataFrame, key: str = "key") -> DataFrame:
    return df.filter(~F.col(key).rlike("_(" + "|".join(STEMS) + ")$"))


def event_lists(spark: SparkSession, root: str, ext: str) -> DataFrame:
    """folder, kind, seq, t: seconds listed one a line, lines that are no numbers left out, in file order."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ext}").text(root, wholetext=True)
    t = F.filter(F.transform(F.split("value", r"\r?\n"), lambda x: F.trim(x).try_cast("double")), lambda x: x.isNotNull())
    return raw.select(_folder(F.col("_metadata.file_path")).alias("folder"), F.lit(ext).alias("kind"), F.posexplode(t).alias("seq", "t"))


def feature_csv(spark: SparkSession, path: str, categorical: list[str], key: str = "track") -> DataFrame:
    """A CSV feature table: key and listed columns as text, all others as doubles; cells that are no numbers are null."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(*[F.col(c) if c == key or c in categorical else F.col(c).try_cast("double").alias(c) for c in raw.columns])


def files(spark: SparkSession, root: str, extensions: tuple[str, ...]) -> DataFrame:
    """path, folder, stem, ext, length: a listing; contents are not read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(root).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return raw.select("path", _folder(F.col("path")).alias("folder"), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1).alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), "length")


def npy(data: bytes) -> np.ndarray:
    """An array in NumPy's own format, by its header; object arrays are refused."""
    return np.load(io.BytesIO(data), allow_pickle=False)


_ARRAY = pa.schema([("path", pa.string()), ("field", pa.string()), ("shape", pa.list_(pa.int32())), ("values", pa.list_(pa.float32())), ("error", pa.string())])


def arrays(spark: SparkSession, root: str) -> DataFrame:
    """path, field, shape, values, error: the arrays of .npy and .npz files, row-major; an unreadable file gives one row with its error."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                try:
                    body = data.as_py()
                    if path.endswith(".npz"):
                        with zipfile.ZipFile(io.BytesIO(body)) as z:
                            found = [(n.removesuffix(".npy"), npy(z.read(n))) for n in z.namelist() if n.endswith(".npy")]
                    else:
                        found = [("", npy(body))]
                    rows = [{"path": path, "field": n, "shape": list(a.shape), "values": a.astype(np.float32).ravel().tolist(), "error": None} for n, a in found if a.dtype.kind in "fiub"]
                except (ValueError, OSError, zipfile.BadZipFile, struct.error) as e:
                    rows = [{"path": path, "field": None, "shape": None, "values": None, "error": str(e)[:200]}]
                yield pa.RecordBatch.from_pylist(rows, _ARRAY)

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{npy,npz}").load(root).select("path", "content")
    return raw.mapInArrow(decode, "path string, field string, shape array<int>, values array<float>, error string")


def frames(tensor: DataFrame, keys: list[str]) -> DataFrame:
    """keys, frame, x: rows of values of a (dims, frames) tensor turned into one vector a frame."""
    dims, n = F.get("shape", F.lit(0)), F.get("shape", F.lit(1))
    vector = F.transform(F.sequence(F.lit(0), dims - 1), lambda i: F.get(F.col("values"), i * n + F.col("frame")))
    return tensor.filter((F.size("shape") == 2) & (n > 0)).select(*keys, "shape", "values", F.explode(F.sequence(F.lit(0), n - 1)).alias("frame")).select(*keys, "frame", vector.alias("x"))


