"""Writers: record tables, feature CSV, column-oriented JSON, event lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featherline.operators.store import last_wins


def append_version(new: DataFrame, path: str) -> int:
    """Append a batch to a versioned Parquet table; readers see the last version of a key. Returns the rows written.

    Appending needs no read-modify-write and no locks, and a retried batch changes nothing that readers see.
    """
    seen = Observation()
    new.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def current(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    return last_wins(spark.read.parquet(path), keys, [version])


def compact(spark: SparkSession, path: str, out: str, keys: list[str], version: str) -> None:
    """The current rows only, in a new table sorted by key, so that point lookups skip row groups."""
    current(spark, path, keys, version).repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(out)


def write_csv(wide: DataFrame, path: str, key: str = "track") -> None:
    """One header a file, the key first, other columns by name, rows sorted by key; missing cells are empty."""
    cols = [key, *sorted(c for c in wide.columns if c != key)]
    wide.select(*cols).sort(key).write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(path)


def write_columns_json(wide: DataFrame, path: str, key: str = "track") -> None:
    """One JSON document: each column as the array of its values, rows by key; null cells are null. For tables of one row a
    recording that a page can load: the document is made in one task, as a single document must be."""
    rows = wide.agg(F.sort_array(F.collect_list(F.struct(key, *[c for c in wide.columns if c != key]))).alias("r"))
    column = lambda c: F.transform("r", lambda x: x[c]).alias(c)
    rows.select(F.to_json(F.struct(*map(column, wide.columns)), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_events(events: DataFrame, path: str, key: str, t: str = "t", digits: int = 6) -> None:
    """A folder a key with its times one a line, in order."""
    line = F.format_string(f"%.{digits}f", F.col(t))
    events.select(key, t, line.alias("value")).repartition(key).sortWithinPartitions(key, t).select(key, "value").write.mode("overwrite").partitionBy(key).text(path)
