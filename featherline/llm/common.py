"""What the operators of this subpackage share: scratch tables, folds and word splitting."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITTEN: list[tuple[SparkSession, str, str | None]] = []

#: White space at which words end; str.split() also splits at the characters below, so texts that hold one of them take the regular expression.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def scratch_dir(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir, or, where that is unset, the warehouse of a cluster or a local folder of a local master."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/") + "/featherline"
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return "file://" + tempfile.gettempdir() + "/featherline"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_featherline"


@contextmanager
def _shuffles_end(spark: SparkSession):
    """Spark removes the shuffle files of a write as soon as the write has ended, and sends Python small batches."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors and fixes row ids. Removed when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    with _shuffles_end(spark):
        df.write.parquet(path)
    _written(spark, path)
    return spark.read.schema(schema).parquet(path)


def materialize_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """As materialize, but in buckets by the hash of a key, as many as shuffles have partitions, so that joins by the key don't shuffle it."""
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{scratch_dir(spark)}/{unique}"
    with _shuffles_end(spark):
        df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(unique)
    _written(spark, path, unique)
    return spark.table(unique)


def lean(run):
    """A function over batches that hands freed memory back to the system when its task ends: Python workers are used again, and
    what each task has grown would stay with them."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()

    return wrapped


def hand_back() -> None:
    """Freed memory goes back to the system, here or in the driver."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def _written(spark: SparkSession, path: str, table_name: str | None = None) -> None:
    if not _WRITTEN:
        atexit.register(_clean)
    _WRITTEN.append((spark, path, table_name))


def _clean() -> None:
    for spark, path, name in _WRITTEN:
        try:
            if name:
                spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM has gone
            return


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], *names: str) -> list[str]:
    """Names that start with these and that no column has."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while (name := f"_{name}_").lower() in taken:
            pass
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: str) -> list[str]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text."""
    return WORD.findall(text) if _ODD_SPACE.search(text) else text.split()


def row_ids():
    """An endless count of ids that no other task of the stage gives."""
    from itertools import count

    from pyspark import TaskContext

    at = TaskContext.get()
    return count((at.partitionId() if at else 0) << 40)
