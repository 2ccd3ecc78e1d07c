"""Keyed records: last writer wins, merges, anti joins, migrations, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Estimated bytes of a table that may be sent to all tasks.
MOST_SENT_BYTES = 64 << 20


def size_checked(df: DataFrame, most: int = MOST_SENT_BYTES) -> DataFrame:
    """df with a broadcast hint if its plan's estimate is small, else as it is, for a shuffled join."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= most else df


def last_wins(df: DataFrame, keys: list[str], version: list[Column | str]) -> DataFrame:
    """One row a key: the one of the greatest version. An aggregate rather than a window, so that it combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def merge_records(old: DataFrame, new: DataFrame, key: str, payload: str, new_wins: bool = True) -> DataFrame:
    """Union of two sets of records with map payloads; on a common entry the new one wins (or the old one)."""
    rows = old.select(key, payload, F.lit(0).alias("_v")).unionByName(new.select(key, payload, F.lit(1).alias("_v")))
    entries = rows.select(key, "_v", F.explode_outer(payload).alias("_k", "_x"))
    pick = F.max_by("_x", "_v") if new_wins else F.min_by("_x", "_v")
    merged = entries.groupBy(key, "_k").agg(pick.alias("_x"))
    return merged.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("_k").isNotNull(), F.struct("_k", "_x")))).alias(payload))


def missing_from(keys: DataFrame, have: DataFrame, on: str) -> DataFrame:
    """Rows of keys without a partner; duplicates stay."""
    return keys.join(size_checked(have.select(on)), on, "left_anti")


def fill_from_parent(child: DataFrame, parent: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Child rows with the listed columns taken from the parent where the child has none."""
    p = size_checked(parent.select(F.col(on).alias("_on"), *[F.col(c).alias(f"_p_{c}") for c in columns]))
    kept = [c for c in child.columns if c not in columns]
    return child.join(p, child[on] == F.col("_on"), "left").select(*kept, *[(F.coalesce(F.col(c), F.col(f"_p_{c}")) if c in child.columns else F.col(f"_p_{c}")).alias(c) for c in columns])


def keep_first_by_fingerprint(df: DataFrame, fingerprint: Column, order: list[str]) -> DataFrame:
    """The first row of each fingerprint; rows without one all stay."""
    f = df.withColumn("_f", fingerprint)
    first = f.filter("_f is not null").groupBy("_f").agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")
    return first.unionByName(f.filter("_f is null").drop("_f"))


def file_fingerprint(content: Column, chunk: int = 8192) -> Column:
    """size and 16 hex digits of the md5 of a file's head and, if it is longer than two chunks, its tail."""
    size = F.octet_length(content)
    head, tail = F.substring(content, 1, chunk), F.substring(content, -chunk, chunk)
    return F.concat(size.cast("string"), F.lit("_"), F.substring(F.md5(F.when(size > 2 * chunk, F.concat(head, tail)).otherwise(head)), 1, 16))


def seeded_sample(df: DataFrame, id_column: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by a hash of id and seed, in id order; all if there are fewer."""
    return df.orderBy(F.xxhash64(id_column, F.lit(seed)), id_column).limit(n).orderBy(id_column)


def seeded_groups(df: DataFrame, group: str, n: int, seed: int = 0) -> DataFrame:
    """All rows of n whole groups."""
    chosen = df.select(group).distinct().orderBy(F.xxhash64(group, F.lit(seed)), group).limit(n)
    return df.join(F.broadcast(chosen), group, "left_semi")


def lookup(keys: DataFrame, store: DataFrame, key: str, payload: str, entry: str) -> DataFrame:
    """keys with `value`, one entry of their record, and `has`, whether there is a record."""
    found = store.select(key, F.try_element_at(F.col(payload), F.lit(entry)).alias("value"), F.lit(True).alias("has"))
    return keys.join(found, key, "left").withColumn("has", F.coalesce("has", F.lit(False)))


def store_size(store: DataFrame, key: str, payload: str) -> DataFrame:
    """One row: n_keys, n_entries."""
    return store.agg(F.count(key).alias("n_keys"), F.coalesce(F.sum(F.size(payload)), F.lit(0)).cast("long").alias("n_entries"))


def strip_entries(store: DataFrame, payload: str, exact: tuple[str, ...], prefixes: tuple[str, ...]) -> DataFrame:
    """Records without the entries named or begun so, with how many were removed and there before."""
    def gone(k: Column) -> Column:
        out = k.isin(*exact)
        for p in prefixes:
            out = out | k.startswith(p)
        return out

    kept = F.map_filter(payload, lambda k, _: ~gone(k))
    return store.withColumns({"before": F.size(payload).cast("long"), "removed": (F.size(payload) - F.size(kept)).cast("long"), payload: kept})
