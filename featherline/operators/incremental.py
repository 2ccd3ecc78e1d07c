"""The incremental driver: which keys still need work, the work on those alone, and its results merged by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def needs_work(required: list[str], payload: str = "payload", overwrite: bool = False) -> Column:
    """Whether a record, a map or null, lacks one of the entries."""
    if overwrite:
        return F.lit(True)
    have = F.coalesce(F.map_keys(payload), F.array().cast("array<string>"))
    return F.size(F.array_except(F.array(*map(F.lit, required)).cast("array<string>"), have)) > 0


def status(keys: DataFrame, store: DataFrame, key: str, required: list[str], locked: DataFrame | None = None, payload: str = "payload", overwrite: bool = False) -> DataFrame:
    """Every key with `status`: locked, complete or ready, in this order. One equi-join a side."""
    out = keys.join(store.select(key, payload), key, "left")
    if locked is None:
        out = out.withColumn("_locked", F.lit(False))
    else:
        out = out.join(locked.select(key).distinct().withColumn("_locked", F.lit(True)), key, "left")
    state = F.when(F.coalesce("_locked", F.lit(False)), "locked").when(needs_work(required, payload, overwrite), "ready").otherwise("complete")
    return out.withColumn("status", state).drop("_locked")


def counts(of: DataFrame) -> DataFrame:
    """One row: total, ready, complete, locked."""
    return of.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("ready", "complete", "locked")])


def run(keys: DataFrame, store: DataFrame, key: str, required: list[str], work: Callable[[DataFrame], DataFrame], locked: DataFrame | None = None, payload: str = "payload", overwrite: bool = False) -> DataFrame:
    """The store after `work` was done on the keys that are ready: (key, payload, outcome).

    work maps the ready rows to (key, payload), with a null payload where it failed. New entries win, others stay. outcome is
    done, failed, complete, locked, or kept for records that were not asked for. Rows are planned once and meet the
    results in one full join, so a run that is repeated does nothing more.
    """
    planned = status(keys, store, key, required, locked, payload, overwrite)
    new = work(planned.filter("status = 'ready'")).select(key, F.col(payload).alias("_new"), F.lit(True).alias("_done"))
    old = store.select(key, payload).join(planned.select(key, "status"), key, "full").join(new, key, "left")
    held, fresh = F.coalesce(F.col(payload), F.create_map().cast(store.schema[payload].dataType)), F.col("_new")
    merged = F.when(fresh.isNotNull(), F.map_concat(F.map_filter(held, lambda k, _: ~F.array_contains(F.map_keys(fresh), k)), fresh)).otherwise(F.col(payload))
    outcome = F.when(F.col("status").isNull(), "kept").when(F.col("status") != "ready", F.col("status")).when(fresh.isNotNull(), "done").otherwise("failed")
    return old.select(key, merged.alias(payload), outcome.alias("outcome"))
