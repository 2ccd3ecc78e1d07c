"""Listings of files, one row a path: folders that hold recordings or crops, stems, sidecars, corrupt files, planned renames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featherline.functions import names as N


def _audio(files: DataFrame) -> DataFrame:
    p = F.col("path")
    return files.filter(N.is_audio(p)).withColumns({"folder": N.folder(p), "stem": N.stem(p), "kind": N.suffix(p)})


def organized_folders(files: DataFrame, skipped: tuple[str, ...] = ()) -> DataFrame:
    """(folder) of every full mix, once; not within the folders named, and not of crops."""
    f = _audio(files).filter(F.col("stem") == "full_mix").select("folder").distinct()
    inside = F.exists(F.split("folder", "/"), lambda x: x.isin(*skipped)) if skipped else F.lit(False)
    return f.filter(~inside & ~F.col("folder").rlike(r"_\d+$"))


def crop_files(files: DataFrame) -> DataFrame:
    """(path, folder, number) of every crop."""
    return _audio(files).filter(N.is_crop(F.col("path"))).select("path", "folder", N.crop_number(F.col("path")).alias("number"))


def crop_folders(files: DataFrame) -> DataFrame:
    """(folder, n_crops) of every folder that holds crops."""
    return crop_files(files).groupBy("folder").agg(F.count(F.lit(1)).cast("long").alias("n_crops"))


def _preferred(rows: DataFrame, *keys: str) -> DataFrame:
    """One path a key: of the first file type in the list."""
    return rows.groupBy(*keys).agg(F.min_by("path", F.array_position(F.array(*map(F.lit, N.AUDIO)), F.col("kind"))).alias("path"))


def stem_files(files: DataFrame, full_mix: bool = False) -> DataFrame:
    """(folder, stem, path) of the stems of folders that have a full mix, one file a stem. The listing is read once."""
    best = _preferred(_audio(files).filter(F.col("stem").isin(*N.STEMS, *N.DRUM_STEMS, "full_mix")), "folder", "stem")
    organized = F.bool_or(F.col("stem") == "full_mix").over(Window.partitionBy("folder"))  # at most a row a stem
    found = best.withColumn("_o", organized).filter("_o").drop("_o")
    return found if full_mix else found.filter(F.col("stem") != "full_mix")


def crop_stem_files(files: DataFrame) -> DataFrame:
    """(crop, stem, path) of the stems that lie beside a crop: its name, _ and the stem's. The listing is read once."""
    is_crop = N.is_crop(F.col("path"))  # a crop's name ends in a number, so it is no stem
    a = _audio(files).withColumns({"part": F.when(~is_crop, F.substring_index("stem", "_", -1)), "crop": F.when(is_crop, F.col("stem")).otherwise(F.regexp_replace("stem", "_[^_]*$", ""))})
    best = _preferred(a.filter(F.col("part").isNull() | F.col("part").isin(*N.STEMS)), "folder", "crop", "part")
    beside = F.bool_or(F.col("part").isNull()).over(Window.partitionBy("folder", "crop"))  # at most a row a stem and the crop's
    return best.withColumn("_c", beside).filter(F.col("_c") & F.col("part").isNotNull()).drop("_c").withColumnRenamed("part", "stem")


def sidecars(files: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(folder, what, path) of files named after their folder, by suffix: {'.BEATS_GRID': 'beats', ...}."""
    p = F.col("path")
    f = files.withColumns({"folder": N.folder(p), "kind": N.suffix(p)}).filter(F.col("kind").isin(*kinds) & (N.stem(p) == N.base_name(N.folder(p))))
    return f.select("folder", F.element_at(F.create_map(*[F.lit(v) for kv in kinds.items() for v in kv]), F.col("kind")).alias("what"), "path")


def files_of_type(files: DataFrame, kinds: list[str], part: str | None = None) -> DataFrame:
    """(folder, path) of files with one of the suffixes, whose lower-cased name holds `part`."""
    p = F.col("path")
    f = files.filter(N.suffix(p).isin(*kinds))
    return (f.filter(F.contains(F.lower(N.stem(p)), F.lit(part))) if part else f).select(N.folder(p).alias("folder"), "path")


def too_small(files: DataFrame, least: int) -> DataFrame:
    """Files of fewer bytes than that."""
    return files.filter(F.col("length") < least)


def replacements(files: DataFrame, sources: DataFrame, lossy: tuple[str, ...]) -> DataFrame:
    """(folder, path, source): full mixes of a lossy type with the source whose lower-cased name is the folder's; source is null without one."""
    a = _audio(files).filter((F.col("stem") == "full_mix") & F.col("kind").isin(*lossy)).groupBy("folder").agg(F.min_by("path", F.array_position(F.array(*map(F.lit, lossy)), F.col("kind"))).alias("path"))
    s = sources.groupBy(F.lower(N.stem(F.col("path"))).alias("name")).agg(F.max("path").alias("source"))
    return a.withColumn("name", F.lower(N.base_name(F.col("folder")))).join(s, "name", "left").select("folder", "path", "source")
