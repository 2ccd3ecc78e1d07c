"""Cutting tracks into crops."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiles(tracks: DataFrame, seconds: float, start: str = "start") -> DataFrame:
    """track, i, start, end: tiles of fixed length from the first sound on; only whole ones."""
    n = F.floor((F.col("duration") - F.col(start)) / seconds)
    return tracks.filter(n > 0).select("track", F.col(start).alias("_s"), F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("i")).select("track", "i", (F.col("_s") + F.col("i") * seconds).alias("start"), (F.col("_s") + (F.col("i") + 1) * seconds).alias("end"))


def bar_crops(downbeats: list[float], duration: float, seconds: float, overlap: bool = False, slack: float = 1e-3) -> list[tuple[float, float]]:
    """Greedy crops from downbeat to downbeat of at most `seconds`, holding a multiple of four bars' starts.

    A crop begins at the downbeat at or before the wanted place and ends at the latest downbeat, within the length, up to
    which the downbeats from its start count a multiple of four, at least four; without one it takes the plain length. The next
    crop begins at its end, or in its middle with overlap.
    """
    out, at, beats = [], 0.0, sorted(downbeats)
    while at + slack < duration:
        i = bisect_right(beats, at + slack) - 1
        start = beats[i] if i >= 0 and beats[i] > (out[-1][0] if out else -1) else at
        target = min(start + seconds, duration)
        a, b = bisect_left(beats, start - slack), bisect_right(beats, target + slack)
        end = next((beats[j] for j in range(b - 1, a, -1) if beats[j] > start and (j - a + 1) % 4 == 0), target)
        if end - start <= slack:
            break
        out.append((start, end))
        nxt = (start + end) / 2 if overlap else end
        if nxt <= at:
            break
        at = nxt
    return out


def crop_tracks(tracks: DataFrame, downbeats: DataFrame, seconds: float, overlap: bool = False) -> DataFrame:
    """track, i, start, end for tracks (track, duration) by their downbeats (track, t). A track's beats meet in one row; a track holds a bounded number."""
    rows = tracks.join(downbeats.groupBy("track").agg(F.collect_list("t").alias("beats")), "track", "left")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [(k, i, a, b) for k, d, beats in zip(f["track"], f["duration"], f["beats"], strict=True) for i, (a, b) in enumerate(bar_crops(list(beats) if beats is not None else [], d, seconds, overlap))]
            yield pd.DataFrame(out, columns=["track", "i", "start", "end"])

    return rows.select("track", "duration", "beats").mapInPandas(cut, f"track {tracks.schema['track'].dataType.simpleString()}, i int, start double, `end` double")
