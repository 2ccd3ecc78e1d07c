"""Scalar column expressions: typing, clamps, musical encodings, levels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, lo: float | Column | None, hi: float | Column | None) -> Column:
    """x within [lo, hi]; null stays null."""
    out = x
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(x.isNotNull(), out)


def finite(x: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def first_truthy(*xs: Column) -> Column:
    """The first value that is neither null nor 0."""
    return F.coalesce(*[F.nullif(x, F.lit(0)) for x in xs])


def circular(x: Column, period: float = 12.0) -> tuple[Column, Column]:
    """(sin, cos) of a place on a circle."""
    return F.sin(x * (2 * math.pi / period)), F.cos(x * (2 * math.pi / period))


def is_minor(scale: Column) -> Column:
    """1 for minor, 0 for any other text, null for null."""
    return F.when(scale.isNotNull(), (F.lower(scale) == "minor").cast("int"))


def octave_corrected(bpm: Column, reference: Column) -> Column:
    """bpm times 1, 1/2, 2, 1/4 or 4, whichever is nearest in ratio to the reference, the earlier on ties; unchanged without a positive reference."""
    tried = F.array(*[F.struct(F.abs(bpm * f / reference - 1).alias("d"), F.lit(i).alias("i"), (bpm * f).alias("v")) for i, f in enumerate((1.0, 0.5, 2.0, 0.25, 4.0))])
    return F.when(reference > 0, F.array_min(tried)["v"]).otherwise(bpm)


def decibels(x: Column, floor: float) -> Column:
    """20 log10 of a level; `floor` for levels of 0 or less."""
    return F.when(x > 0, 20 * F.log10(x)).otherwise(F.lit(floor))


def year(date: Column) -> Column:
    return F.substring(date, 1, 4).try_cast("int")


def min_max(x: Column, lo: Column, hi: Column) -> Column:
    """x moved to [0, 1]; 0.5 where the range is nothing."""
    return F.when(hi - lo < 1e-12, F.lit(0.5)).otherwise((x - lo) / (hi - lo))


def quiet_stem(crest: Column, rms: Column, peak: Column, crest_below: float = -40.0, rms_below: float = -39.0, peak_below: float = -20.0) -> Column:
    return (crest < crest_below) & (rms < rms_below) & (peak < peak_below)


def gap_in_bands(bass: Column, body: Column, mid: Column, air: Column, silent: float = -60.0) -> Column:
    """All lower bands silent while air isn't; a missing air counts as silent."""
    return (bass == silent) & (body == silent) & (mid == silent) & (F.coalesce(air, F.lit(silent)) != silent)


def relative_position(start: Column, duration: Column) -> Column:
    """Where a part begins in its whole, from 0 to 1; 0 in a whole without duration."""
    return F.when(duration <= 0, F.lit(0.0)).otherwise(clamp(start / duration, 0.0, 1.0))


def frame_of(t: Column, rate: float) -> Column:
    """The frame that a time falls in, towards 0."""
    return (t * rate).cast("long")


def time_of(frame: Column, rate: float) -> Column:
    return frame / rate


def whole_frames(samples: Column, hop: int) -> Column:
    """Frames that hold all samples."""
    return F.ceil(samples / hop)
