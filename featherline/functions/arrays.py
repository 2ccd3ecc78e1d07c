"""Column expressions on arrays of numbers: resampling, rolling, compositional and spherical algebra. All stay on the JVM."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def dot(a: Column, b: Column) -> Column:
    """Sum of products over the shorter length."""
    return total(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0))))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where either has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def each_index(n: Column | int, f: Callable[[Column], Column]) -> Column:
    """[f(0), ..., f(n - 1)]."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n <= 0, F.array().cast("array<double>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), f))


def _between(a: Column, p: Column) -> Column:
    """The value at fractional place p."""
    lo = F.floor(p).cast("int")
    hi = F.least(lo + 1, F.size(a) - 1)
    x, y = F.get(a, lo).cast("double"), F.get(a, hi).cast("double")
    return x + (y - x) * (p - lo)


def resample(a: Column, n: int) -> Column:
    """Linear resampling to n points, ends on ends; arrays of n values pass, a single value repeats."""
    step = (F.size(a) - 1) / F.lit(max(1, n - 1))
    return F.when(F.size(a) == n, doubles(a)).otherwise(each_index(n, lambda k: _between(a, F.least(k * step, F.size(a) - 1.0))))


def resample_centres(a: Column, n: int) -> Column:
    """Linear resampling between cell centres, clamped at the ends; an empty array gives zeros."""
    p = lambda k: F.least(F.greatest((k + 0.5) * F.size(a) / F.lit(n) - 0.5, F.lit(0.0)), F.size(a) - 1.0)
    return F.when(F.size(a) == 0, F.array_repeat(F.lit(0.0), n)).otherwise(each_index(n, lambda k: _between(a, p(k))))


def fit_length(a: Column, n: int) -> Column:
    """Cut to n values, or repeat the last one."""
    return F.when(F.size(a) >= n, F.slice(a, 1, n)).otherwise(F.concat(a, F.array_repeat(F.element_at(a, -1), n - F.size(a))))


def bin_medians(a: Column, n: int) -> Column:
    """Medians of n runs of nearly equal counts, bounds i * size div n; an empty array gives zeros."""

    def middle(i: Column) -> Column:
        lo = F.floor(i * F.size(a) / n).cast("int")
        hi = F.greatest(F.floor((i + 1) * F.size(a) / n).cast("int"), lo + 1)
        s = F.array_sort(F.slice(a, lo + 1, hi - lo))
        m = F.size(s)
        return (F.get(s, F.floor((m - 1) / 2).cast("int")).cast("double") + F.get(s, F.floor(m / 2).cast("int")).cast("double")) / 2

    return F.when(F.size(a) == 0, F.array_repeat(F.lit(0.0), n)).otherwise(each_index(n, middle))


def roll_left(a: Column, by: Column) -> Column:
    """Circular shift by whole places."""
    n = F.size(a)
    k = F.pmod(by, n)
    return F.concat(F.slice(a, k + 1, n), F.slice(a, F.lit(1), k))


def roll_fraction(a: Column, by: Column) -> Column:
    """Circular shift to the right by a fraction of places, linear between neighbours."""
    n = F.size(a)

    def at(i: Column) -> Column:
        p = F.pmod(i - by, n.cast("double"))
        lo = F.floor(p).cast("int")
        w = p - lo
        return F.get(a, F.pmod(lo, n)).cast("double") * (1 - w) + F.get(a, F.pmod(lo + 1, n)).cast("double") * w

    return each_index(n, at)


def centred_log_ratio(a: Column, eps: float = 1e-9) -> Column:
    logs = F.transform(a, lambda x: F.ln(x.cast("double") + eps))
    return F.transform(logs, lambda x: x - mean(logs))


#: Weights of the six harmonics of a tonal interval vector.
INTERVAL_WEIGHTS = (3.0, 8.0, 11.5, 15.0, 14.5, 7.5)


def tonal_interval_vector(a: Column) -> Column:
    """Real and imaginary parts of harmonics 1 to 6 of a profile of unit sum, weighted, then of unit length; zeros for a zero profile."""
    s = total(a)
    parts = []
    for k, w in enumerate(INTERVAL_WEIGHTS, 1):
        for f in (math.cos, lambda t: -math.sin(t)):
            table = F.array(*[F.lit(f(2 * math.pi * k * j / 12)) for j in range(12)])
            parts.append(F.coalesce(F.try_divide(dot(a, table) * w, s), F.lit(0.0)))
    v = F.array(*parts)
    return F.transform(v, lambda x: F.coalesce(F.try_divide(x, norm(v)), F.lit(0.0)))


def peak_scaled(a: Column) -> Column:
    """Divided by the maximum where that is positive."""
    m = F.array_max(a)
    return F.when(m > 0, F.transform(a, lambda x: x / m)).otherwise(a)


def activation(times: Column, duration: Column, n: int, sigma: float = 2.0) -> Column:
    """Sum of Gaussians (sigma in steps) at the events within [0, duration], divided by its maximum."""
    places = F.transform(F.filter(times, lambda t: (t >= 0) & (t <= duration)), lambda t: t / duration * n)
    return peak_scaled(each_index(n, lambda s: F.aggregate(places, F.lit(0.0), lambda x, p: x + F.exp(-0.5 * F.pow((s - p) / sigma, 2)))))


def lerp(a: Column, b: Column, t: float | Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") * (1 - t) + y.cast("double") * t)


def slerp(a: Column, b: Column, t: float) -> Column:
    """Spherical interpolation of directions with interpolated length; b's sign follows a; nearly parallel vectors are interpolated linearly."""
    na, nb = norm(a), norm(b)
    c = F.coalesce(F.try_divide(dot(a, b), na * nb), F.lit(0.0))
    sign = F.when(c < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    w = F.acos(F.least(F.abs(c), F.lit(1.0)))
    length = na * (1 - t) + nb * t
    x = F.transform(a, lambda v: F.coalesce(F.try_divide(v.cast("double"), na), F.lit(0.0)))
    y = F.transform(b, lambda v: F.coalesce(F.try_divide(v.cast("double") * sign, nb), F.lit(0.0)))
    mixed = F.zip_with(x, y, lambda p, q: (p * F.sin(w * (1 - t)) + q * F.sin(w * t)) / F.sin(w) * length)
    return F.when(F.sin(w) < 1e-6, lerp(a, b, t)).otherwise(mixed)


def raw_slerp(a: Column, b: Column, t: float) -> Column:
    """Spherical weights on the vectors as they are: no lengths, no sign."""
    w = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0)))))
    mixed = F.zip_with(a, b, lambda p, q: (p.cast("double") * F.sin(w * (1 - t)) + q.cast("double") * F.sin(w * t)) / F.sin(w))
    return F.when(F.sin(w) < 1e-6, lerp(a, b, t)).otherwise(mixed)


def steer(a: Column, direction: Column, amount: float | Column) -> Column:
    return F.zip_with(a, direction, lambda x, d: x.cast("double") + d.cast("double") * amount)


def blend_groups(a: Column, b: Column, groups: Column, shares: dict[int, float]) -> Column:
    """Per place: a moved to b by the share of the place's group, clipped to [0, 1]; groups without a share keep a."""
    table = F.create_map(*[F.lit(v) for g, s in shares.items() for v in (g, float(min(1.0, max(0.0, s))))])
    t = F.transform(groups, lambda g: F.coalesce(F.try_element_at(table, g), F.lit(0.0)))
    moved = F.zip_with(a, b, lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    return F.zip_with(moved, t, lambda p, s: p["x"] + (p["y"] - p["x"]) * s)


def fade(a: Column, n: int) -> Column:
    """Linear fade of the first and last n values; arrays under 2n pass."""
    m = F.size(a)
    gain = lambda i: F.least(F.lit(1.0), i / n, (m - 1 - i) / n)
    return F.when(m < 2 * n, doubles(a)).otherwise(F.transform(a, lambda x, i: x.cast("double") * gain(i)))


def soft_clip(a: Column) -> Column:
    return F.transform(a, F.tanh)


def project(rows: Column, components: list[list[float]], centre: list[float] | None = None) -> Column:
    """Dot products with constant components, after subtracting the centre if one is given."""
    x = F.zip_with(rows, F.array(*map(F.lit, centre)), lambda v, m: v.cast("double") - m) if centre else rows
    return F.array(*[dot(x, F.array(*map(F.lit, map(float, c)))) for c in components])


def loud_start(a: Column, threshold: float, window: int) -> Column:
    """The start of the first window that has a value beyond the threshold; 0 without one."""
    at = F.array_min(F.filter(F.transform(a, lambda x, i: F.when(F.abs(x) > threshold, F.floor(i / window) * window)), lambda x: x.isNotNull()))
    return F.coalesce(at, F.lit(0)).cast("int")


def _changes(a: Column, first: int, last: int, changes) -> Column:
    """Places i from first to last at which changes(a[i], a[i + 1]) holds."""
    if last < first:
        return F.array().cast("array<int>")
    return F.filter(F.sequence(F.lit(first), F.lit(last)), lambda i: F.coalesce(changes(F.get(a, i), F.get(a, i + 1)), F.lit(False)))


def crossing_before(a: Column, target: int, window: int) -> Column:
    """The last place before a change of sign among the `window` values before the target; the target without one."""
    return F.coalesce(F.array_max(_changes(a, max(0, target - window), target - 2, lambda x, y: (x < 0) != (y < 0))), F.lit(target)).cast("int")


def crossing_near(a: Column, target: int, window: int) -> Column:
    """The place of a change of sign nearest to the target within the window, the earlier on ties; the target without one."""
    at = _changes(a, max(0, target - window), target + window - 1, lambda x, y: x * y <= 0)
    return F.coalesce(F.array_min(F.transform(at, lambda i: F.struct(F.abs(i - target).alias("d"), i.alias("i"))))["i"], F.lit(target)).cast("int")


def content_frames(mask: Column, without: int) -> Column:
    """Frames that a padding mask keeps; `without` a mask all of them."""
    return F.when(mask.isNull(), F.lit(without).cast("long")).otherwise(F.aggregate(mask, F.lit(0).cast("long"), lambda s, x: s + x))


def _semitone_distance(n: int) -> list[list[float]]:
    """Of n bins to the centres of 12 semitones on the circle: semitone s is centred at bin n s / 12."""
    return [[min(abs(b - s * n / 12), n - abs(b - s * n / 12)) for s in range(12)] for b in range(n)]


def fold_to_semitones(a: Column, n: int) -> Column:
    """Sums of n bins by the nearest semitone, the lower on ties."""
    near = [min(range(12), key=lambda s, d=d: (d[s], s)) for d in _semitone_distance(n)]
    return F.array(*[sum((F.get(a, F.lit(b)).cast("double") for b in range(n) if near[b] == s), F.lit(0.0)) for s in range(12)])


def spread_semitones(weights: Column, n: int, width: float) -> Column:
    """Twelve weights as bumps of that deviation, in semitones, over n bins on the circle."""
    sigma = width * n / 12
    return F.array(*[sum((F.get(weights, F.lit(s)).cast("double") * math.exp(-0.5 * (d / sigma) ** 2) for s, d in enumerate(row)), F.lit(0.0)) for row in _semitone_distance(n)])


def steering_target(weights: Column, root: Column, profile: dict[int, float], n: int, gains: tuple[float, float, float] = (1.0, 1.0, 0.3), width: float = 0.25) -> Column:
    """Struct of bass, mid and air over n bins: a profile above the root (zeros without one), and the melody's weights twice."""
    melody = spread_semitones(weights, n, width)
    of_root = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda s: F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for o, x in profile.items() for v in (o, float(x))]), F.pmod(s - root, F.lit(12)).cast("int")), F.lit(0.0)))
    scaled = lambda a, g: F.transform(a, lambda x: x * g)
    bass = F.when(root.isNull(), F.array_repeat(F.lit(0.0), n)).otherwise(scaled(spread_semitones(of_root, n, width), gains[0]))
    return F.struct(bass.alias("bass"), scaled(melody, gains[1]).alias("mid"), scaled(melody, gains[2]).alias("air"))


def has_content(a: Column, crest: float, rms: float, peak: float) -> Column:
    """Whether a signal is neither silent nor, in decibels, above a crest and below a level and a peak at once."""
    square = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x) / F.size(a))
    top = F.array_max(F.transform(a, lambda x: F.abs(x.cast("double"))))
    db = lambda x: 20 * F.log10(x)
    return F.coalesce((square > 0) & (top > 0) & ~((db(top / square) > crest) & (db(square) < rms) & (db(top) < peak)), F.lit(False))


def anchored(stems: tuple[Column, Column], mixes: tuple[Column, Column], alpha: float, pull: tuple[float, float], mix) -> Column:
    """Two vectors mixed, drawn towards two others, and brought back to the length of the first mixture."""
    first = mix(stems[0], stems[1], alpha)
    out = first
    for other, beta in zip(mixes, pull, strict=True):
        out = slerp(out, other, beta) if beta > 0 else out
    length = lambda a: F.greatest(F.sqrt(dot(a, a)), F.lit(1e-8))
    scale = length(first) / length(out)
    return F.transform(out, lambda x: x * scale) if max(pull) > 0 else first
