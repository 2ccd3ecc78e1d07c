"""Names and paths as column expressions: parts of a path, numbers in names, sidecar paths, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File types of audio, and the parts that a recording is split into.
AUDIO = (".flac", ".wav", ".mp3", ".ogg", ".m4a", ".aiff", ".aif")
STEMS = ("drums", "bass", "other", "vocals")
DRUM_STEMS = ("kick", "snare", "cymbals", "toms", "percussion")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    """All before the last slash."""
    return F.regexp_replace(path, "/[^/]*$", "")


def suffix(path: Column) -> Column:
    """The last dot and what follows, '' without one; a leading dot starts no suffix."""
    return F.regexp_extract(base_name(path), r"^.+?(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    """The file name without its suffix."""
    name = base_name(path)
    return F.when(suffix(path) == "", name).otherwise(F.left(name, F.length(name) - F.length(suffix(path))))


def crop_number(path: Column) -> Column:
    """N of a name that ends in _N before its suffix; null else."""
    return F.regexp_extract(stem(path), r"_([+-]?\d+)$", 1).try_cast("int")


def section_number(path: Column) -> Column:
    """N of a name that holds `_section_N` once; null else."""
    parts = F.split(base_name(path), "_section_")
    return F.when(F.size(parts) == 2, F.substring_index(F.get(parts, F.lit(1)), ".", 1).try_cast("int"))


def is_audio(path: Column) -> Column:
    return suffix(path).isin(*AUDIO)


def is_crop(path: Column) -> Column:
    """Whether a name ends in a crop's number, so that it names no stem."""
    return crop_number(path).isNotNull()


def is_organized(path: Column) -> Column:
    """Whether a path is the full mix within a folder."""
    return (stem(path) == "full_mix") & path.rlike("^.*[^/]+/[^/]+$")


def sidecar(path: Column, kind: str) -> Column:
    """The sidecar of a recording: named after its folder."""
    return F.concat(folder(path), F.lit("/"), base_name(folder(path)), F.lit(kind))


def crop_sidecar(path: Column, kind: str = ".INFO") -> Column:
    """The sidecar of a crop: its own name with another suffix."""
    return F.concat(folder(path), F.lit("/"), stem(path), F.lit(kind))


#: What labels shorten, in this order.
SHORT = (("rms_energy_", ""), ("spectral_", "spec_"), ("_probability", "_p"))
AXIS = (("rms_energy_", "rms_"), ("spectral_", "sp_"), ("_probability", "_p"), ("production_", "prod_"), ("content_", ""), ("reverberation", "reverb"), ("danceability", "dance"), ("instrumental", "instr"), ("lufs_", "L_"))


def label(feature: Column, short: tuple[tuple[str, str], ...] = SHORT) -> Column:
    for old, new in short:
        feature = F.replace(feature, F.lit(old), F.lit(new))
    return feature


def plain_punctuation(text: Column) -> Column:
    """Typographic hyphens, dashes, spaces and quotes as ASCII ones."""
    #: The em dash is two hyphens, the others are one character each.
    return F.translate(F.replace(text, F.lit("—"), F.lit("--")), "‑‐ –’‘“”", "-- -''\"\"")


def unsafe_characters(text: Column, allowed: str = "") -> Column:
    """The typographic characters that a text holds, as U+XXXX in the order of this list, without those allowed."""
    #: Fixed values
    marks = [c for c in "‑‐ —–’‘“”" if c not in allowed]
    return F.filter(F.array(*[F.when(F.contains(text, F.lit(c)), F.lit(f"U+{ord(c):04X}")) for c in marks]), lambda x: x.isNotNull())


def replace_section(document: Column, section: str, body: Column) -> Column:
    """The document with what stands between a section's start and end marks replaced; an error if they are missing."""
    start, end = f"<!-- script-{section}-start -->", f"<!-- script-{section}-end -->"
    new = F.concat(F.lit(start + "\n"), F.rtrim(body, F.lit(" \t\n\r\f\v")), F.lit("\n" + end))
    found = F.regexp_like(document, F.lit(f"(?s){start}.*?{end}"))
    split = F.split(document, F.lit(f"(?s){start}.*?{end}"), F.lit(-1))
    return F.when(found, F.aggregate(F.slice(split, 2, 1 << 20), F.get(split, F.lit(0)), lambda a, x: F.concat(a, new, x))).otherwise(F.raise_error(F.lit(f"no section {section}")))


def in_ranges(index: Column, ranges: str) -> Column:
    """Whether an index lies in a list such as `0-3,5`; parts that are no numbers are passed over."""
    out = F.lit(False)
    for part in ranges.split(","):
        a, dash, b = part.strip().partition("-")
        try:
            out = out | (index.between(int(a), int(b)) if dash else index == int(a))
        except ValueError:
            continue
    return out


def log_number(log: Column, pattern: str, group: int = 1) -> Column:
    """The first number that a pattern finds in a log; null without one."""
    return F.regexp_extract(log, pattern, group).try_cast("double")


def without_log_lines(output: Column, prefixes: tuple[str, ...], marks: tuple[str, ...]) -> Column:
    """A model's answer without a runtime's lines: those that begin with a prefix or an address, or hold a mark; trimmed."""
    def answer(line: Column) -> Column:
        t = F.trim(line)
        noise = t.startswith("0x")
        for p in prefixes:
            noise = noise | t.startswith(p)
        for m in marks:
            noise = noise | F.contains(t, F.lit(m))
        return ~noise

    return F.trim(F.array_join(F.filter(F.split(F.coalesce(output, F.lit("")), "\n"), answer), "\n"), F.lit(" \n\t\r"))
