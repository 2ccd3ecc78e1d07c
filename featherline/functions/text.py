"""Text expressions: keys, titles, search, markup; Unicode normal forms by Arrow UDF, as SQL has none."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def track_of(crop_key: Column) -> Column:
    """A crop's key without its number."""
    return F.regexp_replace(crop_key, r"_\d+$", "")


def without_number(name: Column) -> Column:
    return F.regexp_replace(name, r"^\d+\s+", "")


def title_of(folder: Column) -> Column:
    return F.regexp_replace(folder, r"^\d+[.\-\s]+", "")


def match_key(name: Column) -> Column:
    """Lower-cased letters and digits only, to match names loosely."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def name_parts(folder: Column) -> Column:
    """Struct of artist, album, track from `artist - album - track`, leading digits aside; missing parts are null."""
    p = F.split(F.regexp_replace(folder, r"^\d+[.\-\s]*", ""), " - ")
    n = F.size(p)
    rest = F.array_join(F.slice(p, 3, 1000), " - ")
    return F.struct(F.when(n > 1, F.get(p, F.lit(0))).alias("artist"), F.when(n > 2, F.get(p, F.lit(1))).alias("album"), F.when(n > 2, rest).when(n == 2, F.get(p, F.lit(1))).otherwise(F.get(p, F.lit(0))).alias("track"))


def folder_name(artist: Column, title: Column) -> Column:
    """`artist - title` without characters that file names can't hold; null if either is empty."""
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(c, r'[<>:"/\\|?*]', "")), F.lit(""))
    return F.concat(clean(artist), F.lit(" - "), clean(title))


#: Names that stand for no single artist.
VARIOUS = ("various artists", "various", "va", "v/a", "v.a.", "compilation", "various artist", "unknown artist", "unknown", "")


def various_artists(artist: Column) -> Column:
    return F.lower(F.trim(F.coalesce(artist, F.lit("")))).isin(*VARIOUS)


def contains_any(query: str, *columns: Column) -> Column:
    """Case-insensitive substring in any column; an empty query holds for all rows."""
    q = query.strip().lower()
    out = F.lit(not q)
    for c in columns:
        out = out | F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(q))
    return out


#: Marks of generated text that are no content.
STRUCTURE_MARKS = ("<|end|>", "<|return|>", "<|message|>", "<|channel|>", "<|start|>", "<|end_of_text|>", "<|start_of_role|>", "<|end_of_role|>")


def without_structure(text: Column) -> Column:
    """What follows the last closing think mark, if that is over 5 characters; think blocks, lone think marks and structure marks removed, trimmed."""
    after = F.substring_index(text, "</think>", -1)
    out = F.when(F.contains(text, F.lit("</think>")) & (F.length(F.btrim(after, F.lit(" \t\n\r\f\v"))) > 5), after).otherwise(text)
    out = F.regexp_replace(F.regexp_replace(out, r"(?s)<think>.*?</think>", ""), "</?think>", "")
    for mark in STRUCTURE_MARKS:
        out = F.replace(out, F.lit(mark), F.lit(""))
    return F.btrim(out, F.lit(" \t\n\r\f\v"))


def squeezed(text: Column) -> Column:
    """ASCII characters only, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\x00-\x7F]", ""), r"[ \t\r\n\f\x0B]+", " "))


def class_label(raw: Column) -> Column:
    """The label of a class cell: the likeliest of a dict's (the first on ties), the first of a list, else the text itself; '' if empty."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    parts = F.regexp_extract_all(t, F.lit(r"""['"]([^'"]*)['"]\s*:\s*([-+0-9.eE]+)"""), 1)
    values = F.regexp_extract_all(t, F.lit(r"""['"]([^'"]*)['"]\s*:\s*([-+0-9.eE]+)"""), 2)
    best = F.array_max(F.transform(F.arrays_zip(parts.alias("k"), values.alias("v")), lambda e, i: F.struct(e["v"].try_cast("double").alias("v"), (-i).alias("i"), e["k"].alias("k"))))["k"]
    first = F.regexp_extract(t, r"""^\[\s*['"]?([^'",\]]*)""", 1)
    return F.when(t.startswith("{"), F.coalesce(best, F.lit(""))).when(t.startswith("["), first).otherwise(t)


def top_labels(scores: Column, n: int = 5) -> Column:
    """The n best entries of a map as `label (0.82), ...`; ties by label."""
    e = F.array_sort(F.transform(F.map_entries(scores), lambda x: F.struct((-x["value"]).alias("v"), x["key"].alias("k"))))
    return F.array_join(F.transform(F.slice(e, 1, n), lambda x: F.concat(x["k"], F.lit(" ("), F.format_number(-x["v"], 2), F.lit(")"))), ", ")


@cache
def _normal(form: str, ascii_only: bool):
    """The UDF is made when first asked for: making one needs a session."""

    @F.pandas_udf("string")
    def apply(s: pd.Series) -> pd.Series:
        out = s.map(lambda x: x if x is None else unicodedata.normalize(form, re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), x)))
        if ascii_only:
            out = out.map(lambda x: x if x is None else "".join(c for c in unicodedata.normalize("NFD", x) if ord(c) < 128))
        return out

    return apply


def normal_form(text: Column, form: str = "NFKC", ascii_only: bool = False) -> Column:
    return _normal(form, ascii_only)(text)
