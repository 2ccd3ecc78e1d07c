import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.functions import arrays as A
from featherline.functions import scalars as S
from featherline.functions import text as X


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(None).cast("string").alias("_")] if not values else [(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first().out


@pytest.mark.parametrize("n", [1, 2, 7, 32, 64])
def test_resample_keeps_ends(spark, n):
    a = [float(x * x) for x in range(n)]
    want = np.interp(np.linspace(0, n - 1, 32), range(n), a)
    assert np.allclose(one(spark, A.resample(F.col("a"), 32), a=a), want)


def test_resample_centres(spark):
    assert one(spark, A.resample_centres(F.col("a"), 4), a=[1.0, 3.0]) == [1.0, 1.5, 2.5, 3.0]


def test_medians_of_bins(spark):
    a = [5.0, 1.0, 2.0, 9.0, 4.0, 4.0, 7.0]
    assert one(spark, A.bin_medians(F.col("a"), 3), a=a) == [float(np.median(a[i * 7 // 3 : (i + 1) * 7 // 3])) for i in range(3)]


def test_rolls(spark):
    a = [float(x) for x in range(12)]
    assert one(spark, A.roll_left(F.col("a"), F.lit(5)), a=a) == a[5:] + a[:5]
    assert one(spark, A.roll_left(F.col("a"), F.lit(0)), a=a) == a
    assert one(spark, A.roll_fraction(F.col("a"), F.lit(-5.0)), a=a) == a[5:] + a[:5]
    assert one(spark, A.roll_fraction(F.col("a"), F.lit(0.5)), a=[0.0, 2.0]) == [1.0, 1.0]


def test_log_ratio_sums_to_nothing(spark):
    assert abs(sum(one(spark, A.centred_log_ratio(F.col("a")), a=[0.0, 0.5, 0.2, 0.3]))) < 1e-9


def test_interval_vector(spark):
    v = one(spark, A.tonal_interval_vector(F.col("a")), a=[1.0] + [0.0] * 11)
    assert math.isclose(sum(x * x for x in v), 1) and v[1::2] == pytest.approx([0] * 6)
    assert one(spark, A.tonal_interval_vector(F.col("a")), a=[0.0] * 12) == [0.0] * 12


def test_slerp(spark):
    assert one(spark, A.slerp(F.col("a"), F.col("b"), 0.5), a=[1.0, 0.0], b=[0.0, 3.0]) == pytest.approx([math.sqrt(2), math.sqrt(2)])
    assert one(spark, A.slerp(F.col("a"), F.col("b"), 0.5), a=[1.0, 0.0], b=[1.0, 0.0]) == [1.0, 0.0]
    assert one(spark, A.raw_slerp(F.col("a"), F.col("b"), 0.0), a=[1.0, 0.0], b=[0.0, 3.0]) == pytest.approx([1, 0])


def test_blend_fade_fit_activation(spark):
    g = F.array(*map(F.lit, [1, 1, 0]))
    assert one(spark, A.blend_groups(F.col("a"), F.col("b"), g, {1: 2.0}), a=[0.0, 0.0, 0.0], b=[1.0, 1.0, 1.0]) == [1, 1, 0]
    assert one(spark, A.fit_length(F.col("a"), 4), a=[1.0, 2.0]) == [1, 2, 2, 2]
    assert one(spark, A.fit_length(F.col("a"), 1), a=[1.0, 2.0]) == [1]
    assert one(spark, A.fade(F.col("a"), 2), a=[1.0] * 6) == [0, 0.5, 1, 1, 0.5, 0]
    assert max(one(spark, A.activation(F.col("a"), F.lit(10.0), 20), a=[1.0, 5.0, 50.0])) == 1
    assert one(spark, A.cosine(F.col("a"), F.col("b")), a=[0.0, 0.0], b=[1.0, 2.0]) == 0


def test_project(spark):
    assert one(spark, A.project(F.col("a"), [[1.0, 1.0], [1.0, -1.0]], [1.0, 0.0]), a=[3.0, 5.0]) == [7, -3]


def test_scalars(spark):
    assert one(spark, S.clamp(F.col("x"), 0.0, 1.0), x=7.0) == 1
    assert one(spark, S.clamp(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert one(spark, S.octave_corrected(F.lit(69.0), F.lit(138.0))) == 138
    assert one(spark, S.octave_corrected(F.lit(140.0), F.lit(138.0))) == 140
    assert one(spark, S.octave_corrected(F.lit(140.0), F.lit(0.0))) == 140
    assert one(spark, S.first_truthy(F.lit(0.0), F.lit(120.0))) == 120
    assert one(spark, S.is_minor(F.lit("Minor"))) == 1 and one(spark, S.is_minor(F.lit("odd"))) == 0 and one(spark, S.is_minor(F.lit(None).cast("string"))) is None
    assert one(spark, S.decibels(F.lit(0.0), -120.0)) == -120
    assert one(spark, S.year(F.lit("1999-02"))) == 1999 and one(spark, S.year(F.lit("soon"))) is None
    assert one(spark, S.gap_in_bands(F.lit(-60.0), F.lit(-60.0), F.lit(-60.0), F.lit(None).cast("double"))) is False
    assert one(spark, S.finite(F.lit(float("nan")))) is None


@pytest.mark.parametrize(("raw", "want"), [("{'a': 0.2, 'b': 0.7, 'c': 0.7}", "b"), ("['x', 'y']", "x"), ("plain", "plain"), ("{}", ""), ("[]", ""), ("", ""), (None, "")])
def test_class_label(spark, raw, want):
    assert one(spark, X.class_label(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("key", "want"), [("Artist - Title_12", "Artist - Title"), ("A_B_C_3", "A_B_C"), ("Ends_in_word_0", "Ends_in_word"), ("No suffix", "No suffix")])
def test_track_of(spark, key, want):
    assert one(spark, X.track_of(F.lit(key))) == want


def test_texts(spark):
    assert one(spark, X.without_structure(F.lit("a <think>b\nc</think> the answer<|end|> "))) == "the answer"
    assert one(spark, X.without_structure(F.lit("<|start|>final<|channel|> <think>open"))) == "final open" and one(spark, X.without_structure(F.lit("x</think>yes <|im_end|>"))) == "yes <|im_end|>"
    assert all(one(spark, X.various_artists(F.lit(x))) for x in ("Compilation", "various artist", " Unknown Artist", "unknown", "", None)) and not one(spark, X.various_artists(F.lit("variousartists")))
    assert one(spark, X.without_structure(F.lit("<think>b</think> x"))) == "x"
    assert one(spark, X.squeezed(F.lit(" a  é b\n\tc "))) == "a b c"
    assert one(spark, X.folder_name(F.lit("A/B"), F.lit("T"))) == "AB - T" and one(spark, X.folder_name(F.lit("?"), F.lit("T"))) is None
    assert one(spark, X.name_parts(F.lit("03 A - B - C - D"))).asDict() == {"artist": "A", "album": "B", "track": "C - D"}
    assert one(spark, X.name_parts(F.lit("C"))).track == "C"
    assert one(spark, X.various_artists(F.lit(" VA "))) is True and one(spark, X.various_artists(F.lit("Va Va"))) is False
    assert one(spark, X.normal_form(F.lit("ﬁ ½"))) == "fi 1⁄2"
    assert one(spark, X.normal_form(F.lit("\\u00e9té"), "NFC", True)) == "ete"
    assert one(spark, X.top_labels(F.create_map(F.lit("a"), F.lit(0.1), F.lit("b"), F.lit(0.82)), 1)) == "b (0.82)"
