import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import dates, labels, numeric as n, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("value, digits, expected", [
    (1.005, 2, 1.01), (0.285, 2, 0.29), (-1.005, 2, -1.01), (2.5, 0, 3.0), (-0.001, 2, 0.0), (0.0, 4, 0.0),
])
def test_ties_round_away_from_zero(spark, value, digits, expected):
    got = one(spark, n.round_half_up(F.lit(value), digits))
    assert got == expected and str(got) == str(expected)


def test_rounding_leaves_what_has_no_digits(spark):
    for value in (1e15, -1e15, 9.3e18, 1e300, 123456789012345.678):
        assert one(spark, n.round_half_up(F.lit(value), 4)) == pytest.approx(value, rel=1e-15)


def test_rounding_keeps_null(spark):
    assert one(spark, n.round_half_up(F.lit(None).cast("double"), 2)) is None


def test_certainty_of_eight_buy_votes_grows_as_documented(spark):
    factors = [0.30, 0.40, 0.50, 0.60, 0.50, 0.70, 0.60, 0.40]
    expected = [0.30, 0.58, 0.79, 0.916, 0.958, 0.987, 0.995, 0.997]
    for steps, value in enumerate(expected, 1):
        got = one(spark, n.fold_certainty([F.lit(f) for f in factors[:steps]]))
        assert got == pytest.approx(value, abs=6e-4)


@pytest.mark.parametrize("left, right, expected", [
    (-0.5, -0.5, -0.75), (0.6, -0.4, 0.2 / 0.6), (-0.6, 0.4, -0.2 / 0.6), (0.0, -0.3, -0.3), (1.0, -1.0, None),
])
def test_certainty_combines_signs(spark, left, right, expected):
    got = one(spark, n.combine_certainty(F.lit(left), F.lit(right)))
    assert got == (None if expected is None else pytest.approx(expected))


def test_votes_ignore_noise_and_null(spark):
    close, mean = F.lit(100.0), F.lit(100.0 + 1e-12)
    assert one(spark, n.vote(n.above(close, mean), n.below(close, mean))) == 0
    unknown = F.lit(None).cast("double")
    assert one(spark, n.vote(n.above(close, unknown), n.below(close, unknown))) == 0


def test_rsi_without_losses_is_100(spark):
    assert one(spark, n.relative_strength(F.lit(0.0), F.lit(0.0))) == 100.0
    assert one(spark, n.relative_strength(F.lit(1.0), F.lit(None).cast("double"))) == 100.0
    assert one(spark, n.relative_strength(F.lit(1.0), F.lit(1.0))) == 50.0


def test_quantiles_interpolate(spark):
    values = F.array(*[F.lit(float(v)) for v in (4, 1, 3, 2)])
    assert one(spark, n.quantiles(values, 0.25, 0.75)) == [1.75, 3.25]


@pytest.mark.parametrize("score, label", [
    (8, "Strong Buy"), (5, "Strong Buy"), (4, "Buy"), (3, "Buy"), (2, "Neutral"), (-2, "Neutral"),
    (-3, "Sell"), (-4, "Sell"), (-5, "Strong Sell"),
])
def test_rating_edges(spark, score, label):
    assert one(spark, labels.rating(F.lit(score))) == label


def test_bins_of_unknown_features(spark):
    unknown = F.lit(None).cast("double")
    got = [one(spark, f(unknown)) for f in (
        labels.volatility_bin, labels.rsi_bin, labels.position_bin, labels.sector_bin
    )]
    assert got == ["very_low", "neutral", "near_high", "neutral"]


def test_text_parts(spark):
    assert one(spark, text.percent(F.lit(0.43))) == "43%"
    assert one(spark, text.percent(F.lit(0.8325), 1)) == "83.3%"
    assert one(spark, text.fixed(F.lit(-0.051), 2)) == "-0.05"
    assert one(spark, text.sentence("a", F.lit(None).cast("string"))) is None
    assert one(spark, text.fragment(F.lit(False), "x")) == ""


@pytest.mark.parametrize("moment, is_open", [
    ("2024-01-07 07:00:00", True),          # Sunday 10:00 there
    ("2024-01-07 06:59:59", False),
    ("2024-01-07 12:00:00", True),          # the closing second is included
    ("2024-01-07 12:00:00.000001", False),
    ("2024-01-05 08:00:00", False),         # Friday
])
def test_session_hours(spark, moment, is_open):
    assert one(spark, dates.is_session_open(F.lit(moment).cast("timestamp"))) is is_open


def test_date_spine_has_both_ends(spark):
    bounds = spark.sql("SELECT DATE '2024-02-27' AS start, DATE '2024-03-01' AS end")
    days = [r.date for r in dates.date_spine(bounds).orderBy("date").collect()]
    assert days[0] == dt.date(2024, 2, 27) and days[-1] == dt.date(2024, 3, 1) and len(days) == 4
