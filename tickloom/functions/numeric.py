"""Arithmetic on columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Two numbers closer than this count as equal when a comparison decides a vote or a flag:
# averages of the same prices summed in another order differ in their last bits.
MARGIN = 1e-9

# Share of the last kept digit by which a value may fall short of a tie and still round up.
TIE = 1e-6
# From here on every double is a whole number.
EXACT = float(2 ** 53)


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero; a value within noise of a tie counts as the tie.

    Plain arithmetic, which compiles to little code; adding 0.0 turns -0.0 into 0.0.
    A value so large that it has no digits to round stays as it is.
    """
    scale = float(10 ** digits)
    scaled = F.abs(value) * scale
    near = F.signum(value) * F.floor(scaled + (0.5 + TIE)) / scale + 0.0
    return F.when(scaled >= EXACT, value).otherwise(near)


def rounded(**digits_of: int) -> dict[str, Column]:
    """``withColumns`` argument that rounds each named column in place."""
    return {name: round_half_up(F.col(name), digits) for name, digits in digits_of.items()}


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL where the divisor is 0."""
    return part / F.nullif(whole, F.lit(0).cast("double"))


def pct_change(now: Column, before: Column) -> Column:
    return F.when(before > 0, (now - before) / before)


def log_return(now: Column, before: Column) -> Column:
    return F.when((before > 0) & (now > 0), F.ln(now / before))


def annualized(volatility: Column, periods: int = 252) -> Column:
    return volatility * F.sqrt(F.lit(float(periods)))


def band(mean: Column, deviation: Column, width: float = 2.0) -> tuple[Column, Column]:
    """Lower and upper bound, ``mean`` plus and minus ``width`` deviations."""
    return mean - width * deviation, mean + width * deviation


def relative_strength(avg_gain: Column, avg_loss: Column) -> Column:
    """RSI from the average gain and loss; 100 where nothing was lost."""
    strength = 100.0 - 100.0 / (1.0 + avg_gain / F.nullif(avg_loss, F.lit(0.0)))
    return F.when(avg_loss.isNull() | (avg_loss == 0), F.lit(100.0)).otherwise(strength)


def vote(buy: Column, sell: Column) -> Column:
    """+1, -1 or 0; a condition that is NULL does not vote."""
    return F.when(buy, F.lit(1)).when(sell, F.lit(-1)).otherwise(F.lit(0))


def above(left: Column, right: Column) -> Column:
    return left > right + MARGIN


def below(left: Column, right: Column) -> Column:
    return left < right - MARGIN


def combine_certainty(left: Column, right: Column) -> Column:
    """Certainty of two pieces of evidence in [-1, 1].

    Agreeing evidence closes part of the gap to full certainty. Conflicting
    evidence is netted, relative to what the weaker side leaves open.
    """
    agree_up = (left >= 0) & (right >= 0)
    agree_down = (left <= 0) & (right <= 0)
    netted = (left + right) / F.nullif(1.0 - F.least(F.abs(left), F.abs(right)), F.lit(0.0))
    return (
        F.when(agree_up, left + right * (1.0 - left))
        .when(agree_down, left + right * (1.0 + left))
        .otherwise(netted)
    )


def fold_certainty(evidence: Sequence[Column]) -> Column:
    """Left fold in the order given (the conflicting case is not associative).

    A higher-order function keeps the expression small: written out as nested
    CASEs, every step would repeat the one before it several times.
    """
    return F.aggregate(F.array(*evidence), F.lit(0.0), combine_certainty)


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def count_true(conditions: Sequence[Column]) -> Column:
    return total([F.when(c, F.lit(1)).otherwise(F.lit(0)) for c in conditions])


def quantiles(values: Column, *shares: float) -> Column:
    """Quantiles of an array with linear interpolation, NULLs if it is empty.

    The sorted array is bound to a lambda variable, so it is sorted once.
    """

    def pick(ordered: Column, share: float) -> Column:
        position = (F.size(ordered) - 1) * F.lit(share)
        low = F.floor(position)
        start = F.get(ordered, low.cast("int"))
        return start + (F.get(ordered, F.ceil(position).cast("int")) - start) * (position - low)

    bound = F.transform(F.array(F.sort_array(values)), lambda s: F.array(*[pick(s, q) for q in shares]))
    return F.get(bound, F.lit(0))
