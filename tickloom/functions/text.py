"""Numbers as text and text put together from parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tickloom.functions.numeric import round_half_up


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text with ``digits`` decimals."""
    return round_half_up(value, digits).cast(f"decimal(18,{digits})").cast("string")


def percent(share: Column, digits: int = 0) -> Column:
    """A share as percent text, ``0.43`` as ``43%``."""
    return F.concat(fixed(share * 100.0, digits), F.lit("%"))


def sentence(*parts: Column | str) -> Column:
    """Concatenate literals and columns; NULL if any part is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def fragment(condition: Column, *parts: Column | str) -> Column:
    """The text when the condition holds, else an empty string."""
    return F.when(condition, sentence(*parts)).otherwise(F.lit(""))


def first_text(cases: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """Text of the first case whose condition holds."""
    chain = F
    for condition, text in cases:
        chain = chain.when(condition, text)
    return chain if otherwise is None else chain.otherwise(otherwise)
