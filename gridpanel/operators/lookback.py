"""Look-back by key value (period n-1, season s-1) in windows of bounded size.

A look-back of a few steps never needs the whole history of an entity in one
task. The axis is cut into blocks of ``width`` values; a row near the end of a
block is also sent to the next one, where it only serves as history. Window
groups then hold at most ``width + reach`` axis values, whoever the entity is,
at the price of about ``reach / width`` extra rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

BLOCK = "_block"


@dataclass(frozen=True)
class Lookback:
    """History of ``keys`` along ``axis``, up to ``reach`` values back."""

    keys: tuple[str, ...]
    axis: str
    reach: int
    width: int = 64

    def usable(self) -> Column:
        """Rows that lack the axis value or a key have no history and are nobody's history."""
        known = F.col(self.axis).isNotNull()
        for key in self.keys:
            known = known & F.col(key).isNotNull()
        return known

    def _own_block(self) -> Column:
        return F.floor(F.col(self.axis) / F.lit(self.width))

    def spread(self, df: DataFrame, scatter: list[str]) -> DataFrame:
        """Add the block, repeating rows that a later block looks back on.

        Unusable rows are scattered on ``scatter`` so that they cannot pile up.
        """
        last = F.floor((F.col(self.axis) + self.reach) / F.lit(self.width))
        blocks = F.when(self.usable(), F.sequence(self._own_block(), last)).otherwise(
            F.array(F.xxhash64(*scatter))
        )
        return df.select("*", F.explode(blocks).alias(BLOCK))

    def own(self) -> Column:
        """True for a row in its own block, false for a copy."""
        return ~self.usable() | (F.col(BLOCK) == self._own_block())

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLOCK).orderBy(self.axis)

    def at(self, value: str, rows: str, offset: int, strict: bool, needed: Column) -> Column:
        """The one value ``offset`` steps away, NULL if there is none.

        ``rows`` counts the source rows behind each value: with ``strict`` a
        second match is an error where the value is ``needed``, as it is for a
        scalar subquery that is evaluated.
        """
        frame = self.window().rangeBetween(offset, offset)
        found = F.max(value).over(frame)
        if strict:
            many = needed & (F.sum(rows).over(frame) > 1)
            found = F.when(many, F.raise_error(F.lit(f"more than one {value} row for a look-up"))).otherwise(found)
        return F.when(self.usable(), found)

    def mean(self, value: str, first: int, last: int) -> Column:
        """Mean of the values between two offsets, NULL values left out."""
        return F.when(self.usable(), F.avg(value).over(self.window().rangeBetween(first, last)))
