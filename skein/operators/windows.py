"""Window specifications: Spark's own, with the dialect's check of ROWS bounds."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Window as SparkWindow
from pyspark.sql.window import WindowSpec

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


class Window:
    unboundedPreceding = SparkWindow.unboundedPreceding
    unboundedFollowing = SparkWindow.unboundedFollowing
    currentRow = SparkWindow.currentRow

    @staticmethod
    def partitionBy(*columns: Any) -> WindowSpec:
        return SparkWindow.partitionBy(*columns)

    @staticmethod
    def orderBy(*columns: Any) -> WindowSpec:
        return SparkWindow.orderBy(*columns)

    @staticmethod
    def rowsBetween(start: int, end: int) -> WindowSpec:
        for bound in (start, end):
            if bound not in (SparkWindow.unboundedPreceding, SparkWindow.unboundedFollowing) and not INT_MIN <= bound <= INT_MAX:
                raise ValueError(f"a ROWS bound fits 32 bits, {bound} doesn't")
        return SparkWindow.rowsBetween(start, end)

    @staticmethod
    def rangeBetween(start: int, end: int) -> WindowSpec:
        return SparkWindow.rangeBetween(start, end)
