"""What groupBy, rollup, cube, grouping sets and pivot return."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, GroupedData
from pyspark.sql import functions as F

from skein.functions import aggregates as A
from skein.functions.core import as_column

from .frame import Frame

#: Aggregates by name.
NAMED = {"avg": A.avg, "average": A.avg, "mean": A.avg, "sum": A.sum, "min": A.min, "max": A.max, "count": A.count, "size": A.count, "median": A.median, "stddev": A.stddev, "std": A.stddev, "any_value": A.any_value, "variance": A.variance, "skew": A.skew, "kurtosis": A.kurtosis}


def named(name: str, column: Any) -> Column:
    f = NAMED.get(name.lower())
    out = f(column) if f else F.call_function(name, as_column(column))
    return out.alias(f"{name}({column})") if isinstance(column, str) else out


def GroupingSets(*sets: Any) -> list[list]:
    """Sets of columns for groupByGroupingSets."""
    return [list(s) for s in sets]


class GroupedFrame:
    def __init__(self, grouped: GroupedData, frame: Frame, keys: int):
        self.grouped, self.frame, self.keys = grouped, frame, keys

    def agg(self, *exprs: Any) -> Frame:
        """Columns, (column, aggregate name) pairs, or a dict of them."""
        items: list = []
        for e in exprs:
            if isinstance(e, dict):
                items += [named(f, c) for c, f in e.items()]
            elif isinstance(e, (list, tuple)):
                items += [named(e[1], e[0])] if len(e) == 2 and isinstance(e[1], str) and not isinstance(e[0], (tuple, list)) else [x if isinstance(x, Column) else named(x[1], x[0]) for x in e]
            else:
                items.append(e)
        if not items:
            raise ValueError("agg needs an aggregate")
        return Frame(self.grouped.agg(*items))

    def _each(self, f, name: str, columns: Sequence[Any]) -> Frame:
        if not columns:
            raise ValueError(f"{name} needs a column")
        return Frame(self.grouped.agg(*[f(c).alias(f"{name}({c})") if isinstance(c, str) else f(c) for c in columns]))

    def avg(self, *columns: Any) -> Frame:
        return self._each(A.avg, "avg", columns)

    mean = avg

    def sum(self, *columns: Any) -> Frame:
        return self._each(A.sum, "sum", columns)

    def median(self, *columns: Any) -> Frame:
        return self._each(A.median, "median", columns)

    def min(self, *columns: Any) -> Frame:
        return self._each(A.min, "min", columns)

    def max(self, *columns: Any) -> Frame:
        return self._each(A.max, "max", columns)

    def any_value(self, *columns: Any) -> Frame:
        return self._each(A.any_value, "any_value", columns)

    def count(self) -> Frame:
        return Frame(self.grouped.agg(F.count(F.lit(1)).alias("count")))

    def builtin(self, name: str):
        return lambda *columns: self._each(lambda c: named(name, c), name, columns)

    def pivot(self, column: str, values: Sequence[Any]) -> GroupedFrame:
        return GroupedFrame(self.grouped.pivot(column, list(values)), self.frame, self.keys)

    def applyInPandas(self, f, schema) -> Frame:
        return Frame(self.grouped.applyInPandas(f, schema))


class PivotedFrame:
    def __init__(self, frame: Frame, column: str, values: list):
        self.frame, self.column, self.values = frame, column, values

    def agg(self, *exprs: Any) -> Frame:
        if len(exprs) != 1:
            raise ValueError("a pivot takes one aggregate")
        e = exprs[0]
        e = named(e[1], e[0]) if isinstance(e, (list, tuple)) else e
        used = {c.lower() for c in self.frame.columns if c.lower() in str(e).lower().replace("`", "").replace("(", " ").replace(")", " ").replace("'", " ").replace("<", " ").replace(">", " ").replace(",", " ").split()}
        keys = [c for c in self.frame.columns if c.lower() != self.column.lower() and c.lower() not in used]
        return Frame(self.frame.df.groupBy(*keys).pivot(self.column, self.values).agg(e))

    def _each(self, name: str, columns: Sequence[Any]) -> Frame:
        if len(columns) != 1:
            raise ValueError("a pivot takes one aggregate")
        return self.agg((columns[0], name))

    def sum(self, *columns: Any) -> Frame:
        return self._each("sum", columns)

    def avg(self, *columns: Any) -> Frame:
        return self._each("avg", columns)

    def min(self, *columns: Any) -> Frame:
        return self._each("min", columns)

    def max(self, *columns: Any) -> Frame:
        return self._each("max", columns)

    def count(self, *columns: Any) -> Frame:
        return self._each("count", columns)
