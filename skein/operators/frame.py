"""Frame: a lazy table. Every method that returns a Frame only extends the logical plan of the DataFrame in `.df`."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from skein.functions.core import as_column

from .table_functions import TableCall, flatten_frame

JOIN_TYPES = {"inner": "inner", "left": "left", "leftouter": "left", "right": "right", "rightouter": "right", "full": "full", "outer": "full", "fullouter": "full", "leftsemi": "left_semi", "semi": "left_semi", "leftanti": "left_anti", "anti": "left_anti", "cross": "cross"}


def join_type(name: str) -> str:
    key = name.lower().replace("_", "").replace(" ", "")
    if key not in JOIN_TYPES:
        raise ValueError(f"unsupported join type '{name}'; one of {', '.join(JOIN_TYPES)}")
    return JOIN_TYPES[key]


def _frame(x: Any) -> DataFrame:
    return x if isinstance(x, DataFrame) else x.df


def _listed(items: tuple) -> list:
    """f(a, b) and f([a, b]) mean the same."""
    return list(items[0]) if len(items) == 1 and isinstance(items[0], (list, tuple)) else list(items)


def _together(parts: list[DataFrame]) -> DataFrame:
    """The union of many frames as a balanced tree, so that the analyser sees each part a few times, not once for every later one."""
    while len(parts) > 1:
        parts = [a.union(b) for a, b in zip(parts[::2], parts[1::2], strict=False)] + parts[len(parts) // 2 * 2 :]
    return parts[0]


class Frame:
    def __init__(self, df: DataFrame, *more: DataFrame):
        """One Spark DataFrame, or the union of several, which is put together when it is first used."""
        self._parts = [df, *more]

    @property
    def df(self) -> DataFrame:
        if len(self._parts) > 1:
            self._parts = [_together(self._parts)]
        return self._parts[0]

    @df.setter
    def df(self, df: DataFrame) -> None:
        self._parts = [df]

    # ---- metadata

    @property
    def schema(self) -> StructType:
        return self.df.schema

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    @property
    def session(self) -> SparkSession:
        return self.df.sparkSession

    @property
    def na(self) -> MissingValues:
        return MissingValues(self)

    @property
    def stat(self) -> Statistics:
        return Statistics(self)

    @property
    def write(self):
        from skein.sources.writer import FrameWriter

        return FrameWriter(self)

    @property
    def async_(self):
        from .asyncjobs import AsyncFrame

        return AsyncFrame(self)

    def explain(self) -> None:
        self.df.explain("formatted")

    def col(self, name: str) -> Column:
        return F.col("*") if name == "*" else self.df[name]

    __getitem__ = col

    def alias(self, name: str) -> Frame:
        return Frame(self.df.alias(name))

    def clone(self) -> Frame:
        """The same rows under fresh column identities, for joins of a table with itself."""
        return Frame(self.df.select(*[F.col(f"`{c}`").alias(c) for c in self.columns]))

    def cacheResult(self) -> Frame:
        """Computes the rows once and keeps them, on disk where memory is short."""
        kept = self.df.persist()
        kept.count()
        return Frame(kept)

    # ---- projection

    def select(self, *columns: Any) -> Frame:
        items = _listed(columns)
        if not items:
            raise ValueError("select needs a column")
        calls = [c for c in items if isinstance(c, TableCall)]
        if len(calls) > 1:
            raise ValueError("at most one table function can stand in a select")
        if not calls:
            return Frame(self.df.select(*items))
        joined, new = calls[0].join(self.df)
        out: list = []
        for c in items:
            out += [F.col(f"`{n}`") for n in new] if isinstance(c, TableCall) else [c]
        return Frame(joined.select(*out))

    def toDF(self, *names: str) -> Frame:
        wanted = _listed(names)
        if len(wanted) != len(self.columns):
            raise ValueError(f"{len(self.columns)} columns can't take {len(wanted)} names")
        return Frame(self.df.toDF(*wanted))

    def drop(self, *columns: Any) -> Frame:
        items = _listed(columns)
        if not all(isinstance(c, (str, Column)) for c in items):
            raise TypeError("drop takes names of columns")
        out = self.df.drop(*items)
        if not out.columns:
            raise ValueError("a frame can't lose all its columns")
        return Frame(out)

    def withColumn(self, name: str, column: Column) -> Frame:
        if isinstance(column, TableCall):
            joined, new = column.join(self.df)
            return Frame(joined.withColumnRenamed(new[-1], name).drop(*new[:-1]))
        return Frame(self.df.withColumn(name, column))

    def withColumns(self, names: Sequence[str], values: Sequence[Column]) -> Frame:
        if len(names) != len(values):
            raise ValueError(f"{len(names)} names for {len(values)} columns")
        if len({n.lower() for n in names}) != len(names):
            raise ValueError("the same name twice")
        return Frame(self.df.withColumns(dict(zip(names, values, strict=True))))

    def rename(self, new: str, column: str | Column) -> Frame:
        old = column if isinstance(column, str) else self.df.select(column).columns[0]
        found = [c for c in self.columns if c.lower() == old.lower()]
        if len(found) != 1:
            raise ValueError(f"column {old} is {'ambiguous' if found else 'not there'}")
        return Frame(self.df.withColumnRenamed(old, new))

    # ---- rows

    def filter(self, condition: Column | str) -> Frame:
        return Frame(self.df.filter(condition))

    where = filter

    def sort(self, *columns: Any, ascending: Any = True) -> Frame:
        """Ascending order puts nulls first, descending order last."""
        items = _listed(columns)
        if not items:
            raise ValueError("sort needs a column")
        return Frame(self.df.orderBy(*items, ascending=ascending))

    orderBy = sort

    def limit(self, n: int) -> Frame:
        return Frame(self.df.limit(n))

    def distinct(self) -> Frame:
        return Frame(self.df.distinct())

    def dropDuplicates(self, *names: str) -> Frame:
        keys = _listed(names)
        return Frame(self.df.dropDuplicates(keys) if keys else self.df.distinct())

    def sample(self, fraction: float | None = None, n: int | None = None) -> Frame:
        """A Bernoulli sample, or n random rows."""
        if (fraction is None) == (n is None):
            raise ValueError("either a fraction or a number of rows")
        if n is not None:
            return Frame(self.df.orderBy(F.rand()).limit(n))
        if not 0 <= fraction <= 1:
            raise ValueError("a fraction lies between 0 and 1")
        return Frame(self.df.sample(fraction))

    def randomSplit(self, weights: Sequence[float], seed: int | None = None) -> list[Frame]:
        if not weights or any(w <= 0 for w in weights):
            raise ValueError("weights must be positive numbers, at least one")
        return [Frame(x) for x in self.df.randomSplit(list(weights), seed)]

    # ---- set operations

    def union(self, other: Any) -> Frame:
        return Frame(self.df.union(_frame(other)).distinct())

    def unionAll(self, other: Any) -> Frame:
        right = other._parts if isinstance(other, Frame) else [_frame(other)]
        left, new = [f.dataType for f in self._parts[0].schema], [f.dataType for f in right[0].schema]
        if left != new:  # the analyser decides about types that differ
            return Frame(self.df.union(_frame(other)))
        return Frame(*self._parts, *right)

    def unionByName(self, other: Any) -> Frame:
        return Frame(self.df.unionByName(_frame(other)).distinct())

    def unionAllByName(self, other: Any) -> Frame:
        return Frame(self.df.unionByName(_frame(other)))

    def intersect(self, other: Any) -> Frame:
        return Frame(self.df.intersect(_frame(other)))

    def except_(self, other: Any) -> Frame:
        return Frame(self.df.subtract(_frame(other)))

    minus = subtract = except_

    # ---- joins

    def join(self, right: Any, on: Any = None, how: str = "inner", partition_by: Sequence = (), order_by: Sequence = ()) -> Frame:
        """With a frame: on shared columns by name, on a condition, or without either every pair. With a table
        function: its rows beside each row; partition_by and order_by deal whole groups to a user-defined one."""
        if isinstance(right, TableCall):
            return Frame(right.join(self.df, partition_by=partition_by, order_by=order_by)[0])
        kind = join_type(how)
        other = _frame(right)
        if on is None:
            if kind not in ("inner", "cross"):
                raise ValueError(f"a {kind} join needs columns or a condition")
            return Frame(self.df.crossJoin(other))
        if not isinstance(on, Column) and kind == "cross":
            raise ValueError("a cross join takes no columns")
        return Frame(self.df.join(other, on if isinstance(on, Column) else [on] if isinstance(on, str) else list(on), kind))

    def crossJoin(self, right: Any) -> Frame:
        return Frame(self.df.crossJoin(_frame(right)))

    def naturalJoin(self, right: Any, how: str = "inner") -> Frame:
        kind = join_type(how)
        if kind not in ("inner", "left", "right", "full"):
            raise ValueError(f"a natural join is inner, left, right or full, not {how}")
        other = _frame(right)
        have = {c.lower() for c in other.columns}
        shared = [c for c in self.columns if c.lower() in have]
        return Frame(self.df.join(other, shared, kind) if shared else self.df.crossJoin(other))

    def flatten(self, column: Any, path: str = "", outer: bool = False, recursive: bool = False, mode: str = "BOTH") -> Frame:
        """Each row beside the parts of a variant, array or object: SEQ, KEY, PATH, INDEX, VALUE, THIS."""
        return Frame(flatten_frame(self.df, as_column(column), path, outer, recursive, mode))

    def explode(self, column: Any) -> Frame:
        kind = self.df.select(as_column(column)).schema[0].dataType
        if not isinstance(kind, (ArrayType, MapType)):
            raise ValueError(f"explode takes an array or a map, not {kind.simpleString()}")
        names = ["VALUE"] if isinstance(kind, ArrayType) else ["KEY", "VALUE"]
        return Frame(self.df.select("*", F.explode(as_column(column)).alias(*names)))

    # ---- grouping

    def agg(self, *exprs: Any) -> Frame:
        return self.groupBy().agg(*exprs)

    def groupBy(self, *columns: Any):
        from .grouped import GroupedFrame

        keys = _listed(columns)
        return GroupedFrame(self.df.groupBy(*keys), self, len(keys))

    def rollup(self, *columns: Any):
        from .grouped import GroupedFrame

        keys = _listed(columns)
        return GroupedFrame(self.df.rollup(*keys), self, len(keys))

    def cube(self, *columns: Any):
        from .grouped import GroupedFrame

        keys = _listed(columns)
        return GroupedFrame(self.df.cube(*keys), self, len(keys))

    def groupByGroupingSets(self, *sets: Any):
        """Sets of columns, each grouped by; all columns named anywhere are keys of the result."""
        from .grouped import GroupedFrame

        wanted = [list(s) for s in _listed(sets)]
        keys = list(dict.fromkeys(c for s in wanted for c in s))
        return GroupedFrame(self.df.groupingSets(wanted, *keys), self, len(keys))

    def pivot(self, column: str, values: Sequence[Any]):
        """One aggregate for each value; all columns but the pivot's and the aggregate's are group keys."""
        from .grouped import PivotedFrame

        return PivotedFrame(self, column, list(values))

    # ---- actions

    def collect(self) -> list[Row]:
        return self.df.collect()

    def toLocalIterator(self) -> Iterator[Row]:
        return self.df.toLocalIterator(prefetchPartitions=True)

    def count(self) -> int:
        return self.df.count()

    def show(self, n: int = 10, width: int = 50) -> None:
        self.df.show(n, width or False)

    def first(self, n: int | None = None) -> Any:
        """The first row or None; with n the first n rows, with a negative n all."""
        return self.df.first() if n is None else self.df.collect() if n < 0 else self.df.take(n)

    def isEmpty(self) -> bool:
        return self.df.isEmpty()

    def createOrReplaceTempView(self, name: str | Sequence[str]) -> None:
        self.df.createOrReplaceTempView(name if isinstance(name, str) else ".".join(name))

    def createOrReplaceView(self, name: str | Sequence[str], query: str | None = None) -> None:
        """A permanent view. Spark keeps permanent views as text, so the query is given; a frame that reads one
        table needs none."""
        target = name if isinstance(name, str) else ".".join(f"`{x}`" for x in name)
        text = query or getattr(self, "source_sql", None)
        if not text:
            raise ValueError("only a query can be a view: pass its text, or start from Session.sql or Session.table")
        if not text.lstrip().lower().startswith(("select", "with", "values", "table", "(")):
            raise ValueError("only a SELECT can be a view")
        self.session.sql(f"CREATE OR REPLACE VIEW {target} AS {text}")


class MissingValues:
    def __init__(self, frame: Frame):
        self.frame = frame

    def drop(self, min_non_nulls: int, columns: Sequence[str]) -> Frame:
        """Rows with at least so many values that are neither null nor NaN; a count over the width keeps none."""
        df = self.frame.df
        if min_non_nulls < 1 or not columns:
            return self.frame
        if min_non_nulls > len(columns):
            return Frame(df.limit(0))
        return Frame(df.na.drop(thresh=min_non_nulls, subset=list(columns)))

    def fill(self, values: dict[str, Any]) -> Frame:
        """Nulls, and NaN in floating columns; a value of another type than its column fills nothing."""
        df, new = self.frame.df, {}
        for name, value in values.items():
            field = df.select(name).schema[0]
            if not _fits(field.dataType, value):
                continue
            c = F.col(f"`{name}`")
            gone = c.isNull() | F.isnan(c) if isinstance(field.dataType, (DoubleType, FloatType)) else c.isNull()
            new[name] = F.when(gone, F.lit(value).cast(field.dataType)).otherwise(c)
        return Frame(df.withColumns(new)) if new else self.frame

    def replace(self, column: str, replacement: dict[Any, Any]) -> Frame:
        """Values by value; None stands for null on either side. The result keeps the column's type."""
        df = self.frame.df
        kind, c = df.select(column).schema[0].dataType, F.col(f"`{column}`")
        out = None
        for old, new in replacement.items():
            if old is not None and not _fits(kind, old) or new is not None and not _fits(kind, new):
                continue
            hit = c.isNull() if old is None else c == F.lit(old)
            value = F.lit(new).cast(kind)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return self.frame if out is None else Frame(df.withColumn(column, out.otherwise(c)))


def _fits(kind: DataType, value: Any) -> bool:
    name = kind.simpleString()
    if isinstance(value, bool):
        return name == "boolean"
    if isinstance(value, int):
        return name in ("tinyint", "smallint", "int", "bigint", "float", "double") or name.startswith("decimal")
    if isinstance(value, float):
        return name in ("float", "double") or name.startswith("decimal")
    return name == "string" if isinstance(value, str) else True


class Statistics:
    MAX_CROSSTAB = 1000

    def __init__(self, frame: Frame):
        self.frame = frame

    def _one(self, e: Column) -> float | None:
        x = self.frame.df.agg(e.alias("x")).first()["x"]
        return None if x is None or x != x else x

    def corr(self, a: str, b: str) -> float | None:
        return self._one(F.corr(a, b))

    def cov(self, a: str, b: str) -> float | None:
        return self._one(F.covar_samp(a, b))

    def approxQuantile(self, columns: str | Sequence[str], percentiles: Sequence[float], error: float = 0.001) -> list:
        many = not isinstance(columns, str)
        found = self.frame.df.approxQuantile(list(columns) if many else columns, list(percentiles), error)
        fill = lambda xs: xs or [None] * len(percentiles)
        return [fill(x) for x in found] if many else fill(found)

    def crosstab(self, a: str, b: str) -> Frame:
        """Counts of pairs, one column for each value of b, at most 1000 of them."""
        df = self.frame.df
        values = [r[0] for r in df.select(b).distinct().limit(self.MAX_CROSSTAB + 1).collect()]
        if len(values) > self.MAX_CROSSTAB:
            raise ValueError(f"column {b} has over {self.MAX_CROSSTAB} values")
        known = sorted(v for v in values if v is not None)
        return Frame(df.groupBy(a).pivot(b, known).count().na.fill(0, [str(v) for v in known]))

    def sampleBy(self, column: Any, fractions: dict[Any, float]) -> Frame:
        return Frame(self.frame.df.sampleBy(as_column(column), fractions))
