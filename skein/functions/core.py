"""Column construction, conditions and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(x: Any) -> Column:
    """A column from a column, the name of one, or a one-column frame (a scalar subquery)."""
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return toScalar(x) if hasattr(x, "columns") else F.lit(x)


def as_value(x: Any) -> Column:
    """A column from a column or a literal."""
    return x if isinstance(x, Column) else F.lit(x)


def col(name: str | Any) -> Column:
    return as_column(name)


column = col


def toScalar(frame: Any) -> Column:
    df = frame if isinstance(frame, DataFrame) else frame.df
    if len(df.columns) != 1:
        raise ValueError(f"a scalar subquery has one column, not {len(df.columns)}")
    return df.scalar()


def lit(value: Any) -> Column:
    return F.lit(value)


typedLit = lit


def sqlExpr(text: str) -> Column:
    return F.expr(text)


expr = sqlExpr


def coalesce(*columns: Any) -> Column:
    return F.coalesce(*map(as_column, columns))


def equal_nan(c: Any) -> Column:
    """True for NaN; null for null."""
    return F.when(as_column(c).isNotNull(), F.isnan(as_column(c)))


def is_null(c: Any) -> Column:
    return as_column(c).isNull()


isnull = is_null


def negate(c: Any) -> Column:
    return -as_column(c)


def not_(c: Any) -> Column:
    return ~as_column(c)


def _unless_null(columns: Sequence[Column], value: Column) -> Column:
    known = columns[0].isNotNull()
    for c in columns[1:]:
        known &= c.isNotNull()
    return F.when(known, value)


def greatest(*columns: Any) -> Column:
    """Null if any argument is null."""
    cs = [as_column(c) for c in columns]
    return cs[0] if len(cs) == 1 else _unless_null(cs, F.greatest(*cs))


def least(*columns: Any) -> Column:
    """Null if any argument is null."""
    cs = [as_column(c) for c in columns]
    return cs[0] if len(cs) == 1 else _unless_null(cs, F.least(*cs))


def when(condition: Column, value: Any) -> Column:
    return F.when(condition, as_value(value))


def iff(condition: Column, yes: Any, no: Any) -> Column:
    """`yes` where the condition holds, else `no`, also where the condition is null."""
    return F.when(condition, as_value(yes)).otherwise(as_value(no))


def in_(columns: Any, values: Any) -> Column:
    """Membership of a column, or of a row of columns, in literals or in the rows of a frame."""
    many = isinstance(columns, (list, tuple))
    cs = [as_column(c) for c in columns] if many else [as_column(columns)]
    if hasattr(values, "columns"):
        df = values if isinstance(values, DataFrame) else values.df
        if len(df.columns) != len(cs):
            raise ValueError(f"{len(cs)} columns can't be in rows of {len(df.columns)}")
        return F.struct(*cs).isin(df.select(F.struct(*df.columns))) if many else cs[0].isin(df)
    if not many:
        return cs[0].isin(*values)
    if any(len(v) != len(cs) for v in values):
        raise ValueError("each row of values needs as many entries as there are columns")
    hit = F.lit(False)
    for v in values:
        one = F.lit(True)
        for c, x in zip(cs, v, strict=True):
            one &= c == as_value(x)
        hit |= one
    return hit


def desc(name: Any) -> Column:
    return as_column(name).desc_nulls_last()


def asc(name: Any) -> Column:
    return as_column(name).asc_nulls_first()


def callBuiltin(name: str, *args: Any) -> Column:
    """A function by name: one of this library, else one of Spark or the session."""
    from skein import functions

    own = getattr(functions, name.lower(), None)
    cs = [as_value(a) for a in args]
    return own(*args) if callable(own) and not name.startswith("_") else F.call_function(name, *cs)


def callUDF(name: str, *args: Any) -> Column:
    return F.call_function(name, *[as_value(a) for a in args])


def udf(f=None, returnType="string", **options: Any):
    """A scalar user-defined function; batches move through Arrow."""
    options.setdefault("useArrow", True)
    return F.udf(f, returnType, **options) if f else F.udf(returnType=returnType, **options)


# ---- operators that Column has under other names


def equal_null(a: Any, b: Any) -> Column:
    return as_column(a).eqNullSafe(as_value(b))


def regexp(c: Any, pattern: Any) -> Column:
    """True if the whole text matches."""
    return F.rlike(as_column(c), F.concat(F.lit("^(?:"), as_value(pattern), F.lit(")$")))


def like(c: Any, pattern: Any) -> Column:
    return F.like(as_column(c), as_value(pattern))


def sub_field(c: Any, key: str | int) -> Column:
    """A field by name or an element by 0-based position."""
    return as_column(c).getItem(key)


TYPE_NAMES = {"byteint": "tinyint", "number": "decimal(38,0)", "numeric": "decimal(38,0)", "object": "map<string,variant>", "varchar": "string", "char": "string", "text": "string", "float8": "double", "real": "double", "datetime": "timestamp_ntz", "array": "array<variant>", "timestampntz": "timestamp_ntz", "timestampltz": "timestamp"}


def cast(c: Any, to: Any) -> Column:
    """A cast; besides Spark's own names the type may be byteint, number[(p, s)], object, array, varchar, ..."""
    if isinstance(to, str):
        head, paren, rest = to.strip().lower().partition("(")
        to = f"decimal({rest}" if paren and head.strip() in ("number", "numeric") else TYPE_NAMES.get(to.strip().lower(), to)
    return as_column(c).cast(to)
