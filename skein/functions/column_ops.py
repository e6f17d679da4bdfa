"""The named forms of column operators."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import as_column, as_value


def equal_to(a: Any, b: Any) -> Column:
    return as_column(a) == as_value(b)


def not_equal(a: Any, b: Any) -> Column:
    return as_column(a) != as_value(b)


def gt(a: Any, b: Any) -> Column:
    return as_column(a) > as_value(b)


def lt(a: Any, b: Any) -> Column:
    return as_column(a) < as_value(b)


def geq(a: Any, b: Any) -> Column:
    return as_column(a) >= as_value(b)


def leq(a: Any, b: Any) -> Column:
    return as_column(a) <= as_value(b)


def and_(a: Any, b: Any) -> Column:
    return as_column(a) & as_value(b)


def or_(a: Any, b: Any) -> Column:
    return as_column(a) | as_value(b)


def between(a: Any, low: Any, high: Any) -> Column:
    return as_column(a).between(as_value(low), as_value(high))


def plus(a: Any, b: Any) -> Column:
    return as_column(a) + as_value(b)


def minus(a: Any, b: Any) -> Column:
    return as_column(a) - as_value(b)


def multiply(a: Any, b: Any) -> Column:
    return as_column(a) * as_value(b)


def divide(a: Any, b: Any) -> Column:
    return as_column(a) / as_value(b)


def mod(a: Any, b: Any) -> Column:
    return as_column(a) % as_value(b)


def bitor(a: Any, b: Any) -> Column:
    return as_column(a).bitwiseOR(as_value(b))


def bitand(a: Any, b: Any) -> Column:
    return as_column(a).bitwiseAND(as_value(b))


def bitxor(a: Any, b: Any) -> Column:
    return as_column(a).bitwiseXOR(as_value(b))


def is_not_null(a: Any) -> Column:
    return as_column(a).isNotNull()


def desc_nulls_first(a: Any) -> Column:
    return as_column(a).desc_nulls_first()


def desc_nulls_last(a: Any) -> Column:
    return as_column(a).desc_nulls_last()


def asc_nulls_first(a: Any) -> Column:
    return as_column(a).asc_nulls_first()


def asc_nulls_last(a: Any) -> Column:
    return as_column(a).asc_nulls_last()


def within_group(name: str, *args: str, order_by: str) -> Column:
    """An ordered-set aggregate by name, its arguments and order as SQL: within_group('percentile_cont', '0.5', order_by='v DESC')."""
    return F.expr(f"{name}({', '.join(args)}) WITHIN GROUP (ORDER BY {order_by})")


def get_name(c: Column) -> str | None:
    """The name of a column or alias; None for an expression without one."""
    text = str(c)[len("Column<'") : -2]
    if " AS " in text:
        return text.rsplit(" AS ", 1)[1].strip("`")
    return text.strip("`") if text.replace("_", "").replace(".", "").replace("`", "").isalnum() else None
