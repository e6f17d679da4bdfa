"""Aggregate and window functions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .core import as_column, as_value


def approx_count_distinct(e: Any) -> Column:
    return F.approx_count_distinct(as_column(e))


def avg(e: Any) -> Column:
    return F.avg(as_column(e))


mean = avg


def corr(a: Any, b: Any) -> Column:
    return F.corr(as_column(a), as_column(b))


def count(e: Any) -> Column:
    return F.count(F.lit(1) if isinstance(e, str) and e == "*" else as_column(e))


def count_distinct(*columns: Any) -> Column:
    return F.count_distinct(*map(as_column, columns))


countDistinct = count_distinct


def covar_pop(a: Any, b: Any) -> Column:
    return F.covar_pop(as_column(a), as_column(b))


def covar_samp(a: Any, b: Any) -> Column:
    return F.covar_samp(as_column(a), as_column(b))


def grouping(e: Any) -> Column:
    return F.grouping(as_column(e))


def grouping_id(*columns: Any) -> Column:
    return F.grouping_id(*map(as_column, columns))


def kurtosis(e: Any) -> Column:
    """Sample excess kurtosis; null for fewer than four values or no spread."""
    c = as_column(e).cast("double")
    n = F.count(c).cast("double")
    return F.when((n > 3) & (F.var_pop(c) > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def skew(e: Any) -> Column:
    """Sample skewness; null for fewer than three values or no spread."""
    c = as_column(e).cast("double")
    n = F.count(c).cast("double")
    return F.when((n > 2) & (F.var_pop(c) > 0), F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(c))


def max(e: Any) -> Column:
    return F.max(as_column(e))


def min(e: Any) -> Column:
    return F.min(as_column(e))


def any_value(e: Any) -> Column:
    return F.any_value(as_column(e))


def median(e: Any) -> Column:
    return F.median(as_column(e))


def stddev(e: Any) -> Column:
    return F.stddev_samp(as_column(e))


stddev_samp = stddev


def stddev_pop(e: Any) -> Column:
    return F.stddev_pop(as_column(e))


def sum(e: Any) -> Column:
    return F.sum(as_column(e))


def sum_distinct(e: Any) -> Column:
    return F.sum_distinct(as_column(e))


def variance(e: Any) -> Column:
    return F.var_samp(as_column(e))


var_samp = variance


def var_pop(e: Any) -> Column:
    return F.var_pop(as_column(e))


def approx_percentile(e: Any, percentile: float) -> Column:
    """Interpolates between values (exact)."""
    return F.percentile(as_column(e), percentile)


def approx_percentile_accumulate(e: Any) -> Column:
    """A mergeable sketch as binary."""
    return F.kll_sketch_agg_double(as_column(e).cast("double"))


def approx_percentile_combine(state: Any) -> Column:
    return F.kll_merge_agg_double(as_column(state))


def approx_percentile_estimate(state: Any, percentile: float) -> Column:
    return F.kll_sketch_get_quantile_double(as_column(state), F.lit(float(percentile)))


def array_agg(e: Any) -> Column:
    """The values that aren't null; an empty array for none."""
    return F.collect_list(as_column(e))


collect_list = array_agg


def collect_set(e: Any) -> Column:
    return F.collect_set(as_column(e))


def objectagg(key: Any, value: Any) -> Column:
    """An object of all pairs whose key and value aren't null."""
    k, v = as_column(key), as_column(value)
    return F.map_from_entries(F.collect_list(F.when(k.isNotNull() & v.isNotNull(), F.struct(k, v))))


def listagg(e: Any, delimiter: str = "", is_distinct: bool = False) -> Column:
    """The texts of a group, joined; an empty text for none."""
    f = F.listagg_distinct if is_distinct else F.listagg
    return F.coalesce(f(as_column(e).cast("string"), F.lit(delimiter)), F.lit(""))


def listagg_within_group(e: str, delimiter: str, order_by: str) -> Column:
    """listagg in an order: names of columns, order_by may hold ASC or DESC."""
    quoted = delimiter.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"coalesce(listagg({e}, '{quoted}') WITHIN GROUP (ORDER BY {order_by}), '')")


# ---- window functions


def cume_dist() -> Column:
    return F.cume_dist()


def dense_rank() -> Column:
    return F.dense_rank()


def lag(e: Any, offset: int = 1, default: Any = None) -> Column:
    return _shift(F.lag if offset >= 0 else F.lead, e, abs(offset), default)


def lead(e: Any, offset: int = 1, default: Any = None) -> Column:
    return _shift(F.lead if offset >= 0 else F.lag, e, abs(offset), default)


def _shift(f, e: Any, offset: int, default: Any) -> Column:
    return f(as_column(e), offset, default) if not isinstance(default, Column) else F.call_function("lag" if f is F.lag else "lead", as_column(e), F.lit(offset), default)


def ntile(n: int) -> Column:
    return F.ntile(n)


def percent_rank() -> Column:
    return F.percent_rank()


def rank() -> Column:
    return F.rank()


def row_number() -> Column:
    return F.row_number()


class _Last:
    """last(c).over(w): without a frame of its own the window is the whole partition."""

    def __init__(self, c: Column):
        self.c = c

    def over(self, window) -> Column:
        return F.last_value(self.c).over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def over_frame(self, window) -> Column:
        return F.last_value(self.c).over(window)


def last(e: Any) -> _Last:
    return _Last(as_column(e))


def first_value(e: Any) -> Column:
    return F.first_value(as_value(e))
