"""Arrays and objects. Positions are 0-based; objects are maps from text to a value or variant."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import as_column, as_value
from .semistructured import xml_attribute, xml_content, xml_name


def arrays_overlap(a: Any, b: Any) -> Column:
    return F.arrays_overlap(as_column(a), as_column(b))


def array_intersection(a: Any, b: Any) -> Column:
    """What both arrays hold, as often as the array that has it less often."""
    x, y = as_column(a), as_column(b)

    def times(arr, v):
        return F.size(F.filter(arr, lambda e: e.eqNullSafe(v)))

    kept = F.transform(x, lambda e, i: F.when(times(F.slice(x, 1, i + 1), e) <= times(y, e), F.struct(e.alias("v"))))
    return F.transform(F.filter(kept, lambda s: s.isNotNull()), lambda s: s["v"])


def array_append(a: Any, e: Any) -> Column:
    return F.array_append(as_column(a), as_value(e))


def array_prepend(a: Any, e: Any) -> Column:
    return F.array_prepend(as_column(a), as_value(e))


def array_cat(a: Any, b: Any) -> Column:
    return F.concat(as_column(a), as_column(b))


def array_compact(a: Any) -> Column:
    return F.array_compact(as_column(a))


def array_construct(*columns: Any) -> Column:
    """An array of values of one type (cast mixed types to variant with to_variant)."""
    return F.array(*map(as_value, columns))


array = array_construct


def array_construct_compact(*columns: Any) -> Column:
    return F.array_compact(array_construct(*columns))


def array_contains(value: Any, a: Any) -> Column:
    return F.array_contains(as_column(a), as_value(value))


def variant_array_contains(value: Any, a: Any) -> Column:
    """array_contains over an array of variants; values are compared by their JSON."""
    return F.exists(as_column(a), lambda x: F.to_json(x) == F.to_json(as_column(value)))


def array_flatten(a: Any) -> Column:
    return F.flatten(as_column(a))


def array_insert(a: Any, pos: Any, e: Any) -> Column:
    """Before a 0-based position; a negative one counts from the end."""
    arr, p = as_column(a), as_value(pos)
    at = F.when(p < 0, F.size(arr) + p).otherwise(p)
    return F.array_insert(arr, (at + 1).cast("int"), as_value(e))


def array_position(value: Any, a: Any) -> Column:
    """Null if absent."""
    return (F.nullif(F.array_position(as_column(a), as_value(value)), F.lit(0).cast("long")) - 1).cast("int")


def array_size(a: Any) -> Column:
    return F.array_size(as_column(a))


size = array_size


def array_slice(a: Any, start: Any, stop: Any) -> Column:
    """From start up to, not including, stop; negative ones count from the end."""
    arr = as_column(a)
    n = F.size(arr)
    lo, hi = (F.greatest(F.least(F.when(p < 0, n + p).otherwise(p), n), F.lit(0)) for p in (as_value(start), as_value(stop)))
    return F.slice(arr, (lo + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))


def array_to_string(a: Any, separator: Any) -> Column:
    return F.call_function("array_join", F.transform(as_column(a), lambda x: F.coalesce(x.cast("string"), F.lit(""))), as_value(separator))


def object_construct(*key_values: Any) -> Column:
    """Pairs of key and value; those with a null key or value are left out."""
    if len(key_values) % 2:
        raise ValueError("keys and values come in pairs")
    if not key_values:
        return F.create_map().cast("map<string,variant>")
    pairs = [as_value(v) if i % 2 == 0 else as_value(v).cast("variant") for i, v in enumerate(key_values)]
    entries = F.array(*[F.when(k.isNotNull() & v.isNotNull(), F.struct(k.cast("string").alias("key"), v.alias("value"))) for k, v in zip(pairs[::2], pairs[1::2], strict=True)])
    return F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))


def object_delete(obj: Any, *keys: Any) -> Column:
    names = [as_value(k) for k in keys]
    return F.map_filter(as_column(obj), lambda k, v: ~k.isin(*names))


def object_pick(obj: Any, *keys: Any) -> Column:
    names = [as_value(k) for k in keys]
    return F.map_filter(as_column(obj), lambda k, v: k.isin(*names))


def object_insert(obj: Any, key: Any, value: Any, update: Any = False) -> Column:
    """An existing key is an error unless update is true; a null value inserts nothing."""
    m, k, v = as_column(obj), as_value(key), as_value(value)
    rest = F.map_filter(m, lambda x, _: x != k)
    clash = F.map_contains_key(m, k) & ~as_value(update)
    new = F.when(v.isNull(), m).otherwise(F.map_concat(rest, F.create_map(k, v)))
    return F.when(F.assert_true(~clash, "duplicate key in object_insert").isNull(), new)


def object_keys(obj: Any) -> Column:
    return F.map_keys(as_column(obj))


def to_array(e: Any) -> Column:
    """A scalar as an array of one; null stays null. An array is returned by array_cat or itself."""
    return F.when(as_column(e).isNotNull(), F.array(as_column(e)))


def get(container: Any, key: Any) -> Column:
    """An element by 0-based position, a value by key, null if absent; a variant by its path or position. Of an XML element
    '$' is the content, '@' the name and '@name' an attribute."""
    c = as_column(container)
    if isinstance(key, str) and key[:1] in ("$", "@"):
        return xml_content(c) if key == "$" else xml_name(c) if key == "@" else xml_attribute(c, key[1:])
    return F.try_element_at(c, as_value(key)) if isinstance(key, str) else F.get(c, as_value(key))


def get_ignore_case(obj: Any, key: Any) -> Column:
    """The exact key first, else any that differs by case alone."""
    m, k = as_column(obj), as_value(key)
    alike = F.map_values(F.map_filter(m, lambda x, _: F.lower(x) == F.lower(k)))
    return F.coalesce(F.try_element_at(m, k), F.get(alike, F.lit(0)))
