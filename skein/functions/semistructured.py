"""JSON, XML and variants."""

from __future__ import annotations

import re
from typing import Any
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import as_column, as_value

#: What stands between the tags of an element; an attribute's value may hold any character.
INNER = re.compile(r"""^<(?:"[^"]*"|'[^']*'|[^'">])*>(.*)</[^>]*>$""", re.S)


def variant_type(v: Any) -> Column:
    """'BIGINT', 'DECIMAL(2,1)', 'STRING', 'ARRAY<...>', 'OBJECT<...>', 'VOID', ..."""
    return F.schema_of_variant(as_column(v))


def _is(v: Any, *starts: str) -> Column:
    t = variant_type(v)
    hit = t.startswith(starts[0])
    for s in starts[1:]:
        hit |= t.startswith(s)
    return hit


def is_array(v: Any) -> Column:
    return _is(v, "ARRAY")


def is_boolean(v: Any) -> Column:
    return _is(v, "BOOLEAN")


def is_binary(v: Any) -> Column:
    return _is(v, "BINARY")


def is_varchar(v: Any) -> Column:
    return _is(v, "STRING")


is_char = is_varchar


def is_date(v: Any) -> Column:
    return _is(v, "DATE")


is_date_value = is_date


def is_integer(v: Any) -> Column:
    return _is(v, "BIGINT") | variant_type(v).rlike(r"^DECIMAL\(\d+,0\)$")


def is_decimal(v: Any) -> Column:
    return _is(v, "BIGINT", "DECIMAL")


def is_double(v: Any) -> Column:
    return _is(v, "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


is_real = is_double


def is_null_value(v: Any) -> Column:
    return F.when(as_column(v).isNotNull(), F.is_variant_null(as_column(v)))


def is_object(v: Any) -> Column:
    return _is(v, "OBJECT")


def is_time(v: Any) -> Column:
    """Variants of this engine hold no time of day."""
    return _is(v, "TIME(")


def is_timestamp_ntz(v: Any) -> Column:
    return _is(v, "TIMESTAMP_NTZ")


def is_timestamp_ltz(v: Any) -> Column:
    return variant_type(v) == "TIMESTAMP"


is_timestamp_tz = is_timestamp_ltz


def _as(v: Any, hit: Column, kind: str) -> Column:
    """The value if it is of the type already, else null."""
    return F.when(hit, F.try_variant_get(as_column(v), "$", kind))


def as_array(v: Any) -> Column:
    return _as(v, is_array(v), "array<variant>")


def as_binary(v: Any) -> Column:
    return _as(v, is_binary(v), "binary")


def as_varchar(v: Any) -> Column:
    return _as(v, is_varchar(v), "string")


as_char = as_varchar


def as_date(v: Any) -> Column:
    return _as(v, is_date(v), "date")


def as_decimal(v: Any, precision: int = 38, scale: int = 0) -> Column:
    return _as(v, is_decimal(v), f"decimal({precision},{scale})")


as_number = as_decimal


def as_double(v: Any) -> Column:
    return _as(v, is_double(v), "double")


as_real = as_double


def as_integer(v: Any) -> Column:
    return _as(v, is_integer(v), "bigint")


def as_object(v: Any) -> Column:
    return _as(v, is_object(v), "map<string,variant>")


def as_time(v: Any) -> Column:
    """Null: variants of this engine hold no time of day."""
    return F.lit(None).cast("string")


def as_timestamp_ntz(v: Any) -> Column:
    return _as(v, is_timestamp_ntz(v), "timestamp_ntz")


def as_timestamp_ltz(v: Any) -> Column:
    return _as(v, is_timestamp_ltz(v), "timestamp")


as_timestamp_tz = as_timestamp_ltz


def check_json(e: Any) -> Column:
    """Null for valid JSON and for null, else a message. Spark's parser stops after the first value, so text behind it is
    found by parsing the whole as the only element of an array, and as a field."""
    c = as_column(e)
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    whole = listed.isNotNull() & field.isNotNull() & (F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1)
    return F.when(c.isNotNull() & ~whole, F.lit("invalid JSON"))


def _xml_errors(texts: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            ElementTree.fromstring(text)
        except ElementTree.ParseError as e:
            return f"invalid XML: {e}"
        return None

    return texts.map(one)


def check_xml(e: Any) -> Column:
    """Null for well-formed XML and for null, else a message."""
    return F.pandas_udf(_xml_errors, "string")(as_column(e))


def variant_path(path: str) -> str:
    """'a.b[0]:c' to '$.a.b[0].c'; names in double quotes may hold any character."""
    parts = re.findall(r'"([^"]*)"|\[(\d+)\]|\[[\'"]([^\'"]*)[\'"]\]|([^.:\[\]"]+)', path)
    out = "$"
    for quoted, index, bracket, plain in parts:
        name = quoted or bracket or plain
        out += f"[{index}]" if index else f".{name}" if re.fullmatch(r"\w+", name) else f"['{name}']"
    return out


def get_path(v: Any, path: str | Column) -> Column:
    """What lies at a path of a variant, as a variant; null if nothing does."""
    p = variant_path(path) if isinstance(path, str) else F.concat(F.lit("$."), F.replace(path, F.lit(":"), F.lit(".")))
    return F.try_variant_get(as_column(v), p, "variant")


def json_extract_path_text(e: Any, path: str | Column) -> Column:
    """What lies at a path of a JSON text, as text."""
    if isinstance(path, str):
        return F.get_json_object(as_column(e), variant_path(path))
    return F.call_function("get_json_object", as_column(e), F.concat(F.lit("$."), path))


def parse_json(e: Any) -> Column:
    return F.parse_json(as_column(e))


def try_parse_json(e: Any) -> Column:
    return F.try_parse_json(as_column(e))


def parse_xml(e: Any, schema: str | None = None) -> Column:
    """XML text, checked; with a schema a struct."""
    c = as_column(e)
    if schema is not None:
        return F.from_xml(c, schema)
    return F.when(F.assert_true(check_xml(c).isNull(), F.lit("invalid XML")).isNull(), c)


def strip_null_value(v: Any) -> Column:
    return F.when(~F.is_variant_null(as_column(v)), as_column(v))


def to_json(e: Any) -> Column:
    return F.to_json(as_column(e))


def to_object(e: Any) -> Column:
    return as_column(e).cast("map<string,variant>")


def to_variant(e: Any) -> Column:
    return as_column(e).cast("variant")


def to_variant_object(e: Any) -> Column:
    """A struct or map as a variant object."""
    return F.to_variant_object(as_column(e))


def to_xml(e: Any) -> Column:
    return F.to_xml(as_column(e))


def _child(texts: pd.Series, tags: pd.Series, instances: pd.Series) -> pd.Series:
    def one(text: str | None, tag: str | None, instance: Any) -> str | None:
        if text is None or tag is None or pd.isna(instance):
            return None
        try:
            found = ElementTree.fromstring(text).findall(tag)
        except (ElementTree.ParseError, SyntaxError):
            return None
        if not 0 <= int(instance) < len(found):
            return None
        found[int(instance)].tail = None
        return ElementTree.tostring(found[int(instance)], encoding="unicode")

    return pd.Series([one(*x) for x in zip(texts, tags, instances, strict=True)], dtype=object)


def xmlget(xml: Any, tag: Any, instance: Any = 0) -> Column:
    """The n-th child element of that name (0-based) as XML text, null if absent. xml_content and xml_name ask such an
    element further; xmlget of it gives its own children."""
    t, n = (as_value(x) for x in (tag, instance))
    return F.pandas_udf(_child, "string")(as_column(xml), t.cast("string"), n.cast("int"))


def _root(text: str) -> tuple[str, dict[str, str], str]:
    """The name, attributes and own text of an XML element, names as they are written."""
    found: list = []
    texts: list[str] = []

    def start(name: str, attributes: dict[str, str]) -> None:
        if not found:
            found.extend((name, attributes))

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.CharacterDataHandler = start, texts.append
    parser.Parse(text, True)
    return found[0], found[1], "".join(texts)


def _once(element: Any) -> Column:
    """An element that xmlget finds is found once for all that ask it: called directly, each would find it anew in its own worker call."""
    return F.nullif(as_column(element), F.lit(""))


def _content(elements: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        if not text:
            return None
        own = _root(text)[2]
        inner = INNER.search(text)
        return inner[1] if inner and "<" in inner[1] else own

    return pd.Series([one(x) for x in elements], dtype=object)


def _name(elements: pd.Series) -> pd.Series:
    return pd.Series([_root(x)[0] if x else None for x in elements], dtype=object)


def _attribute(elements: pd.Series, names: pd.Series) -> pd.Series:
    return pd.Series([_root(x)[1].get(n) if x else None for x, n in zip(elements, names, strict=True)], dtype=object)


def xml_content(element: Any) -> Column:
    """What get(element, '$') gives: the element's text, or the XML of its children if it has any."""
    return F.pandas_udf(_content, "string")(_once(element))


def xml_name(element: Any) -> Column:
    """What get(element, '@') gives: the element's name."""
    return F.pandas_udf(_name, "string")(_once(element))


def xml_attribute(element: Any, name: str) -> Column:
    """What get(element, '@name') gives: an attribute, null if absent."""
    return F.pandas_udf(_attribute, "string")(_once(element), F.lit(name))
