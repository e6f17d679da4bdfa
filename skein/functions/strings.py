"""Strings, regular expressions, hashes and encodings."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import _unless_null, as_column, as_value


def md5(e: Any) -> Column:
    return F.md5(as_column(e).cast("binary"))


def sha1(e: Any) -> Column:
    return F.sha1(as_column(e).cast("binary"))


def sha2(e: Any, bits: int = 256) -> Column:
    if bits not in (0, 224, 256, 384, 512):
        raise ValueError(f"the digest size is 0, 224, 256, 384 or 512, not {bits}")
    return F.sha2(as_column(e).cast("binary"), bits)


def hash(*columns: Any) -> Column:
    """A 64-bit hash; its values are this engine's own."""
    return F.xxhash64(*map(as_column, columns))


def ascii(e: Any) -> Column:
    return F.ascii(as_column(e))


def concat_ws(separator: Any, *columns: Any) -> Column:
    """Null if any argument is null."""
    cs = [as_column(c).cast("string") for c in columns]
    return _unless_null(cs, F.array_join(F.array(*cs), separator)) if isinstance(separator, str) else _unless_null([separator, *cs], F.call_function("concat_ws", separator, *cs))


def concat_ws_ignore_nulls(separator: str, *columns: Any) -> Column:
    """Arrays are flattened, nulls left out; no value at all gives an empty text."""
    return F.concat_ws(separator, *map(as_column, columns))


def concat(*columns: Any) -> Column:
    return F.concat(*map(as_column, columns))


#: Characters after which a word begins, besides white space.
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def initcap(e: Any) -> Column:
    """Words start after white space or punctuation."""
    breaks = r"\s" + re.escape(WORD_BREAKS)
    parts = F.regexp_extract_all(F.lower(as_column(e)), F.lit(f"[{breaks}]+|[^{breaks}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))), "")


def length(e: Any) -> Column:
    return F.length(as_column(e))


def lower(e: Any) -> Column:
    return F.lower(as_column(e))


def upper(e: Any) -> Column:
    return F.upper(as_column(e))


def lpad(e: Any, n: Any, pad: Any) -> Column:
    return F.call_function("lpad", as_column(e), as_value(n), as_value(pad))


def rpad(e: Any, n: Any, pad: Any) -> Column:
    return F.call_function("rpad", as_column(e), as_value(n), as_value(pad))


def ltrim(e: Any, chars: Any = None) -> Column:
    return F.ltrim(as_column(e)) if chars is None else F.ltrim(as_column(e), as_value(chars))


def rtrim(e: Any, chars: Any = None) -> Column:
    return F.rtrim(as_column(e)) if chars is None else F.rtrim(as_column(e), as_value(chars))


def trim(e: Any, chars: Any = None) -> Column:
    return F.trim(as_column(e)) if chars is None else F.btrim(as_column(e), as_value(chars))


def repeat(e: Any, n: Any) -> Column:
    return F.repeat(as_column(e), as_value(n))


def soundex(e: Any) -> Column:
    return F.soundex(as_column(e))


def split(e: Any, separator: Any) -> Column:
    """Splits at a literal separator; an empty one doesn't split."""
    c, s = as_column(e), as_value(separator)
    quoted = F.concat(F.lit("\\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.when(s == "", F.array(c)).otherwise(F.call_function("split", c, quoted))


def strtok_to_array(e: Any, delimiters: str = " ") -> Column:
    """Splits at any of the delimiter characters and leaves out empty tokens."""
    if not delimiters:
        return F.when(as_column(e) != "", F.array(as_column(e))).otherwise(F.array().cast("array<string>"))
    pattern = "[" + "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in delimiters) + "]"
    return F.filter(F.split(as_column(e), pattern), lambda x: x != "")


def substring(e: Any, pos: Any, n: Any = None) -> Column:
    """1-based; negative positions count from the end."""
    return F.substr(as_column(e), as_value(pos)) if n is None else F.substr(as_column(e), as_value(pos), as_value(n))


def translate(e: Any, matching: Any, replacement: Any) -> Column:
    return F.call_function("translate", as_column(e), as_value(matching), as_value(replacement))


def contains(e: Any, part: Any) -> Column:
    return F.contains(as_column(e), as_value(part))


def startswith(e: Any, part: Any) -> Column:
    return F.startswith(as_column(e), as_value(part))


def endswith(e: Any, part: Any) -> Column:
    return F.endswith(as_column(e), as_value(part))


def char(e: Any) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(as_column(e).cast("int")), 8, "0")), "UTF-32")


chr = char


def insert(base: Any, pos: Any, n: Any, new: Any) -> Column:
    """Replaces n characters from a 1-based position."""
    return F.overlay(as_column(base), as_value(new), as_value(pos), as_value(n))


def left(e: Any, n: Any) -> Column:
    return F.left(as_column(e), as_value(n))


def right(e: Any, n: Any) -> Column:
    return F.right(as_column(e), as_value(n))


def _flagged(pattern: Any, parameters: str) -> Column:
    """Flags i, m, s inside the pattern; c (case matters) is the default."""
    flags = "".join(dict.fromkeys(x for x in parameters if x in "ims"))
    if "c" in parameters and parameters.rfind("c") > parameters.rfind("i"):
        flags = flags.replace("i", "")
    return F.concat(F.lit(f"(?{flags})"), as_value(pattern)) if flags else as_value(pattern)


def regexp_count(e: Any, pattern: Any, position: int = 1, parameters: str = "") -> Column:
    return F.regexp_count(F.substr(as_column(e), F.lit(position)), _flagged(pattern, parameters))


def regexp_replace(e: Any, pattern: Any, replacement: Any = "") -> Column:
    """Backslash and number name a group in the replacement."""
    if isinstance(replacement, str):
        replacement = re.sub(r"\\(\d)", r"$\1", replacement)
    return F.regexp_replace(as_column(e), as_value(pattern), as_value(replacement))


def regexp_extract(e: Any, pattern: str, position: int = 1, occurrence: int = 1, group: int = 0) -> Column:
    """The group of the nth match from a position; no match gives an empty text, null gives null."""
    c = as_column(e)
    found = F.try_element_at(F.regexp_extract_all(F.substr(c, F.lit(position)), F.lit(pattern), F.lit(group)), F.lit(occurrence))
    return F.when(c.isNotNull(), F.coalesce(found, F.lit("")))


def replace(e: Any, search: Any, replacement: Any = "") -> Column:
    return F.replace(as_column(e), as_value(search), as_value(replacement))


def charindex(target: Any, source: Any, position: Any = 1) -> Column:
    return F.call_function("locate", as_value(target), as_column(source), as_value(position))


def locate(part: Any, e: Any, position: int = 1) -> Column:
    return charindex(part, e, position)


def instr(e: Any, pattern: str) -> Column:
    """The position of the first match of a regular expression, 0 for none."""
    return F.regexp_instr(as_column(e), F.lit(pattern))


#: Collation parts and the suffixes that stand for them.
_COLLATION_PARTS = {"ci": "_CI", "ai": "_AI", "trim": "_TRIM", "ltrim": "_LTRIM", "rtrim": "_RTRIM"}


def collation_name(spec: str) -> str:
    """'en-ci', 'utf8', 'lower', 'en_US-trim', ... to a Spark collation."""
    parts = [p for p in re.split("-", spec) if p]
    base = parts[0] if parts else "utf8"
    rest = "".join(_COLLATION_PARTS.get(p.lower(), "") for p in parts[1:])
    if base.lower() in ("utf8", "bin", ""):
        return "UTF8_LCASE" + rest.replace("_CI", "") if "_CI" in rest else "UTF8_BINARY" + rest
    if base.lower() in ("lower", "upper"):
        return "UTF8_LCASE" + rest
    return {"en": "en", "de": "de", "fr": "fr", "es": "es"}.get(base.split("_")[0].lower(), "UNICODE") + rest if len(base) <= 5 else spec


def collate(e: Any, spec: str) -> Column:
    return F.collate(as_column(e), collation_name(spec))


def collation(e: Any) -> Column:
    return F.collation(as_column(e))


def reverse(e: Any) -> Column:
    return F.reverse(as_column(e))


def substring_index(text: str | Column, delim: str, count: int, exact: bool = False) -> Column:
    """Before the count-th delimiter, for negative counts after the count-th from the end.

    A literal text keeps the reference results: the prefix ends one character after the delimiter, and a suffix starts
    where the delimiter lies in the reversed text. `exact` (and any column) cuts at the delimiter itself.
    """
    if exact or isinstance(text, Column):
        return F.substring_index(as_value(text), delim, count)
    if count < 0:
        hits = [m.start() for m in re.finditer(delim, text[::-1])]
        return F.lit(text[hits[-count - 1] :] if len(hits) >= -count else text)
    ends = [m.end() for m in re.finditer(delim, text)]
    return F.lit(text[: ends[count - 1] + 1] if 0 < count <= len(ends) else "")


def base64(e: Any) -> Column:
    return F.base64(as_column(e).cast("binary"))


def unbase64(e: Any) -> Column:
    return F.decode(F.unbase64(as_column(e)), "UTF-8")


def hex(e: Any) -> Column:
    """The hexadecimal digits of the text's bytes."""
    return F.hex(as_column(e).cast("string"))


def unhex(e: Any) -> Column:
    return F.decode(F.unhex(as_column(e)), "UTF-8")
