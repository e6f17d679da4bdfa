"""PII: format-preserving Feistel pseudonyms."""

from __future__ import annotations

import datetime
import hashlib
import hmac
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


def permuted(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size): a Feistel network on two halves of nearly equal size, walked until it
    lands inside. `tweak` names the format, so formats have permutations of their own."""
    if size < 2:
        return x
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)

    def step(k: int, half: int) -> int:
        return int.from_bytes(hmac.digest(key, f"{tweak}|{size}|{k}|{half}".encode(), "sha256"), "big")

    while True:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2:
                right = (right + sign * step(k, left)) % b
            else:
                left = (left + sign * step(k, right)) % a
        x = left * b + right
        if x < size:
            return x


def string(text: str, key: bytes, tweak: str, back: bool = False) -> str:
    """Permutes the ASCII letters and digits of a string: each keeps its place and kind, all else stays."""
    kinds = [next((k for k in (DIGITS, LOWER, UPPER) if c in k), None) for c in text]
    return _radix(text, kinds, key, tweak + re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text))), back)


def _radix(text: str, kinds: list, key: bytes, tweak: str, back: bool) -> str:
    value, size = 0, 1
    for c, k in zip(text, kinds, strict=True):
        if k:
            value, size = value * len(k) + k.index(c), size * len(k)
    value, out = permuted(value, size, key, tweak, back), []
    for c, k in zip(reversed(text), reversed(kinds), strict=True):
        if k:
            value, digit = divmod(value, len(k))
            c = k[digit]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    return -sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits))) % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _filled(shape: str, digits: str) -> str:
    """shape with its alphanumerics replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in shape)


#: First digits and lengths of card numbers by network; no prefix starts another.
ISSUERS = (
    (re.compile("4"), (13, 16, 19)), (re.compile("5[1-5]|222[1-9]|22[3-9][0-9]|2[3-6][0-9][0-9]|27[01][0-9]|2720"), (16,)), (re.compile("3[47]"), (15,)),
    (re.compile("30[0-5]|3[689]"), tuple(range(14, 20))), (re.compile("35(?:2[89]|[3-8][0-9])"), tuple(range(16, 20))), (re.compile("6011|64[4-9]|65|62"), tuple(range(16, 20))),
    (re.compile("50|5[6-8]|6[37]"), tuple(range(13, 20))),
)


def _issuer(d: str) -> str | None:
    """The network's digits of a valid card number."""
    if 13 <= len(d) <= 19 and luhn(d[:-1]) == int(d[-1]) and len(set(d)) > 1:
        return next((m[0] for p, lengths in ISSUERS if len(d) in lengths and (m := p.match(d))), None)
    return None


def _is_card(d: str) -> bool:
    return _issuer(d) is not None


def _card(s: str, key: bytes, back: bool) -> str | None:
    """The network's digits stay, the check digit is computed anew, all others are permuted."""
    d = re.sub("[ -]", "", s)
    issuer = _issuer(d)
    if issuer is None:
        return None
    body = issuer + string(d[len(issuer) : -1], key, "card" + issuer, back)
    return _filled(s, body + str(luhn(body)))


def _iban(s: str, key: bytes, back: bool) -> str | None:
    d = s.replace(" ", "")
    if not 15 <= len(d) <= 34 or mod97(d) != 1:
        return None
    body = string(d[4:], key, "iban" + d[:2], back)
    return _filled(s, f"{d[:2]}{98 - mod97(d[:2] + '00' + body):02d}{body}")


def _ip(s: str, key: bytes, back: bool) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    x = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, key, "ip", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ssn(s: str, key: bytes, back: bool) -> str | None:
    """Area 001 to 899 but 666, group and serial not zero, as numbers within those limits."""
    area, group, serial = map(int, s.split("-"))
    if not (1 <= area <= 899 and area != 666 and group and serial):
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(permuted(x, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(s: str, key: bytes, back: bool) -> str | None:
    """The country code stays; all other digits are permuted as one number, whatever separates them."""
    lead = re.match(r"\+\d{1,3}(?=[ (.-])", s) or _CALLING_CODE.match(s)
    head = lead[0] if lead else ""
    digits = re.sub(r"\D", "", s[len(head) :])
    if not 7 <= len(digits) <= 14:
        return None
    return head + _filled(s[len(head) :], string(digits, key, "phone" + head, back))


#: English month names, in full and with three letters.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MONTH = re.compile(r"[A-Za-z]{3,9}")


@lru_cache
def _days() -> dict[tuple, list[int]]:
    """The days of 1900 to 2099 by how they are written: digits of the month and of the day, whether a day can be taken for a
    month, and May, whose name is its short form too. A day is permuted within its class, so every notation of it
    keeps its length and has the same pseudonym."""
    out: dict[tuple, list[int]] = {}
    for n in range(FIRST_DAY, LAST_DAY + 1):
        out.setdefault(_day_class(datetime.date.fromordinal(n)), []).append(n)
    return out


def _day_class(d: datetime.date) -> tuple:
    return d.month == 5, d.month > 9, d.day > 9, d.day > 12


def _day(y: str, m: str, d: str, key: bytes, back: bool) -> datetime.date | None:
    try:
        day = datetime.date(int(y), int(m), int(d))
    except ValueError:
        return None
    if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
        return None
    kind = _day_class(day)
    days = _days()[kind]
    return datetime.date.fromordinal(days[permuted(bisect_left(days, day.toordinal()), len(days), key, f"date{kind}", back)])


def _date(s: str, key: bytes, back: bool) -> str | None:
    """A valid day of 1900 to 2099 becomes another one in the same notation: year first; else day first, or month
    first where day first is no date."""
    a, sep, b, _, c = re.split(r"([-/.])", s)
    if len(a) == 4:
        new = _day(a, b, c, key, back)
        return new and sep.join((f"{new.year}", f"{new.month}".zfill(len(b)), f"{new.day}".zfill(len(c))))
    if new := _day(c, b, a, key, back):
        return sep.join((f"{new.day}".zfill(len(a)), f"{new.month}".zfill(len(b)), f"{new.year}"))
    if new := _day(c, a, b, key, back):
        return sep.join((f"{new.month}".zfill(len(a)), f"{new.day}".zfill(len(b)), f"{new.year}"))
    return None


def _named_date(s: str, key: bytes, back: bool) -> str | None:
    """'Feb 29, 2024', '29 February 2024', 'March 1st, 2024': names keep their form and case, ordinals follow the day."""
    word = _MONTH.search(s)[0]
    month = next((k for k, m in enumerate(MONTHS, 1) if word.lower() in (m, m[:3])), None)
    day, year = re.search(r"(?<!\d)\d{1,2}(?!\d)", s), re.search(r"\d{4}", s)
    new = _day(year[0], str(month), day[0], key, back) if month else None
    if new is None:
        return None
    name = MONTHS[new.month - 1][: 3 if len(word) == 3 else None]
    name = name.upper() if word.isupper() else name.title() if word[0].isupper() else name
    end = "th" if 11 <= new.day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
    out = re.sub(r"(?<!\d)\d{1,2}(?!\d)(st|nd|rd|th)?", lambda m: f"{new.day}".zfill(len(day[0])) + (end if m[1] else ""), s, count=1)
    return re.sub(r"\d{4}", f"{new.year}", out).replace(word, name, 1)


def _email(s: str, key: bytes, back: bool) -> str:
    name, host = s.rsplit("@", 1)
    first, dot, rest = host.partition(".")
    new = string(f"{name}@{first}", key, "email", back)
    return f"{new}{dot}{rest}"


def _secret(s: str, key: bytes, back: bool) -> str:
    if set(s) <= set(HEX):
        return _radix(s, [HEX] * len(s), key, "hex", back)
    return string(s, key, "secret", back)


#: Letters and digits of an IBAN by country.
IBAN_LENGTHS = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
#: The groups in which cards are written, fewest digits first. One group of 13 to 19 digits is a card too.
CARD_GROUPS = ((4, 4, 4, 1), (4, 6, 4), (4, 4, 4, 2), (4, 4, 4, 3), (4, 6, 5), (4, 4, 4, 4), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3))
_CALLING_CODE = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})")
#: Most digits with the country code: of numbering plans of one length, else of E.164.
PHONE_DIGITS = {"+1": 11, "+7": 11, "+31": 11, "+33": 11, "+34": 11, "+41": 11, "+44": 12, "+45": 10, "+46": 11, "+47": 10, "+48": 11, "+61": 11, "+86": 13, "+91": 12, "+351": 12, "+420": 12}

_NAMES = "|".join(dict.fromkeys(x for m in MONTHS for x in (m, m[:3])))
#: In the order in which they are tried at a place of the text.
FORMATS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", _email),
    "secret": (r"\b(?:[0-9a-f]{32,128}|(?:AKIA|ASIA)[A-Z0-9]{16}|(?:sk|pk|ghp|gho|xox[bp])[-_][A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_.-]{10,})\b", _secret),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    "ip": (r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)", _ip),
    "date": (r"(?<![\d/.-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d/-]|\.\d)", _date),
    "date+": (rf"(?i)\b(?:(?:{_NAMES})\.? \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}|\d{{1,2}}(?:st|nd|rd|th)? (?:{_NAMES}),? \d{{4}})\b(?!-\d)", _named_date),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "phone+": (r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,14}(?:[ .-]\d{2,14}){0,5}(?![\w-])", _phone),
    "card": (r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])", _card),
    "phone": (r"(?<![\w+])(?:\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])", _phone),
}
_PATTERNS = [(kind.rstrip("+"), re.compile(p), f) for kind, (p, f) in FORMATS.items()]
_ANY_DIGIT_OR_AT = re.compile(r"[0-9@]")
#: Groups that stand side by side; the numbers in them are looked for from group to group.
_RUNS = {"iban": re.compile(r"\b[A-Z0-9]+(?: [A-Z0-9]+)*\b"), "card": re.compile(r"\d+(?:[ -]\d+)*")}
_GROUP = re.compile(r"[A-Z0-9]+")


def _card_end(groups: list[str], i: int) -> int | None:
    """Where a card that starts with group i ends."""
    n = len(groups[i])
    if n != 4:
        return i + 1 if 13 <= n <= 19 and _is_card(groups[i]) else None
    sizes = tuple(len(g) for g in groups[i : i + 5])
    return next((i + len(c) for c in CARD_GROUPS if sizes[: len(c)] == c and _is_card("".join(groups[i : i + len(c)]))), None)


def _iban_end(groups: list[str], i: int) -> int | None:
    """Where an IBAN that starts with group i ends: at its country's length."""
    if not re.match(r"[A-Z]{2}\d{2}", groups[i]):
        return None
    length, n = IBAN_LENGTHS.get(groups[i][:2], 0), 0
    for j in range(i, len(groups)):
        n += len(groups[j])
        if n >= length:
            return j + 1 if n == length and mod97("".join(groups[i : j + 1])) == 1 else None
    return None


_ENDS = {"iban": (_iban_end, _iban, 9), "card": (_card_end, _card, 4)}


def _in_runs(kind: str, text: str, taken: bytearray, key: bytes, back: bool) -> Iterator[tuple[int, int, str]]:
    """Numbers in groups beside other groups: the first that validates from each group on.

    A pseudonym that would validate together with the groups before it, and so couldn't be found again, is permuted once more.
    """
    end_of, change, reach = _ENDS[kind]
    for run in _RUNS[kind].finditer(text):
        if run.end() - run.start() < 13:
            continue
        spans = [(run.start() + g.start(), run.start() + g.end()) for g in _GROUP.finditer(run[0])]
        if kind == "card":  # no part of a word with a hyphen
            spans = spans[text[run.start() - 1 : run.start()] == "-" : len(spans) - (text[run.end() : run.end() + 1] == "-")]
        parts: list[list[tuple[int, int]]] = [[]]
        for s, e in spans:
            if any(taken[s:e]):
                parts.append([])
            else:
                parts[-1].append((s, e))
        for part in parts:
            groups, i, done = [text[s:e] for s, e in part], 0, 0
            while i < len(groups):
                j = end_of(groups, i)
                if j is None:
                    i += 1
                    continue
                first, new = max(done, i - reach), text[part[i][0] : part[j - 1][1]]
                while True:
                    new = change(new, key, back)
                    now = groups[first:i] + _GROUP.findall(new) + groups[j : j + reach]
                    if all(end_of(now, k) is None for k in range(i - first)) and end_of(now, i - first) == j - first:
                        break
                yield part[i][0], part[j - 1][1], new
                i = done = j


def _whole_card(m: re.Match, text: str, taken: bytearray, key: bytes, back: bool) -> str | None:
    """A card in groups of other sizes. As above, its pseudonym must not hold a card in the usual groups."""
    new, s, e = m[0], m.start(), m.end()
    while (new := _card(new, key, back)) is not None:
        before, after = max(0, s - 40), e + 40
        shown = "".join("." if t else c for c, t in zip(text[before:s], taken[before:s], strict=True)) + new
        shown += "".join("." if t else c for c, t in zip(text[e:after], taken[e:after], strict=True))
        if all(_card_end(g, k) is None for r in _RUNS["card"].finditer(shown) for g in [_GROUP.findall(r[0])] for k in range(len(g))):
            return new
    return None


def _phone_cut(s: str) -> str:
    """Without the groups at the end that a number of its country has no room for. Empty: a card after a plus sign."""
    if s[0] != "+":
        return s
    groups = _GROUP.findall(s)
    if len(s) > 16 and (end := _card_end(groups, 0)) and sum(map(len, groups[:end])) > 15:
        return ""
    lead = re.match(r"\+\d{1,3}(?=[ (.-])", s) or _CALLING_CODE.match(s)
    if long := re.match(r"\+.*?\d{6}\d*(?= )", s):  # so long a group is the last one of its number
        s = long[0]
    most = PHONE_DIGITS.get(lead[0] if lead else "", 15)
    while len(re.sub(r"\D", "", s)) > most and (cut := re.search(r"[ .-]\d+$", s)):
        s = s[: cut.start()]
    return s


def _found(kind: str, pattern: re.Pattern, change, text: str, taken: bytearray, key: bytes, back: bool) -> Iterator[tuple[int, int, str]]:
    if kind in _ENDS:
        yield from _in_runs(kind, text, taken, key, back)
    if kind == "iban":
        return
    for m in pattern.finditer(text):
        value = _phone_cut(m[0]) if kind == "phone" else m[0]
        if value and not any(taken[m.start() : m.start() + len(value)]):
            new = _whole_card(m, text, taken, key, back) if kind == "card" else change(value, key, back)
            if new is not None:
                yield m.start(), m.start() + len(value), new


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every validated value permuted, and how many of each kind. With `back`, the inverse."""
    counts: dict[str, int] = {}
    if not _ANY_DIGIT_OR_AT.search(text):
        return text, counts
    values, taken = [], bytearray(len(text))
    for kind, pattern, change in _PATTERNS:
        for s, e, new in _found(kind, pattern, change, text, taken, key, back):
            values.append((s, e, kind, new))
            taken[s:e] = b"\1" * (e - s)
    out, at = [], 0
    for s, e, kind, new in sorted(values):
        out += [text[at:s], new]
        at = e
        counts[kind] = counts.get(kind, 0) + 1
    return "".join([*out, text[at:]]), counts


def _mapper(key: bytes, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [(None, {}) if t is None else pseudonymise(t, key, back) for t in b.column("_text").to_pylist()]
            texts = pa.array([d[0] for d in done], pa.string())
            cols = {n: b.column(n) for n in b.schema.names if n != "_text"}
            yield pa.RecordBatch.from_pydict(cols | {"_new": texts, "_found": pa.array([sum(d[1].values()) for d in done], pa.int64()), "_kinds": pa.array([",".join(f"{k}:{n}" for k, n in sorted(d[1].items())) for d in done], pa.string())})

    return run


def pseudonymise_table(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(id, text, n_replaced, kinds): whole texts with pseudonyms of the same format.

    Numbers are validated first (Luhn and issuer, mod 97, octets, calendar, number ranges); those that fail stay, as they
    are no such values. A day or a phone number has the same pseudonym in each of its notations (day first is assumed where month first
    is possible too; a country code is part of the number). A card or IBAN is found beside other numbers and words too: a card in one group or in the groups of
    CARD_GROUPS, an IBAN at its country's length. Check digits are computed anew, so a pseudonym validates like its original,
    and the same value has the same pseudonym in every document under the same key, unless that would validate
    together with a number before it. With `back` and the key the mapping is
    undone. A null text stays null with 0 replaced; ids pass through untouched, null or repeated.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    out = rows.mapInArrow(_mapper(hashlib.sha256(key.encode()).digest(), back), f"_id {kind}, _new string, _found long, _kinds string")
    return out.select(F.col("_id").alias(id_col), F.col("_new").alias(text_col), F.col("_found").alias("n_replaced"), F.col("_kinds").alias("kinds"))
