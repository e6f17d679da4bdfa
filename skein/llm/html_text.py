"""HTML extraction by nearest-URL page differencing.

Two pages of a host whose URLs lie close to each other share their template, not their article. Lines that recur on near
pages mark blocks of the template; markup rules cover what recurs nowhere.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, running, small
from .url_lists import url_parts

#: Fixed word lists of HTML: element kinds, and the names that sites give to what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea|template|iframe|svg|canvas|audio|video"
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr caption ul".split())
TEXTUAL = frozenset("address blockquote caption center dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend li p pre summary tbody tfoot thead tr".split())
CHROME = frozenset("nav aside footer form head menu dialog search button select datalist fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
_KEY = "ad|ads|advert|adverts|advertisement|adsense|sponsor|sponsored|sponsors|promo|promos|promotion|banner|banners|sidebar|sidebars|menu|menus|nav|navbar|navigation|breadcrumb|breadcrumbs|footer|masthead|toolbar|pagination|pager|cookie|cookies|consent|gdpr|notice|notices|alert|alerts|popup|popups|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|recommendations|comment|comments|disqus|reply|replies|respond|skip|skip-link|teaser|teasers|outbrain|taboola"
_BEFORE = "site|page|main|top|bottom|global|left|right|primary|secondary|reader|readers|user|post|article|social|cookie|related|ad|ads|sub|mobile|desktop|sticky|inline|google|dfp|js|wp"
_AFTER = "bar|box|list|area|section|container|wrapper|wrap|block|slot|unit|widget|links|link|inner|content|banner|notice|form|thread|panel|text|item|items|body|menu|posts|articles|buttons|\\d+"
BOILERPLATE = re.compile(rf"(?:(?:{_BEFORE})[-_]+)*(?:{_KEY})(?:[-_]+(?:{_AFTER}))*", re.I)
HEADER = re.compile(r"(?:(?:site|page|main|top|global)[-_]+)*header(?:[-_]+(?:bar|wrapper|container|inner))*", re.I)
BODY = re.compile(r"(?:article|post|entry|story)[-_]*(?:body|content|text)", re.I)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
DROPPED, OPEN, MAIN, BODIED, ARTICLE = range(5)

#: Every page is compared with so many pages before and after it in the URL order of its host.
NEAR = 16
#: A block of a host is part of its template if more than this share of its lines, of at least LINES, recur on near pages.
RECURRING, LINES = 0.2, 8
#: Pages vote if they share less than VOTE of the shorter one's text; COPY and more makes them near copies.
VOTE, COPY = 0.5, 0.8
#: Pages are compared in groups of so many; a group also holds the NEAR pages beyond each of its ends.
GROUP = 1024
#: Two pages are aligned in blocks of at least so many lines.
STEP = 256


def _kind(tag: str, attrs: str, inside: int) -> int:
    """What an element makes of its text; `inside` is what its parent makes of it."""
    if inside == DROPPED or tag in CHROME or (tag == "header" and inside < MAIN):
        return DROPPED
    if attrs.strip() and tag not in ("html", "body"):
        a = {k.lower(): x or y or z for k, x, y, z in ATTR.findall(attrs)}
        names = [*a.get("class", "").split(), a.get("id", "")]
        if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
            return DROPPED
        if any(BOILERPLATE.fullmatch(n) or (inside < MAIN and HEADER.fullmatch(n)) for n in names if n) and tag not in ("main", "article") or tag == "article" and any(re.fullmatch("(?:.*[-_])?(?:comment|teaser|related|promo|ad)", n, re.I) for n in names):
            return DROPPED
        if a.get("itemprop", "").lower() == "articlebody" or any(BODY.fullmatch(n) for n in names):
            return max(inside, BODIED)
        if a.get("role", "").lower() == "main":
            return max(inside, MAIN)
    return max(inside, ARTICLE if tag == "article" else MAIN if tag == "main" else inside)


def _block(tag: str, attrs: str, parent: int) -> int:
    """A number for the place of a block in its page: tags and classes from the root, digits left out. Headings, paragraphs
    and list items are no blocks of their own, so an article's heading and text are judged together."""
    if tag in TEXTUAL or tag not in BLOCKS:
        return parent
    classes = ""
    if "class" in attrs.lower():
        a = {k.lower(): x or y or z for k, x, y, z in ATTR.findall(attrs)}
        classes = " ".join(sorted(set(re.sub(r"\d+", "#", a.get("class", "")).lower().split())))
    return xxhash.xxh64_intdigest(f"{parent}>{tag}.{classes}") - 2**63


def page_lines(source: str, hints: bool = True) -> list[tuple[str, int, int]]:
    """Every visible text block of a page in order: its text, what structure says of it (dropped, open, main, article
    body or article) and the number of its block. Without hints structure says nothing.

    A heading of the first order that stands before an article body belongs to it.
    """
    lines: list[tuple[str, int, int]] = []
    stack: list[tuple[str, int, int]] = []
    buffers: dict[int, tuple[list[str], int]] = {}
    state, place, title = OPEN, 0, None

    def add(text: str) -> None:
        if state not in buffers:
            buffers[state] = ([], place)
        buffers[state][0].append(text)

    def flush() -> None:
        nonlocal title
        for kind, (parts, at) in buffers.items():
            if text := " ".join("".join(parts).split()):
                if kind == BODIED and title is not None:
                    lines[title] = (lines[title][0], BODIED, lines[title][2])
                    title = None
                if kind in (OPEN, MAIN) and any(x[0] == "h1" for x in stack):
                    title = len(lines)
                lines.append((text, kind, at))
        buffers.clear()

    def pop(tag: str, within: tuple) -> None:
        """Closes the nearest open `tag`, if none of `within` lies between."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at = 0
    for m in TOKEN.finditer(source):
        if m.start() > at:
            add(html.unescape(source[at : m.start()]))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            add(" ")
        if m["end"]:
            pop(tag, ("article", "main", "body") if tag not in ("article", "main", "body", "html") else ())
        elif tag not in VOID:
            if tag in ("body", "article", "main"):
                # an unclosed head, paragraph or list doesn't reach into them
                while stack and stack[-1][0] in ("head", "p", "li", "ul", "b", "i", "span", "a"):
                    stack.pop()
            elif tag in BLOCKS:
                pop("li" if tag == "li" else "p", ("ul", "ol", "menu") if tag == "li" else ("div", "section", "li", "blockquote", "aside", "nav", "header", "footer", "form", "table", "td", "button", "article", "main", "body"))
            if not m["attrs"].endswith("/") or tag in BLOCKS:
                kind = (_kind(tag, m["attrs"], stack[-1][1] if stack else OPEN)) if hints else DROPPED if tag == "head" else stack[-1][1] if stack else OPEN
                block = stack[-1][2] if stack else 0
                stack.append((tag, kind, _block(tag, m["attrs"], block)))
        state, place = stack[-1][1:] if stack else (OPEN, 0)
    if at < len(source):
        add(html.unescape(source[at:]))
    flush()
    return lines


def common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence of a and b as pairs of positions, by one method at any size.

    A row of bits for each line of a says where in b the length grows (bit-parallel, Hyyrö), so lines that repeat cost no
    more than others. The pairs are read from the last row backwards: of all longest chains the one whose positions in b
    are least, and for those the last in a. Only every STEP-th row is kept; the others are made again from it.
    """
    found = set(a)
    cols = [j for j, x in enumerate(b) if x in found]
    where: dict = {}
    for k, j in enumerate(cols):
        where.setdefault(b[j], []).append(k)
    rows = [i for i, x in enumerate(a) if x in where]
    if not rows:
        return []
    full = (1 << len(cols)) - 1
    # a line that repeats little costs less to make than its mask costs to keep
    masks = {x: sum(1 << k for k in ks) for x, ks in where.items() if len(ks) > 32}
    step = max(STEP, isqrt(len(rows)))

    def block(start: int, v: int) -> tuple[list[int], int]:
        """The rows before each of the next `step` lines, and the row after them; a zero is where the length grows."""
        out = []
        for i in rows[start : start + step]:
            out.append(v)
            x = a[i]
            u = v & (masks.get(x) or sum(1 << k for k in where[x]))
            v = ((v + u) | (v - u)) & full
        return out, v

    starts, before, v = [], [], full
    for start in range(0, len(rows), step):
        starts.append(v)
        before, v = block(start, v)
    pairs = []
    k = (full & ~v).bit_length() - 1
    for n in range(len(starts) - 1, -1, -1):
        if n < len(starts) - 1:
            before = block(n * step, starts[n])[0]
        for r in range(len(before) - 1, -1, -1):
            i = rows[n * step + r]
            if a[i] == b[cols[k]]:
                pairs.append((i, cols[k]))
                k = (~before[r] & ((1 << k) - 1)).bit_length() - 1
                if k < 0:
                    return pairs[::-1]
    return pairs[::-1]


LINES_SCHEMA = "_url string, _host string, _path string, _key binary, _texts array<string>, _hashes array<bigint>, _sizes array<int>, _blocks array<bigint>, _best int"


def _parsed(hints: bool):
    """Each page once: its lines as hashes, sizes and blocks, and the texts of those that markup allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("_key", "_texts", "_hashes", "_sizes", "_blocks", "_best")}
            for i, url, source in zip(*(b.column(n).to_pylist() for n in ("_id", "_url", "_html")), strict=True):
                lines = page_lines(source or "", hints)
                best = max((k for _, k, _ in lines), default=OPEN)
                out["_key"].append(xxhash.xxh3_128_digest(repr((i, url, source)).encode("utf-8", "surrogatepass")))
                out["_texts"].append([t if k == best and k != DROPPED else None for t, k, _ in lines])
                out["_hashes"].append([xxhash.xxh64_intdigest(t) - 2**63 for t, _, _ in lines])
                out["_sizes"].append([len(t) for t, _, _ in lines])
                out["_blocks"].append([p for _, _, p in lines])
                out["_best"].append(best)
            kinds = {"_key": pa.binary(), "_texts": pa.list_(pa.string()), "_hashes": pa.list_(pa.int64()), "_sizes": pa.list_(pa.int32()), "_blocks": pa.list_(pa.int64()), "_best": pa.int32()}
            names = ["_id", "_url", "_host", "_path"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *(pa.array(out[n], t) for n, t in kinds.items())], [*names, *kinds])

    return run


def _compared(group: pa.Table) -> pa.Table:
    """Near pages of one group: how often each block's lines recur, and the recurring lines of pages without article.

    Two pages that share half of the text of one of them have no vote: they may be copies, whose shared lines say nothing
    about templates. From 0.8 on, where texts count as near duplicates, nothing is cut for such a pair either.
    """
    rows = sorted(group.to_pylist(), key=lambda r: r["_pos"])
    hits: list[set[int]] = [set() for _ in rows]
    cut: list[set[int]] = [set() for _ in rows]
    seen = [False] * len(rows)
    lines = [set(r["_hashes"]) for r in rows]
    whole = [sum(r["_sizes"]) for r in rows]
    for i, r in enumerate(rows):
        for j in range(i + 1, len(rows)):
            s = rows[j]
            if s["_pos"] - r["_pos"] > NEAR or s["_host"] != r["_host"]:
                break
            if not r["_own"] and not s["_own"]:
                continue
            pairs = [] if lines[i].isdisjoint(lines[j]) else common(r["_hashes"], s["_hashes"])
            share = sum(r["_sizes"][x] for x, _ in pairs) / max(1, min(whole[i], whole[j]))
            if share < COPY:
                cut[i].update(x for x, _ in pairs)
                cut[j].update(y for _, y in pairs)
            if share < VOTE:
                seen[i] = seen[j] = True
                hits[i].update(x for x, _ in pairs)
                hits[j].update(y for _, y in pairs)
    votes: dict[tuple[str, int], list[int]] = {}
    cuts = []
    for r, hit, gone, was in zip(rows, hits, cut, seen, strict=True):
        if r["_own"] and was:
            for k, block in enumerate(r["_blocks"]):
                v = votes.setdefault((r["_host"], block), [0, 0])
                v[0] += 1
                v[1] += k in hit
        if r["_own"] and gone and r["_best"] < BODIED:
            cuts.append((r["_key"], sorted(gone)))
    n, m = len(votes), len(cuts)
    return pa.table({
        "_host": pa.array([h for h, _ in votes] + [None] * m, pa.string()), "_block": pa.array([b for _, b in votes] + [None] * m, pa.int64()),
        "_n": pa.array([v[0] for v in votes.values()] + [None] * m, pa.int64()), "_again": pa.array([v[1] for v in votes.values()] + [None] * m, pa.int64()),
        "_key": pa.array([None] * n + [k for k, _ in cuts], pa.binary()), "_cut": pa.array([None] * n + [c for _, c in cuts], pa.list_(pa.int32())),
    })


def chosen(texts: list[str | None], blocks: list[int], template: set[int], steady: set[int], cut: set[int]) -> tuple[list[str], int]:
    """The lines of a page that stay, and how many differencing removes.

    Of template blocks every line goes, a line that recurs nowhere too, as long as at least half of the text that markup
    allows is left; else only the lines that recur themselves go, but for those of steady blocks, and if that leaves
    nothing, none.
    """
    size = sum(len(t) for t in texts if t is not None)
    gone = {k for k, b in enumerate(blocks) if b in template}
    kept = [t for k, t in enumerate(texts) if t is not None and k not in gone]
    if 2 * sum(map(len, kept)) < size or not gone:
        gone = {k for k in cut if blocks[k] not in steady}
        kept = [t for k, t in enumerate(texts) if t is not None and k not in gone]
        if not kept:
            return [t for t in texts if t is not None], 0
    return kept, len(gone)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, lines, cut_lines = [], [], []
        for own, blocks, *known in zip(*(b.column(n).to_pylist() for n in ("_texts", "_blocks", "_template", "_steady", "_cut")), strict=True):
            kept, gone = chosen(own, blocks, *(set(x or ()) for x in known))
            texts.append("\n".join(kept))
            lines.append(len(own))
            cut_lines.append(gone)
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(lines, pa.int64()), pa.array(cut_lines, pa.int64())], ["_id", "_url", "_text", "_n", "_lines", "_gone"])


def parsed_lines(ws: Workspace, pages: DataFrame, id_col: str, url_col: str, html_col: str, hints: bool = True) -> DataFrame:
    """The lines of every page, written: the only time that HTML is read."""
    source = url_parts(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")), "_url")
    kind = source.schema["_id"].dataType.simpleString()
    return ws.put("lines", source.select("_id", "_url", "_host", "_path", "_html").mapInArrow(_parsed(hints), f"_id {kind}, {LINES_SCHEMA}"))


def differences(ws: Workspace, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_site, _template, _steady): the blocks of each host whose lines recur, and those whose lines don't;
    (_page, _cut): recurring lines of pages without article markup.

    Hashes, sizes and URLs move, no texts. Pages are ranked by (host, path, key), which splits a hot host by range, and
    compared in groups of GROUP in that order; the NEAR pages on both sides of a border belong to both groups.
    """
    narrow = lines.filter("_host <> ''").select("_host", "_path", "_key", "_hashes", "_sizes", "_blocks", "_best").dropDuplicates(["_key"])
    ranked = running(ws, "order", narrow.withColumn("_all", F.lit(0)), "_all", ["_host", "_path", "_key"], F.lit(1))
    ranked = ranked.withColumns({"_pos": F.col("before"), "_home": F.floor(F.col("before") / GROUP).cast("long")})
    at = F.pmod("_pos", F.lit(GROUP))
    beside = F.array_compact(F.array(F.col("_home"), F.when((at < NEAR) & (F.col("_home") > 0), F.col("_home") - 1), F.when(at >= GROUP - NEAR, F.col("_home") + 1)))
    dealt = ranked.withColumn("_group", F.explode(beside)).withColumn("_own", F.col("_group") == F.col("_home"))
    dealt = dealt.select("_group", "_own", "_pos", "_host", "_key", "_hashes", "_sizes", "_blocks", "_best")
    seen = ws.put("seen", dealt.groupBy("_group").applyInArrow(_compared, "_host string, _block long, _n long, _again long, _key binary, _cut array<int>"))
    ws.drop("order")
    votes = seen.filter("_host is not null").groupBy("_host", "_block").agg(F.sum("_n").alias("_n"), F.sum("_again").alias("_again"))
    recurs = F.col("_again") >= RECURRING * F.col("_n") + 1
    blocks = {name: F.sort_array(F.collect_list(F.when(rule, F.col("_block")))).alias(name) for name, rule in (("_template", recurs), ("_steady", ~recurs))}
    templates = ws.put("templates", votes.filter(F.col("_n") >= LINES).groupBy(F.col("_host").alias("_site")).agg(*blocks.values()))
    return templates, seen.filter("_key is not null").select(F.col("_key").alias("_page"), "_cut")


def main_text(ws: Workspace, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", hints: bool = True) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines, n_differenced): the main text of every page, from its whole HTML.

    1. Each page is parsed once, into lines with the block that they stand in.
    2. Each page is paired with the NEAR pages before and after it in the URL order of its host, and the two pages' lines
       are aligned by longest common subsequence. Near copies don't count.
    3. Shared lines vote for their block. A block of a host of which a fifth of the lines recur is part of the template:
       all its lines are deleted, those that recur nowhere too (an advert that was shown once). Where
       that would take more than half of the text (article and boilerplate in blocks of the same kind), only the shared
       lines are deleted. A block whose lines hardly ever recur is an article's: a sentence that two articles
       have in common stays, as the main text is the whole article.
    4. Markup rules remove what differencing can't see, on hosts with few pages above all: navigation, header, footer, form,
       advert, comments; and if a page marks an article, its text is taken from there. `hints` False: no such rules.

    n_lines counts a page's lines, n_differenced those that differencing deletes. Null or empty HTML: empty text. Null or
    unparsable URL, or the only page of a host: markup decides. Null ids are pages like others. Equal rows are one page for pairing, and each is
    returned; rows that share an id but not the rest are pages of their own. Other columns are ignored.
    """
    lines = parsed_lines(ws, pages, id_col, url_col, html_col, hints)
    templates, cuts = differences(ws, lines)
    kind = lines.schema["_id"].dataType.simpleString()
    sited = lines.join(small(templates, F.octet_length("_site") + (F.size("_template") + F.size("_steady")) * 8 + 64), F.col("_host") == F.col("_site"), "left")
    columns = ["_id", "_url", "_texts", "_blocks", "_template", "_steady"]
    marked = sited.filter(F.col("_best") >= BODIED).select(*columns, F.lit(None).cast("array<int>").alias("_cut"))
    bare = sited.filter(F.col("_best") < BODIED).join(small(cuts, F.size("_cut") * 4 + 64), F.col("_key") == F.col("_page"), "left").select(*columns, "_cut")
    out = marked.unionByName(bare).mapInArrow(_joined, f"_id {kind}, _url string, _text string, _n long, _lines long, _gone long")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_text").alias("text"), F.col("_n").alias("n_chars"), F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_differenced"))
