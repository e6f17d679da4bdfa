"""URL filters by a temporal list join (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, small


def intervals(entries: DataFrame) -> DataFrame:
    """Dated list entries (list, kind, key, action, at) to validity intervals (list, kind, key, start, end).

    An entry is active from an 'add' to the next 'remove' of the same list, kind and key; end null: still active.
    Repeated adds extend the interval that is open, a remove without an add does nothing, and of several
    events at the same time a remove counts last. Rows with a null in any of the five columns are ignored.
    """
    known = entries.select("list", "kind", F.lower("key").alias("key"), "action", "at").dropna().distinct()
    w = Window.partitionBy("list", "kind", "key").orderBy("at", "action")
    changes = known.withColumn("before", F.lag("action").over(w)).filter("not (before <=> action)")
    ends = changes.withColumn("end", F.lead("at").over(w))
    return ends.filter("action = 'add' and (end is null or end > at)").select("list", "kind", "key", F.col("at").alias("start"), "end")


def url_parts(captures: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds _host (lower case, no port, user or trailing dot) and _path (from the first slash, no query or fragment)."""
    rest = F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", 1)
    host = F.rtrim(F.regexp_replace(F.regexp_replace(F.lower(rest), r"^.*@", ""), r":\d*$", ""), F.lit("."))
    path = F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", 2)
    return captures.withColumns({"_host": host, "_path": F.when(path == "", "/").otherwise(path)})


def filter_urls(ws: Workspace, captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """(id, url, time, blocked, lists, n_entries) for every capture, by the entries active at its fetch time.

    An entry of kind 'domain' matches a host and all its subdomains; 'prefix' matches host and path up to a path
    segment ('example.com/a' matches /a and /a/b, not /ab). Keys, hosts and paths are compared in lower case. A capture asks
    with those suffixes of its host and prefixes of its path that are as deep as some key of the list; an equality join
    finds the keys and the interval decides as of the fetch time (start <= time < end). Lists are the sorted names of the
    lists that block it.

    A null or unparsable URL, or a null time, matches nothing: blocked false. Rows that share an id are
    evaluated alike and each returned: equal rows count as one question. Extra columns of captures are dropped.
    """
    asked = url_parts(captures, url_col).select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(time_col).alias("_at"), "_host", "_path")
    valid = ws.put("intervals", intervals(entries))
    # only keys as deep as some key of the list are asked, so that no capture asks for 'com' if the list has no such entry
    depth = F.size(F.split("key", F.when(F.col("kind") == "domain", F.lit(r"\.")).otherwise(F.lit("/"))))
    depths: dict[str, list[int]] = {"domain": [], "prefix": []}
    for r in valid.select("kind", depth.alias("depth")).distinct().collect():  # one row for each kind and depth
        depths.setdefault(r["kind"], []).append(r["depth"])
    labels, steps = F.split("_host", r"\."), F.split("_path", "/")
    last = lambda parts, n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
    first = lambda parts, n: F.lower(F.concat("_host", F.array_join(F.slice(parts, 1, n), "/")))
    keys = [F.when(F.size(labels) >= n, F.struct(F.lit("domain").alias("kind"), last(labels, n).alias("key"))) for n in sorted(depths["domain"])]
    keys += [F.when(F.size(steps) >= n, F.struct(F.lit("prefix").alias("kind"), first(steps, n).alias("key"))) for n in sorted(depths["prefix"])]
    nothing = F.lit(None).cast("struct<kind:string,key:string>")
    questions = asked.filter("_host <> '' and _at is not null").select("_id", "_url", "_at", F.inline(F.array(*keys, nothing))).filter("key is not null")
    hits = questions.join(small(valid), ["kind", "key"]).filter((F.col("_at") >= F.col("start")) & (F.col("end").isNull() | (F.col("_at") < F.col("end"))))
    found = hits.groupBy("_id", "_url", "_at").agg(F.array_join(F.array_sort(F.collect_set("list")), ",").alias("_lists"), F.count_distinct("list", "kind", "key", "start").alias("_n"))
    right = found.select(F.col("_id").alias("_i"), F.col("_url").alias("_u"), F.col("_at").alias("_t"), "_lists", "_n")
    out = asked.join(right.hint("merge"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_url") == F.col("_u")) & (F.col("_at") == F.col("_t")), "left")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_at").alias(time_col), F.col("_n").isNotNull().alias("blocked"), F.coalesce("_lists", F.lit("")).alias("lists"), F.coalesce("_n", F.lit(0)).cast("long").alias("n_entries"))


#: list, kind, key, action, date: the query's list
ENTRIES = [
    ("spam", "domain", "spam-farm.example.org", "add", "2024-01-10"),
    ("spam", "domain", "spam-farm.example.org", "remove", "2024-05-01"),
    ("spam", "domain", "spam-farm.example.org", "add", "2024-08-01"),
    ("spam", "domain", "cheap-pills.example.com", "add", "2024-03-15"),
    ("pharma", "domain", "www.cheap-pills.example.com", "add", "2024-01-01"),
    ("pharma", "domain", "www.cheap-pills.example.com", "remove", "2024-06-30"),
    ("legal", "domain", "ththth.example.net", "add", "2024-02-01"),
    ("legal", "domain", "ththth.example.net", "remove", "2024-02-20"),
    ("legal", "prefix", "blog.ththan.example.net/en", "add", "2024-04-01"),
    ("legal", "prefix", "tionsh.example.net/de", "add", "2024-07-01"),
    ("legal", "prefix", "tionsh.example.net/de", "remove", "2024-09-01"),
    ("legal", "prefix", "therin.example.net/en/77", "add", "2024-01-01"),
]


def entries_table(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(ENTRIES, "list string, kind string, key string, action string, at string")
    return rows.withColumn("at", F.to_timestamp_ntz("at"))


def with_fetch_time(pages: DataFrame) -> DataFrame:
    """pages have no fetch time; one day of 2024 for each page, from its id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.pmod(F.col("page_id") * 37, F.lit(366))).cast("int"))
    return pages.withColumn("fetched_at", day.cast("timestamp_ntz"))


ORACLE = (
    "with e(list, kind, key, action, ts) as (values "
    + ", ".join(f"('{a}', '{b}', '{c}', '{d}', timestamp '{t} 00:00:00')" for a, b, c, d, t in ENTRIES)
    + r"""),
ch as (select * from (select *, lag(action) over (partition by list, kind, key order by ts, action) b from e) where b is distinct from action),
nx as (select *, lead(ts) over (partition by list, kind, key order by ts, action) stop from ch),
iv as (select list, kind, key, ts as start, stop from nx where action = 'add'),
p as (select page_id, url, (date '2024-01-01' + ((page_id * 37) % 366)::int)::timestamp fetched_at,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) host,
             regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) path from pages),
h as (select p.*, iv.list, iv.key, iv.start from p join iv on p.fetched_at >= iv.start and (iv.stop is null or p.fetched_at < iv.stop)
      and case when kind = 'domain' then host = key or ends_with(host, '.' || key)
               else lower(host || path) = key or starts_with(lower(host || path), key || '/') end),
g as (select page_id, url, fetched_at, string_agg(distinct list, ',' order by list) lists, count(distinct list || ' ' || key || ' ' || start) n from h group by all)
select p.page_id, p.url, p.fetched_at, n is not null as blocked, coalesce(lists, '') lists, coalesce(n, 0)::bigint n_entries
from p left join g using (page_id, url, fetched_at)
"""
)
