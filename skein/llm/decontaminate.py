"""Benchmark decontamination by size-partitioned MinHash containment search (DataFrame functions only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, fresh, small, words

SHINGLE, PERCENT = 5, 80


def spread(df: DataFrame, keys: list, longest: int) -> DataFrame:
    """(keys, w0, w1, ...): every word of the array _w with those that follow it; null beyond the end.

    Neighbouring words stand side by side in generated code, without a lambda for each position. inline_outer: for a
    plain inline Spark would push a filter on its size below, and tokenise the text for each word.
    """
    side = F.arrays_zip(*[F.slice("_w", j + 1, F.greatest(F.size("_w"), F.lit(1))).alias(f"w{j}") for j in range(longest)])
    return df.select(*keys, F.inline_outer(side).alias(*[f"w{j}" for j in range(longest)]))


def _hash(k: int) -> Column:
    return F.xxhash64(*[f"w{j}" for j in range(k)])


def _text(k: int) -> Column:
    return F.concat_ws(" ", *[f"w{j}" for j in range(k)])


def _full(k: int) -> Column:
    return F.col(f"w{k - 1}").isNotNull()


def _by_length(make, lengths: range) -> Column:
    """make(k) for the row's own shingle length _k, null at the last words of a text."""
    out = F.when(F.lit(False), make(lengths[0]))
    for k in lengths:
        out = out.when((F.col("_k") == k) & _full(k), make(k))
    return out


@dataclass(frozen=True)
class Partition:
    """Items of one shingle length whose shingle count has the same number of binary digits."""

    k: int  # words in a shingle
    size_class: int  # floor(log2(shingles))
    top: int  # the largest hash in the sketches of these items
    need: int  # the fewest shingles that a document must share with one of them


def item_sets(ws: Workspace, items: DataFrame, item_id: str, item_text: str, shingle: int) -> DataFrame:
    """(item_id, _item, _k, _w): items by the words that they consist of; equal ones are searched once."""
    it = items.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("_w")).filter("item_id is not null and size(_w) > 0")
    return ws.put("items", it.select("item_id", F.sha2(F.array_join("_w", " "), 256).alias("_item"), F.least(F.size("_w"), F.lit(shingle)).alias("_k"), "_w").distinct())


def sketches(ws: Workspace, it: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, list[Partition]]:
    """(_k, _class, _min): the sketches of all items, and their size partitions with a bound of its own for each.

    A sketch is the n - ceil(percent * n) + 1 smallest of an item's n shingle hashes: a document with the required containment
    can miss fewer shingles than that, so it holds at least one of them. Its length goes with the item's size.
    """
    one = it.select("_item", "_k", "_w").dropDuplicates(["_item"])
    hashed = spread(one, ["_item", "_k"], shingle).select("_item", "_k", _by_length(_hash, range(1, shingle + 1)).alias("_h")).filter("_h is not null")
    sets = hashed.groupBy("_item", "_k").agg(F.sort_array(F.collect_set("_h")).alias("_h")).withColumn("_n", F.size("_h"))
    need = F.ceil(F.col("_n") * percent / 100).cast("int")
    sets = sets.select("_k", F.floor(F.log2("_n")).cast("int").alias("_class"), need.alias("_need"), F.explode(F.slice("_h", 1, F.col("_n") - need + 1)).alias("_min"))
    sketch = ws.put("sketch", sets.groupBy("_k", "_class", "_min").agg(F.min("_need").alias("_need")))
    # at most `shingle` times the number of binary digits of the largest item
    found = sketch.groupBy("_k", "_class").agg(F.max("_min").alias("top"), F.min("_need").alias("need")).orderBy("_k", "_class").collect()
    return sketch, [Partition(r["_k"], r["_class"], r["top"], r["need"]) for r in found]


def probes(docs: DataFrame, partitions: list[Partition]) -> DataFrame:
    """(_id, _version, _k, _class, _min): what documents ask each size partition, from one pass over their words.

    A hash goes only to partitions whose sketches reach as far, and only from documents large enough for their items.
    """
    d = docs.withColumn("_size", F.size("_w"))
    rows = spread(d, ["_id", "_version", "_size"], max(p.k for p in partitions))
    lengths = sorted({p.k for p in partitions})
    # each hash is computed once to filter the rows and once more for those that pass
    some = F.lit(False)
    for k in lengths:
        own = [p for p in partitions if p.k == k]
        some |= _full(k) & (F.col("_size") - (k - 1) >= min(p.need for p in own)) & (_hash(k) <= max(p.top for p in own))
    rows = rows.filter(some).select("_id", "_version", "_size", *[F.when(_full(k), _hash(k)).alias(f"h{k}") for k in lengths])
    asks = [F.when((F.col(f"h{p.k}") <= p.top) & (F.col("_size") - (p.k - 1) >= p.need), F.struct(F.lit(p.k).alias("_k"), F.lit(p.size_class).alias("_class"), F.col(f"h{p.k}").alias("_min"))) for p in partitions]
    return rows.select("_id", "_version", F.inline(F.array(*asks))).filter("_min is not null")


def contaminated(ws: Workspace, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs (doc_id, item_id, n_shared, n_item) in which a document holds at least `percent` % of an item's shingles.

    1. Items are partitioned by size: powers of two of their shingle count, and the shingle length for items of fewer
       words than a shingle. Each partition has MinHash sketches as long as its items need, and a bound of its own.
    2. Documents are tokenised once; their hashes ask the partitions. A document that hits a sketch is a candidate. No
       pair at the threshold is lost, and no pairs are made yet, so a shingle that many items share costs nothing.
    3. Of candidates alone the distinct shingles are joined with the items' shingles, as strings, and counted.

    Words are runs of letters, marks and digits of the lower-cased text. An item without words, a null id or a null
    text matches nothing. Items of fewer words than a shingle count as one shingle of all their words. Of rows that
    share an id each text is searched on its own, and the one that shares most counts. Extra columns are ignored.
    """
    it = item_sets(ws, items, item_id, item_text, shingle)
    sketch, partitions = sketches(ws, it, shingle, percent)
    versions = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_version"), F.col(text_col).alias("_text"))
    if not partitions:
        kind = it.schema["item_id"].dataType
        return versions.filter(F.lit(False)).select(F.col("_id").alias("doc_id"), F.lit(None).cast(kind).alias("item_id"), F.lit(0).alias("n_shared"), F.lit(0).alias("n_item"))
    asked = probes(versions.select("_id", "_version", words(F.col("_text")).alias("_w")), partitions)
    hit = ws.put("candidates", asked.join(small(sketch.drop("_need")), ["_k", "_class", "_min"], "left_semi").select("_id", "_version").distinct())
    ws.drop("sketch")

    lengths = sorted({p.k for p in partitions})
    one = it.select("_item", "_k", "_w").dropDuplicates(["_item"])
    own = ws.put("shingles", spread(one, ["_item", "_k"], shingle).select("_item", "_k", _by_length(_text, range(1, shingle + 1)).alias("_s")).filter("_s is not null").distinct())
    sizes = own.groupBy("_item").agg(F.count(F.lit(1)).cast("int").alias("n_item"))
    held = versions.join(small(hit), ["_id", "_version"], "left_semi").select("_id", "_version", words(F.col("_text")).alias("_w"))
    held = spread(held, ["_id", "_version"], lengths[-1])
    each = F.array(*[F.when(_full(k), F.struct(F.lit(k).alias("_k"), _text(k).alias("_s"))) for k in lengths])
    shared = held.select("_id", "_version", F.inline(each)).filter("_s is not null").join(small(own), ["_k", "_s"]).groupBy("_id", "_version", "_item").agg(F.count_distinct("_s").cast("int").alias("n_shared"))
    found = shared.join(small(sizes), "_item").filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    pairs = found.join(small(it.select("item_id", "_item")), "_item").groupBy(F.col("_id").alias("doc_id"), "item_id").agg(F.max(F.struct("n_shared", "n_item")).alias("_most"))
    return pairs.select("doc_id", "item_id", "_most.n_shared", "_most.n_item")


def decontaminate(ws: Workspace, docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """docs without the documents that hold an item; rows with a null id or text stay."""
    hit = ws.put("hits", contaminated(ws, docs, items, **names).select(F.col("doc_id").alias(gone := fresh("_hit", docs))).distinct())
    return docs.join(small(hit), F.col(names.get("id_col", "doc_id")) == F.col(gone), "left_anti")


ORACLE = r"""
with iw as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') w from benchmark),
ik as (select item_id, w, least(len(w), 5) k from iw where len(w) > 0),
ish as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') s
        from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) i from ik)),
n as (select item_id, count(*) n_item from ish group by 1),
dw as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') w from documents),
ks as (select distinct k from ish),
dsh as (select distinct doc_id, k, array_to_string(w[i:i + k - 1], ' ') s
        from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from dw, ks where len(w) >= k)),
m as (select doc_id, item_id, count(*) n_shared from dsh join ish using (k, s) group by 1, 2)
select doc_id, item_id, n_shared::int n_shared, n_item::int n_item
from m join n using (item_id) where n_shared * 100 >= n_item * 80
"""
