"""Line dedup by overlapping three-line windows (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, inside, packed, small

WINDOW = 3


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _pos, _k1, _k2): one row for each three consecutive lines; two 64-bit hashes identify the lines."""
    lines = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.split(text_col, "\n").alias("_l")).filter(F.size("_l") >= WINDOW)

    def window(i):
        three = [F.get("_l", i + j) for j in range(WINDOW)]
        return F.struct(i.alias("_pos"), F.xxhash64(*three).alias("_k1"), F.xxhash64(F.lit("second"), *three).alias("_k2"), F.length(F.trim(F.concat(*three))).alias("_size"))

    # inline_outer: for a plain inline Spark would push a filter on its size below, and split the text for each line
    last = F.greatest(F.size("_l") - WINDOW, F.lit(0))
    return lines.select("_id", F.inline_outer(F.transform(F.sequence(F.lit(0), last), window))).filter("_size > 0").drop("_size")


def dedup_lines(ws: Workspace, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes every line that a later occurrence of a repeated three-line window covers.

    Windows occur in the order (id, line number); the first occurrence in the whole corpus stays, all three lines
    of each later one go, and overlapping ones merge. Adds n_lines and n_removed and replaces the text.

    Null text: null, with no lines. Fewer than three lines: unchanged. Windows of blank lines alone don't count.
    A null id takes no part and keeps its text. Rows that share an id count as one document and lose the same
    lines. If all lines go, the text is empty. Other columns pass through, whatever their names; n_lines and n_removed are replaced.
    """
    all_windows = windows(docs, id_col, text_col)
    # A hot window is one row for each task after partial aggregation. Written, so that the join below has a plain
    # exchange on both sides, whose large partitions adaptive execution can split.
    repeated = ws.put("repeated", all_windows.groupBy("_k1", "_k2").agg(F.min(F.struct("_id", "_pos")).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    later = all_windows.join(repeated, ["_k1", "_k2"]).filter(F.struct("_id", "_pos") > F.col("_first"))
    covered = ws.put("covered", later.groupBy(F.col("_id")).agg(F.collect_set("_pos").alias("_starts")))
    ws.drop("repeated")
    gone = F.array_distinct(F.flatten(F.transform("_starts", lambda p: F.sequence(p, p + WINDOW - 1))))
    text = inside(text_col)
    # few documents change: a short list of them is broadcast, so that no text moves; a long one is merged
    out = packed(docs).join(small(covered), inside(id_col) == F.col("_id"), "left")
    out = out.withColumns({"_lines": F.split(text, "\n"), "_gone": F.coalesce(gone, F.array().cast("array<int>"))})
    all_lines = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.array_join(F.transform(F.array_except(all_lines, F.col("_gone")), lambda i: F.get("_lines", i)), "\n")
    added = {
        text_col: F.when(F.col("_lines").isNotNull() & (F.size("_gone") > 0), kept).otherwise(text),
        "n_lines": F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")),
        "n_removed": F.when(F.col("_lines").isNull(), 0).otherwise(F.size(F.array_intersect("_gone", all_lines))),
    }
    others = [inside(c).alias(c) for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    out = out.select("_in", F.struct(*[c.alias(n) for n, c in added.items()]).alias("_new"))
    return out.select(*others, *[F.col(f"_new.{n}").alias(n) for n in added])


ORACLE = """
with l as (select doc_id, string_split(text, chr(10)) ls from documents where doc_id is not null),
p as (select doc_id, ls, unnest(range(0, len(ls) - 2)) pos from l where len(ls) >= 3),
w as (select doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] k,
             length(trim(ls[pos + 1] || ls[pos + 2] || ls[pos + 3])) n from p),
r as (select doc_id, pos, row_number() over (partition by k order by doc_id, pos) o from w where n > 0),
c as (select distinct doc_id, pos + unnest([0, 1, 2]) i from r where o > 1),
x as (select doc_id, unnest(range(0, len(ls))) i, unnest(ls) s from l),
t as (select x.doc_id, count(*) n_lines, count(c.i) n_removed,
             coalesce(string_agg(x.s, chr(10) order by x.i) filter (c.i is null), '') txt
      from x left join c on x.doc_id = c.doc_id and x.i = c.i group by x.doc_id)
select d.doc_id, coalesce(n_lines, 0)::int n_lines, coalesce(n_removed, 0)::int n_removed,
       case when d.text is null then null else t.txt end as text
from documents d left join t using (doc_id)
"""
