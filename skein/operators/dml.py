"""Tables that can be updated, deleted from and merged into.

Parquet tables have no row-level changes, so each one writes the new rows to a sibling table in one distributed job and
then swaps the names; readers of the old files are never overwritten. Counts are taken from the same plan.
"""

from __future__ import annotations

import uuid
from collections import namedtuple
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skein.functions.core import as_value

from .frame import Frame, _frame

UpdateResult = namedtuple("UpdateResult", "rows_updated multi_joined_rows_updated")
DeleteResult = namedtuple("DeleteResult", "rows_deleted")
MergeResult = namedtuple("MergeResult", "rows_inserted rows_updated rows_deleted")


def swap(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Replaces a table's rows by a frame that may read the table."""
    new, old = _sibling(name, "new"), _sibling(name, "old")
    rows.write.saveAsTable(new, format="parquet")
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")


def row_id() -> Column:
    """A row's place in the table's files: the same in every scan, however the files are split."""
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def _sibling(name: str, kind: str) -> str:
    """A new table name in the same schema."""
    base = name.rsplit(".", 1)
    return (f"{base[0]}." if len(base) == 2 else "") + f"_{kind}_{uuid.uuid4().hex}"


def _name(column: Any) -> str:
    return column if isinstance(column, str) else column._jc.toString().rsplit(".", 1)[-1].strip("`")


class Table(Frame):
    def __init__(self, spark: SparkSession, name: str):
        super().__init__(spark.table(name))
        self.spark, self.name = spark, name
        self.source_sql = f"SELECT * FROM {name}"

    def clone(self) -> Table:
        return Table(self.spark, self.name)

    @property
    def async_(self):
        from .asyncjobs import AsyncTable

        return AsyncTable(self)

    def refresh(self) -> None:
        self.spark.catalog.refreshTable(self.name)
        self.df = self.spark.table(self.name)

    def _matched(self, condition: Column | None, source: Any) -> DataFrame:
        """Each row once, with how many source rows meet the condition (_hits) and one of these (_src)."""
        rows = self.df.withColumn("_row", row_id())
        if source is None:
            hit = F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True)
            return rows.withColumn("_hits", hit.cast("long"))
        other = _frame(source)
        packed = other.withColumn("_src", F.struct(*[F.col(f"`{c}`") for c in other.columns]))
        pairs = self.df.withColumn("_row", row_id()).join(packed, condition if condition is not None else F.lit(True), "inner")
        found = pairs.select("_row", "_src").groupBy("_row").agg(F.count(F.lit(1)).alias("_hits"), F.first("_src").alias("_src"))
        return rows.join(found, "_row", "left").withColumn("_hits", F.coalesce("_hits", F.lit(0).cast("long")))

    def update(self, assignments: dict[Any, Any], condition: Column | None = None, source: Any = None) -> UpdateResult:
        """Sets columns where the condition holds. With a source frame, its rows are joined on the condition and the
        new values may use its columns; a row that meets several takes one of them and is counted as multi-joined."""
        new = {_name(k).lower(): v for k, v in assignments.items()}
        unknown = set(new) - {c.lower() for c in self.columns}
        if unknown:
            raise ValueError(f"no such column: {', '.join(sorted(unknown))}")
        if source is None:
            rows = self._matched(condition, None)
        else:
            other = _frame(source)
            values = F.struct(*[as_value(v).alias(f"_v{i}") for i, v in enumerate(new.values())])
            keyed = self.df.withColumn("_row", row_id())
            pairs = keyed.join(other, condition if condition is not None else F.lit(True)).select("_row", values.alias("_src"))
            found = pairs.groupBy("_row").agg(F.count(F.lit(1)).alias("_hits"), F.first("_src").alias("_src"))
            base = self.df.withColumn("_row", row_id())
            rows = base.join(found, "_row", "left").withColumn("_hits", F.coalesce("_hits", F.lit(0).cast("long")))
        seen = Observation()
        counted = rows.observe(seen, F.count_if(F.col("_hits") > 0).alias("n"), F.count_if(F.col("_hits") > 1).alias("multi"))
        value = {c: (F.col(f"_src._v{i}") if source is not None else as_value(v)) for i, (c, v) in enumerate(new.items())}
        out = counted.select(*[F.when(F.col("_hits") > 0, value[f.name.lower()].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name) if f.name.lower() in value else F.col(f"`{f.name}`") for f in self.schema])
        swap(self.spark, self.name, out)
        self.refresh()
        return UpdateResult(seen.get["n"], seen.get["multi"])

    def delete(self, condition: Column | None = None, source: Any = None) -> DeleteResult:
        """Drops the rows that meet the condition, for some row of a source frame if there is one."""
        rows = self._matched(condition, source)
        seen = Observation()
        out = rows.observe(seen, F.count_if(F.col("_hits") > 0).alias("n")).filter(F.col("_hits") == 0).select(*[F.col(f"`{c}`") for c in self.columns])
        swap(self.spark, self.name, out)
        self.refresh()
        return DeleteResult(seen.get["n"])

    def merge(self, source: Any, condition: Column) -> MergeBuilder:
        return MergeBuilder(self, _frame(source), condition)


class MergeBuilder:
    """Clauses are tried in order; the first whose condition holds decides about a row."""

    def __init__(self, target: Table, source: DataFrame, condition: Column, clauses: tuple = ()):
        self.target, self.source, self.condition, self.clauses = target, source, condition, clauses

    def whenMatched(self, condition: Column | None = None) -> MatchedClause:
        return MatchedClause(self, condition)

    def whenNotMatched(self, condition: Column | None = None) -> NotMatchedClause:
        return NotMatchedClause(self, condition)

    def _with(self, *clause: Any) -> MergeBuilder:
        return MergeBuilder(self.target, self.source, self.condition, (*self.clauses, clause))

    @property
    def async_(self):
        from .asyncjobs import AsyncMerge

        return AsyncMerge(self)

    def collect(self) -> MergeResult:
        """One outer join decides about every row. A target row that several source rows would change is an error."""
        t, columns = self.target, self.target.columns
        target = t.df.withColumns({"_t": F.lit(True), "_row": row_id()})
        source = self.source.withColumn("_s", F.lit(True))
        both = target.join(source, self.condition, "full_outer")
        on_target, on_source = F.col("_t").isNotNull(), F.col("_s").isNotNull()
        action, values = F.lit("keep"), {c: t.df[c] for c in columns}
        for kind, what, cond, new in reversed(self.clauses):
            side = on_target & on_source if kind == "matched" else ~on_target & on_source
            hit = side & F.coalesce(cond, F.lit(False)) if cond is not None else side
            action = F.when(hit, F.lit(what)).otherwise(action)
            if what != "delete":
                for c in columns:
                    v = new.get(c.lower()) if what == "update" else new.get(c.lower(), F.lit(None))
                    if v is not None:
                        values[c] = F.when(hit, as_value(v)).otherwise(values[c])
                    else:
                        values[c] = F.when(hit, t.df[c]).otherwise(values[c])
        kinds = {f.name: f.dataType for f in t.schema}
        decided = both.select(*[values[c].cast(kinds[c]).alias(c) for c in columns], "_row", on_target.alias("_had"), action.alias("_action"))
        # written once: the check, the rows that stay and those that change read it, and the join runs a single time
        work = _sibling(t.name, "merge")
        decided.filter("_had or _action = 'insert'").write.saveAsTable(work, format="parquet")
        try:
            return self._apply(t.spark.table(work))
        finally:
            t.spark.sql(f"DROP TABLE IF EXISTS {work}")

    def _apply(self, decided: DataFrame) -> MergeResult:
        t, columns = self.target, self.target.columns
        several = decided.filter("_had and _action <> 'keep'").groupBy("_row").count().filter("count > 1")
        if not several.isEmpty():
            raise ValueError("a target row matches several source rows")
        seen = Observation()
        first = decided.filter("_had and _action = 'keep'").dropDuplicates(["_row"])
        changed = decided.filter("_action <> 'keep'")
        untouched = first.join(changed.filter("_had").select("_row"), "_row", "left_anti")
        out = untouched.select(*columns, "_action").unionByName(changed.select(*columns, "_action"))
        out = out.observe(seen, *[F.count_if(F.col("_action") == a).alias(a) for a in ("insert", "update", "delete")])
        swap(t.spark, t.name, out.filter("_action <> 'delete'").drop("_action"))
        t.refresh()
        got = seen.get
        return MergeResult(got["insert"], got["update"], got["delete"])


class MatchedClause:
    def __init__(self, builder: MergeBuilder, condition: Column | None):
        self.builder, self.condition = builder, condition

    def update(self, assignments: dict[Any, Any]) -> MergeBuilder:
        return self.builder._with("matched", "update", self.condition, {_name(k).lower(): v for k, v in assignments.items()})

    def delete(self) -> MergeBuilder:
        return self.builder._with("matched", "delete", self.condition, {})


class NotMatchedClause:
    def __init__(self, builder: MergeBuilder, condition: Column | None):
        self.builder, self.condition = builder, condition

    def insert(self, values: Any) -> MergeBuilder:
        """A value for each column of the target, or a dict; columns left out are null."""
        if not isinstance(values, dict):
            if len(values) != len(self.builder.target.columns):
                raise ValueError("insert needs a value for each column")
            values = dict(zip(self.builder.target.columns, values, strict=True))
        return self.builder._with("unmatched", "insert", self.condition, {_name(k).lower(): v for k, v in values.items()})
