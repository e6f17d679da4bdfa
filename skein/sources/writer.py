"""Writing frames to tables and files."""

from __future__ import annotations

import uuid
from collections import namedtuple
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

WriteFileResult = namedtuple("WriteFileResult", "rows_unloaded input_bytes output_bytes")
MODES = {"append": "append", "overwrite": "overwrite", "ignore": "ignore", "errorifexists": "errorifexists", "error": "errorifexists"}
#: What each option means for Spark's writers; None: handled here.
OPTIONS = {"HEADER": "header", "FIELD_DELIMITER": "sep", "COMPRESSION": "compression", "NULL_IF": "nullValue", "DATE_FORMAT": "dateFormat", "TIMESTAMP_FORMAT": "timestampFormat", "FIELD_OPTIONALLY_ENCLOSED_BY": "quote", "ESCAPE": "escape", "ENCODING": "encoding", "PARTITION BY": None, "PARTITION_BY": None, "SINGLE": None, "OVERWRITE": None, "MAX_FILE_SIZE": None, "FORMAT_TYPE": None, "DETAILED_OUTPUT": None, "INCLUDE_QUERY_ID": None, "COLUMNORDER": None, "TABLETYPE": None, "FILE_EXTENSION": None, "EMPTY_FIELD_AS_NULL": None}


class FrameWriter:
    def __init__(self, frame: Any, options: dict[str, Any] | None = None, mode: str | None = None):
        self.frame, self._options, self._mode = frame, options or {}, mode

    def option(self, key: str, value: Any) -> FrameWriter:
        return self.options({key: value})

    def options(self, values: dict[str, Any]) -> FrameWriter:
        new = {k.upper(): v for k, v in values.items()}
        if bad := [k for k in new if k not in OPTIONS]:
            raise ValueError(f"unknown writer option: {', '.join(bad)}")
        return FrameWriter(self.frame, self._options | new, self._mode)

    def mode(self, mode: str) -> FrameWriter:
        if mode.lower() not in MODES:
            raise ValueError(f"unknown save mode '{mode}'; one of {', '.join(MODES)}")
        return FrameWriter(self.frame, self._options, MODES[mode.lower()])

    @property
    def async_(self):
        from skein.operators.asyncjobs import AsyncWriter

        return AsyncWriter(self)

    def saveAsTable(self, name: str | Sequence[str]) -> None:
        """Appends unless a mode says otherwise; columns go by position, or by name with COLUMNORDER = name."""
        table = name if isinstance(name, str) else ".".join(f"`{x}`" for x in name)
        df, spark, mode = self.frame.df, self.frame.session, self._mode or "append"
        if str(self._options.get("TABLETYPE", "")).lower() in ("temp", "temporary"):
            self._temporary(table, df, mode)
            return
        if not spark.catalog.tableExists(table):
            df.write.saveAsTable(table, format="parquet", mode=mode)
        elif mode == "append":
            if str(self._options.get("COLUMNORDER", "index")).lower() == "name":
                df = df.select(*[F.col(f"`{c}`") for c in spark.table(table).columns])
            df.write.insertInto(table)
        elif mode == "overwrite":
            from skein.operators.dml import swap

            swap(spark, table, df)
        elif mode == "errorifexists":
            raise ValueError(f"table {table} exists")

    def _temporary(self, table: str, df: DataFrame, mode: str) -> None:
        """Rows as they are now, in a folder of the session, under a name that only this session sees."""
        spark = self.frame.session
        known = any(t.isTemporary and f"`{t.name}`".strip("`") == table.strip("`") for t in spark.catalog.listTables())
        if known and mode == "errorifexists":
            raise ValueError(f"table {table} exists")
        if known and mode == "ignore":
            return
        if known and mode == "append":
            df = spark.table(table).union(df)
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_skein_temporary/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(table)

    def _files(self, fmt: str, path: str) -> WriteFileResult:
        """Exports files; the result tells rows as observed while writing, and bytes from a listing afterwards."""
        mode = self._mode or ("overwrite" if str(self._options.get("OVERWRITE", "")).lower() == "true" else "errorifexists")
        if mode not in ("overwrite", "errorifexists"):
            raise ValueError(f"files can't be written in mode {mode}")
        df = self.frame.df
        if str(self._options.get("SINGLE", "")).lower() == "true":
            df = df.coalesce(1)
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        w = df.write.mode(mode)
        for k, v in self._options.items():
            if OPTIONS[k]:
                w = w.option(OPTIONS[k], v)
        by = self._options.get("PARTITION BY", self._options.get("PARTITION_BY"))
        if by:
            w = w.partitionBy(*([by] if isinstance(by, str) else by))
        w.format(fmt).save(path)
        spark = self.frame.session
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
        return WriteFileResult(seen.get["rows"], size, size)

    def csv(self, path: str) -> WriteFileResult:
        return self._files("csv", path)

    def json(self, path: str) -> WriteFileResult:
        return self._files("json", path)

    def parquet(self, path: str) -> WriteFileResult:
        return self._files("parquet", path)
