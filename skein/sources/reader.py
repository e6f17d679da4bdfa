"""Reading files, and copying them into tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skein.operators.frame import Frame

#: Options by their names in the dialect, and what they are for Spark's readers.
OPTIONS = {
    "FIELD_DELIMITER": "sep", "FIELD_OPTIONALLY_ENCLOSED_BY": "quote", "ESCAPE": "escape", "RECORD_DELIMITER": "lineSep", "NULL_IF": "nullValue",
    "DATE_FORMAT": "dateFormat", "TIMESTAMP_FORMAT": "timestampFormat", "ENCODING": "encoding", "COMPRESSION": "compression", "PATTERN": "pathGlobFilter",
    "TRIM_SPACE": "ignoreLeadingWhiteSpace", "MULTI_LINE": "multiLine", "STRIP_OUTER_ARRAY": "multiLine", "ROW_TAG": "rowTag", "COMMENT": "comment",
}
#: Options that say how files are loaded, not how they are parsed.
COPY = {"ON_ERROR", "FORCE", "PURGE", "SIZE_LIMIT", "VALIDATION_MODE", "RETURN_FAILED_ONLY", "ENFORCE_LENGTH", "TRUNCATECOLUMNS", "PARSE_HEADER", "SKIP_HEADER", "MATCH_BY_COLUMN_NAME", "ERROR_ON_COLUMN_COUNT_MISMATCH"}
LOADS = "skein_loads"


def _without_header(skip: int):
    """Drops the first lines of each file: the first ones of the split that starts at its byte 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, left = None, 0
        for b in batches:
            keep = []
            for f, start in zip(b.column("_file").to_pylist(), b.column("_start").to_pylist(), strict=True):
                if (f, start) != file:
                    file, left = (f, start), 0 if start else skip
                keep.append(left == 0)
                left = max(0, left - 1)
            yield b.filter(pa.array(keep, pa.bool_()))

    return run


class FrameReader:
    def __init__(self, spark: SparkSession, options: dict[str, Any] | None = None, schema: StructType | str | None = None):
        self.spark, self._options, self._schema = spark, options or {}, schema

    def table(self, name: str):
        from skein.operators.dml import Table

        return Table(self.spark, name)

    def schema(self, schema: StructType | str) -> FrameReader:
        return FrameReader(self.spark, self._options, schema)

    def option(self, key: str, value: Any) -> FrameReader:
        return FrameReader(self.spark, self._options | {key.upper(): value}, self._schema)

    def options(self, values: dict[str, Any]) -> FrameReader:
        return FrameReader(self.spark, self._options | {k.upper(): v for k, v in values.items()}, self._schema)

    def _reader(self):
        r = self.spark.read
        mode = str(self._options.get("ON_ERROR", "ABORT_STATEMENT")).upper()
        r = r.option("mode", "DROPMALFORMED" if mode.startswith(("CONTINUE", "SKIP_FILE")) else "FAILFAST")
        for k, v in self._options.items():
            if k == "SKIP_HEADER":
                r = r.option("header", bool(int(v)))
            elif k == "PARSE_HEADER":
                r = r.option("header", bool(v))
            elif k == "FIELD_OPTIONALLY_ENCLOSED_BY":
                r = r.option("quote", v).option("escape", v)
            elif k == "NULL_IF":
                r = r.option("nullValue", v if isinstance(v, str) else next(iter(v), ""))
            elif k not in COPY and k != "PATTERN":
                r = r.option(OPTIONS.get(k, k), v)
        return r

    def _reload(self, frame: FileFrame) -> FileFrame:
        """The same files under these options."""
        return getattr(self, frame.format)(frame.path)

    def _matching(self, df: DataFrame) -> DataFrame:
        """PATTERN is a regular expression on the file's path."""
        pattern = self._options.get("PATTERN")
        return df if pattern is None else df.filter(F.regexp_like(F.col("_metadata.file_path"), F.lit(pattern)))

    def _line_options(self, mode: str) -> dict[str, str]:
        out = {"mode": mode}
        for k, v in self._options.items():
            if k == "FIELD_OPTIONALLY_ENCLOSED_BY":
                out |= {"quote": v, "escape": v}
            elif k not in COPY and k not in ("PATTERN", "NULL_IF", "ENCODING", "COMPRESSION", "RECORD_DELIMITER"):
                out[OPTIONS.get(k, k)] = str(v).lower() if isinstance(v, bool) else str(v)
        return out

    def _by_lines(self, path: str, schema: StructType, skip: int, nulls: list[str], on_error: str) -> DataFrame:
        """CSV files line by line, for what Spark's reader has no option for: several header lines, several texts that
        stand for null, and leaving out files with errors. Values can't span lines here."""
        if str(self._options.get("MULTI_LINE", False)).lower() == "true":
            raise ValueError("MULTI_LINE goes with one header line and one null text at most, and not with SKIP_FILE")
        reader = self.spark.read
        if "RECORD_DELIMITER" in self._options:
            reader = reader.option("lineSep", self._options["RECORD_DELIMITER"])
        text = reader.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata").alias("_about"))
        if skip:
            text = text.mapInArrow(_without_header(skip), text.schema)
        text = text.filter(F.length("value") > 0)
        bad = "_bad"
        while bad in schema.fieldNames():
            bad += "_"
        # an error is found by parsing permissively; with ABORT_STATEMENT parsing fails at once
        mode = "FAILFAST" if on_error.startswith("ABORT") else "PERMISSIVE"
        options = self._line_options(mode) | {"columnNameOfCorruptRecord": bad}
        kept = StructType([*schema.fields, StructField(bad, StringType())]) if mode == "PERMISSIVE" else schema
        value = F.col("value")
        if nulls:
            words = F.from_csv(value, ", ".join(f"c{i} string" for i in range(len(schema))), self._line_options("PERMISSIVE"))
            mark = "\\N"
            fields = [F.when(~F.col(f"_words.c{i}").isin(nulls), F.col(f"_words.c{i}")).alias(f"c{i}") for i in range(len(schema))]
            text = text.withColumn("_words", words)
            value = F.to_csv(F.struct(*fields), {"nullValue": mark, "sep": ",", "quoteAll": "true", "emptyValue": ""})
            options |= {"nullValue": mark, "sep": ",", "quote": '"', "escape": "\\"}
        rows = text.select("_file", "_about", F.from_csv(value, kept.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("_row"))
        if mode == "PERMISSIVE":
            rows = rows.withColumn("_error", F.col(f"_row.`{bad}`").isNotNull())
            if on_error.startswith("SKIP_FILE"):
                limit = on_error.removeprefix("SKIP_FILE").strip("_")
                share = limit.endswith("%")
                errors = F.count_if("_error") * 100 / F.count(F.lit(1)) if share else F.count_if("_error")
                spoiled = rows.groupBy("_file").agg(errors.alias("_n")).filter(F.col("_n") >= float(limit.rstrip("%") or 1)).filter("_n > 0")
                rows = rows.join(spoiled.select("_file"), "_file", "left_anti")
            rows = rows.filter("not _error")
        return rows.select(*[F.col(f"_row.`{f}`").alias(f) for f in schema.fieldNames()], F.col("_about").alias("_metadata"))

    def csv(self, path: str) -> FileFrame:
        """CSV files need a schema. Unless SKIP_HEADER says so, the first line is data."""
        if self._schema is None:
            raise ValueError("CSV files need a schema: call schema() first")
        skip, nulls = int(self._options.get("SKIP_HEADER", 0)), self._options.get("NULL_IF", ())
        on_error = str(self._options.get("ON_ERROR", "ABORT_STATEMENT")).upper()
        nulls = [nulls] if isinstance(nulls, str) else list(nulls)
        if skip > 1 or len(nulls) > 1 or on_error.startswith("SKIP_FILE"):
            schema = self._schema if isinstance(self._schema, StructType) else StructType.fromDDL(self._schema)
            df = self._by_lines(path, schema, skip, nulls, on_error)
            df = self._matching(df)
            return FileFrame(df.drop("_metadata"), self, path, "csv", located=df)
        return FileFrame(self._matching(self._reader().schema(self._schema).csv(path)), self, path, "csv")

    def _variant(self, path: str, fmt: str, df: DataFrame) -> FileFrame:
        return FileFrame(self._matching(df), self, path, fmt)

    def _no_schema(self) -> None:
        if self._schema is not None:
            raise ValueError("only CSV files take a schema")

    def json(self, path: str) -> FileFrame:
        """One variant column, `$1`, for each object."""
        self._no_schema()
        return self._variant(path, "json", self._reader().option("singleVariantColumn", "$1").json(path))

    def _as_variant(self, path: str, fmt: str, df: DataFrame) -> FileFrame:
        one = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("$1")
        return FileFrame(self._matching(df).select(one), self, path, fmt, native=df)

    def parquet(self, path: str) -> FileFrame:
        """One variant column; `.native` keeps the file's own columns, of which only those in use are read."""
        self._no_schema()
        return self._as_variant(path, "parquet", self.spark.read.parquet(path))

    def orc(self, path: str) -> FileFrame:
        self._no_schema()
        return self._as_variant(path, "orc", self.spark.read.orc(path))

    def avro(self, path: str) -> FileFrame:
        """Needs Spark's Avro package on the class path."""
        self._no_schema()
        return self._as_variant(path, "avro", self.spark.read.format("avro").load(path))

    def xml(self, path: str) -> FileFrame:
        """ROW_TAG names the element that is a row."""
        self._no_schema()
        return self._as_variant(path, "xml", self._reader().xml(path))


class FileFrame(Frame):
    """Rows of files; copyInto loads them into a table."""

    def __init__(self, df: DataFrame, reader: FrameReader, path: str, fmt: str, native: DataFrame | None = None, located: DataFrame | None = None):
        """`located` is df with the column _metadata, where that isn't the hidden one of Spark's readers."""
        super().__init__(df)
        self.located = located if located is not None else df
        self.reader, self.path, self.format = reader, path, fmt
        self.native = Frame(native) if native is not None else self

    def clone(self) -> FileFrame:
        return FileFrame(self.df, self.reader, self.path, self.format, self.native.df, self.located)

    @property
    def async_(self):
        from skein.operators.asyncjobs import AsyncCopy

        return AsyncCopy(self)

    def copyInto(self, table: str, target_columns: Sequence[str] | None = None, transformations: Sequence[Column] | None = None, options: dict[str, Any] | None = None) -> int:
        """Appends the files' rows to a table and returns how many files were loaded.

        A ledger of loaded files skips those that a table has loaded already, unless FORCE is set. Transformations
        are columns over the files' columns; target columns that are left out become null.
        """
        spark, opts = self.session, {k.upper(): v for k, v in (self.reader._options | (options or {})).items()}
        if not spark.catalog.tableExists(table):
            if transformations or target_columns:
                raise ValueError(f"table {table} doesn't exist")
            self.df.limit(0).write.saveAsTable(table, format="parquet")
        rows = FrameReader(spark, opts, self.reader._schema)._reload(self) if options else self
        if opts.get("VALIDATION_MODE"):
            # the rows are parsed, and an error is raised, but nothing is loaded
            rows.df.write.format("noop").mode("overwrite").save()
            return 0
        df = rows.located.withColumns({"_file": F.col("_metadata.file_path"), "_bytes": F.col("_metadata.file_size")})
        if not spark.catalog.tableExists(LOADS):
            # at a fixed place, so that a later session of the same warehouse finds it
            place = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_{LOADS}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {LOADS} (target string, file string) USING parquet LOCATION '{place}'")
        done = spark.table(LOADS).filter(F.col("target") == table).select(F.col("file").alias("_file"))
        if not str(opts.get("FORCE", False)).lower() == "true":
            df = df.join(done.distinct(), "_file", "left_anti")
        columns = list(transformations) if transformations else [F.col(f"`{c}`") for c in self.columns]
        target = spark.table(table).schema
        names = list(target_columns) if target_columns else [f.name for f in target][: len(columns)]
        if len(names) != len(columns):
            raise ValueError(f"{len(columns)} columns for {len(names)} target columns")
        if limit := int(opts.get("SIZE_LIMIT") or 0):
            df = df.join(F.broadcast(self._within(df, limit)), "_file", "left_semi")  # one row for each file
        given = df.select("_file", *[c.alias(f"_c{i}") for i, c in enumerate(columns)])
        at = {n.lower(): i for i, n in enumerate(names)}
        unknown = set(at) - {f.name.lower() for f in target}
        if unknown:
            raise ValueError(f"no such column in {table}: {', '.join(sorted(unknown))}")
        files = [r[0] for r in given.select("_file").distinct().collect()]  # one row for each file
        out = given.select(*[(F.col(f"_c{at[f.name.lower()]}").cast(f.dataType) if f.name.lower() in at else F.lit(None).cast(f.dataType)).alias(f.name) for f in target])
        if files:
            out.write.insertInto(table)
            spark.createDataFrame([(table, f) for f in files], "target string, file string").write.insertInto(LOADS)
        if str(opts.get("PURGE", False)).lower() == "true":
            conf = spark._jsc.hadoopConfiguration()
            for f in files:
                p = spark._jvm.org.apache.hadoop.fs.Path(f)
                p.getFileSystem(conf).delete(p, False)
        return len(files)

    def _within(self, df: DataFrame, limit: int) -> DataFrame:
        """The files, in the order of their paths, until their bytes exceed the limit; one at least."""
        chosen, size = [], 0
        for file, n in sorted(map(tuple, df.select("_file", "_bytes").distinct().collect())):  # one row for each file
            if chosen and size > limit:
                break
            chosen.append((file,))
            size += n
        return self.session.createDataFrame(chosen, "_file string")
