"""Table functions: calls that give rows, alone or beside each row of a frame."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from skein.functions.core import as_column
from skein.functions.semistructured import variant_path
from skein.functions.strings import split as split_literal

MODES = ("OBJECT", "ARRAY", "BOTH")


class TableCall:
    """A call that a select, a join or the session turns into rows."""

    def join(self, df: DataFrame, partition_by: Sequence = (), order_by: Sequence = ()) -> tuple[DataFrame, list[str]]:
        """df with the call's columns appended, and their names."""
        raise NotImplementedError

    def alone(self, spark: SparkSession) -> DataFrame:
        one = spark.range(1).withColumnRenamed("id", "_one")
        return self.join(one)[0].drop("_one")


class _Generated(TableCall):
    def __init__(self, expand, names: list[str]):
        self.expand, self.names = expand, names

    def join(self, df, partition_by=(), order_by=()):
        if partition_by or order_by:
            raise ValueError("only user-defined table functions take partitions")
        return self.expand(df), self.names


def split_to_table(text: Any, delimiter: Any) -> TableCall:
    """SEQ, INDEX (from 1) and VALUE of each part of a text."""

    def expand(df: DataFrame) -> DataFrame:
        parts = df.withColumn("SEQ", F.monotonically_increasing_id()).select("*", F.posexplode(split_literal(text, delimiter)).alias("INDEX", "VALUE"))
        return parts.withColumn("INDEX", F.col("INDEX") + 1)

    return _Generated(expand, ["SEQ", "INDEX", "VALUE"])


def explode(column: Any) -> TableCall:
    """VALUE of each array element, or KEY and VALUE of each map entry."""

    class Call(TableCall):
        def join(self, df, partition_by=(), order_by=()):
            kind = df.select(as_column(column)).schema[0].dataType
            if not isinstance(kind, (ArrayType, MapType)):
                raise ValueError(f"explode takes an array or a map, not {kind.simpleString()}")
            names = ["VALUE"] if isinstance(kind, ArrayType) else ["KEY", "VALUE"]
            return df.select("*", F.explode(as_column(column)).alias(*names)), names

    return Call()


def flatten(column: Any, path: str = "", outer: bool = False, recursive: bool = False, mode: str = "BOTH") -> TableCall:
    return _Generated(lambda df: flatten_frame(df, as_column(column), path, outer, recursive, mode), ["SEQ", "KEY", "PATH", "INDEX", "VALUE", "THIS"])


_ENCODE = json.JSONEncoder(ensure_ascii=False).encode
#: So many texts are walked before their parts leave Python's objects for Arrow's memory.
WALKED = 256


def _parts(text: str, mode: str) -> Iterator[tuple]:
    """(key, path, index, value, this) of all parts of a JSON text, JSON texts for the last two."""

    def walk(node: Any, path: str) -> Iterator[tuple]:
        if isinstance(node, dict):
            items = [(k, f"{path}.{k}" if path else k, None, v) for k, v in node.items()]
        elif isinstance(node, list):
            items = [(None, f"{path}[{i}]", i, v) for i, v in enumerate(node)]
        else:
            return
        wanted = mode == "BOTH" or (mode == "OBJECT") == isinstance(node, dict)
        this = _ENCODE(node) if wanted else None
        for key, at, index, value in items:
            if wanted:
                yield key, at, index, _ENCODE(value), this
            if isinstance(value, (dict, list)):
                yield from walk(value, at)

    return walk(json.loads(text), "")


def _walked(mode: str):
    """All parts of each text of an Arrow batch, as lists of structs: a batch's parts are never all Python objects at once."""
    fields = [pa.field(n, pa.int32() if n == "INDEX" else pa.string()) for n in ("KEY", "PATH", "INDEX", "VALUE", "THIS")]
    kind = pa.list_(pa.field("element", pa.struct(fields)))

    def some(texts: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in fields]
        ends: list[int] = [0]
        for text in texts.to_pylist():
            for part in () if text is None else _parts(text, mode):
                for column, x in zip(columns, part, strict=True):
                    column.append(x)
            ends.append(len(columns[0]))
        parts = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts, type=kind, mask=texts.is_null())

    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([some(texts.slice(i, WALKED)) for i in range(0, max(1, len(texts)), WALKED)])

    return run


_PART = "array<struct<KEY:string,PATH:string,INDEX:int,VALUE:string,THIS:string>>"


def flatten_frame(df: DataFrame, column: Column, path: str = "", outer: bool = False, recursive: bool = False, mode: str = "BOTH") -> DataFrame:
    """One level stays in Spark's own functions; only recursion walks the JSON in an Arrow-batched function."""
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode}")
    kind = df.select(column).schema[0].dataType
    # a source column with the name of one of the six new ones is prefixed
    names = ["SEQ", "KEY", "PATH", "INDEX", "VALUE", "THIS"]
    base = df.withColumn("_v", column).withColumnsRenamed({c: f"l_{c}" for c in df.columns if c.upper() in names})
    if isinstance(kind, StringType):
        v = F.parse_json("_v")
    elif kind.simpleString() == "variant":
        v = F.col("_v")
    else:
        v = F.parse_json(F.to_json("_v"))
    base = base.withColumns({"SEQ": F.monotonically_increasing_id(), "_v": F.try_variant_get(v, variant_path(path), "variant") if path else v})
    if recursive:
        parts = F.arrow_udf(_walked(mode), _PART)(F.to_json("_v"))
    else:
        t = F.schema_of_variant("_v")
        entries = F.map_entries(F.when(t.startswith("OBJECT"), F.try_variant_get("_v", "$", "map<string,variant>")))
        elements = F.when(t.startswith("ARRAY"), F.try_variant_get("_v", "$", "array<variant>"))
        this = F.col("_v")
        from_object = F.transform(entries, lambda e: F.struct(e["key"].alias("KEY"), e["key"].alias("PATH"), F.lit(None).cast("int").alias("INDEX"), e["value"].alias("VALUE"), this.alias("THIS")))
        from_array = F.transform(elements, lambda e, i: F.struct(F.lit(None).cast("string").alias("KEY"), F.concat(F.lit("["), i.cast("string"), F.lit("]")).alias("PATH"), i.alias("INDEX"), e.alias("VALUE"), this.alias("THIS")))
        parts = from_object if mode == "OBJECT" else from_array if mode == "ARRAY" else F.coalesce(from_object, from_array)
    rows = base.withColumn("_parts", parts)
    rows = rows.select("*", (F.explode_outer if outer else F.explode)("_parts").alias("_p")).select("*", "_p.*").drop("_parts", "_p", "_v")
    if recursive:
        rows = rows.withColumns({c: F.parse_json(c) for c in ("VALUE", "THIS")})
    if path:
        rows = rows.withColumn("PATH", F.when(F.col("PATH").isNotNull(), F.concat(F.lit(path), F.when(F.col("PATH").startswith("["), F.lit("")).otherwise(F.lit(".")), F.col("PATH"))))
    return rows.select(*[c for c in rows.columns if c not in names], *names)


class TableFunction:
    """A named table function of the session; a call takes positional or named columns."""

    def __init__(self, name: str):
        self.name = name

    def __call__(self, *args: Any, **named: Any) -> TableCall:
        return _Named(self.name, args, named)


class _Named(TableCall):
    def __init__(self, name: str, args: tuple, named: dict):
        self.name, self.args, self.named = name, args, named

    def join(self, df, partition_by=(), order_by=()):
        spark = df.sparkSession
        low = self.name.lower()
        if low in ("flatten", "split_to_table", "explode"):
            return {"flatten": flatten, "split_to_table": split_to_table, "explode": explode}[low](*self.args, **self.named).join(df, partition_by, order_by)
        view = f"_tf_{abs(hash((self.name, id(self))))}"
        args = [as_column(a) for a in self.args] + [as_column(a) for a in self.named.values()]
        keyed = df.select("*", *[a.alias(f"_a{i}") for i, a in enumerate(args)])
        keyed.createOrReplaceTempView(view)
        names = ", ".join([f"_a{i}" for i in range(len(self.args))] + [f"{k} => _a{i + len(self.args)}" for i, k in enumerate(self.named)])
        if partition_by or order_by:
            # the function sees whole groups; what it returns stands beside the group's keys if it returns them
            keyed = keyed.select(*[as_column(p).alias(f"_p{i}") for i, p in enumerate(partition_by)], *[as_column(o).alias(f"_o{i}") for i, o in enumerate(order_by)], *[f"_a{i}" for i in range(len(args))])
            keyed.createOrReplaceTempView(view)
            by = ("PARTITION BY " + ", ".join(f"_p{i}" for i in range(len(partition_by)))) if partition_by else "WITH SINGLE PARTITION"
            order = (" ORDER BY " + ", ".join(f"_o{i}" for i in range(len(order_by)))) if order_by else ""
            out = spark.sql(f"SELECT * FROM {self.name}(TABLE({view}) {by}{order})")
            return out, out.columns
        out = spark.sql(f"SELECT * FROM {view}, LATERAL {self.name}({names})").drop(*[f"_a{i}" for i in range(len(args))])
        return out, out.columns[len(df.columns) :]
