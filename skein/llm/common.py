"""What the operators of this subpackage share: reading tables, written intermediates, exact distributed ranks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A side of a join is broadcast only if the measured bytes of its rows stay under this.
BROADCAST_BYTES = 16 * 2**20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """Tables written to the shared folder that the cluster names in spark.checkpoint.dir.

    Writing cuts the lineage, so lost executors only cost the stages since the last write, and a read of few
    columns stays a read of few columns. Only where that setting is unset (tests) is a local folder used.
    """

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(tempfile.gettempdir(), "skein-checkpoints")
        self.spark, self.root = spark, f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def width(df: DataFrame) -> Column:
    """About the bytes of a row: fixed-width columns as 16, texts and arrays as measured."""
    size = F.lit(16)
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        more = F.octet_length(c) if kind in ("string", "binary") else F.size(c) * 16 if kind == "array" else F.lit(0)
        size += F.coalesce(more, F.lit(0)) + 16
    return size


def small(df: DataFrame, row_bytes: int | Column | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if the summed bytes of its rows fit the limit; else unchanged, for a shuffled join.

    A number stands for rows of fixed width; without one each row is measured.
    """
    size = width(df) if row_bytes is None else row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= limit else df


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct `_in`, so that none can clash with a column that an operator adds for itself."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_in"))


def inside(name: str) -> Column:
    """A column of packed rows."""
    return F.col(f"_in.`{name}`")


def fresh(name: str, df: DataFrame) -> str:
    """`name`, or a longer one if df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def running(ws: Workspace, name: str, df: DataFrame, key: str, order: list[str], amount: Column, rows_per_bucket: int = 50_000) -> DataFrame:
    """Adds `before`: the exact sum of `amount` over the rows of the same key that come earlier in `order`.

    A window over a hot key would put a third of all rows into one task. Here rows are dealt by range of
    (key, order), so that a key spans as many partitions as it needs; each partition ranks its own rows, and
    the sums of whole partitions (one row for each partition and key in it) are added. `order` must be total;
    rows that tie in all of it share no defined sequence among themselves.
    """
    n = max(1, -(-df.count() // rows_per_bucket))
    # the partition number is only stable once it is written
    dealt = ws.put(name, df.withColumn("_range_amount", amount.cast("long")).repartitionByRange(n, key, *order).withColumn("_range_part", F.spark_partition_id()))
    sums = dealt.groupBy(key, "_range_part").agg(F.sum("_range_amount").alias("_range_sum"))
    w = Window.partitionBy(key).orderBy("_range_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(key).alias("_range_key"), F.col("_range_part").alias("_range_p"), F.coalesce(F.sum("_range_sum").over(w), F.lit(0)).alias("_range_offset"))
    inside = Window.partitionBy("_range_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("_range_inside", F.coalesce(F.sum("_range_amount").over(inside), F.lit(0)))
    joined = ranked.join(small(offsets, 64), (F.col("_range_part") == F.col("_range_p")) & F.col(key).eqNullSafe(F.col("_range_key")))
    return joined.withColumn("before", F.col("_range_offset") + F.col("_range_inside")).drop("_range_key", "_range_p", "_range_part", "_range_offset", "_range_inside", "_range_amount")


def renumbered(ws: Workspace, name: str, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """df with its column _id as a long, and the table (_id, _name) that leads back.

    Whole numbers stay as they are, without a table. Ids of other types get their place in the order of all ids, so
    the smallest one stays the smallest; that costs one more join.
    """
    if df.schema["_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return df.withColumn("_id", F.col("_id").cast("long")), None
    names = df.select(F.col("_id").alias("_name")).filter("_name is not null").distinct().withColumn("_all", F.lit(0))
    ranked = running(ws, f"{name}_rank", names, "_all", ["_name"], F.lit(1))
    names = ws.put(name, ranked.select(F.col("before").alias("_id"), "_name"))
    ws.drop(f"{name}_rank")
    columns = [c for c in df.columns if c != "_id"]
    return ws.put(f"{name}_rows", df.withColumnRenamed("_id", "_name").join(names, "_name", "left").select("_id", *columns)), names


def block_pairs(rows: DataFrame, first: Column, n_first: Column, n_second: Column, key: str) -> DataFrame:
    """One row for each pair of blocks (_i, _j), _i <= _j, that a row takes part in, on _side 0 (block _i) or 1 (block _j).

    Rows of the first kind are dealt by a hash of `key` over n_first blocks, those of the second kind over n_second further
    ones. First blocks meet each other and themselves once, and all second blocks; second blocks don't meet each other.
    """
    own = F.pmod(F.xxhash64(key), F.greatest(F.when(first, n_first).otherwise(n_second), F.lit(1))).cast("int")
    rows = rows.withColumn("_block", F.when(first, own).otherwise(own + n_first).cast("int"))
    left = rows.filter(first).withColumns({"_i": F.col("_block"), "_j": F.explode(F.sequence(F.col("_block"), n_first + n_second - 1)), "_side": F.lit(0)})
    right = rows.filter((F.col("_block") > 0) & (n_first > 0)).withColumns({"_j": F.col("_block"), "_i": F.explode(F.sequence(F.lit(0), F.least(F.col("_block"), n_first) - 1)), "_side": F.lit(1)})
    return left.unionByName(right)


def components(ws: Workspace, name: str, edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) long edges: (node, label), label the smallest node of the component.

    Alternating stars: every node points its larger neighbours at the smallest node it sees, then its smaller
    ones. The number of rounds grows with the logarithm of the longest path, each round writes its edges, and no
    component is ever gathered in a task: minima are pre-aggregated and a hot node's rows can be split.
    """
    last, now = None, ws.put(f"{name}0", edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    k = 0
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last, k = state, k + 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ws.put(f"{name}{k}m", both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = ws.put(f"{name}{k}l", large)
        least = ws.put(f"{name}{k}n", large.groupBy("a").agg(F.min("b").alias("m")))
        star = large.join(least, "a").select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = star.unionByName(least.select("a", F.col("m").alias("b")))
        was, now = f"{name}{k - 1}", ws.put(f"{name}{k}", star.distinct())
        ws.drop(was, f"{name}{k}m", f"{name}{k}l", f"{name}{k}n")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))


def words(text: Column) -> Column:
    """Runs of letters, marks and digits of the lower-cased text; null gives an empty array."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))
