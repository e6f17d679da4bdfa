"""Table functions, sources and sinks, changes of tables, user-defined functions."""

import os
import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import functions as F

from skein.operators import udx
from skein.operators.table_functions import split_to_table
from skein.session import Session

from .registry import query
from .relational_queries import t


def folder(spark, name):
    """A new folder in the shared place that the cluster names; a local one only where Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "skein-files")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("""select item_id, i "INDEX", w "VALUE" from (select item_id, unnest(string_split(text, ' ')) w, unnest(range(1, len(string_split(text, ' ')) + 1))::int i from benchmark)""")
def lateral_split(spark, d):
    return t(spark, d, "benchmark").join(split_to_table("text", " ")).select("item_id", "INDEX", "VALUE")


@query("""select event_id, key "KEY", json_extract(props, '$.' || key)::bigint "VALUE" from (select event_id, props, unnest(json_keys(props)) key from events)""")
def flatten_json(spark, d):
    return t(spark, d, "events").flatten("props").select("event_id", "KEY", F.col("VALUE").cast("bigint").alias("VALUE"))


@query("""select event_id, p "PATH" from events, (values ('a'), ('a.k'), ('b'), ('b[0]'), ('b[1]'), ('b[1].k')) x(p)""")
def flatten_recursive(spark, d):
    nested = F.concat(F.lit('{"a": '), "props", F.lit(', "b": [1, '), "props", F.lit("]}"))
    return t(spark, d, "events").withColumn("j", nested).flatten("j", recursive=True).select("event_id", "PATH")


@query("select vec_id, unnest(embedding) \"VALUE\" from embeddings")
def explode_array(spark, d):
    return t(spark, d, "embeddings").explode("embedding").select("vec_id", "VALUE")


def copy_of(spark, d, name):
    """A table of the session's catalog with the rows of a file."""
    target = f"q_{name}_{uuid.uuid4().hex[:8]}"
    s = Session(spark)
    t(spark, d, name).write.saveAsTable(target)
    return s.table(target)


@query("select o_orderkey, case when o_orderstatus = 'F' then 0.0 else o_totalprice end o_totalprice from orders")
def update_table(spark, d):
    o = copy_of(spark, d, "orders")
    o.update({"o_totalprice": F.lit(0.0)}, F.col("o_orderstatus") == "F")
    return o.select("o_orderkey", "o_totalprice")


@query("select o_orderkey from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_mktsegment = 'BUILDING')")
def delete_rows(spark, d):
    o, c = copy_of(spark, d, "orders"), t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    o.delete(F.col("c_custkey") == F.col("o_custkey"), c)
    return o.select("o_orderkey")


@query("""select n_nationkey, case when n_regionkey = 1 then 'changed' else n_name end n_name, n_regionkey from nation where n_regionkey <> 2
    union all select r_regionkey + 1000, r_name, r_regionkey from region""")
def merge_rows(spark, d):
    n = copy_of(spark, d, "nation")
    source = t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.lit("changed").alias("v"), F.col("n_regionkey").alias("r")).filter("r in (1, 2)")
    fresh = t(spark, d, "region").select((F.col("r_regionkey") + 1000).alias("k"), F.col("r_name").alias("v"), F.col("r_regionkey").alias("r"))
    merge = n.merge(source.unionAll(fresh), F.col("n_nationkey") == F.col("k")).whenMatched(F.col("r") == 1).update({"n_name": F.col("v")}).whenMatched().delete()
    merge.whenNotMatched().insert([F.col("k"), F.col("v"), F.col("r")]).collect()
    return n


@query("select * from nation")
def csv_round_trip(spark, d):
    n, path = t(spark, d, "nation"), folder(spark, "csv")
    n.write.option("HEADER", True).csv(path)
    return Session(spark).read.schema(n.schema).option("SKIP_HEADER", 1).csv(path)


@query("select n_nationkey, n_name from nation")
def json_variant(spark, d):
    path = folder(spark, "json")
    t(spark, d, "nation").write.json(path)
    v = Session(spark).read.json(path)
    return v.select(F.variant_get("$1", "$.n_nationkey", "int").alias("n_nationkey"), F.variant_get("$1", "$.n_name", "string").alias("n_name"))


@query("select r_regionkey, r_name from region")
def orc_xml_round_trip(spark, d):
    path = folder(spark, "orc")
    t(spark, d, "region").df.write.orc(path)
    v = Session(spark).read.orc(path)
    return v.select(F.variant_get("$1", "$.r_regionkey", "int").alias("r_regionkey"), F.variant_get("$1", "$.r_name", "string").alias("r_name"))


@query("select n_nationkey + 100 n_nationkey, upper(n_name) n_name, null::int n_regionkey from nation")
def copy_into(spark, d):
    n, path, target = t(spark, d, "nation"), folder(spark, "load"), f"q_load_{uuid.uuid4().hex[:8]}"
    n.write.csv(path)
    n.limit(0).write.saveAsTable(target)
    files = Session(spark).read.schema(n.schema).csv(path)
    files.copyInto(target, ["n_nationkey", "n_name"], [F.col("n_nationkey") + 100, F.upper("n_name")])
    files.copyInto(target, ["n_nationkey", "n_name"], [F.col("n_nationkey") + 100, F.upper("n_name")])  # loaded already
    return Session(spark).table(target)


@query("select c_custkey, c_acctbal * 2 + 1 x from customer")
def udf_scalar(spark, d):
    f = udx.UdfRegistration(spark).registerTemporary(lambda s: s * 2 + 1, "double", vectorized=False)
    return t(spark, d, "customer").select("c_custkey", f("c_acctbal").alias("x"))


class _Words:
    def process(self, text):
        for w in re.findall(r"[^\t\n\f\r ]+", text or ""):  # what \S means in SQL, where a no-break space is part of a word
            yield (w, len(w))


@query("select item_id, w word, length(w)::int n from (select item_id, unnest(regexp_extract_all(text, '\\S+')) w from benchmark)")
def udtf_words(spark, d):
    f = udx.UdtfRegistration(spark).registerTemporary(_Words, "word string, n int")
    return t(spark, d, "benchmark").join(f("text")).select("item_id", "word", "n")


class _Mean:
    def initialize(self):
        return (0.0, 0)

    def accumulate(self, state, x):
        return state if x is None else (state[0] + x, state[1] + 1)

    def merge(self, a, b):
        return (a[0] + b[0], a[1] + b[1])

    def terminate(self, state):
        return round(state[0] / state[1], 4) if state[1] else None


@query("select l_returnflag, round(avg(l_quantity), 4) m from lineitem group by 1")
def udaf_mean(spark, d):
    agg = udx.UdafRegistration(spark).registerTemporary(_Mean, "double")
    return agg.partial(t(spark, d, "lineitem").df, ["l_returnflag"], ["l_quantity"], "m")


@query("select c_custkey, lower(c_mktsegment) s from customer")
def udf_vectorised(spark, d):
    def low(s: pd.Series) -> pd.Series:
        return s.str.lower()

    f = udx.UdfRegistration(spark).registerTemporary(low, "string", vectorized=True)
    return t(spark, d, "customer").select("c_custkey", f("c_mktsegment").alias("s"))


@query("select n_regionkey + 1 x from nation")
def procedure_call(spark, d):
    s = Session(spark)
    p = s.sproc.registerTemporary(lambda session, by: t(session.spark, d, "nation").select((F.col("n_regionkey") + by).alias("x")), "add_to_region")
    return s.storedProcedure(p, 1)


@query("select c_custkey from customer where c_nationkey = 3 and c_acctbal > 10")
def sql_text(spark, d):
    t(spark, d, "customer").createOrReplaceTempView("q_customer")
    return Session(spark).sql("select c_custkey from q_customer where c_nationkey = ? and c_acctbal > ?", [3, 10])


@query("select count(*) n from orders where o_orderstatus = 'F'")
def async_count(spark, d):
    job = t(spark, d, "orders").filter("o_orderstatus = 'F'").async_.count()
    return spark.createDataFrame([(job.getResult(600),)], "n long")


@query("select n_nationkey from nation where n_regionkey = 2")
def view_over_table(spark, d):
    n, view = copy_of(spark, d, "nation"), f"q_view_{uuid.uuid4().hex[:8]}"
    Session(spark).sql(f"select n_nationkey from {n.name} where n_regionkey = 2").createOrReplaceView(view)
    return Session(spark).table(view)


@query("select r_regionkey, r_name from region where r_regionkey > 1 union all select r_regionkey, r_name from region where r_regionkey > 1")
def save_modes(spark, d):
    target, r = f"q_modes_{uuid.uuid4().hex[:8]}", t(spark, d, "region")
    r.write.saveAsTable(target)
    r.filter("r_regionkey > 1").write.mode("overwrite").saveAsTable(target)
    r.filter("r_regionkey > 1").write.option("COLUMNORDER", "name").saveAsTable(target)
    r.write.mode("ignore").saveAsTable(target)
    return Session(spark).table(target)


@query("select r_regionkey k, r_name v from region")
def xml_variant(spark, d):
    path = folder(spark, "xml")
    t(spark, d, "region").df.write.option("rowTag", "row").xml(path)
    x = Session(spark).read.option("ROW_TAG", "row").xml(path)
    return x.select(F.variant_get("$1", "$.r_regionkey", "int").alias("k"), F.variant_get("$1", "$.r_name", "string").alias("v"))
