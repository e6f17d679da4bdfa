"""Projection, joins, grouping, windows, sets, missing values."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein import functions as S
from skein.operators.frame import Frame

from .registry import query


def t(spark, d, name):
    return Frame(spark.read.parquet(f"{d}/{name}.parquet"))


@query("""select l_returnflag, l_linestatus, round(sum(l_quantity), 2) sum_qty, round(sum(l_extendedprice), 2) sum_base_price,
    round(sum(l_extendedprice * (1 - l_discount)), 2) sum_disc_price, round(avg(l_quantity), 4) avg_qty, count(*) count_order
    from lineitem where l_shipdate <= timestamp '1998-09-02' group by all""")
def pricing_summary(spark, d):
    li = t(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(S.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(S.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(S.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"),
        F.round(S.avg("l_quantity"), 4).alias("avg_qty"),
        S.count("*").alias("count_order"),
    ).sort("l_returnflag", "l_linestatus")


@query("select o_orderkey, o_totalprice * 2 doubled, o_orderstatus status from orders where o_totalprice > 1000 and o_orderstatus in ('F', 'O')")
def project_filter(spark, d):
    o = t(spark, d, "orders")
    o = o.filter((F.col("o_totalprice") > 1000) & S.in_("o_orderstatus", ["F", "O"]))
    return o.withColumn("doubled", F.col("o_totalprice") * 2).select("o_orderkey", "doubled", "o_orderstatus").rename("status", "o_orderstatus")


@query("select c_custkey, c_name, n_name from customer join nation on c_nationkey = n_nationkey where c_acctbal > 0")
def join_inner(spark, d):
    c, n = t(spark, d, "customer"), t(spark, d, "nation")
    return c.filter("c_acctbal > 0").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query("select c_custkey, count(o_orderkey) n from customer left join orders on c_custkey = o_custkey and o_totalprice > 100000 group by 1")
def join_left(spark, d):
    c, o = t(spark, d, "customer"), t(spark, d, "orders").filter("o_totalprice > 100000")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(S.count("o_orderkey").alias("n"))


@query("select s_suppkey, c_custkey from supplier right join customer on s_suppkey = c_custkey")
def join_right(spark, d):
    s, c = t(spark, d, "supplier"), t(spark, d, "customer")
    return s.join(c, F.col("s_suppkey") == F.col("c_custkey"), "rightouter").select("s_suppkey", "c_custkey")


@query("select s_suppkey, c_custkey from supplier full join customer on s_suppkey = c_custkey + 3")
def join_full(spark, d):
    s, c = t(spark, d, "supplier"), t(spark, d, "customer")
    return s.join(c, F.col("s_suppkey") == F.col("c_custkey") + 3, "full_outer").select("s_suppkey", "c_custkey")


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority like '1%')")
def join_semi(spark, d):
    c, o = t(spark, d, "customer"), t(spark, d, "orders").filter(S.like("o_orderpriority", "1%"))
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "leftsemi").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def join_anti(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "leftanti").select("c_custkey")


@query("select r_name, n_name from region cross join nation")
def join_cross(spark, d):
    return t(spark, d, "region").crossJoin(t(spark, d, "nation")).select("r_name", "n_name")


@query("select k, r_name, n_name from (select r_regionkey k, r_name from region) natural full join (select n_nationkey k, n_name from nation)")
def join_natural(spark, d):
    r = t(spark, d, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return r.naturalJoin(n, "full").select("k", "r_name", "n_name")


@query("select a.n_name a, b.n_name b from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")
def join_self(spark, d):
    n = t(spark, d, "nation")
    a, b = n.alias("a"), n.clone().alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_name").alias("a"), F.col("b.n_name").alias("b"))


@query("select n_name, r_name from nation join region on n_nationkey < r_regionkey * 3")
def join_theta(spark, d):
    return t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_nationkey") < F.col("r_regionkey") * 3).select("n_name", "r_name")


@query("""select r_name, n_name, round(sum(o_totalprice), 2) total from region join nation on r_regionkey = n_regionkey join customer on n_nationkey = c_nationkey
    join orders on c_custkey = o_custkey group by 1, 2""")
def join_chain(spark, d):
    r, n, c, o = (t(spark, d, x) for x in ("region", "nation", "customer", "orders"))
    j = r.join(n, F.col("r_regionkey") == F.col("n_regionkey")).join(c, F.col("n_nationkey") == F.col("c_nationkey")).join(o, F.col("c_custkey") == F.col("o_custkey"))
    return j.groupBy("r_name", "n_name").agg(F.round(S.sum("o_totalprice"), 2).alias("total"))


@query("select c_mktsegment, c_nationkey, count(*) n, grouping_id(c_mktsegment, c_nationkey)::bigint g from customer group by rollup (c_mktsegment, c_nationkey)")
def rollup_segment(spark, d):
    return t(spark, d, "customer").rollup("c_mktsegment", "c_nationkey").agg(S.count("*").alias("n"), S.grouping_id("c_mktsegment", "c_nationkey").alias("g"))


@query("select o_orderstatus, o_orderpriority, count(*) n from orders group by cube (o_orderstatus, o_orderpriority)")
def cube_orders(spark, d):
    return t(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(S.count("*").alias("n"))


@query("select o_orderstatus, o_orderpriority, count(*) n from orders group by grouping sets ((o_orderstatus), (o_orderpriority))")
def grouping_sets(spark, d):
    return t(spark, d, "orders").groupByGroupingSets(["o_orderstatus"], ["o_orderpriority"]).agg(S.count("*").alias("n"))


@query("""select o_orderpriority, round(sum(o_totalprice) filter (o_orderstatus = 'F'), 2) "F", round(sum(o_totalprice) filter (o_orderstatus = 'O'), 2) "O" from orders group by 1""")
def pivot_status(spark, d):
    p = t(spark, d, "orders").select("o_orderpriority", "o_orderstatus", "o_totalprice").pivot("o_orderstatus", ["F", "O"]).sum("o_totalprice")
    return p.select("o_orderpriority", F.round("F", 2).alias("F"), F.round("O", 2).alias("O"))


@query("""select o_orderkey, row_number() over w rn, rank() over w rk, dense_rank() over w dr, ntile(4) over w nt, round(percent_rank() over w, 9) pr,
    round(cume_dist() over w, 9) cd from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def rank_functions(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", S.row_number().over(w).cast("long").alias("rn"), S.rank().over(w).cast("long").alias("rk"), S.dense_rank().over(w).cast("long").alias("dr"), S.ntile(4).over(w).cast("long").alias("nt"), F.round(S.percent_rank().over(w), 9).alias("pr"), F.round(S.cume_dist().over(w), 9).alias("cd"))


@query("""select o_orderkey, lag(o_totalprice, 1, -1.0) over w prev, lead(o_totalprice) over w next, last_value(o_orderkey) over
    (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and unbounded following) final
    from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def lag_lead_last(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", S.lag("o_totalprice", 1, -1.0).over(w).alias("prev"), S.lag("o_totalprice", -1).over(w).alias("next"), S.last("o_orderkey").over(w).alias("final"))


@query("""select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows between 1 preceding and current row), 2) moving,
    count(*) over (partition by o_custkey order by o_orderkey range between 2000 preceding and 1000 following) near from orders""")
def window_frames(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", F.round(S.sum("o_totalprice").over(w.rowsBetween(-1, Window.currentRow)), 2).alias("moving"), S.count("*").over(w.rangeBetween(-2000, 1000)).alias("near"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_orders(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_totalprice").sort(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(10)


@query("select n_nationkey k from nation union select c_nationkey from customer")
def union_distinct(spark, d):
    return t(spark, d, "nation").select(F.col("n_nationkey").alias("k")).union(t(spark, d, "customer").select("c_nationkey"))


@query("select n_nationkey k from nation union all select s_nationkey from supplier")
def union_all(spark, d):
    return t(spark, d, "nation").select(F.col("n_nationkey").alias("k")).unionAll(t(spark, d, "supplier").select("s_nationkey"))


@query("select a, b from (select n_name a, n_regionkey b from nation union by name select r_regionkey b, r_name a from region)")
def union_by_name(spark, d):
    n = t(spark, d, "nation").select(F.col("n_name").alias("a"), F.col("n_regionkey").alias("b"))
    return n.unionByName(t(spark, d, "region").select(F.col("r_regionkey").alias("b"), F.col("r_name").alias("a")))


@query("select c_nationkey k from customer intersect select s_nationkey from supplier")
def intersect_keys(spark, d):
    return t(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(t(spark, d, "supplier").select("s_nationkey"))


@query("select c_custkey k from customer except select o_custkey from orders")
def except_keys(spark, d):
    return t(spark, d, "customer").select(F.col("c_custkey").alias("k")).except_(t(spark, d, "orders").select("o_custkey"))


@query("select distinct user_id, event_type from events")
def distinct_rows(spark, d):
    return t(spark, d, "events").select("user_id", "event_type").distinct()


@query("select event_type, count(*) n from (select distinct on (user_id, event_type) * from events) group by 1")
def drop_duplicates(spark, d):
    return t(spark, d, "events").dropDuplicates("user_id", "event_type").groupBy("event_type").agg(S.count("*").alias("n"))


_GAPS = "(select event_id, nullif(user_id % 5, 0) u, case when event_id % 7 = 0 then 'nan'::double when event_id % 3 = 0 then null else value end v, nullif(event_type, 'view') e from events)"


def gaps(spark, d):
    v = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 3 == 0, None).otherwise(F.col("value"))
    return t(spark, d, "events").select("event_id", S.iff(F.col("user_id") % 5 == 0, None, F.col("user_id") % 5).alias("u"), v.alias("v"), F.nullif(F.col("event_type"), F.lit("view")).alias("e"))


@query(f"select * from {_GAPS} where (u is not null)::int + (v is not null and not isnan(v))::int + (e is not null)::int >= 2")
def na_drop(spark, d):
    return gaps(spark, d).na.drop(2, ["u", "v", "e"])


@query(f"select event_id, coalesce(u, -1) u, case when v is null or isnan(v) then 0.5 else v end v, coalesce(e, 'none') e from {_GAPS}")
def na_fill(spark, d):
    return gaps(spark, d).na.fill({"u": -1, "v": 0.5, "e": "none"})


@query(f"select event_id, u, case when e is null then 'missing' when e = 'click' then null else e end e from {_GAPS}")
def na_replace(spark, d):
    return gaps(spark, d).na.replace("e", {None: "missing", "click": None}).select("event_id", "u", "e")


@query("""select o_orderstatus, count(*) filter (o_orderpriority = '1-URGENT') "1-URGENT", count(*) filter (o_orderpriority = '2-HIGH') "2-HIGH", count(*) filter (o_orderpriority = '3-MEDIUM') "3-MEDIUM", count(*) filter (o_orderpriority = '4-NOT SPECIFIED') "4-NOT SPECIFIED", count(*) filter (o_orderpriority = '5-LOW') "5-LOW" from orders group by 1""")
def crosstab(spark, d):
    return t(spark, d, "orders").stat.crosstab("o_orderstatus", "o_orderpriority")


@query("select round(corr(l_quantity, l_extendedprice), 9) corr, round(covar_samp(l_quantity, l_extendedprice), 3) cov from lineitem")
def corr_cov(spark, d):
    li = t(spark, d, "lineitem")
    return li.agg(F.round(S.corr("l_quantity", "l_extendedprice"), 9).alias("corr"), F.round(S.covar_samp("l_quantity", "l_extendedprice"), 3).alias("cov"))


@query("""select l_returnflag, round(stddev(l_quantity), 6) sd, round(stddev_pop(l_quantity), 6) sp, round(variance(l_quantity), 6) v, round(var_pop(l_quantity), 6) vp,
    median(l_quantity) med, round(skewness(l_quantity), 6) sk, round(kurtosis(l_quantity), 6) ku, count(distinct l_suppkey) nd, round(sum(distinct l_quantity), 2) sd2,
    round(covar_pop(l_quantity, l_discount), 6) cp, min(l_tax) lo, max(l_tax) hi, round(quantile_cont(l_extendedprice, 0.9), 4) p90 from lineitem group by 1""")
def statistics(spark, d):
    r = lambda c, n: F.round(c, n)
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(
        r(S.stddev("l_quantity"), 6).alias("sd"), r(S.stddev_pop("l_quantity"), 6).alias("sp"), r(S.variance("l_quantity"), 6).alias("v"), r(S.var_pop("l_quantity"), 6).alias("vp"),
        S.median("l_quantity").alias("med"), r(S.skew("l_quantity"), 6).alias("sk"), r(S.kurtosis("l_quantity"), 6).alias("ku"), S.count_distinct("l_suppkey").alias("nd"), r(S.sum_distinct("l_quantity"), 2).alias("sd2"),
        r(S.covar_pop("l_quantity", "l_discount"), 6).alias("cp"), S.min("l_tax").alias("lo"), S.max("l_tax").alias("hi"), r(S.approx_percentile("l_extendedprice", 0.9), 4).alias("p90"),
    )


@query("select n_regionkey, string_agg(n_name, ', ' order by n_name) names, list(n_nationkey order by n_nationkey) keys from nation group by 1")
def list_aggregates(spark, d):
    n = t(spark, d, "nation")
    return n.groupBy("n_regionkey").agg(S.listagg_within_group("n_name", ", ", "n_name").alias("names"), F.sort_array(S.array_agg("n_nationkey")).alias("keys"))


@query("select c_custkey, c_acctbal from customer where c_acctbal > (select avg(c_acctbal) from customer)")
def scalar_subquery(spark, d):
    c = t(spark, d, "customer")
    mean = c.clone().agg(S.avg("c_acctbal").alias("m"))
    return c.filter(F.col("c_acctbal") > S.toScalar(mean)).select("c_custkey", "c_acctbal")


@query("select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def in_subquery(spark, d):
    c = t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    return t(spark, d, "orders").filter(S.in_("o_custkey", c)).select("o_orderkey")


@query("select i id, i * 2 twice from range(0, 100, 3) r(i)")
def range_generator(spark, d):
    from skein.session import Session

    return Session(spark).range(0, 100, 3).select(F.col("ID").alias("id"), (F.col("ID") * 2).alias("twice"))


@query()
def approx_distinct(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(S.approx_count_distinct("l_partkey").alias("n"))


@query()
def sample_rows(spark, d):
    return t(spark, d, "events").sample(n=100).select("event_id")


@query()
def sample_by(spark, d):
    return t(spark, d, "events").stat.sampleBy("event_type", {"click": 0.5, "view": 0.1}).select("event_id", "event_type")


@query("select n_name a, n_regionkey b from nation union all by name select r_regionkey b, r_name a from region")
def union_all_by_name(spark, d):
    n = t(spark, d, "nation").select(F.col("n_name").alias("a"), F.col("n_regionkey").alias("b"))
    return n.unionAllByName(t(spark, d, "region").select(F.col("r_regionkey").alias("b"), F.col("r_name").alias("a")))


@query("select c_mktsegment, count(*) n, sum(c_custkey)::bigint s from customer group by 1")
def cached_result(spark, d):
    c = t(spark, d, "customer").select("c_mktsegment", "c_custkey").cacheResult()
    return c.groupBy("c_mktsegment").agg(S.count("*").alias("n"), S.sum("c_custkey").alias("s"))


@query("select c_custkey, not (c_acctbal > 0) neg, (c_custkey & 6) b, (c_custkey | 1) o, xor(c_custkey, 5::bigint) x, c_acctbal between 0 and 100 m, c_custkey + 1 p, c_custkey % 7 r from customer")
def column_operators(spark, d):
    k = "c_custkey"
    return t(spark, d, "customer").select(k, S.not_(S.gt("c_acctbal", 0)).alias("neg"), S.bitand(k, F.lit(6).cast("long")).alias("b"), S.bitor(k, F.lit(1).cast("long")).alias("o"), S.bitxor(k, F.lit(5).cast("long")).alias("x"), S.between("c_acctbal", 0, 100).alias("m"), S.plus(k, 1).alias("p"), S.mod(k, 7).alias("r"))


@query("select o_orderpriority, quantile_cont(o_totalprice, 0.5) m from orders group by 1")
def ordered_set_aggregate(spark, d):
    return t(spark, d, "orders").groupBy("o_orderpriority").agg(S.within_group("percentile_cont", "0.5", order_by="o_totalprice").alias("m"))


@query("select o_orderkey, o_orderdate from orders order by o_orderdate nulls first, o_orderkey desc")
def sort_null_order(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_orderdate").sort(S.asc_nulls_first("o_orderdate"), S.desc_nulls_last("o_orderkey"))


@query("select o_orderkey, true both_parts from orders")
def random_split_union(spark, d):
    """The parts together are the table, and neither is empty."""
    a, b = t(spark, d, "orders").select("o_orderkey").randomSplit([0.3, 0.7], 5)
    return a.unionAll(b).withColumn("both_parts", F.lit(not a.isEmpty() and not b.isEmpty()))


@query("select count(*) n, true in_range from orders")
def approx_quantile(spark, d):
    """Of all orders a quarter, half and nine tenths lie below the three values, give or take one in a hundred."""
    o, wanted = t(spark, d, "orders"), [0.25, 0.5, 0.9]
    below = [F.avg((F.col("o_totalprice") <= v).cast("double")).between(w - 0.01, w + 0.01) for w, v in zip(wanted, o.stat.approxQuantile("o_totalprice", wanted), strict=True)]
    return o.agg(S.count("*").alias("n"), (below[0] & below[1] & below[2]).alias("in_range"))
