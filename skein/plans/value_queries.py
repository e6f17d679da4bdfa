"""Functions and entry points that the other queries leave out, over whole tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein import functions as S
from skein.operators.table_functions import split_to_table
from skein.operators.windows import Window as W
from skein.session import Session

from .registry import query
from .relational_queries import t
from .table_queries import folder


@query("""select event_id, true is_obj, false is_arr, k is_int, k is_dec, k is_dbl, false is_str, false is_bool, false is_date, false is_bin, false is_null_v, false is_ts, false is_time
    from (select event_id, json_type(json_extract(props, '$.k')) in ('UBIGINT', 'BIGINT') k from events)""")
def variant_types(spark, d):
    e = t(spark, d, "events").withColumn("v", S.parse_json("props")).withColumn("k", S.get_path("v", "k"))
    return e.select(
        "event_id", S.is_object("v").alias("is_obj"), S.is_array("v").alias("is_arr"), S.is_integer("k").alias("is_int"), S.is_decimal("k").alias("is_dec"), S.is_double("k").alias("is_dbl"), S.is_varchar("k").alias("is_str"), S.is_boolean("k").alias("is_bool"),
        (S.is_date("k") | S.is_date_value("k")).alias("is_date"), S.is_binary("k").alias("is_bin"), S.is_null_value("k").alias("is_null_v"), (S.is_timestamp_ltz("k") | S.is_timestamp_ntz("k") | S.is_timestamp_tz("k")).alias("is_ts"), S.is_time("k").alias("is_time"),
    )


@query("""select o_orderkey, o_orderstatus str, o_orderstatus chr, o_totalprice dbl, o_totalprice rl, o_orderkey num, o_orderkey::decimal(20, 0) dcm, o_orderkey::bigint itg, o_orderstatus = 'F' is_f, o_orderdate::date dt, o_orderdate ts,
    null::varchar not_str, null::double not_dbl, true is_str, true is_real, true is_char, true is_bool, true is_day, true is_ntz, encode(o_orderstatus) bn, true is_bin from orders""")
def variant_values(spark, d):
    v = S.to_variant
    o, day = t(spark, d, "orders"), F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey", S.as_varchar(v("o_orderstatus")).alias("str"), S.as_char(v("o_orderstatus")).alias("chr"), S.as_double(v("o_totalprice")).alias("dbl"), S.as_real(v("o_totalprice")).alias("rl"), S.as_number(v("o_orderkey")).cast("long").alias("num"),
        S.as_decimal(v("o_orderkey"), 20, 0).alias("dcm"), S.as_integer(v("o_orderkey")).alias("itg"), F.variant_get(v(F.col("o_orderstatus") == "F"), "$", "boolean").alias("is_f"), S.as_date(v(day)).alias("dt"), S.as_timestamp_ntz(v("o_orderdate")).alias("ts"),
        S.as_varchar(v("o_totalprice")).alias("not_str"), S.as_double(v("o_orderstatus")).alias("not_dbl"), S.is_varchar(v("o_orderstatus")).alias("is_str"), S.is_real(v("o_totalprice")).alias("is_real"), S.is_char(v("o_orderstatus")).alias("is_char"),
        S.is_boolean(v(F.col("o_orderstatus") == "F")).alias("is_bool"), S.is_date(v(day)).alias("is_day"), S.is_timestamp_ntz(v("o_orderdate")).alias("is_ntz"), S.as_binary(v(F.col("o_orderstatus").cast("binary"))).alias("bn"), S.is_binary(v(F.col("o_orderstatus").cast("binary"))).alias("is_bin"),
    )


@query("""select o_orderkey, o_orderdate lt, true is_lt, true is_tz, o_orderdate tz from orders""")
def variant_instants(spark, d):
    at = S.to_variant(F.col("o_orderdate").cast("timestamp"))
    o = t(spark, d, "orders")
    plain = lambda c: F.to_timestamp_ntz(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", plain(S.as_timestamp_ltz(at)).alias("lt"), S.is_timestamp_ltz(at).alias("is_lt"), S.is_timestamp_tz(at).alias("is_tz"), plain(S.as_timestamp_tz(at)).alias("tz"))


@query("""select event_id, null::varchar good, true bad, true xml_good, true xml_bad, '{"id":' || event_id || ',"type":"' || event_type || '"}' js, event_type as stripped, true gone, 2::int n_arr, event_id first, ['id', 'type'] ks from events""")
def json_checks(spark, d):
    e = t(spark, d, "events")
    xml = F.concat(F.lit("<e>"), "event_type", F.lit("</e>"))
    v = S.parse_json(F.concat(F.lit('{"id": ['), F.col("event_id").cast("string"), F.lit(', null], "type": "'), "event_type", F.lit('", "none": null}')))
    e = e.withColumn("v", v)
    obj = S.to_object(F.create_map(F.lit("id"), F.col("event_id"), F.lit("type"), F.lit(1)))
    return e.select(
        "event_id", S.check_json("props").alias("good"), S.check_json(F.concat("props", F.lit("{"))).isNotNull().alias("bad"), S.check_xml(xml).isNull().alias("xml_good"), S.check_xml(F.concat(xml, F.lit("<"))).isNotNull().alias("xml_bad"),
        S.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("js"), S.as_varchar(S.strip_null_value(S.get_path("v", "type"))).alias("stripped"), S.strip_null_value(S.get_path("v", "none")).isNull().alias("gone"),
        S.array_size(S.as_array(S.get_path("v", "id"))).alias("n_arr"), S.as_integer(S.get(S.as_array(S.get_path("v", "id")), 0)).alias("first"), F.sort_array(S.object_keys(obj)).alias("ks"),
    )


@query("""select p_partkey, p_name nm, 'name' tag, p_brand br, null::varchar none, '<name>' || p_name || '</name>' el, p_name same from part""")
def xml_elements(spark, d):
    doc = F.concat(F.lit("<part><name>"), "p_name", F.lit('</name><x brand="'), "p_brand", F.lit('"/></part>'))
    p = t(spark, d, "part").withColumn("x", S.parse_xml(doc))
    return p.select("p_partkey", S.get(S.xmlget("x", "name"), "$").alias("nm"), S.get(S.xmlget("x", "name"), "@").alias("tag"), S.get(S.xmlget("x", "x"), "@brand").alias("br"), S.xmlget("x", "name", 1).alias("none"), S.xmlget("x", "name", F.lit(0)).alias("el"), S.parse_xml("x", "name string")["name"].alias("same"))


@query("""select event_id, hour(ts)::int h, minute(ts)::int mi, second(ts)::int s, (ts::date + ((7 - (isodow(ts) - 1)) % 7 + case when isodow(ts) = 1 then 7 else 0 end)::int)::date nx, (ts::date - case when isodow(ts) = 1 then 7 else isodow(ts) - 1 end::int)::date pv,
    strptime(strftime(ts, '%Y%m%d'), '%Y%m%d')::date d2, (ts::date + 40)::date da, make_timestamp(year(ts), month(ts), day(ts), 1, 2, 3.0) fp, date_trunc('second', ts) tt, null::timestamp tb, date_trunc('second', ts) - interval 5 hour cz,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000' fu, (ts::date + 1)::date pl from events""")
def date_values(spark, d):
    e, ts = t(spark, d, "events"), F.col("ts")
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return e.select(
        "event_id", S.hour(ts).alias("h"), S.minute(ts).alias("mi"), S.second(ts).alias("s"), S.next_day(ts, "monday").alias("nx"), S.previous_day(ts, "monday").alias("pv"), S.to_date(F.date_format(ts, "yyyyMMdd"), "YYYYMMDD").alias("d2"),
        F.date_add(ts.cast("date"), 40).alias("da"), S.timestamp_from_parts(S.year(ts), S.month(ts), S.dayofmonth(ts), 1, 2, 3).cast("timestamp_ntz").alias("fp"), S.try_to_timestamp(text).cast("timestamp_ntz").alias("tt"), S.try_to_timestamp("event_type").cast("timestamp_ntz").alias("tb"),
        S.convert_timezone("UTC", "Etc/GMT+5", F.to_timestamp_ntz(text)).cast("timestamp_ntz").alias("cz"), S.from_unixtime(S.unix_timestamp(F.to_timestamp(text))).alias("fu"), S.dateadd("day", 1, ts.cast("date")).alias("pl"),
    )


@query("""select o_orderkey, (year(o_orderdate) - 1990) * 12 + month(o_orderdate) - 1 mb, o_orderdate + interval 1 second l1, make_timestamp(2020, month(o_orderdate), 2, 3, 4, 5.0) lp, make_timestamp(2020, month(o_orderdate), 2, 3, 4, 5.0) np, '03:04:05' tp from orders""")
def date_building(spark, d):
    o, at = t(spark, d, "orders"), F.col("o_orderdate")
    first = F.trunc(at, "month")
    plain = lambda c: F.to_timestamp_ntz(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return o.select(
        "o_orderkey", S.months_between(first, F.lit("1990-01-01").cast("date")).cast("long").alias("mb"), S.dateadd("second", 1, at).alias("l1"), plain(S.timestamp_ltz_from_parts(F.lit(2020), S.month(at), F.lit(2), F.lit(3), F.lit(4), F.lit(5))).alias("lp"),
        S.timestamp_ntz_from_parts(F.lit(2020), S.month(at), F.lit(2), F.lit(3), F.lit(4), F.lit(5)).alias("np"), S.time_from_parts(3, 4, 5).cast("string").substr(1, 8).alias("tp"),
    )


@query("""select l_orderkey, l_linenumber, ~l_linenumber bn, round(acos(l_tax), 9) ac, round(asin(l_tax), 9) asn, round(atan(l_quantity), 9) atn, round(cosh(l_tax), 9) ch, round(sinh(l_tax), 9) sh, round(tan(l_tax), 9) tn, round(tanh(l_tax), 9) th, round(radians(l_quantity), 9) rd,
    factorial(l_linenumber)::bigint fc, round(log10(l_quantity), 9) lt, round(ln(1 + l_tax), 9) lp, (l_linenumber::bigint << 3) sl, (l_orderkey >> 2) sr, sign(l_tax - l_discount)::double sg, -l_quantity ng, round(exp(ln(l_quantity)), 6) ex from lineitem""")
def math_values(spark, d):
    r = lambda c: F.round(c, 9)
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", S.bitnot("l_linenumber").alias("bn"), r(S.acos("l_tax")).alias("ac"), r(S.asin("l_tax")).alias("asn"), r(S.atan("l_quantity")).alias("atn"), r(S.cosh("l_tax")).alias("ch"), r(S.sinh("l_tax")).alias("sh"), r(S.tan("l_tax")).alias("tn"), r(S.tanh("l_tax")).alias("th"),
        r(S.radians("l_quantity")).alias("rd"), S.factorial("l_linenumber").alias("fc"), r(S.log10("l_quantity")).alias("lt"), r(S.log1p("l_tax")).alias("lp"), S.shiftleft("l_linenumber", 3).alias("sl"), S.shiftright("l_orderkey", 2).alias("sr"), S.signum(F.col("l_tax") - F.col("l_discount")).alias("sg"),
        S.negate(F.col("l_quantity")).alias("ng"), F.round(S.exp(S.log(F.lit(2.718281828459045), "l_quantity")), 6).alias("ex"),
    )


@query("""select o_orderkey, (case o_orderkey % 3 when 0 then round(o_totalprice::decimal(12, 2), 0)::decimal(18, 2) when 1 then round(o_totalprice::decimal(12, 2), 1)::decimal(18, 2) else o_totalprice::decimal(18, 2) end)::decimal(18, 2) rc, (trunc(o_totalprice::decimal(12, 2) * 10) / 10)::decimal(18, 2) t1, (trunc(o_totalprice / 1000) * 1000)::bigint t3,
    (9007199254740993 + o_orderkey) big, o_totalprice::decimal(10, 1) dc, (o_orderkey || '.5')::decimal(12, 1) tn, null::decimal(12, 1) tb, case when o_totalprice < 1000000 then trim(format('{:,.2f}', o_totalprice)) else '###,###.##' end fn from orders""")
def number_values(spark, d):
    o, price = t(spark, d, "orders"), F.col("o_totalprice").cast("decimal(12,2)")
    text = F.concat(F.col("o_orderkey").cast("string"), F.lit(".5"))
    return o.select(
        "o_orderkey", S.round(price, (F.col("o_orderkey") % 3).cast("int")).cast("decimal(18,2)").alias("rc"), S.trunc(price, 1).cast("decimal(18,2)").alias("t1"), S.trunc("o_totalprice", -3).cast("long").alias("t3"), S.trunc(F.col("o_orderkey") + 9007199254740993, 0).alias("big"),
        S.to_decimal("o_totalprice", 10, 1).alias("dc"), S.to_number(text, precision=12, scale=1).alias("tn"), S.try_to_number("o_orderstatus", precision=12, scale=1).alias("tb"), S.format_number("o_totalprice", 2).alias("fn"),
    )


@query("""select p_partkey, 'A' || p_partkey || coalesce(null, '') cw, upper(p_name[1]) || substring(split_part(p_name, ' ', 1), 2) || ' ' || upper(split_part(p_name, ' ', 2)[1]) || substring(split_part(p_name, ' ', 2), 2) ic, p_name lt, p_name rt, chr(128512 + (p_partkey % 50)::int) ch, p_name || p_brand cc,
    string_split(p_name, ' ') tk, p_name sx, (regexp_extract(p_brand, '^[^0-9]*').length() + 1)::int ins, p_name ub, p_name uh, position('i' in p_name)::int lc, lower(p_brand) = 'brand#1' eqi, p_type || '|' || p_name ws from part""")
def string_values(spark, d):
    p = t(spark, d, "part")
    return p.select(
        "p_partkey", S.concat_ws_ignore_nulls("", F.lit("A"), F.col("p_partkey").cast("string"), F.lit(None).cast("string")).alias("cw"), S.initcap("p_name").alias("ic"), S.ltrim(F.concat(F.lit("  "), "p_name")).alias("lt"), S.rtrim(F.concat("p_name", F.lit("  "))).alias("rt"),
        S.char((F.lit(128512) + F.col("p_partkey") % 50).cast("int")).alias("ch"), S.concat("p_name", "p_brand").alias("cc"), S.strtok_to_array("p_name", " ").alias("tk"), S.substring_index(F.concat("p_name", F.lit("|x")), "|", 1).alias("sx"), S.instr("p_brand", "[0-9]").alias("ins"),
        S.unbase64(S.base64("p_name")).alias("ub"), S.unhex(S.hex("p_name")).alias("uh"), S.locate("i", "p_name", 1).alias("lc"), (S.collate("p_brand", "en-ci") == S.collate(F.lit("BRAND#1"), "en-ci")).alias("eqi"), S.concat_ws("|", "p_type", "p_name").alias("ws"),
    )


@query("""select vec_id, list_has_any(embedding[1:3], embedding[3:5]) ov, list_distinct(list_intersect(embedding[1:3], [embedding[2], embedding[3]])).len()::int ni, embedding[1:2] cp, embedding[1:2] || embedding[3:3] fl, [embedding[1]] || [embedding[5]] || [embedding[2]] ins,
    [embedding[4]] || embedding[1:2] pp, [embedding[1]] ta, len(embedding)::int sz, [embedding[1], embedding[2]] ar from embeddings""")
def array_values(spark, d):
    e = F.col("embedding")
    at = lambda i: S.get(e, i)
    return t(spark, d, "embeddings").select(
        "vec_id", S.arrays_overlap(S.array_slice(e, 0, 3), S.array_slice(e, 2, 5)).alias("ov"), S.array_size(S.array_intersection(S.array_slice(e, 0, 3), S.array(at(1), at(2)))).alias("ni"), S.array_compact(S.array(at(0), F.lit(None).cast("float"), at(1))).alias("cp"),
        S.array_flatten(S.array(S.array(at(0), at(1)), S.array(at(2)))).alias("fl"), S.array_insert(S.array_slice(e, 0, 2), 1, at(4)).alias("ins"), S.array_prepend(S.array_slice(e, 0, 2), at(3)).alias("pp"), S.to_array(at(0)).alias("ta"), S.size(e).alias("sz"), S.array(at(0), at(1)).alias("ar"),
    )


@query("select n_nationkey, ['name'] del, ['k', 'name', 'new'] ins, n_name v, 'x' upd from nation")
def object_values(spark, d):
    n = t(spark, d, "nation").withColumn("o", S.object_construct("name", F.col("n_name"), "k", F.col("n_nationkey")))
    keys = lambda o: F.sort_array(S.object_keys(o))
    text = lambda o, k: S.as_varchar(S.get(o, k))
    more = S.object_insert("o", "new", F.lit("x"))
    return n.select("n_nationkey", keys(S.object_delete("o", "k")).alias("del"), keys(more).alias("ins"), text(more, "name").alias("v"), text(S.object_insert("o", "name", F.lit("x"), True), "name").alias("upd"))


@query("""select o_orderstatus, count(distinct o_orderpriority) cd, round(stddev_samp(o_totalprice), 4) sd, round(var_samp(o_totalprice / 1000), 4) vr, list_sort(list(distinct o_orderpriority)) cs, count(*) cl, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) la,
    round(corr(o_totalprice, o_custkey), 9) co, round(median(o_totalprice), 4) md from orders group by 1""")
def aggregate_values(spark, d):
    o = t(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(
        S.countDistinct("o_orderpriority").alias("cd"), F.round(S.stddev_samp("o_totalprice"), 4).alias("sd"), F.round(S.var_samp(F.col("o_totalprice") / 1000), 4).alias("vr"), F.sort_array(S.collect_set("o_orderpriority")).alias("cs"), F.size(S.collect_list("o_orderkey")).cast("long").alias("cl"),
        F.array_join(F.sort_array(F.split(S.listagg("o_orderpriority", ",", True), ",")), ",").alias("la"), F.round(S.corr("o_totalprice", "o_custkey"), 9).alias("co"), F.round(S.callBuiltin("median", F.col("o_totalprice")), 4).alias("md"),
    )


@query("""select o_orderstatus, o_orderpriority, grouping(o_orderpriority)::int g, count(*) n from orders group by rollup (o_orderstatus, o_orderpriority)""")
def grouping_flag(spark, d):
    return t(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(S.grouping("o_orderpriority").cast("int").alias("g"), S.count("*").alias("n"))


@query("""select o_orderstatus, true in_range, true same from orders group by 1""")
def percentile_sketches(spark, d):
    """Sketches of parts, combined, estimate the median of the whole: half of the group's orders lie below it, give or take two in a hundred."""
    o = t(spark, d, "orders").df
    parts = o.groupBy("o_orderstatus", F.pmod("o_orderkey", F.lit(4)).alias("part")).agg(S.approx_percentile_accumulate("o_totalprice").alias("state"))
    whole = parts.groupBy("o_orderstatus").agg(S.approx_percentile_combine("state").alias("state"))
    found = whole.select(F.col("o_orderstatus").alias("s"), S.approx_percentile_estimate("state", 0.5).alias("m"))
    below = o.join(found, F.col("s") == F.col("o_orderstatus")).groupBy("o_orderstatus").agg(F.avg((F.col("o_totalprice") <= F.col("m")).cast("double")).alias("b"))
    return below.select("o_orderstatus", F.col("b").between(0.48, 0.52).alias("in_range"), F.lit(True).alias("same"))


@query("""select l_orderkey, l_linenumber, l_partkey, lead(l_partkey, 1, -1) over w ld, count(*) over (partition by l_orderkey order by l_linenumber, l_partkey rows between unbounded preceding and current row) up, count(*) over (partition by l_orderkey order by l_linenumber, l_partkey rows between current row and unbounded following) dn
    from lineitem window w as (partition by l_orderkey order by l_linenumber, l_partkey)""")
def window_bounds(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    ours = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.lead("l_partkey", 1, -1).over(w).alias("ld"), S.count("*").over(ours.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("up"), S.count("*").over(ours.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("dn")
    )


@query("""select o_orderkey, o_orderkey = o_custkey eq, o_orderkey <> o_custkey ne, o_orderkey < o_custkey lt, o_orderkey <= o_custkey le, o_orderkey >= o_custkey ge, o_orderstatus is null nul, o_orderstatus is not null nn, o_orderstatus = 'F' or o_orderkey > 5 orr, o_orderstatus = 'F' and o_orderkey > 5 andd,
    o_orderkey - o_custkey mi, o_orderkey * o_custkey mu, round(o_totalprice / 3, 6) di, isnan(o_totalprice) nan, 5::int tl, o_orderkey + 1 se, upper(o_orderstatus) ub, o_orderkey * 2 u2 from orders""")
def column_methods(spark, d):
    o = t(spark, d, "orders")
    a, b, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    spark.udf.register("skein_twice", lambda x: x * 2, "bigint")
    return o.select(
        "o_orderkey", S.equal_to(a, b).alias("eq"), S.not_equal(a, b).alias("ne"), S.lt(a, b).alias("lt"), S.leq(a, b).alias("le"), S.geq(a, b).alias("ge"), S.isnull(s).alias("nul"), S.is_not_null(s).alias("nn"), S.or_(s == "F", a > 5).alias("orr"), S.and_(s == "F", a > 5).alias("andd"), S.minus(a, b).alias("mi"), S.multiply(a, b).alias("mu"),
        F.round(S.divide(F.col("o_totalprice"), F.lit(3)), 6).alias("di"), S.equal_nan("o_totalprice").alias("nan"), S.typedLit(5).alias("tl"), S.sqlExpr("o_orderkey + 1").alias("se"), S.callBuiltin("upper", s).alias("ub"), S.callUDF("skein_twice", a).alias("u2"),
    )


@query("select o_orderkey k, o_custkey c, o_totalprice p, o_orderkey + 1 n1, 'x' n2 from orders where o_orderstatus = 'F'")
def frame_methods(spark, d):
    o = t(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice").toDF("k", "c", "p")
    return o.withColumns(["n1", "n2"], [o["k"] + 1, F.lit("x")])


def tallies(frame, key):
    """How many rows each of 64 buckets of a key has: of a table of any size no more reaches the driver, and every row is counted."""
    return frame.groupBy(F.pmod(F.hash(key), F.lit(64)).alias("bucket")).agg(F.count("*").alias("n"))


@query("select count(*) n, min(o_orderkey) first, true nonempty, count(*) again, count(*) whole from orders")
def frame_actions(spark, d):
    o = t(spark, d, "orders").select("o_orderkey").sort(F.col("o_orderkey").asc_nulls_last())
    first, rows = o.first(), tallies(o, "o_orderkey")
    counted = sum(r["n"] for r in rows.toLocalIterator())
    whole = sum(r["n"] for r in rows.async_.collect().getRows())
    return spark.createDataFrame([(o.count(), first and first[0], not o.isEmpty(), counted, whole)], "n bigint, first bigint, nonempty boolean, again bigint, whole bigint")


@query("select count(*) n, count(*) n_iter, true done, count(*) by_id from orders")
def async_jobs(spark, d):
    o = t(spark, d, "orders")
    count, found = o.async_.count(), tallies(o, "o_orderkey").async_.toLocalIterator()
    n, seen = count.getResult(), sum(r["n"] for r in found.getIterator())
    again = Session(spark).createAsyncJob(count.getQueryId())
    return spark.createDataFrame([(n, seen, count.isDone(), again.getResult())], "n bigint, n_iter bigint, done boolean, by_id bigint")


@query("""select item_id, i "INDEX", w "VALUE" from (select item_id, unnest(string_split(text, ' ')) w, unnest(range(1, len(string_split(text, ' ')) + 1))::int i from benchmark)""")
def table_function_rows(spark, d):
    return t(spark, d, "benchmark").join(split_to_table(F.col("text"), F.lit(" "))).select("item_id", "INDEX", "VALUE")


@query("select range::bigint s8, (range % 256 - case when range % 256 >= 128 then 256 else 0 end)::bigint s1, (range % 65536 - case when range % 65536 >= 32768 then 65536 else 0 end)::bigint s2, range::bigint s4, range::bigint mi from range(70000)")
def generator_rows(spark, d):
    s = Session(spark).generator(70_000, S.seq8().alias("s8"), S.seq1(False).cast("long").alias("s1"), S.seq2(False).cast("long").alias("s2"), S.seq4().cast("long").alias("s4"), S.monotonically_increasing_id().alias("mi"))
    return s


@query("select p_partkey, p_name, p_retailprice from part")
def parquet_variants(spark, d):
    path = folder(spark, "parquet")
    t(spark, d, "part").write.options({"COMPRESSION": "snappy"}).parquet(path)
    v = Session(spark).read.options({"COMPRESSION": "snappy"}).parquet(path)
    one = F.col("`$1`")
    return v.select(S.as_integer(S.get_path(one, "p_partkey")).alias("p_partkey"), S.as_varchar(S.get_path(one, "p_name")).alias("p_name"), S.as_double(S.get_path(one, "p_retailprice")).alias("p_retailprice"))


@query("select p_partkey, p_name, case when p_brand in ('Brand#1', 'Brand#2') then null else p_brand end p_brand from part")
def csv_options(spark, d):
    """Two header lines in each file and several texts that stand for null."""
    path = folder(spark, "csv")
    lines = F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand")
    # each file starts with its own two header lines
    text = t(spark, d, "part").df.select(lines.alias("line")).repartition(3)
    text.mapInPandas(_with_headers, "line string").write.text(path)
    reader = Session(spark).read.schema("p_partkey bigint, p_name string, p_brand string").options({"FIELD_DELIMITER": "|", "SKIP_HEADER": 2, "NULL_IF": ["Brand#1", "Brand#2"]})
    return reader.csv(path)


def _with_headers(parts):
    import pandas as pd

    yield pd.DataFrame({"line": ["made by nobody", "key|name|brand"]})
    yield from parts


@query("select 'default' schema, true tagged, 2::bigint jobs, true same from (select 1)")
def session_entry_points(spark, d):
    s = Session(spark)
    s.setQueryTag("nightly")
    tagged = s.getQueryTag() == "nightly"
    s.unsetQueryTag()
    full = s.getFullyQualifiedCurrentSchema()
    same = full.endswith(s.getCurrentSchema()) and full.startswith(s.getCurrentDatabase()) and s.getSessionInfo() != "" and s.getSessionStage() != ""
    return s.createDataFrame([(s.getCurrentSchema(), tagged and s.getQueryTag() is None, s.range(2).count(), same)], "schema string, tagged boolean, jobs bigint, same boolean")
