"""Functions over the driver's tables."""

from pyspark.sql import functions as F

from skein import functions as S

from .registry import query
from .relational_queries import t


@query("""select p_partkey, upper(p_name) up, lower(p_brand) lo, length(p_name) len, left(p_name, 3) l3, right(p_name, 2) r2, reverse(p_brand) rev,
    lpad(p_brand, 12, '*') lp, rpad(p_brand, 12, '-') rp, p_name || '/' || p_brand cat, replace(p_type, 'A', 'x') rep, contains(p_name, 'a') has, starts_with(p_brand, 'Brand') sw,
    substring(p_name, 2, 4) sub, ascii(p_name) code, position('a' in p_name) pos, repeat('ab', 2) rr, trim('  x ') tr, translate(p_brand, 'Bd', 'XY') tl, ends_with(p_brand, '1') ew from part""")
def string_functions(spark, d):
    return t(spark, d, "part").select(
        "p_partkey", S.upper("p_name").alias("up"), S.lower("p_brand").alias("lo"), S.length("p_name").cast("long").alias("len"), S.left("p_name", 3).alias("l3"), S.right("p_name", 2).alias("r2"), S.reverse("p_brand").alias("rev"),
        S.lpad("p_brand", 12, "*").alias("lp"), S.rpad("p_brand", 12, "-").alias("rp"), S.concat_ws("/", "p_name", "p_brand").alias("cat"), S.replace("p_type", "A", "x").alias("rep"), S.contains("p_name", "a").alias("has"), S.startswith("p_brand", "Brand").alias("sw"),
        S.substring("p_name", 2, 4).alias("sub"), S.ascii("p_name").alias("code"), S.charindex("a", "p_name").cast("long").alias("pos"), S.repeat(F.lit("ab"), 2).alias("rr"), S.trim(F.lit("  x ")).alias("tr"), S.translate("p_brand", "Bd", "XY").alias("tl"), S.endswith("p_brand", "1").alias("ew"),
    )


@query("""select p_partkey, md5(p_name) m, sha1(p_name) s1, sha256(p_name) s2, hex(encode(p_brand)) hx, base64(encode(p_brand)) b64, regexp_replace(p_name, '[aeiou]', '', 'g') rr,
    regexp_extract(p_brand, '[0-9]+') rx, len(regexp_extract_all(p_name, 'a')) rc, string_split(p_type, ' ') sp, regexp_full_match(p_brand, 'Brand.*') fm from part""")
def hash_regex_functions(spark, d):
    return t(spark, d, "part").select(
        "p_partkey", S.md5("p_name").alias("m"), S.sha1("p_name").alias("s1"), S.sha2("p_name", 256).alias("s2"), S.hex("p_brand").alias("hx"), S.base64("p_brand").alias("b64"), S.regexp_replace("p_name", "[aeiou]").alias("rr"),
        S.regexp_extract("p_brand", "[0-9]+").alias("rx"), S.regexp_count("p_name", "a").cast("long").alias("rc"), S.split("p_type", " ").alias("sp"), S.regexp("p_brand", "Brand.*").alias("fm"),
    )


@query("""select l_orderkey, l_linenumber, round(sqrt(l_quantity), 9) sq, round(exp(l_discount), 9) ex, round(ln(l_quantity) / ln(2), 9) lg, round(pow(l_quantity, 2), 4) pw, ceil(l_extendedprice)::bigint ce, floor(l_extendedprice)::bigint fl,
    round(sin(l_tax), 9) si, round(cos(l_tax), 9) co, round(atan2(l_tax, l_discount + 1), 9) a2, abs(l_discount - l_tax) ab, sign(l_discount - l_tax)::double sg, round(degrees(l_tax), 9) dg, l_linenumber % 3 md,
    trunc(l_extendedprice) tc, (l_linenumber::bigint << 2) sh, (l_orderkey >> 1) sr, case when l_discount = 0 then 0 else round(l_tax / l_discount, 9) end dv, greatest(l_tax, l_discount) g, least(l_tax, l_discount) ls from lineitem""")
def math_functions(spark, d):
    r = lambda c: F.round(c, 9)
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", r(S.sqrt("l_quantity")).alias("sq"), r(S.exp("l_discount")).alias("ex"), r(S.log(F.lit(2), "l_quantity")).alias("lg"), F.round(S.pow("l_quantity", F.lit(2)), 4).alias("pw"), S.ceil("l_extendedprice").alias("ce"), S.floor("l_extendedprice").alias("fl"),
        r(S.sin("l_tax")).alias("si"), r(S.cos("l_tax")).alias("co"), r(S.atan2("l_tax", F.col("l_discount") + 1)).alias("a2"), S.abs(F.col("l_discount") - F.col("l_tax")).alias("ab"), S.sign(F.col("l_discount") - F.col("l_tax")).alias("sg"), r(S.degrees("l_tax")).alias("dg"), (F.col("l_linenumber") % 3).alias("md"),
        S.trunc("l_extendedprice", 0).alias("tc"), S.bitshiftleft("l_linenumber", 2).alias("sh"), S.bitshiftright("l_orderkey", 1).alias("sr"), r(S.div0("l_tax", "l_discount")).alias("dv"), S.greatest("l_tax", "l_discount").alias("g"), S.least("l_tax", "l_discount").alias("ls"),
    )


@query("""select o_orderkey, year(o_orderdate) y, quarter(o_orderdate) q, month(o_orderdate) m, day(o_orderdate) dd, dayofweek(o_orderdate) dw, dayofyear(o_orderdate) dy, weekofyear(o_orderdate) wk,
    last_day(o_orderdate) ld, date_trunc('month', o_orderdate)::timestamp tm, o_orderdate + interval 1 hour ph, (o_orderdate::date + interval 2 day)::date pd, date_diff('month', o_orderdate, timestamp '1999-01-15') dm,
    date_diff('year', o_orderdate, timestamp '1999-01-15') dyr, left(dayname(o_orderdate), 3) dn, left(monthname(o_orderdate), 3) mn, strftime(o_orderdate, '%Y/%m/%d') f from orders""")
def date_functions(spark, d):
    o, to = F.col("o_orderdate"), F.lit("1999-01-15").cast("timestamp_ntz")
    lng = lambda c: c.cast("long")
    return t(spark, d, "orders").select(
        "o_orderkey", lng(S.year(o)).alias("y"), lng(S.quarter(o)).alias("q"), lng(S.month(o)).alias("m"), lng(S.dayofmonth(o)).alias("dd"), lng(S.dayofweek(o)).alias("dw"), lng(S.dayofyear(o)).alias("dy"), lng(S.weekofyear(o)).alias("wk"),
        S.last_day(o).alias("ld"), S.date_trunc("month", o).cast("timestamp_ntz").alias("tm"), S.dateadd("hour", 1, o).alias("ph"), S.dateadd("day", 2, o.cast("date")).alias("pd"), lng(S.datediff("month", o, to)).alias("dm"),
        lng(S.datediff("year", o, to)).alias("dyr"), S.dayname(o).alias("dn"), S.monthname(o).alias("mn"), S.date_format(o, "YYYY/MM/DD").alias("f"),
    )


@query("""select o_orderkey, strptime(strftime(o_orderdate, '%d-%m-%Y %H:%M'), '%d-%m-%Y %H:%M') ts, try_cast(o_orderpriority as date) bad, make_date(year(o_orderdate)::int, 2, 3) md,
    (date_trunc('month', o_orderdate) + interval 1 month)::date am, epoch(o_orderdate)::bigint ep from orders""")
def date_parsing(spark, d):
    o = F.col("o_orderdate")
    return t(spark, d, "orders").select(
        "o_orderkey", S.to_timestamp(S.date_format(o, "DD-MM-YYYY HH24:MI"), "DD-MM-YYYY HH24:MI").cast("timestamp_ntz").alias("ts"), S.try_to_date("o_orderpriority").alias("bad"), S.date_from_parts(S.year(o), 2, 3).alias("md"),
        S.add_months(S.date_trunc("month", o).cast("date"), 1).alias("am"), S.unix_timestamp(o.cast("timestamp")).alias("ep"),
    )


@query("""select o_orderkey, case when o_totalprice > 200000 then 'high' when o_totalprice > 100000 then 'mid' else 'low' end band, coalesce(nullif(o_orderstatus, 'F'), 'done') st,
    if(o_orderstatus = 'O', 1, 0) op, o_orderstatus is not distinct from 'P' eq, o_totalprice between 1000 and 50000 bt, (o_orderstatus, o_orderpriority) in (('F', '1-URGENT'), ('O', '5-LOW')) tup from orders""")
def conditional_functions(spark, d):
    p = F.col("o_totalprice")
    return t(spark, d, "orders").select(
        "o_orderkey", S.when(p > 200000, "high").when(p > 100000, "mid").otherwise("low").alias("band"), S.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("F")), F.lit("done")).alias("st"),
        S.iff(F.col("o_orderstatus") == "O", 1, 0).alias("op"), S.equal_null("o_orderstatus", "P").alias("eq"), p.between(1000, 50000).alias("bt"), S.in_(["o_orderstatus", "o_orderpriority"], [("F", "1-URGENT"), ("O", "5-LOW")]).alias("tup"),
    )


@query("""select event_id, (json_extract(props, '$.k'))::bigint k, json_extract_string(props, '$.k') kt, json_extract(props, '$.none') is null missing, json_type(json_extract(props, '$.k')) in ('UBIGINT', 'BIGINT') is_int from events""")
def json_functions(spark, d):
    e = t(spark, d, "events").withColumn("v", S.parse_json("props"))
    return e.select("event_id", S.as_integer(S.get_path("v", "k")).alias("k"), S.json_extract_path_text("props", "k").alias("kt"), S.is_null(S.get_path("v", "none")).alias("missing"), S.is_integer(S.get_path("v", "k")).alias("is_int"))


@query("""select vec_id, len(embedding)::int n, round(embedding[1]::double, 6) first, embedding[3:5] part, list_contains(embedding, embedding[2]) has, (list_position(embedding, embedding[4]) - 1)::int pos from embeddings""")
def array_functions(spark, d):
    e = F.col("embedding")
    return t(spark, d, "embeddings").select("vec_id", S.array_size(e).alias("n"), F.round(S.get(e, 0).cast("double"), 6).alias("first"), S.array_slice(e, 2, 5).alias("part"), S.array_contains(S.get(e, 1), e).alias("has"), S.array_position(S.get(e, 3), e).alias("pos"))


@query("""select n_nationkey, list_concat([n_name], ['x', 'y']) cat, list_concat([n_name], ['z']) app, array_to_string([n_name, 'q'], '-') js, [x for x in [n_name, null, 'w'] if x is not null] cmp from nation""")
def array_building(spark, d):
    one = S.array_construct(F.col("n_name"))
    return t(spark, d, "nation").select("n_nationkey", S.array_cat(one, S.array_construct("x", "y")).alias("cat"), S.array_append(one, "z").alias("app"), S.array_to_string(S.array_append(one, "q"), "-").alias("js"), S.array_construct_compact(F.col("n_name"), None, "w").alias("cmp"))


@query("select n_nationkey, ['k', 'name'] ks, n_name v, n_name v2 from nation")
def object_functions(spark, d):
    o = S.object_construct("name", F.col("n_name"), "k", F.col("n_nationkey"), "none", None)
    n = t(spark, d, "nation").withColumn("o", o)
    return n.select("n_nationkey", F.sort_array(S.object_keys("o")).alias("ks"), S.as_varchar(S.get("o", "name")).alias("v"), S.as_varchar(S.get_ignore_case(S.object_pick("o", "name"), "NAME")).alias("v2"))


@query("""select l_returnflag, count(*) n, count(l_tax)::bigint c, any_value(l_returnflag) av, round(avg(l_quantity), 6) m from lineitem group by 1""")
def aggregate_names(spark, d):
    li = t(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(S.count("*").alias("n"), S.count("l_tax").alias("c"), S.any_value("l_returnflag").alias("av"), F.round(S.mean("l_quantity"), 6).alias("m"))


@query()
def session_context(spark, d):
    from skein.session import Session

    s = Session(spark)
    return s.range(1).select(S.current_database().alias("database"), S.current_schema().alias("schema"), S.current_version().alias("version"), S.current_role().alias("role"), S.current_schemas().alias("schemas"))


@query()
def random_numbers(spark, d):
    return t(spark, d, "nation").select("n_nationkey", S.random(1).alias("r"), S.uniform(1, 6).alias("u"), S.randn(3).alias("z"))


@query("select n_nationkey, (row_number() over (order by n_nationkey) - 1)::bigint s8 from nation")
def sequence_numbers(spark, d):
    return t(spark, d, "nation").sort("n_nationkey").select("n_nationkey", S.seq8().alias("s8"))
