"""Frames, tables, sources, user-defined functions and jobs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skein import functions as S
from skein.operators.frame import Frame
from skein.operators.table_functions import explode, flatten, split_to_table
from skein.session import Session


@pytest.fixture(scope="session")
def session(spark):
    return Session(spark)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture
def pairs(session):
    return session.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2)], ["a", "b"])


def test_projection(session, pairs):
    assert pairs.select("a").columns == ["a"]
    assert pairs.toDF("x", "y").columns == ["x", "y"]
    assert pairs.withColumns(["c", "d"], [F.lit(1), F.lit(2)]).columns == ["a", "b", "c", "d"]
    assert pairs.rename("z", "b").columns == ["a", "z"]
    assert pairs.drop("b").columns == ["a"]
    for bad in (lambda: pairs.select(), lambda: pairs.toDF("x"), lambda: pairs.drop("a", "b"), lambda: pairs.withColumns(["c", "C"], [F.lit(1), F.lit(2)]), lambda: pairs.rename("q", "nope")):
        with pytest.raises(ValueError):
            bad()


def test_rows(session, pairs):
    assert pairs.filter(pairs["a"] > 2).count() == 2
    assert pairs.first() is not None and len(pairs.first(2)) == 2 and len(pairs.first(-1)) == 6
    assert pairs.sample(n=3).count() == 3
    assert sum(f.count() for f in pairs.randomSplit([1.0, 2.0], 1)) == 6
    assert pairs.dropDuplicates("a").count() == 3
    assert [r.a for r in pairs.sort(F.col("a").desc()).limit(1).collect()] == [3]
    with pytest.raises(ValueError):
        pairs.randomSplit([])
    assert session.range(10, 0, -3).count() == 4 and session.range(0, 3, -1).isEmpty()
    with pytest.raises(ValueError):
        session.range(0, 1, 0)


def test_set_operations(session):
    a, b = session.createDataFrame([(1,), (1,), (2,), (None,)], "x int"), session.createDataFrame([(1,), (None,)], "x int")
    assert rows(a.union(b)) == rows(session.createDataFrame([(1,), (2,), (None,)], "x int"))
    assert a.unionAll(b).count() == 6 and a.intersect(b).count() == 2 and rows(a.except_(b)) == [(2,)]


def test_joins(session):
    a = session.createDataFrame([(1, "a"), (2, "b")], ["k", "x"])
    b = session.createDataFrame([(2, "c"), (3, "d")], ["k", "y"])
    assert rows(a.join(b, "k")) == [(2, "b", "c")]
    assert a.join(b, "k", "full_outer").count() == 3
    assert rows(a.join(b, "k", "leftanti")) == [(1, "a")]
    assert a.join(b).count() == 4 and a.naturalJoin(b, "left").count() == 2
    assert a.join(a.clone(), "k").count() == 2
    for bad in (lambda: a.join(b, "k", "sideways"), lambda: a.naturalJoin(b, "semi"), lambda: a.join(b, how="left")):
        with pytest.raises(ValueError):
            bad()


def test_grouping(session, pairs):
    assert rows(pairs.groupBy("a").sum("b")) == [(1, 3), (2, 3), (3, 3)]
    assert pairs.groupBy("a").agg(("b", "max"), ("b", "min")).columns == ["a", "max(b)", "min(b)"]
    assert pairs.rollup("a", "b").count().count() == 10 and pairs.cube("a", "b").count().count() == 12
    assert pairs.groupByGroupingSets(["a"], ["b"]).agg(F.count("*").alias("n")).count() == 5
    assert rows(pairs.groupBy("a").builtin("max")("b")) == [(1, 2), (2, 2), (3, 2)]
    with pytest.raises(ValueError):
        pairs.groupBy("a").avg()
    sales = session.createDataFrame([(1, 10, "JAN"), (1, 5, "FEB"), (2, 7, "JAN"), (1, 1, "JAN")], ["empid", "amount", "month"])
    assert rows(sales.pivot("month", ["JAN", "FEB"]).sum("amount")) == [(1, 11, 5), (2, 7, None)]
    with pytest.raises(ValueError):
        sales.pivot("month", ["JAN"]).agg(F.sum("amount"), F.max("amount"))


def test_missing_values_and_statistics(session):
    f = session.createDataFrame([(1.0, 1, "a"), (float("nan"), 2, None), (None, None, None)], "d double, i int, s string")
    assert f.na.drop(1, ["d", "i"]).count() == 2 and f.na.drop(3, ["d"]).count() == 0 and f.na.drop(0, ["d"]).count() == 3
    assert [r.d for r in f.na.fill({"d": 9.0, "s": 5}).collect()] == [1.0, 9.0, 9.0]
    assert sorted(str(r.s) for r in f.na.replace("s", {None: "z", "a": None}).collect()) == ["None", "z", "z"]
    n = session.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0)], ["a", "b"])
    assert n.stat.corr("a", "b") == pytest.approx(1.0) and n.stat.cov("a", "b") == pytest.approx(2.0)
    assert n.filter("a > 5").stat.corr("a", "b") is None
    assert n.stat.approxQuantile("a", [0.5]) == [2.0] and n.filter("a > 5").stat.approxQuantile(["a"], [0.5]) == [[None]]
    assert n.stat.crosstab("a", "a").count() == 3 and n.stat.sampleBy("a", {1: 1.0}).count() == 1


def test_table_functions(session):
    f = session.createDataFrame([("a,b", '{"x": [1, {"y": 2}]}')], ["s", "j"])
    assert [r.VALUE for r in f.join(split_to_table("s", ",")).collect()] == ["a", "b"]
    assert [(r.KEY, r.PATH) for r in f.flatten("j").collect()] == [("x", "x")]
    assert [r.PATH for r in f.flatten("j", recursive=True).collect()] == ["x", "x[0]", "x[1]", "x[1].y"]
    assert [(r.PATH, r.INDEX) for r in f.flatten("j", path="x").collect()] == [("x[0]", 0), ("x[1]", 1)]
    assert f.flatten("j", path="none").isEmpty() and f.flatten("j", path="none", outer=True).count() == 1
    assert session.tableFunction(explode(F.array(F.lit(1), F.lit(2)))).count() == 2
    assert session.flatten(F.parse_json(F.lit("[1, 2, 3]"))).count() == 3
    assert f.select("s", split_to_table("s", ",")).columns == ["s", "SEQ", "INDEX", "VALUE"]
    with pytest.raises(ValueError):
        f.select(split_to_table("s", ","), flatten("j"))
    with pytest.raises(ValueError):
        f.flatten("j", mode="ALL")
    with pytest.raises(ValueError):
        f.explode("s")


def test_window_frames(session, pairs):
    w = Window.partitionBy("a").orderBy("b")
    got = pairs.select("a", "b", F.sum("b").over(w.rowsBetween(-1, 0)).alias("r"), S.lag("b", -1).over(w).alias("l"))
    assert rows(got)[0] == (1, 1, 1, 2)


@pytest.fixture
def table(session):
    session.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string").write.mode("overwrite").saveAsTable("t_dml")
    yield session.table("t_dml")
    session.spark.sql("DROP TABLE IF EXISTS t_dml")


def test_update_and_delete(session, table):
    assert table.update({"v": F.lit("z")}, F.col("k") > 1) == (2, 0)
    assert rows(table) == [(1, "a"), (2, "z"), (3, "z")]
    source = session.createDataFrame([(1, "p"), (1, "p"), (3, "q")], "sk int, sv string")
    assert table.update({"v": F.col("sv")}, F.col("k") == F.col("sk"), source) == (2, 1)
    assert rows(table) == [(1, "p"), (2, "z"), (3, "q")]
    assert table.delete(F.col("k") == F.col("sk"), source) == (2,)
    assert rows(table) == [(2, "z")]
    assert table.delete() == (1,) and table.isEmpty()
    with pytest.raises(ValueError):
        table.update({"nope": F.lit(1)})


def test_merge(session, table):
    source = session.createDataFrame([(2, "B"), (3, "C"), (9, "N"), (10, "skip")], "sk int, sv string")
    done = (
        table.merge(source, F.col("k") == F.col("sk"))
        .whenMatched(F.col("sv") == "B").update({"v": F.col("sv")})
        .whenMatched().delete()
        .whenNotMatched(F.col("sv") != "skip").insert([F.col("sk"), F.col("sv")])
        .collect()
    )
    assert done == (1, 1, 1) and rows(table) == [(1, "a"), (2, "B"), (9, "N")]
    double = session.createDataFrame([(1, "x"), (1, "y")], "sk int, sv string")
    with pytest.raises(ValueError, match="several"):
        table.merge(double, F.col("k") == F.col("sk")).whenMatched().update({"v": F.col("sv")}).collect()


def test_save_modes_and_views(session, pairs):
    pairs.write.saveAsTable("t_modes")
    pairs.write.saveAsTable("t_modes")
    assert session.table("t_modes").count() == 12
    session.table("t_modes").limit(3).write.mode("overwrite").saveAsTable("t_modes")
    pairs.write.mode("ignore").saveAsTable("t_modes")
    assert session.table("t_modes").count() == 3
    with pytest.raises(ValueError):
        pairs.write.mode("error").saveAsTable("t_modes")
    pairs.select("b", "a").write.option("columnOrder", "name").saveAsTable("t_modes")
    assert session.table("t_modes").count() == 9
    session.sql("select a from t_modes").createOrReplaceView("v_modes")
    assert session.table("v_modes").count() == 9
    with pytest.raises(ValueError):
        session.sql("show tables").createOrReplaceView("v_bad")
    session.spark.sql("DROP VIEW v_modes")
    session.spark.sql("DROP TABLE t_modes")


def test_files(session, tmp_path, pairs):
    out = pairs.write.option("HEADER", True).csv(str(tmp_path / "c"))
    assert out.rows_unloaded == 6 and out.output_bytes > 0
    back = session.read.schema("a int, b int").option("SKIP_HEADER", 1).csv(str(tmp_path / "c"))
    assert rows(back) == rows(pairs)
    with pytest.raises(ValueError):
        session.read.csv(str(tmp_path / "c"))
    pairs.write.parquet(str(tmp_path / "p"))
    one = session.read.parquet(str(tmp_path / "p"))
    assert one.columns == ["$1"] and one.native.columns == ["a", "b"]
    pairs.write.json(str(tmp_path / "j"))
    assert session.read.json(str(tmp_path / "j")).select(F.variant_get("$1", "$.a", "int").alias("a")).count() == 6
    with pytest.raises(ValueError):
        pairs.write.option("NOPE", 1)
    with pytest.raises(ValueError):
        session.read.schema("a int").json(str(tmp_path / "j"))
    (tmp_path / "broken.csv").write_text("1,one,1.2\n2,two,x\n")
    loose = session.read.schema("a int, b string, c double").option("ON_ERROR", "CONTINUE").csv(str(tmp_path / "broken.csv"))
    assert len(loose.collect()) == 1


def test_copy_into(session, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,one,1.2\n2,two,2.2\n")
    session.spark.sql("DROP TABLE IF EXISTS t_copy")
    session.spark.sql("CREATE TABLE t_copy (a int, b string, c double) USING parquet")
    files = session.read.schema("a int, b string, c double").csv(str(tmp_path / "in"))
    assert files.copyInto("t_copy") == 1 and files.copyInto("t_copy") == 0
    assert session.table("t_copy").count() == 2
    files.copyInto("t_copy", ["a", "c"], [F.col("a") + 10, F.col("c")], {"FORCE": True})
    assert rows(session.table("t_copy"))[-1][0] == 2 and session.table("t_copy").count() == 4
    with pytest.raises(ValueError):
        files.copyInto("t_copy", ["a"], [F.col("a"), F.col("b")], {"FORCE": True})
    session.spark.sql("DROP TABLE t_copy")


def test_stages(session, tmp_path):
    (tmp_path / "x.txt").write_text("hello")
    assert session.file.put(str(tmp_path / "x.txt"), "@st")[0].status == "UPLOADED"
    assert session.file.put(str(tmp_path / "x.txt"), "@st")[0].status == "SKIPPED"
    assert session.file.downloadStream("@st/x.txt.gz").read() == b"hello"
    assert session.file.get("@st", str(tmp_path / "back"))[0].file == "x.txt.gz"


def test_user_defined(session, pairs):
    double = session.udf.registerTemporary(lambda x: x * 2, "long", "double_it")
    assert [r[0] for r in pairs.select(double("a")).limit(1).collect()] == [2]
    assert session.sql("select double_it(4) as x").first()["x"] == 8

    class Words:
        def process(self, text):
            for w in text.split():
                yield (w,)

        def endPartition(self):
            yield ("end",)

    f = session.udtf.registerTemporary(Words, "word string", "words_of")
    assert [r.word for r in session.tableFunction(f(F.lit("a b"))).collect()][:2] == ["a", "b"]

    class Mean:
        def initialize(self):
            return (0, 0)

        def accumulate(self, state, x):
            return (state[0] + x, state[1] + 1)

        def merge(self, a, b):
            return (a[0] + b[0], a[1] + b[1])

        def terminate(self, state):
            return state[0] / state[1]

    mean = session.udaf.registerTemporary(Mean, "double")
    assert rows(pairs.groupBy("a").agg(mean("b").alias("m"))) == [(1, 1.5), (2, 1.5), (3, 1.5)]
    assert rows(Frame(mean.partial(pairs.df, ["a"], ["b"], "m"))) == [(1, 1.5), (2, 1.5), (3, 1.5)]
    plus = session.sproc.registerTemporary(lambda s, x: x + 1, "plus_one")
    assert session.storedProcedure(plus, 4).first()[0] == 5 and session.storedProcedure("plus_one", 1).first()[0] == 2


def test_jobs_tags_names(session, pairs):
    job = pairs.async_.count()
    assert job.getResult(60) == 6 and job.isDone() and session.createAsyncJob(job.getQueryId()) is job
    assert len(pairs.async_.collect().getRows()) == 6
    session.setQueryTag('{"a": 1}')
    session.updateQueryTag('{"b": 2}')
    assert session.getQueryTag() == '{"a": 1, "b": 2}'
    session.unsetQueryTag()
    assert session.getQueryTag() is None and session.getCurrentSchema() == "default"
    assert session.sql("select ? as x", [3]).first()["x"] == 3
    assert session.generator(3, F.col("id")).count() == 3 and "spark" in session.getSessionInfo()
    with pytest.raises(NotImplementedError):
        session.jdbcConnection()
    assert pairs.filter(F.col("a") == S.toScalar(session.createDataFrame([(3,)], ["m"]))).count() == 2
    with pytest.raises(ValueError):
        S.toScalar(pairs)


def _csv(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_csv_options_beyond_the_plain_reader(spark, tmp_path):
    session = Session(spark)
    path = _csv(tmp_path, a="h1\nh2\n1,x,1.5\n-,NA,\n3,\"q,r\",2.5\n", b="h1\nh2\n4,y,0.5\n")
    reader = session.read.schema("i int, t string, d double").option("SKIP_HEADER", 2)
    got = sorted(map(tuple, reader.options({"NULL_IF": ["", "NA", "-"], "FIELD_OPTIONALLY_ENCLOSED_BY": '"'}).csv(path).collect()), key=str)
    assert got == [(1, "x", 1.5), (3, "q,r", 2.5), (4, "y", 0.5), (None, None, None)]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        reader.csv(path).collect()


def test_csv_files_with_errors_are_left_out(spark, tmp_path):
    session = Session(spark)
    path = _csv(tmp_path, good="1,a\n2,b\n", bad="3,c\nx,d\n5,e\n")
    reader = session.read.schema("i int, t string")
    load = lambda how: sorted(r.i for r in reader.option("ON_ERROR", how).csv(path).collect())
    assert load("SKIP_FILE") == [1, 2] and load("SKIP_FILE_2") == load("SKIP_FILE_50%") == [1, 2, 3, 5] and load("CONTINUE") == [1, 2, 3, 5]
    assert load("SKIP_FILE_30%") == [1, 2]


def test_copy_limits_and_validation(spark, tmp_path):
    session = Session(spark)
    path = _csv(tmp_path, a="1\n" * 50, b="2\n" * 50, c="3\n" * 50)
    spark.sql("drop table if exists copy_limits")
    spark.sql("create table copy_limits (i int) using parquet")
    files = session.read.schema("i int").csv(path)
    assert files.copyInto("copy_limits", options={"VALIDATION_MODE": "RETURN_ERRORS"}) == 0 and spark.table("copy_limits").count() == 0
    assert files.copyInto("copy_limits", options={"SIZE_LIMIT": 150}) == 2 and spark.table("copy_limits").count() == 100
    assert files.copyInto("copy_limits") == 1 and spark.table("copy_limits").count() == 150


def test_aggregates_of_many_arguments(spark):
    class Sum:
        def initialize(self):
            return 0

        def accumulate(self, state, a, b, c, d, e):
            return state + a + b + c + d + e

        def merge(self, a, b):
            return a + b

        def terminate(self, state):
            return state

    df = spark.range(6).select(F.col("id").alias("k"), *[(F.col("id") * i).alias(f"c{i}") for i in range(5)])
    made = Session(spark).udaf.registerTemporary(Sum, "bigint")
    assert df.agg(made(*[f"c{i}" for i in range(5)]).alias("s")).first().s == 150
    assert made.partial(df, [], [f"c{i}" for i in range(5)], "s").first().s == 150


def test_permanent_functions_are_registered_again(spark, session):
    class Words:
        def eval(self, text):
            for w in text.split():
                yield (w,)

    class Total:
        def initialize(self):
            return 0

        def accumulate(self, state, x):
            return state + x

        def merge(self, a, b):
            return a + b

        def terminate(self, state):
            return state

    session.udf.registerPermanent(lambda x: x + 1, "bigint", "kept_plus")
    session.udtf.registerPermanent(Words, "word string", "kept_words")
    session.udaf.registerPermanent(Total, "bigint", "kept_total")
    session.sproc.registerPermanent(lambda s, x: s.range(x).count(), "kept_count")
    with pytest.raises(ValueError):
        session.udf.registerPermanent(lambda x: x, "bigint")
    later = Session(spark.newSession())
    found = later.restoreFunctions()
    assert set(found) == {"kept_plus", "kept_words", "kept_total", "kept_count"}
    assert later.sql("select kept_plus(id) x from range(2)").df.agg(F.sum("x")).first()[0] == 3
    assert later.sql("select * from kept_words('a b')").count() == 2
    assert later.sql("select kept_total(id) x from range(4)").first().x == 6
    assert later.range(3).df.agg(found["kept_total"]("id").alias("x")).first().x == 3
    assert later.sproc.known["kept_count"].f(later, 5) == 5


def test_temporary_tables_hold_the_rows_of_their_time(spark, session):
    spark.sql("create table moving (i int) using parquet")
    spark.sql("insert into moving values (1), (2)")
    session.table("moving").write.option("TABLETYPE", "temp").saveAsTable("still")
    spark.sql("insert into moving values (3)")
    assert sorted(r.i for r in session.table("still").collect()) == [1, 2] and any(t.name == "still" and t.isTemporary for t in spark.catalog.listTables())
    session.table("moving").write.option("TABLETYPE", "temp").saveAsTable("still")
    assert sorted(r.i for r in spark.table("still").collect()) == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError):
        session.table("moving").write.option("TABLETYPE", "temp").mode("errorifexists").saveAsTable("still")
    assert not any(t.name == "still" for t in spark.newSession().catalog.listTables())
