"""Queries on what the given tables don't hold, and the order in which their modules can be imported."""

import subprocess
import sys

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein import functions as S
from skein.operators import table_functions, udx
from skein.operators.frame import Frame
from skein.plans import catalogue


@pytest.mark.parametrize("name", ["catalogue", "registry", "relational_queries", "function_queries", "table_queries", "value_queries"])
def test_any_module_of_queries_can_be_imported_first(name):
    """A Python worker that unpickles a class of a module imports that module before the catalogue."""
    subprocess.run([sys.executable, "-c", f"import skein.plans.{name}"], check=True, timeout=100)


def test_udtf_words_of_awkward_texts(spark, tmp_path):
    spark.createDataFrame([(1, "a  bb\n\u00a0c"), (2, ""), (3, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(map(tuple, catalogue.QUERIES["udtf_words"](spark, str(tmp_path)).collect())) == [(1, "a", 1), (1, "bb", 2), (1, "\u00a0c", 2)]


def test_udaf_mean_skips_nulls(spark, tmp_path):
    rows = [("A", 1.0), ("A", None), ("A", 2.0), ("B", None), (None, 4.0)]
    spark.createDataFrame(rows, "l_returnflag string, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r[0]: None if pd.isna(r[1]) else r[1] for r in catalogue.QUERIES["udaf_mean"](spark, str(tmp_path)).collect()}
    assert got == {"A": 1.5, "B": None, None: 4.0}


def test_partial_aggregates_keep_large_keys_beside_null_keys(spark):
    class Largest:
        def initialize(self):
            return None

        def accumulate(self, state, x):
            return x if state is None or x is not None and x > state else state

        merge = accumulate

        def terminate(self, state):
            return state

    df = spark.createDataFrame([(2**53 + 1, 1), (None, 2**53 + 1), (None, None)], "k long, v long").coalesce(1)
    agg = udx.UdafRegistration(spark).registerTemporary(Largest, "long")
    assert set(map(tuple, agg.partial(df, ["k"], ["v"], "m").collect())) == {(2**53 + 1, 1), (None, 2**53 + 1)}


@pytest.mark.parametrize("name", ["frame_actions", "async_jobs"])
def test_actions_over_orders_send_the_driver_a_bounded_number_of_rows(spark, tmp_path, monkeypatch, name):
    spark.range(100_000).select(F.when(F.col("id") > 0, F.col("id")).alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []
    collect, iterate = Frame.collect, Frame.toLocalIterator
    monkeypatch.setattr(Frame, "collect", lambda self: (got := collect(self), seen.append(len(got)))[0])
    monkeypatch.setattr(Frame, "toLocalIterator", lambda self: (seen.append(1) or r for r in iterate(self)))
    got = catalogue.QUERIES[name](spark, str(tmp_path)).first().asDict()
    assert 0 < sum(seen) <= 128
    n = 100_000
    assert got == ({"n": n, "first": 1, "nonempty": True, "again": n, "whole": n} if name == "frame_actions" else {"n": n, "n_iter": n, "done": True, "by_id": n})


def test_parts_of_xml_elements(spark):
    texts = ['<a b="x>y"><c/></a>', '<p:a p:b="1">x &amp; y</p:a>', "<a/>", '<a b="&quot;"><!-- n --></a>', "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string").coalesce(1)
    got = df.select(S.get("x", "$"), S.get("x", "@"), S.get("x", "@b"), S.get("x", "@p:b")).collect()
    assert list(map(tuple, got)) == [("<c/>", "a", "x>y", None), ("x & y", "p:a", None, "1"), ("", "a", None, None), ("<!-- n -->", "a", '"', None), (None,) * 4, (None,) * 4]


def test_an_element_is_found_once_for_all_that_ask_it(spark):
    found = S.xmlget(F.lit("<r><a b='1'>t</a></r>"), "a")
    plan = spark.range(1).select(S.get(found, "$"), S.get(found, "@"), S.get(found, "@b"), found)._jdf.queryExecution().optimizedPlan().toString()
    evaluated = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert sum(line.split("], [")[0].count("_child(") for line in evaluated) == 1


def test_parts_of_a_batch_are_walked_in_pieces(monkeypatch):
    texts = pa.array(['{"a": {"k": 1}, "b": [1, {"k": "é"}]}', None, "[]", "3"] * 3)
    whole = table_functions._walked("BOTH")(texts)
    monkeypatch.setattr(table_functions, "WALKED", 2)
    assert table_functions._walked("BOTH")(texts).equals(whole) and table_functions._walked("ARRAY")(pa.array([], pa.string())).to_pylist() == []
    assert [p["PATH"] for p in whole[0].as_py()] == ["a", "a.k", "b", "b[0]", "b[1]", "b[1].k"] and whole[1].as_py() is None and whole[2].as_py() == []
    assert [p["THIS"] for p in table_functions._walked("ARRAY")(texts)[0].as_py()] == ['[1, {"k": "é"}]'] * 2
