"""The pipeline on the smallest tables: columns, order, effect of each stage; and its queries against DuckDB."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skein.llm import queries
from skein.llm.common import Workspace, table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def test_stages(spark):
    docs, ws = table(spark, DATA, "documents"), Workspace(spark, "stages")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = ws.put(f"s{k}", stage(spark, docs, DATA))
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left and left <= ids, name
        if k < 4:
            assert docs.columns == columns
        else:
            assert left == ids and docs.columns == [*columns, "shard", "slot"]
        ids = left
    assert {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()} == ids


@pytest.fixture
def edges(spark, tmp_path):
    """Documents with every awkward case, and a folder with labels and benchmark for them."""
    r = random.Random(3)
    text = lambda n: " ".join(f"w{r.randrange(4000)}" for _ in range(n))
    item = text(30)
    rows = [(i, text(r.randrange(60, 120)), ["en", "de", None][i % 3], f"src{i % 3}") for i in range(120)]
    rows += [(200 + i, " ".join(w + "###" for w in text(60).split()), "en", "src1") for i in range(60)]
    rows += [(300, None, "en", "src1"), (301, "", "en", None), (None, None, None, None), (None, text(50), "en", "src0"), (302, text(100_000), "en", "src2")]
    rows += [(303, rows[5][1], "en", "src1"), (304, rows[5][1] + " end", "en", "src1"), rows[7], rows[7], (305, text(40) + " " + item, "en", "src0")]
    names = ("domain", "n_tokens", "n_copies", "_id", "_in", "_gone", "_hit", "_leaf", "_row", "_shard", "_text", "score")
    df = spark.createDataFrame([(i, t, la, so, k) for k, (i, t, la, so) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    for n in names:
        df = df.withColumn(n, F.concat(F.lit("own "), F.col("n_chars")))
    labels = [(i, int(i < 200), 0) for i in [*range(120), *range(200, 260)]] + [(None, 1, 0), (5, None, 0), (9999, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return df, str(tmp_path)


def test_stages_on_awkward_rows(spark, edges):
    docs, folder = edges
    ws, seen = Workspace(spark, "edges"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = ws.put(f"s{k}", stage(spark, docs, folder))
        rows = docs.collect()
        assert all(r["domain"] == r["score"] == r["_in"] == f"own {r.n_chars}" for r in rows), "columns of the user's are untouched"
        seen.append({r.n_chars: r for r in rows})
    good, single, clean, mixed, sharded = seen
    ids = lambda x: sorted(r.doc_id for r in x.values() if r.doc_id is not None)
    assert set(range(120)) <= set(ids(good)) and not set(ids(good)) & set(range(200, 260))
    assert 302 in ids(good), "the very long text is good"
    assert {303, 304} & set(ids(single)) == set() and ids(single).count(7) == 3 and sum(r.doc_id is None for r in single.values()) == sum(r.doc_id is None for r in good.values())
    assert set(single) - set(clean) == {n for n, r in single.items() if r.doc_id == 305}
    assert set(mixed) <= {n for n, r in clean.items() if r.text and r.text.split()} and set(sharded) == set(mixed)
    sizes = [sum(r["shard"] == s for r in sharded.values()) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_stages_on_empty_tables(spark, edges, tmp_path):
    docs, folder = edges
    empty, none = docs.limit(0), tmp_path / "none"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{none}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0, name
    few = docs.filter("doc_id < 9")
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, few, str(none)).count() == few.count(), f"{name}: without labels or items nothing goes"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df, want = queries.QUERIES[name](spark, DATA), con.sql(queries.ORACLES[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    rows = sorted(str([r[n] for n in names]) for r in df.collect())
    assert rows == sorted(str([dict(zip(want.columns, r, strict=True))[n] for n in names]) for r in want.fetchall())
