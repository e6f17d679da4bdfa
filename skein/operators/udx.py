"""User-defined scalar functions, table functions, aggregates and procedures."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.core import as_column

from .table_functions import TableFunction


def _named(prefix: str, name: str | None) -> str:
    return name or f"{prefix}_{uuid.uuid4().hex}"


class _Kept:
    """Permanent registrations: pickled files in the warehouse, which every later session of it registers again."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_skein_functions"

    def _path(self, name: str = "") -> tuple[Any, Any]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put(self, kind: str, name: str | None, args: tuple) -> None:
        if not name or not name.isidentifier():
            raise ValueError("a permanent function needs a name of letters, digits and underscores")
        path, fs = self._path(f"{kind}-{name}.pickle")
        out = fs.create(path, True)
        out.write(bytearray(cloudpickle.dumps((name, args))))
        out.close()

    def drop(self, kind: str, name: str) -> None:
        path, fs = self._path(f"{kind}-{name}.pickle")
        fs.delete(path, False)

    def all(self, kind: str) -> list[tuple]:
        path, fs = self._path()
        if not fs.exists(path):
            return []
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", f"{kind}-*.pickle").load(self.root)
        return [cloudpickle.loads(bytes(r["content"])) for r in files.select("content").collect()]  # one row for each function


class UdfRegistration:
    """Scalar functions. A permanent one is kept in the warehouse; `restore` registers all of them in a later session."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def registerPermanent(self, f: Callable, returnType: Any = "string", name: str | None = None, vectorized: bool = False) -> Callable[..., Column]:
        _Kept(self.spark).put("udf", name, (f, returnType, vectorized))
        return self.registerTemporary(f, returnType, name, vectorized)

    def restore(self) -> dict[str, Callable[..., Column]]:
        return {name: self.registerTemporary(f, kind, name, vectorized) for name, (f, kind, vectorized) in _Kept(self.spark).all("udf")}

    def registerTemporary(self, f: Callable, returnType: Any = "string", name: str | None = None, vectorized: bool = False) -> Callable[..., Column]:
        made = F.pandas_udf(f, returnType) if vectorized else F.udf(f, returnType, useArrow=True)
        self.spark.udf.register(_named("udf", name), made)
        return lambda *columns: made(*map(as_column, columns))


class UdtfRegistration:
    """Table functions: classes with eval (or process) and terminate (or endPartition) that yield tuples."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def registerTemporary(self, cls: type, returnType: str, name: str | None = None) -> TableFunction:
        known = _named("udtf", name)
        row, end = (getattr(cls, n, None) or getattr(cls, m, None) for n, m in (("eval", "process"), ("terminate", "endPartition")))

        class Handler(cls):
            """Spark can't place rows that the end of an empty partition yields: there is no input row beside them."""

            def eval(self, *args: Any):
                self._seen = True
                yield from row(self, *args) or ()

            def terminate(self):
                if end is not None and getattr(self, "_seen", False):
                    yield from end(self) or ()

        cls = Handler
        self.spark.udtf.register(known, F.udtf(cls, returnType=returnType))
        return TableFunction(known)

    def registerPermanent(self, cls: type, returnType: str, name: str | None = None) -> TableFunction:
        _Kept(self.spark).put("udtf", name, (cls, returnType))
        return self.registerTemporary(cls, returnType, name)

    def restore(self) -> dict[str, TableFunction]:
        return {name: self.registerTemporary(cls, kind, name) for name, (cls, kind) in _Kept(self.spark).all("udtf")}


class UdafRegistration:
    """Aggregates by four methods: initialize() to a state, accumulate(state, *row), merge(a, b), terminate(state)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def registerTemporary(self, handler: Any, returnType: str, name: str | None = None) -> Aggregate:
        agg = Aggregate(handler() if isinstance(handler, type) else handler, returnType)
        if name:
            self.spark.udf.register(name, agg.whole_group())
        return agg

    def registerPermanent(self, handler: Any, returnType: str, name: str | None = None) -> Aggregate:
        _Kept(self.spark).put("udaf", name, (handler, returnType))
        return self.registerTemporary(handler, returnType, name)

    def restore(self) -> dict[str, Aggregate]:
        return {name: self.registerTemporary(handler, kind, name) for name, (handler, kind) in _Kept(self.spark).all("udaf")}


class Aggregate:
    def __init__(self, handler: Any, returnType: str):
        self.handler, self.returnType = handler, returnType

    def whole_group(self):
        """A pandas aggregate of any number of columns: a group's rows come to one task in one batch. For groups of moderate
        size; `partial` is for others."""
        h = self.handler

        def fold(*columns: pd.Series):
            state = h.initialize()
            for row in zip(*columns, strict=True):
                state = h.accumulate(state, *row)
            return h.terminate(state)

        return F.pandas_udf(fold, self.returnType, F.PandasUDFType.GROUPED_AGG)

    def __call__(self, *columns: Any) -> Column:
        return self.whole_group()(*map(as_column, columns))

    def partial(self, df: DataFrame, keys: list[str], columns: list[str], output: str) -> DataFrame:
        """Groups of any size: each batch of rows is folded to one state for each key in it, states move to their
        keys and are merged there. States travel pickled. A null argument is None, and whole numbers stay whole beside nulls."""
        import pickle

        h, n_keys = self.handler, len(keys)
        key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

        def fold(batches):
            for b in batches:
                states: dict = {}
                for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    k = row[:n_keys]
                    states[k] = h.accumulate(states[k] if k in states else h.initialize(), *row[n_keys:])
                out = [pa.array([k[i] for k in states], b.schema.field(i).type) for i in range(n_keys)]
                yield pa.RecordBatch.from_arrays([*out, pa.array(map(pickle.dumps, states.values()), pa.binary())], [*keys, "_state"])

        def merge(key, group):
            state = None
            for raw in group["_state"]:
                s = pickle.loads(raw)
                state = s if state is None else h.merge(state, s)
            return pd.DataFrame([(*key, h.terminate(state))], columns=[*keys, output])

        sep = ", " if keys else ""
        states = df.select(*keys, *columns).mapInArrow(fold, f"{key_schema}{sep}_state binary")
        return states.groupBy(*keys).applyInPandas(merge, f"{key_schema}{sep}`{output}` {self.returnType}")


class ProcedureRegistration:
    """Procedures: functions of the session and arguments, run where they are called."""

    def __init__(self, session: Any):
        self.session, self.known = session, {}

    def registerTemporary(self, f: Callable, name: str | None = None) -> StoredProcedure:
        made = StoredProcedure(_named("procedure", name), f)
        self.known[made.name] = made
        return made

    def registerPermanent(self, f: Callable, name: str | None = None) -> StoredProcedure:
        _Kept(self.session.spark).put("procedure", name, (f,))
        return self.registerTemporary(f, name)

    def restore(self) -> dict[str, StoredProcedure]:
        return {name: self.registerTemporary(f, name) for name, (f,) in _Kept(self.session.spark).all("procedure")}

    def runLocally(self, f: Callable, *args: Any) -> Any:
        return f(self.session, *args)


class StoredProcedure:
    def __init__(self, name: str, f: Callable):
        self.name, self.f = name, f
