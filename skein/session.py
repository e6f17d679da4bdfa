"""The session: where frames come from."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, Row, SparkSession
from pyspark.sql.types import StructType

from .operators import asyncjobs, udx
from .operators.dml import Table
from .operators.frame import Frame
from .operators.table_functions import TableCall, TableFunction
from .operators.table_functions import flatten as flatten_call
from .sources.files import FileOperations
from .sources.reader import FrameReader

CONF = {"spark.sql.timeType.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}


class SessionBuilder:
    def __init__(self):
        self._config: dict[str, str] = {}
        self._name: str | None = None

    def appName(self, name: str) -> SessionBuilder:
        self._name = name
        return self

    def config(self, key: str, value: Any) -> SessionBuilder:
        self._config[key] = str(value)
        return self

    def configs(self, values: dict[str, Any]) -> SessionBuilder:
        self._config |= {k: str(v) for k, v in values.items()}
        return self

    def configFile(self, path: str) -> SessionBuilder:
        """A properties file: key = value lines, # for comments."""
        with open(path) as f:
            for line in f:
                if m := re.match(r"\s*([^#!=:\s]+)\s*[=:]\s*(.*?)\s*$", line):
                    self._config[m[1]] = m[2]
        return self

    def _spark(self) -> SparkSession:
        b = SparkSession.builder.config(map=CONF | self._config)
        return (b.appName(self._name) if self._name else b).getOrCreate()

    def getOrCreate(self) -> Session:
        return Session(self._spark())

    def create(self) -> Session:
        return Session(self._spark().newSession())


class _Builder:
    def __get__(self, *_: Any) -> SessionBuilder:
        return SessionBuilder()


class Session:
    builder = _Builder()

    def __init__(self, spark: SparkSession):
        self.spark = spark
        for k, v in CONF.items():
            spark.conf.set(k, v)
        self.udf, self.udtf, self.udaf = udx.UdfRegistration(spark), udx.UdtfRegistration(spark), udx.UdafRegistration(spark)
        self.sproc, self.file = udx.ProcedureRegistration(self), FileOperations(spark)
        self._tag: str | None = None
        self._dependencies: list[str] = []
        self._stage: str | None = None

    # ---- frames

    @property
    def read(self) -> FrameReader:
        return FrameReader(self.spark)

    def table(self, name: str | Sequence[str]) -> Table:
        return Table(self.spark, name if isinstance(name, str) else ".".join(f"`{x}`" for x in name))

    def sql(self, query: str, params: Sequence[Any] | None = None) -> Frame:
        out = Frame(self.spark.sql(query, args=list(params)) if params else self.spark.sql(query))
        out.source_sql = None if params else query
        return out

    def createDataFrame(self, data: Sequence[Any], schema: StructType | Sequence[str] | str | None = None) -> Frame:
        return Frame(self.spark.createDataFrame([x if isinstance(x, (tuple, list, Row, dict)) else (x,) for x in data], schema))

    def range(self, start: int, end: int | None = None, step: int = 1) -> Frame:
        """One column ID; empty if the step leads away from the end."""
        if step == 0:
            raise ValueError("a range can't have step 0")
        lo, hi = (0, start) if end is None else (start, end)
        return Frame(self.spark.range(lo, hi, step).toDF("ID"))

    def generator(self, rows: int, *columns: Column) -> Frame:
        if not columns:
            raise ValueError("a generator needs columns")
        return Frame(self.spark.range(rows).select(*columns))

    def tableFunction(self, f: TableFunction | TableCall, *args: Any, **named: Any) -> Frame:
        """A call on literals, or on columns of one frame given as `frame`; only the call's columns are returned."""
        frame = named.pop("frame", None)
        call = f if isinstance(f, TableCall) else f(*args, **named)
        if frame is None:
            return Frame(call.alone(self.spark))
        joined, new = call.join(frame.df)
        return Frame(joined.select(*[f"`{c}`" for c in new]))

    def flatten(self, column: Any, path: str = "", outer: bool = False, recursive: bool = False, mode: str = "BOTH") -> Frame:
        return self.tableFunction(flatten_call(column, path, outer, recursive, mode))

    def storedProcedure(self, procedure: udx.StoredProcedure | str, *args: Any) -> Frame:
        known = self.sproc.known[procedure] if isinstance(procedure, str) else procedure
        out = known.f(self, *args)
        return out if isinstance(out, Frame) else self.createDataFrame([(out,)], [known.name])

    # ---- jobs

    def restoreFunctions(self) -> dict[str, Any]:
        """Registers the warehouse's permanent functions in this session, by name. They are pickles: only for a warehouse
        that one trusts."""
        return self.udf.restore() | self.udtf.restore() | self.udaf.restore() | self.sproc.restore()

    def cancelAll(self) -> None:
        self.spark.interruptAll()

    def createAsyncJob(self, query_id: str) -> asyncjobs.AsyncJob:
        return asyncjobs.job(query_id)

    def setQueryTag(self, tag: str) -> None:
        self.unsetQueryTag()
        self._tag = tag
        self.spark.addTag(self._spark_tag())

    def _spark_tag(self) -> str:
        return (self._tag or "").replace(",", ";")

    def unsetQueryTag(self) -> None:
        if self._tag is not None:
            self.spark.removeTag(self._spark_tag())
        self._tag = None

    def getQueryTag(self) -> str | None:
        return self._tag

    def updateQueryTag(self, tag: str) -> None:
        """Merges a JSON object into the current tag, which must be one too."""
        self.setQueryTag(json.dumps((json.loads(self._tag) if self._tag else {}) | json.loads(tag)))

    # ---- dependencies

    def addDependency(self, path: str) -> None:
        if path not in self._dependencies:
            if path.endswith((".py", ".zip", ".egg")):
                self.spark.sparkContext.addPyFile(path)
            else:
                self.spark.sparkContext.addFile(path, recursive=True)
            self._dependencies.append(path)

    def removeDependency(self, path: str) -> None:
        """Spark can't take a file back from executors; it is only forgotten here."""
        if path in self._dependencies:
            self._dependencies.remove(path)

    def getDependencies(self) -> set[str]:
        return set(self._dependencies)

    # ---- names

    def getDefaultDatabase(self) -> str | None:
        return self.spark.conf.get("spark.sql.defaultCatalog", "spark_catalog")

    def getDefaultSchema(self) -> str | None:
        return "default"

    def getCurrentDatabase(self) -> str:
        return self.spark.catalog.currentCatalog()

    def getCurrentSchema(self) -> str:
        return self.spark.catalog.currentDatabase()

    def getFullyQualifiedCurrentSchema(self) -> str:
        return f"{self.getCurrentDatabase()}.{self.getCurrentSchema()}"

    def getSessionStage(self) -> str:
        if self._stage is None:
            self._stage = f"@session_{self.spark.sparkContext.applicationId}_{uuid.uuid4().hex[:8]}"
        return self._stage

    def getSessionInfo(self) -> str:
        import platform

        return json.dumps({"spark": self.spark.version, "python": platform.python_version(), "application": self.spark.sparkContext.applicationId})

    def jdbcConnection(self):
        raise NotImplementedError("there is no JDBC connection: Spark runs the queries")

    def close(self) -> None:
        self.spark.stop()
