"""Asynchronous actions: the same actions on a thread of their own, under a job tag that can be cancelled."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from concurrent.futures import TimeoutError as FutureTimeout
from typing import Any

from pyspark.sql import SparkSession

_POOL = ThreadPoolExecutor(max_workers=8, thread_name_prefix="skein-async")
_JOBS: dict[str, AsyncJob] = {}


class AsyncJob:
    def __init__(self, spark: SparkSession, work: Callable[[], Any]):
        self.spark, self.id = spark, f"job-{uuid.uuid4().hex}"
        _JOBS[self.id] = self
        self.future: Future = _POOL.submit(self._run, work)

    def _run(self, work: Callable[[], Any]) -> Any:
        self.spark.addTag(self.id)
        try:
            return work()
        finally:
            self.spark.removeTag(self.id)

    def getQueryId(self) -> str:
        return self.id

    def isDone(self) -> bool:
        return self.future.done()

    def cancel(self) -> None:
        self.future.cancel()
        self.spark.interruptTag(self.id)

    def getResult(self, max_wait_seconds: float | None = None) -> Any:
        try:
            return self.future.result(max_wait_seconds)
        except FutureTimeout as e:
            raise TimeoutError(f"{self.id} has not finished after {max_wait_seconds} s") from e

    def getRows(self, max_wait_seconds: float | None = None) -> list:
        out = self.getResult(max_wait_seconds)
        return out if isinstance(out, list) else list(out)

    def getIterator(self, max_wait_seconds: float | None = None) -> Iterator:
        return iter(self.getResult(max_wait_seconds))


def job(query_id: str) -> AsyncJob:
    """A job of this process by its id."""
    return _JOBS[query_id]


class AsyncFrame:
    def __init__(self, frame: Any):
        self.frame = frame

    def _start(self, work: Callable[[], Any]) -> AsyncJob:
        return AsyncJob(self.frame.session, work)

    def collect(self) -> AsyncJob:
        return self._start(self.frame.collect)

    def toLocalIterator(self) -> AsyncJob:
        return self._start(self.frame.toLocalIterator)

    def count(self) -> AsyncJob:
        return self._start(self.frame.count)


class AsyncTable(AsyncFrame):
    def update(self, *args: Any, **named: Any) -> AsyncJob:
        return self._start(lambda: self.frame.update(*args, **named))

    def delete(self, *args: Any, **named: Any) -> AsyncJob:
        return self._start(lambda: self.frame.delete(*args, **named))


class AsyncMerge:
    def __init__(self, builder: Any):
        self.builder = builder

    def collect(self) -> AsyncJob:
        return AsyncJob(self.builder.target.spark, self.builder.collect)


class AsyncWriter:
    def __init__(self, writer: Any):
        self.writer = writer

    def __getattr__(self, name: str):
        if name not in ("csv", "json", "parquet", "saveAsTable"):
            raise AttributeError(name)
        return lambda *args: AsyncJob(self.writer.frame.session, lambda: getattr(self.writer, name)(*args))


class AsyncCopy:
    def __init__(self, frame: Any):
        self.frame = frame

    def copyInto(self, *args: Any, **named: Any) -> AsyncJob:
        return AsyncJob(self.frame.session, lambda: self.frame.copyInto(*args, **named))
