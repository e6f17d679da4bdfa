"""Stages: named folders under the warehouse. Files move through Hadoop's file systems, so any store will do."""

from __future__ import annotations

import glob
import gzip
import io
import os
from collections import namedtuple
from typing import Any, BinaryIO

from pyspark.sql import SparkSession

PutResult = namedtuple("PutResult", "source target source_size target_size status")
GetResult = namedtuple("GetResult", "file size status")


class FileOperations:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def location(self, stage: str) -> str:
        """'@name/folder' to a folder of the warehouse; other paths stay."""
        if not stage.startswith("@"):
            return stage
        return f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages/{stage[1:].strip('/')}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def put(self, local: str, stage: str, options: dict[str, Any] | None = None) -> list[PutResult]:
        """Uploads local files (wildcards too). AUTO_COMPRESS (default true) packs them with gzip; OVERWRITE
        (default false) replaces what is there."""
        opts = {k.upper(): str(v).lower() for k, v in (options or {}).items()}
        out = []
        found = sorted(glob.glob(local.removeprefix("file://")))
        if not found:
            raise FileNotFoundError(local)
        for name in found:
            pack = opts.get("AUTO_COMPRESS", "true") == "true" and not name.endswith(".gz")
            target = os.path.basename(name) + (".gz" if pack else "")
            fs, p = self._fs(f"{self.location(stage)}/{target}")
            if fs.exists(p) and opts.get("OVERWRITE", "false") != "true":
                out.append(PutResult(os.path.basename(name), target, os.path.getsize(name), 0, "SKIPPED"))
                continue
            with open(name, "rb") as f:
                self.uploadStream(f"{self.location(stage)}/{target}", f, pack)
            out.append(PutResult(os.path.basename(name), target, os.path.getsize(name), fs.getFileStatus(p).getLen(), "UPLOADED"))
        return out

    def get(self, stage: str, folder: str, options: dict[str, Any] | None = None) -> list[GetResult]:
        """Downloads a file, or all files of a folder."""
        fs, p = self._fs(self.location(stage))
        os.makedirs(folder.removeprefix("file://"), exist_ok=True)
        out = []
        for s in fs.listStatus(p):
            if s.isFile():
                name = s.getPath().getName()
                with open(os.path.join(folder.removeprefix("file://"), name), "wb") as f:
                    f.write(self._read(s.getPath().toString()))
                out.append(GetResult(name, s.getLen(), "DOWNLOADED"))
        return out

    def uploadStream(self, stage_file: str, stream: BinaryIO, compress: bool = True) -> None:
        fs, p = self._fs(self.location(stage_file))
        data = stream.read()
        sink = fs.create(p, True)
        try:
            sink.write(bytearray(gzip.compress(data) if compress else data))
        finally:
            sink.close()

    def _read(self, path: str) -> bytes:
        fs, p = self._fs(path)
        source = fs.open(p)
        try:
            return bytes(source.readAllBytes())
        finally:
            source.close()

    def downloadStream(self, stage_file: str, decompress: bool = True) -> BinaryIO:
        data = self._read(self.location(stage_file))
        return io.BytesIO(gzip.decompress(data) if decompress and data[:2] == b"\x1f\x8b" else data)

    def list(self, stage: str) -> list[tuple[str, int]]:
        fs, p = self._fs(self.location(stage))
        return [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(p)] if fs.exists(p) else []
