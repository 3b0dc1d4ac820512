"""Zip archives as a data source of lines, and their passwords."""

from __future__ import annotations

import glob
import os
import shutil
import subprocess
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def is_encrypted(path: str) -> bool:
    """By the first entry's flag; the extension does not count. Files that are no zips are not."""
    if not zipfile.is_zipfile(path):
        return False
    with zipfile.ZipFile(path) as z:
        return bool(z.infolist() and z.infolist()[0].flag_bits & 1)


def password(path: str) -> str:
    """From a .env file beside the archive (which does not override the environment), ZIP_PASSWORD, or the only variable
    whose name holds PASSWORD."""
    env = dict(os.environ)
    side = Path(path).parent / ".env"
    if side.exists():
        for line in side.read_text().splitlines():
            key, sep, value = line.strip().partition("=")
            if sep and not key.startswith("#"):
                env.setdefault(key.strip(), value.strip().strip("'\""))
    if "ZIP_PASSWORD" in env:
        return env["ZIP_PASSWORD"]
    names = [k for k in env if "PASSWORD" in k]
    if len(names) != 1:
        raise ValueError(f"expected one password variable for {path}, found {sorted(names)}")
    return env[names[0]]


def require_7z() -> str:
    if not (tool := shutil.which("7z") or shutil.which("7zz")):
        raise RuntimeError("AES archives need the 7z program: install p7zip or 7-Zip")
    return tool


def lines_of(path: str, secret: str | None = None) -> Iterator[str]:
    """Lines of all files of an archive, a part in memory at a time. Plain and classically encrypted ones are read here,
    others by 7z."""
    try:
        with zipfile.ZipFile(path) as z:
            for info in z.infolist():
                if not info.is_dir():
                    with z.open(info, pwd=secret.encode() if secret and info.flag_bits & 1 else None) as f:
                        for line in f:
                            yield line.decode().rstrip("\r\n")
        return
    except (NotImplementedError, zipfile.BadZipFile):
        pass
    run = subprocess.Popen([require_7z(), "e", "-so", *([f"-p{secret}"] if secret else []), path], stdout=subprocess.PIPE, text=True)
    with run:
        yield from (line.rstrip("\r\n") for line in run.stdout)
    if run.returncode:
        raise RuntimeError(f"7z ended with {run.returncode} on {path}")


class _Part(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = sorted(glob.glob(options["path"])) or [options["path"]]
        self.secret = options.get("password")

    def partitions(self) -> list[_Part]:
        return [_Part(p) for p in self.paths]

    def read(self, partition: _Part) -> Iterator[tuple[str]]:
        for line in lines_of(partition.path, self.secret):
            if line.strip():
                yield (line,)


class ZipLines(DataSource):
    """spark.read.format("ziplines").load(glob): one task per archive, column value."""

    @classmethod
    def name(cls) -> str:
        return "ziplines"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: object) -> _Reader:
        return _Reader(self.options)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Archives must lie where every executor sees them under the same path."""
    spark.dataSource.register(ZipLines)
    reader = spark.read.format("ziplines")
    if any(is_encrypted(p) for p in glob.glob(path)):
        reader = reader.option("password", password(path))
    return reader.load(path)


def first_line(path: str) -> str:
    return next(lines_of(path))
