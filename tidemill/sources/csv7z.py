"""7z archives of one vendor CSV each, as a Spark data source: format("csv7z").

An archive isn't splittable, so each is one partition; its rows stream out of a `7z x -so` child process in Arrow batches. All columns are
strings; the vendor's null tokens, quoted ones too, are null.
"""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyarrow import csv
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemill.operators.parse import NULL_TOKENS

BLOCK_BYTES = 16 << 20


def seven_zip() -> str:
    for name in ("7z", "7zz", "7za"):
        if found := shutil.which(name):
            return found
    raise RuntimeError("no 7z program on this machine")


def archives(path: str) -> list[str]:
    """FileNotFoundError if there is nothing, ValueError for another suffix."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(path)
    if p.is_dir():
        return sorted(str(f) for f in p.glob("*.7z"))
    if p.suffix != ".7z":
        raise ValueError(f"not a .7z archive: {path}")
    return [str(p)]


def header(path: str, command: list[str] | None = None) -> list[str]:
    """Column names, of the first line only; RuntimeError if there is none."""
    with subprocess.Popen([*(command or [seven_zip(), "x", "-so"]), path], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL) as child:
        line = child.stdout.readline().decode("utf-8-sig").strip()
        child.kill()
    if not line:
        raise RuntimeError(f"empty header: {path}")
    return [c.strip().strip('"') for c in line.split(",")]


def batches(path: str, columns: list[str], command: list[str] | None = None, block: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of an archive; the child ends with the reading, whichever way that ends."""
    child = subprocess.Popen([*(command or [seven_zip(), "x", "-so"]), path], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL)
    try:
        reader = csv.open_csv(
            child.stdout,
            read_options=csv.ReadOptions(column_names=columns, skip_rows=1, block_size=block),
            convert_options=csv.ConvertOptions(column_types=dict.fromkeys(columns, pa.string()), strings_can_be_null=True, quoted_strings_can_be_null=True, null_values=list(NULL_TOKENS)),
        )
        yield from reader
    finally:
        child.kill()
        child.wait()


@dataclass
class Archive(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


class Csv7zReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self) -> list[Archive]:
        return [Archive(p) for p in archives(self.path)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        own = header(partition.path)
        for b in batches(partition.path, own):
            yield pa.RecordBatch.from_arrays([b.column(own.index(c)) if c in own else pa.nulls(b.num_rows, pa.string()) for c in self.columns], names=self.columns)


class Csv7zDataSource(DataSource):
    """Option path: an archive or a folder of them; the first one's header is the schema."""

    @classmethod
    def name(cls) -> str:
        return "csv7z"

    def schema(self) -> str:
        found = archives(self.options["path"])
        if not found:
            raise FileNotFoundError(self.options["path"])
        return ", ".join(f"`{c}` string" for c in header(found[0]))

    def reader(self, schema) -> DataSourceReader:
        return Csv7zReader(self.options["path"], schema.names)
