"""Shared helpers: word splitting on UTF-8 bytes, row filters, tables and
files in the shared scratch folder.

Texts are handled as UTF-8 bytes inside tasks.  Both word classes used by the
operators are defined by ASCII bytes only, so splitting the bytes gives
exactly the words of the text, without decoding it.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import scratch_dir

# A-Z to a-z; 0-9, a-z and every byte of a non-ASCII character stay; the
# other ASCII bytes become blanks.
_LETTERS = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else c + 32 if 0x41 <= c <= 0x5A
    else 0x20
    for c in range(256))

CONTINUATION = bytes(range(0x80, 0xC0))   # UTF-8 bytes that start no character
BLANKS = b" \t\n\x0b\x0c\r"


def letter_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_LETTERS).split()


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return text.split()


def ship(spark: SparkSession) -> None:
    """Put this package's folder on the Python path of workers started for
    functions made from now on (they may run in any folder)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """The kept columns and the text as UTF-8 bytes (null stays null)."""
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("__utf8"))


def texts_of(column: pa.Array) -> list[bytes]:
    """Python bytes of a string or binary Arrow column, null as empty."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [b"" if t is None else t for t in column.to_pylist()]


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: helper columns cannot clash
    with them, whatever the names were; ``toDF`` with the old names undoes it."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


_HELD: dict = {"owner": None}


def claim(owner: str, key=None, make: Callable | None = None):
    """What an operator keeps in a worker from task to task (a tokenizer, a
    block of the benchmark): made when its key is new, one at a time.  Workers
    outlive their stage, so the first task of another operator frees it and
    gives the memory back to the system."""
    if _HELD["owner"] != owner or (make is not None and _HELD.get("key") != key):
        had = _HELD.pop("value", None) is not None
        _HELD.clear()
        _HELD.update(owner=owner, key=key)
        if had:
            _give_back()
    if make is not None and "value" not in _HELD:
        _HELD["value"] = make()
    return _HELD.get("value")


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def filter_rows(docs: DataFrame, text: str, keep: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows whose text ``keep`` accepts, all columns unchanged."""
    at, rows = docs.columns.index(text), positional(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(keep.__module__)
        for batch in batches:
            yield batch.filter(pa.array(keep(texts_of(batch.column(at))), pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared scratch folder and read
    back: cuts the lineage, survives lost executors and gives the planner the
    table's size."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it."""
    if uri.startswith("file:"):
        uri = re.sub(r"^file:/*", "/", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def task_name() -> str:
    """Name of this task for its files: partition and attempt.  Each attempt
    (a retry, a speculative copy) has files of its own, since not every store
    lets a move replace a file; readers follow the names that the successful
    attempt returned."""
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


def write_file(uri: str, write: Callable) -> int:
    """Write a file under a temporary name and move it into place, so a
    retried or a lost task never leaves a partial file; returns its bytes."""
    store, path = open_fs(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as out:
        write(out)
        size = out.tell()
    store.move(part, path)
    return size


def read_file(uri: str) -> bytes:
    store, path = open_fs(uri)
    with store.open_input_file(path) as f:
        return f.read()
