"""What the operators share: text as bytes, written intermediate tables, lower case, words."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

# ASCII letters.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def text_bytes(column: str = "text") -> Column:
    """UTF-8 of a text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def valid_utf8(texts: list[bytes]) -> list[bytes]:
    """Texts with bytes that are not UTF-8 replaced; Spark does not check them."""
    try:
        b"".join(texts).decode()
    except UnicodeDecodeError:
        return [t.decode("utf-8", "replace").encode() for t in texts]
    return texts


def space_words(text: bytes) -> list[bytes]:
    """Words between spaces, tabs, line feeds, vertical tabs, form feeds and returns; A-Z in lower case."""
    return text.translate(ASCII_LOWER).split()


def blocks_of(part: pa.RecordBatch, size: int, text: int = -1) -> Iterator[list[tuple]]:
    """The rows of a batch in lists of about ``size`` bytes of the text column; only one list is held as objects."""
    block: list[tuple] = []
    held = 0
    for begin in range(0, part.num_rows, 64):
        for row in zip(*(c.to_pylist() for c in part.slice(begin, 64).columns), strict=True):
            block.append(row)
            held += len(row[text])
            if held >= size:
                yield block
                block, held = [], 0
    if block:
        yield block


_HELD: dict = {}


def hold(name: str, make: Callable[[], T]) -> T:
    """One large object a worker process, kept from task to task until another or :func:`release` takes its place."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def release() -> None:
    """Called by tasks that hold nothing: what an earlier operator left in this worker goes."""
    _HELD.clear()


#: Bytes of an Arrow batch on its way to a Python worker and back; each running task holds a few.
BATCH_BYTES = 8 << 20
#: Rows that a Parquet reader holds at once in the JVM, in arrays as long as all their texts; a task has one or two readers.
READER_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """What the operators need of the session: small batches, and the package for their Python workers.

    Workers on this machine look for the package where the driver found it; a
    cluster is given it with --py-files. Batch size is bounded by bytes, since a
    row may hold a text of any length; Parquet readers can bound rows only.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


class Numbers(dict):
    """Numbers things in the order in which they are met."""

    def __missing__(self, thing: object) -> int:
        value = self[thing] = len(self)
        return value


# Odd multipliers of the hash function.
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Bytes of a word that are hashed in step with the others'.
IN_STEP = 64


def byte_hashes(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every range of bytes, eight bytes of all of them at a time; few ranges may be long."""
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the bytes from each place on
    size = end - begin
    key = size.astype(np.uint64) * ODD[0]
    todo, at, left = np.flatnonzero(size <= IN_STEP), begin, size
    if len(todo) < len(size):
        at, left = at[todo], left[todo]
    while len(todo):
        unused = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)
        h = (key[todo] ^ eight[at] & np.uint64(0xFFFFFFFFFFFFFFFF) >> unused) * ODD[1]
        key[todo] = (h ^ h >> np.uint64(32)) * ODD[2]
        on = np.flatnonzero(left > 8)
        todo, at, left = todo[on], at[on] + 8, left[on] - 8
    for k in np.flatnonzero(size > IN_STEP).tolist():
        key[k] = xxhash.xxh64_intdigest(data[begin[k] : end[k]])
    return key ^ key >> np.uint64(29)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder on storage that driver and executors share: below ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to shared storage and read it back: computed once, cut lineage, safe from lost executors."""
    return stored_at(df, purpose)[0]


def stored_at(df: DataFrame, purpose: str, page_rows: int | None = None) -> tuple[DataFrame, str]:
    """The same, with the folder, for :func:`discard`; ``page_rows``: at most so many rows a page, for rows of megabytes."""
    path = shared_folder(df.sparkSession, purpose)
    pages = {} if page_rows is None else {"parquet.page.row.count.limit": str(page_rows)}
    df.write.option("compression", "zstd").options(**pages).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of :func:`shared_folder` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
