"""Helpers shared by the training-data operators: words, folds, the shared folder, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from typing import Any, TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: A word: a run of anything but the ASCII white space characters 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; bytes.lower and bytes.split know ASCII only, as WORD asks."""
    return text.lower().split() if text else []


def fold(doc_id: str | Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % n


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; one of our own only where that is unset."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-shared-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cuts the lineage: writes a table to the shared folder and reads it back, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_memory: dict[str, Any] = {}


def remembered(owner: str, make: Callable[[], T]) -> T:
    """What a worker keeps between the tasks of one operator's run; what it kept for another run is forgotten, since
    workers outlive operators.
    """
    if owner not in _memory:
        _memory.clear()
        _memory[owner] = make()
    return _memory[owner]


def forget() -> None:
    _memory.clear()


def utf8(batch: pa.RecordBatch | pa.Table, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    return col.cast(pa.large_binary() if big else pa.binary()).to_pylist()
