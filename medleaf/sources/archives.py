"""Reading what is published: manifests, archives of records, and clinical terminology."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medleaf import schemas


def read_manifest(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(file, records, partition_index from 1, total_records) of the archives of `ndc` or `label`."""
    lists = spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path).select(f"results.drug.{kind}.*")
    rows = lists.select("total_records", F.posexplode("partitions").alias("pos", "part"))
    return rows.select("part.file", F.col("part.records").try_cast("long").alias("records"), (F.col("pos") + 1).alias("partition_index"), F.col("total_records").try_cast("long").alias("total_records"))


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(archive, pos, record) of JSON documents {"results": [...]}."""
    whole = spark.read.schema(T.StructType([T.StructField("results", T.ArrayType(schema))])).option("multiLine", True).json(path)
    return whole.select(F.col("_metadata.file_name").alias("archive"), F.posexplode("results").alias("pos", "record"))


def results(text: io.TextIOBase, piece: int = 1 << 20) -> Iterator[str]:
    """The members of the array under the key `results` of a JSON object, as they are written there (see members)."""
    return (written for written, _ in members(text, piece))


def members(text: io.TextIOBase, piece: int = 1 << 20) -> Iterator[tuple[str, object]]:
    """The members of the array under the key `results` of a JSON object, as they are written there and as values, one after
    the other and without holding the document. Only the object's own key counts, not one of that name further in; a document
    without it gives nothing, and one that is cut short raises ValueError.
    """
    decoder, buffer, ended = json.JSONDecoder(), "", False

    def upcoming() -> str:
        """The next character that is no white space, "" at the end."""
        nonlocal buffer, ended
        while not (buffer := buffer.lstrip(" \t\r\n")) and not ended:
            ended = not (buffer := text.read(piece))
        return buffer[:1]

    def value() -> tuple[str, object]:
        """The next value, as it is written and as it is."""
        nonlocal buffer, ended
        while True:
            try:
                upcoming()
                decoded, end = decoder.raw_decode(buffer)
                if not ended and (end == len(buffer) or buffer[end] not in ",:]} \t\r\n"):
                    raise ValueError  # a number may go on
            except ValueError:
                if ended:
                    raise
                new = text.read(piece)
                buffer, ended = buffer + new, not new
                continue
            found, buffer = buffer[:end], buffer[end:]
            return found, decoded

    def past(*marks: str) -> str:
        nonlocal buffer
        if (mark := upcoming()) not in marks or not mark:
            raise ValueError(f"one of {marks} expected in a JSON document")
        buffer = buffer[1:]
        return mark

    if upcoming() != "{":
        return
    past("{")
    mark = "," if upcoming() != "}" else past("}")
    while mark == ",":
        key = value()[1]
        past(":")
        if key == "results" and upcoming() == "[":
            past("[")
            inner = "," if upcoming() != "]" else past("]")
            while inner == ",":
                yield value()
                inner = past(",", "]")
        else:
            value()
        mark = past(",", "}")


def read_zipped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(archive, pos, record) of zip archives that hold one JSON document each; one task reads one archive, wherever
    Spark can read it. An archive cannot be split, so repartition what is read before heavy work.
    """
    return unzipped(spark.read.format("binaryFile").load(path).select("path", "content"), schema)


def unzipped(archives: DataFrame, schema: T.StructType) -> DataFrame:
    """(archive, pos, record) of zip archives (path, content); archive is the last part of the path."""

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = next(m for m in archive.namelist() if m.endswith(".json"))
                    rows: list[str] = []
                    first = 0
                    with io.TextIOWrapper(archive.open(member), "utf-8") as text:
                        for record in results(text):
                            rows.append(record)
                            if len(rows) == 1000:
                                yield made(name, first, rows)
                                first, rows = first + len(rows), []
                    yield made(name, first, rows)

    def made(name: str, first: int, rows: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name.rpartition("/")[2]] * len(rows), pa.string()), pa.array(range(first, first + len(rows)), pa.int32()), pa.array(rows, pa.string())], names=["archive", "pos", "json"])

    texts = archives.select("path", "content").mapInArrow(unzip, "archive string, pos int, json string")
    return texts.select("archive", "pos", F.from_json("json", schema).alias("record"))


def capped(records: DataFrame, first_archive: str, most: int = 5000) -> DataFrame:
    """For smoke runs: the first records of the first archive, by position and so the same each time."""
    if most < 0:
        raise ValueError("most must not be negative")
    return records.filter((F.col("archive") == first_archive) & (F.col("pos") < most))


def or_empty(read: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType, allow_empty: bool = False) -> DataFrame:
    """What read gives; an empty table if it fails and that is allowed."""
    try:
        found = read()
        found.schema  # noqa: B018  analysis errors show here
        return found
    except (AnalysisException, PySparkException):
        if not allow_empty:
            raise
        return spark.createDataFrame([], schema)


def product_codes(products: DataFrame) -> DataFrame:
    """Only what the map from product codes to RxNorm ids needs."""
    return products.select("product_id", "product_ndc", "rxnorm_ids")


def label_texts(labels: DataFrame, most: int | None = None) -> DataFrame:
    """Only what evidence needs of labels; with `most`, those with the smallest ids."""
    rows = labels.select("id", "set_id", "product_ndc", "package_ndc", "indications_and_usage")
    return rows if most is None else rows.orderBy("id").limit(most)
