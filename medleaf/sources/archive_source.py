"""Archives of records as a data source: a partition for each entry of a manifest.

A task opens its own archive, unzips it as it reads, and stops at the cap; nothing is read whole into memory, and archives
beyond the cap are not opened. Only the fields that are asked for leave the reader. Files are opened with Arrow's file
systems, so that archives may lie where these reach: local and shared folders, S3, GCS, HDFS. (sources.archives.read_zipped
goes through Spark's own readers instead, and holds an archive in memory.)
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from medleaf.sources.archives import members

NAME, BATCH_ROWS = "medleaf_archives", 1000
ROW = "archive string, partition_index int, pos long, json string"


@dataclass
class Archive(InputPartition):
    file: str
    index: int


class ArchiveSource(DataSource):
    """Options: archives (JSON list of [file, partition_index]), folder (of relative files), max_records (of each archive),
    fields (JSON list of the records' fields to keep; all if there is none).
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ROW

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(dict(self.options))


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.archives = json.loads(options["archives"])
        self.folder = options.get("folder", "").rstrip("/")
        self.most = int(options["max_records"]) if "max_records" in options else None
        self.fields = json.loads(options["fields"]) if "fields" in options else None

    def partitions(self) -> list[Archive]:
        return [Archive(file, index) for file, index in self.archives]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        path = partition.file if "://" in partition.file or partition.file.startswith("/") else f"{self.folder}/{partition.file}"
        name = path.rpartition("/")[2]
        rows: list[str] = []
        first = 0
        if self.most is not None and self.most <= 0:
            return
        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
            member = next(m for m in archive.namelist() if m.endswith(".json"))
            with io.TextIOWrapper(archive.open(member), "utf-8") as text:
                for written, value in members(text):
                    rows.append(written if self.fields is None or not isinstance(value, dict) else json.dumps({f: value[f] for f in self.fields if f in value}))
                    if len(rows) == BATCH_ROWS:
                        yield self._batch(name, partition.index, first, rows)
                        first, rows = first + len(rows), []
                    if self.most is not None and first + len(rows) >= self.most:
                        break
        yield self._batch(name, partition.index, first, rows)

    @staticmethod
    def _batch(name: str, index: int, first: int, rows: list[str]) -> pa.RecordBatch:
        n = len(rows)
        columns = [pa.array([name] * n, pa.string()), pa.array([index] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()), pa.array(rows, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["archive", "partition_index", "pos", "json"])


def read_archives(spark: SparkSession, manifest: DataFrame, schema: T.StructType, folder: str = "", max_records: int | None = None, max_archives: int | None = None) -> DataFrame:
    """(archive, partition_index, pos, record) of the archives of a manifest (file, partition_index): of the first
    max_archives only, and of at most max_records records of each, if these are given. `schema` says which fields are read.

    The manifest's rows become partitions, so that they pass through the driver: one for each archive. Files that a URL
    names are looked for in `folder`, under the URL's last part.
    """
    if any(n is not None and n < 0 for n in (max_records, max_archives)):
        raise ValueError("caps must not be negative")
    entries = manifest.select("file", "partition_index").filter("file is not null").orderBy("partition_index")
    entries = entries if max_archives is None else entries.filter(F.col("partition_index") <= max_archives)
    files = [(r.file.rpartition("/")[2] if folder and r.file.startswith(("http://", "https://")) else r.file, r.partition_index) for r in entries.toLocalIterator()]
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(NAME).option("archives", json.dumps(files)).option("folder", folder).option("fields", json.dumps(schema.names))
    reader = reader if max_records is None else reader.option("max_records", str(max_records))
    return reader.load().select("archive", "partition_index", "pos", F.from_json("json", schema).alias("record"))


def completeness(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file, partition_index, expected, found): records read against those that the manifest promises; no archive is left
    out.
    """
    found = records.groupBy("partition_index").agg(F.count("*").alias("found"))
    return manifest.join(found, "partition_index", "left").select("file", "partition_index", F.col("records").alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))


def write_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Writes archives (path, content, records) into a folder that tasks share, each in place at once. Gives (file, records),
    once it has run.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                store, inner = fs.FileSystem.from_uri(f"{folder}/{path}")
                store.create_dir(inner.rpartition("/")[0], recursive=True)
                # a task that is tried again, or twice at once, writes a file of its own
                aside = f"{inner}.{uuid.uuid4().hex}"
                with store.open_output_stream(aside) as out:
                    out.write(content)
                store.move(aside, inner)
            yield batch.select(["path", "records"]).rename_columns(["file", "records"])

    return archives.select("path", "content", "records").mapInArrow(put, "file string, records long")
