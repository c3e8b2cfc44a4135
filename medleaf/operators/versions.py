"""Tables that are published together, in one step.

Every import writes its tables to a folder of its own. A pointer, a small file, names the folder that is live and the one
before; it is put in place by a rename that replaces it, so that a reader sees all tables of one import or all of the
other. A reader that has read the pointer keeps its folder, whatever is published meanwhile. The file system must replace
files by rename at once (HDFS and local ones do; on others use one that has the pointer only).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from medleaf.operators.publish import GateError, counted

POINTER = "_current"


@dataclass(frozen=True)
class Version:
    """What is live: the import's id, the counts of its tables, and the import before it (its id)."""

    run: str
    counts: dict[str, int] = field(default_factory=dict)
    before: str | None = None


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def current(spark: SparkSession, root: str) -> Version | None:
    """The version that is live; none if nothing has been published."""
    jvm, path, files = _files(spark, f"{root}/{POINTER}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return Version(**json.loads(bytes(stream.readAllBytes()).decode()))
    finally:
        stream.close()


def _point(spark: SparkSession, root: str, version: Version) -> None:
    """Puts the pointer in place at once."""
    jvm, path, files = _files(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    stream = files.create(path, True)
    stream.write(bytearray(json.dumps(asdict(version)).encode()))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(path, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), overwrite)


def publish_together(spark: SparkSession, root: str, run: str, tables: dict[str, DataFrame], keys: dict[str, str], gates: dict | None = None) -> Version:
    """Writes all tables of an import, holds the counts of their keys against their gates (count -> whether it will do), and
    makes them live. If anything fails before the last step, what was live stays so.
    """
    before = current(spark, root)
    if before is not None and before.run == run:
        raise ValueError(f"{run} is live already")
    counts = {}
    for name, rows in tables.items():
        rows, seen = counted(rows, keys[name])
        rows.write.mode("overwrite").parquet(f"{root}/{run}/{name}")
        counts[name] = seen.get["n"]
        if gates and name in gates and not gates[name](counts[name]):
            raise GateError(f"{name} of {run}: {counts[name]} rows with {keys[name]} are not enough")
    version = Version(run, counts, before.run if before else None)
    _point(spark, root, version)
    return version


def roll_back(spark: SparkSession, root: str) -> Version:
    """Makes the import before the live one live again."""
    now = current(spark, root)
    if now is None or now.before is None:
        raise ValueError("there is no import to go back to")
    version = Version(now.before)
    _point(spark, root, version)
    return version


def read_version(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame:
    """A table as it is live now, or as it was in a version that a reader holds on to."""
    version = version or current(spark, root)
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/{version.run}/{table}")


def drop_old(spark: SparkSession, root: str) -> list[str]:
    """Removes the folders of imports other than the live one and the one before; gives their ids. Not while they are read."""
    now = current(spark, root)
    _, path, files = _files(spark, root)
    kept = {POINTER} | ({now.run, now.before} if now else set())
    gone = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if now is not None and entry.isDirectory() and name not in kept:
            files.delete(entry.getPath(), True)
            gone.append(name)
    return sorted(gone)
