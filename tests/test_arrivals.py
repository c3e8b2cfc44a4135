"""Archives by manifest, versions, zipped ingest, dates, live progress in any order."""

from __future__ import annotations

import datetime
import io
import json
import random
import zipfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medleaf.functions.dates import parsed_date
from medleaf.operators import products as P
from medleaf.operators import runs as R
from medleaf.operators import versions as V
from medleaf.operators.publish import GateError, counted
from medleaf.plans import records
from medleaf.schemas import PRODUCT_RECORD
from medleaf.sources import archive_source as A
from medleaf.sources import archives
from medleaf.streaming import ingest
from medleaf.streaming import progress as S

RECORD = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def zipped(records) -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("read.me", "first")
        archive.writestr("x.json", json.dumps({"meta": {"results": [1]}, "results": records}))
    return raw.getvalue()


@pytest.fixture()
def folder(spark, tmp_path):
    sizes = [2500, 0, 3]
    content = [(f"in/p{k}.json.zip", zipped([{"a": i, "b": "é,\n" * (i % 3), "c": {"d": [1]}} for i in range(n)]), n) for k, n in enumerate(sizes)]
    found = A.write_archives(spark.createDataFrame(content, "path string, content binary, records long"), f"file://{tmp_path}")
    assert rows(found) == [("in/p0.json.zip", 2500), ("in/p1.json.zip", 0), ("in/p2.json.zip", 3)]
    return f"file://{tmp_path}"


def test_archives_by_manifest(spark, folder):
    manifest = spark.createDataFrame([("in/p0.json.zip", 1, 2500), ("in/p1.json.zip", 2, 5), (f"{folder}/in/p2.json.zip", 3, 3), (None, 4, 1)], "file string, partition_index int, records long")
    records = A.read_archives(spark, manifest, RECORD, folder)
    assert records.rdd.getNumPartitions() == 3
    got = sorted((r.partition_index, r.pos, r.archive, r.record.a, r.record.b) for r in records.collect())
    assert got == [(k, i, f"p{k - 1}.json.zip", i, "é,\n" * (i % 3)) for k, n in ((1, 2500), (3, 3)) for i in range(n)]
    assert rows(A.completeness(records, manifest.filter("file is not null")).select("partition_index", "expected", "found")) == [(1, 2500, 2500), (2, 5, 0), (3, 3, 3)]


def test_caps_of_archives(spark, folder):
    manifest = spark.createDataFrame([("https://a.example/x/in/nowhere.zip", 2), ("in/p0.json.zip", 1)], "file string, partition_index int")
    assert A.read_archives(spark, manifest, RECORD, folder, max_records=1001, max_archives=1).agg(F.count("*"), F.max("pos")).first() == (1001, 1000)
    assert A.read_archives(spark, manifest, RECORD, folder, max_records=0, max_archives=1).count() == 0
    with pytest.raises(PySparkException):  # an archive that is not there is no empty one
        A.read_archives(spark, manifest, RECORD, folder).count()
    with pytest.raises(ValueError):
        A.read_archives(spark, manifest, RECORD, folder, max_records=-1)
    linked = spark.createDataFrame([("https://a.example/x/p2.json.zip", 1)], "file string, partition_index int")
    assert A.read_archives(spark, linked, RECORD, f"{folder}/in").count() == 3


def test_only_fields_asked_for_leave_the_reader(spark, folder):
    reader = A.ArchiveReader({"archives": '[["in/p2.json.zip", 1]]', "folder": folder, "fields": '["a"]'})
    assert [j for b in reader.read(reader.partitions()[0]) for j in b.column("json").to_pylist()] == ['{"a": 0}', '{"a": 1}', '{"a": 2}']


# versions


def test_a_failure_between_tables_changes_nothing(spark, tmp_path):
    root, keys = str(tmp_path / "live"), {"product": "id", "package": "id"}
    assert V.current(spark, root) is None
    with pytest.raises(ValueError):
        V.read_version(spark, root, "product")
    first = V.publish_together(spark, root, "r1", {"product": spark.range(5), "package": spark.range(9)}, keys)
    assert first.counts == {"product": 5, "package": 9} and first.before is None
    broken = spark.range(3).withColumn("id", F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(PySparkException):
        V.publish_together(spark, root, "r2", {"product": spark.range(6), "package": broken}, keys)
    with pytest.raises(GateError):
        V.publish_together(spark, root, "r3", {"product": spark.range(1), "package": spark.range(9)}, keys, {"product": lambda n: n > 4})
    assert V.current(spark, root) == first
    held = V.read_version(spark, root, "package", first)
    second = V.publish_together(spark, root, "r4", {"product": spark.range(7), "package": spark.range(2)}, keys)
    assert (second.before, V.read_version(spark, root, "package").count(), held.count()) == ("r1", 2, 9)
    with pytest.raises(ValueError):
        V.publish_together(spark, root, "r4", {"product": spark.range(7)}, keys)
    assert V.drop_old(spark, root) == ["r2", "r3"]
    assert V.roll_back(spark, root).run == "r1" and V.read_version(spark, root, "product").count() == 5
    with pytest.raises(ValueError):
        V.roll_back(spark, root)


def test_counts_come_with_the_write(spark, tmp_path):
    """One job writes and counts."""
    group = f"write-{tmp_path}"
    df, seen = counted(spark.createDataFrame([(1,), (None,), (3,)], "id int"), "id")
    spark.sparkContext.setJobGroup(group, "")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"n": 2}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# zipped ingest


def test_a_batch_that_fails_between_tables_adds_nothing_twice(spark, tmp_path):
    def land(name, keys):
        records = [{"product_id": f"P{k}", "product_ndc": str(k), "generic_name": name, "packaging": [{"package_ndc": f"{k}-1", "description": "x"}]} for k in keys]
        A.write_archives(spark.createDataFrame([(name, zipped(records), len(records))], "path string, content binary, records long"), f"file://{tmp_path}/in").count()

    (tmp_path / "in").mkdir()
    fail = {"on": True}

    def packages(batch):
        if fail["on"]:
            raise RuntimeError("between both tables")
        return P.packages(batch)

    sinks, staged, state = {"product": P.products, "package": packages}, f"{tmp_path}/staged", f"{tmp_path}/state"
    stream = lambda: ingest.landed_archives(spark, f"{tmp_path}/in", PRODUCT_RECORD)
    land("a.zip", range(5))
    with pytest.raises(Exception, match="between both tables"):
        ingest.ingest_together(stream(), sinks, staged, state)
    fail["on"] = False
    ingest.ingest_together(stream(), sinks, staged, state)
    land("b.zip", range(3, 8))
    ingest.ingest_together(stream(), sinks, staged, state)
    ingest.ingest_together(stream(), sinks, staged, state)
    got = rows(ingest.ingested(spark, staged, "product", "product_id").select("product_id", "generic_name"))
    assert got == [(f"P{k}", "a.zip" if k < 5 else "b.zip") for k in range(8)]
    assert ingest.ingested(spark, staged, "package", "package_ndc").count() == 8
    spark.range(1).write.parquet(f"{staged}/product/batch=99")  # a batch that is not in the ledger
    assert ingest.ingested(spark, staged, "product", "product_id").count() == 8


# dates

DAY = datetime.date(2024, 1, 5)
DATES = {
    "20240105": DAY, "202401051230": DAY, "240105": DAY, " 2024-01-05 ": DAY, "2024-1-5": DAY, "2024/01/05": DAY, "2024.1.5": DAY, "2024-01-05T10:20:30Z": DAY, "2024-01-05 10:20:30.123+02:00": DAY,
    "2024-Jan-05": DAY, "2024 January 5": DAY, "5 Jan 2024": DAY, "05-JAN-24": DAY, "5th of January, 2024": DAY, "the 5th January 2024, a Friday": DAY, "5jan2024": DAY,
    "January 5, 2024": DAY, "Jan. 5th, 2024": DAY, "JAN 5 '24": DAY, "effective Fri January 5, 2024 at 10:30 pm": DAY, "1/5/2024": DAY, "01/05/24": DAY, "1-5-2024 9:05 AM": DAY, "10:15 1/5/2024": DAY,
    "13.5.2024": datetime.date(2024, 5, 13), "5/13/2024": datetime.date(2024, 5, 13), "99-1-5": datetime.date(1999, 1, 5), "1/5/99": datetime.date(1999, 1, 5), "2024-13-05": datetime.date(2024, 5, 13),
    "Sept 30 2020": datetime.date(2020, 9, 30), "29 February 2024": datetime.date(2024, 2, 29), "29 February 2023": None, "2024-02-30": None, "20241301": None, "": None, None: None, "no date": None,
    "maybe never": None, "1/2/3/4": None, "123456789": None, "13/13/2024": None,
}
PARTS = {"January 2024": (2024, 1, 31), "Feb 2024": (2024, 2, 29), "2/2023": (2023, 2, 28), "2024-06": (2024, 6, 30), "June 5": (2020, 6, 5), "5 jun": (2020, 6, 5), "1999": (1999, 12, 31), "1/5/69": (1969 + 100, 1, 5), "1/5/71": (1971, 1, 5)}


def test_dates_in_text(spark):
    df = spark.createDataFrame([(t,) for t in DATES], "t string")
    assert {r.t: r.d for r in df.select("t", parsed_date(F.col("t")).alias("d")).collect()} == DATES
    df = spark.createDataFrame([(t,) for t in PARTS], "t string")
    today = F.lit("2020-12-31").cast("date")
    assert {r.t: r.d for r in df.select("t", parsed_date(F.col("t"), today).alias("d")).collect()} == {t: datetime.date(*d) for t, d in PARTS.items()}
    assert {r.d for r in df.filter("t not like '%/%/%'").select(parsed_date(F.col("t")).alias("d")).collect()} == {None}


# live progress

NOON = datetime.datetime(2024, 1, 1, 12)
HOUR = 3600


def at(seconds: float) -> datetime.datetime:
    return NOON + datetime.timedelta(seconds=seconds)


def some_updates(n: int, seed: int) -> list[tuple]:
    """Updates of a few runs, in order; gaps of days among them."""
    rng, out, now = random.Random(seed), [], 0.0
    for k in range(n):
        now += rng.choice([1, 60, 5 * HOUR, 24 * HOUR, 49 * HOUR])
        maybe = lambda *x: rng.choice([None, *x])
        out.append((f"r{rng.randrange(3)}", k, at(now), at(now - 100) if rng.random() < 0.4 else None, maybe("unknown", "", "ndc", "label"), maybe("unknown", "s1", "s2"), maybe("", "low"), rng.choice(["running", "Succeeded", None]), maybe("p1", "p2"), rng.choice([None, 0.0, 3.0, 20.0]), rng.choice([None, 10.0])))
    return out


KIND = "run_id string, event_id long, updated_at timestamp, started_at timestamp, importer string, source string, confidence string, status string, phase string, done double, total double"


def streamed(spark, tmp_path, frames, late=S.LATE_SECONDS):
    source, out = tmp_path / "in", {}
    source.mkdir()
    for frame in frames:
        spark.createDataFrame(frame, KIND).coalesce(1).write.mode("append").parquet(str(source))
        stream = S.live_progress_stream(spark.readStream.schema(KIND).parquet(str(source)), late)
        S.read_to_end(spark, stream.writeStream.outputMode("update").foreachBatch(lambda df, _: out.update({r.run_id: r for r in df.collect()})).option("checkpointLocation", str(tmp_path / "state")))
    return out


def by_batch(spark, updates):
    """The last update of each run by the batch operator, with estimates as of that update."""
    df = spark.createDataFrame(updates, KIND).withColumnRenamed("event_id", "seq").withColumn("status", F.coalesce("status", F.lit("running")))
    df = df.withColumns({"pct": F.lit(None).cast("double"), "elapsed_seconds": F.lit(None).cast("double")})
    last = R.latest_progress(df, F.lit("2000-01-01").cast("timestamp"))
    return {r.run_id: r for r in R.with_estimates(last, F.col("updated_at")).collect()}


SHOWN = ("updated_at", "started_at", "importer", "source", "confidence", "status", "phase", "done", "total", "pct", "eta_seconds")


@pytest.mark.parametrize("seed", [1, 2])
def test_live_progress_as_by_batch(spark, tmp_path, seed):
    updates = some_updates(60, seed)
    got, want = streamed(spark, tmp_path, [updates[:13], updates[13:40], updates[40:]]), by_batch(spark, updates)
    assert {k: [getattr(r, c) for c in SHOWN] for k, r in got.items()} == {k: [getattr(r, c) for c in SHOWN] for k, r in want.items()}
    assert not any(r.stale for r in got.values())


def test_live_progress_in_another_order(spark, tmp_path):
    updates = some_updates(45, 3)
    mixed = updates[:]
    random.Random(9).shuffle(mixed)
    got, want = streamed(spark, tmp_path, [mixed[:20], mixed[20:21], mixed[21:]], late=10_000 * HOUR), by_batch(spark, updates)
    assert {k: [getattr(r, c) for c in SHOWN] for k, r in got.items()} == {k: [getattr(r, c) for c in SHOWN] for k, r in want.items()}


def test_very_late_updates_still_count(spark, tmp_path):
    one = ("a", 5, at(5 * HOUR), None, "unknown", "s", "low", "running", "p", 1.0, 2.0)
    two = ("a", 6, at(6.5 * HOUR), None, "unknown", "s", "low", "running", "p", 1.0, 2.0)
    late = ("a", 1, at(HOUR), at(0), "ndc", "s0", "low", "running", "old", 0.0, 2.0)
    last = streamed(spark, tmp_path, [[one], [two], [late], [(None, 1, at(0), *late[3:]), (" ", 1, at(0), *late[3:])]])
    assert set(last) == {"a"} and (last["a"].started_at, last["a"].importer, last["a"].source, last["a"].phase) == (at(0), "ndc", "s", "p")
    assert S.merged_late({"at": 10**15, "started_at": None, "importer": "x", "source": "s", "confidence": "c"}, {"updated_at": 0, "started_at": 5, "importer": "y", "source": None, "confidence": None})["started_at"] is None


class Kept:
    """State, timers and clock of one run, with the number of calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, *_):  # noqa: N802
        return self

    def getListState(self, *_):  # noqa: N802
        return Kept()

    def get(self):
        self.calls += 1
        return self.value or ()

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    put = update

    def listTimers(self):  # noqa: N802
        self.calls += 1
        return []

    def registerTimer(self, _):  # noqa: N802
        self.calls += 1

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 0


def test_live_progress_takes_updates_as_texts():
    run, handle = S.LiveProgress(HOUR), Kept()
    run.init(handle)
    texts = [f'{{"event_id":{k},"updated_at":{k * 10**6},"importer":"ndc","started_at":0,"done":{k}.0,"total":100.0,"eta_seconds":"Infinity"}}' for k in range(1, 51)]
    [last] = run.handleInputRows(("a",), iter([Row(run_id="a", update=t) for t in texts]), handle)
    assert (last.run_id, last.updated_at, last.started_at, last.importer, last.done, last.pct, last.eta_seconds, last.estimated_finish_at) == ("a", 50 * 10**6, 0, "ndc", 50.0, 50.0, 50.0, 100 * 10**6)
    assert handle.calls <= 4  # of the run, not of its updates


def test_gaps(spark):
    day = 24 * HOUR
    data = [("a", 1, at(0)), ("a", 2, at(2 * day)), ("a", 3, at(4 * day + 1)), ("a", 4, at(5 * day)), ("b", 1, at(0)), ("b", 2, at(2 * day)), ("c", 1, at(0)), ("c", 2, at(9 * day)), ("c", 3, at(18 * day))]
    got = rows(R.after_last_gap(spark.createDataFrame(data, "run_id string, seq int, updated_at timestamp_ntz"), "run_id", "updated_at").select("run_id", "seq"))
    assert got == [("a", 3), ("a", 4), ("b", 1), ("b", 2), ("c", 3)]


# landed records


def test_landed_records_are_zipped_and_whole(spark, capsys):
    lines = records._dealt(spark.range(3000).select((F.col("id") % 1100).alias("k"), F.col("id").cast("string").alias("v")), "k")
    grouped = lines.groupBy("g", "k").agg(F.sort_array(F.collect_list("v")).alias("pharm_class"))
    grouped.groupBy("g").agg(F.collect_list("pharm_class")).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
    path = records._landed(grouped, F.struct(F.col("k").cast("string").alias("product_ndc"), "pharm_class"), "k")
    assert len(list(Path(path).glob("*.gz"))) == len(list(Path(path).glob("part-*"))) == 3
    got = archives.read_records(spark, path, T.StructType().add("product_ndc", "string").add("pharm_class", T.ArrayType(T.StringType()))).select("record.*")
    assert rows(got) == sorted(((str(k), sorted(str(i) for i in range(k, 3000, 1100))) for k in range(1100)), key=repr)
