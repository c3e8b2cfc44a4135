from __future__ import annotations

import datetime
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from medleaf.operators import hygiene
from medleaf.operators import runs as R
from medleaf.streaming import progress as P

NOON = datetime.datetime(2024, 1, 1, 12)


def at(seconds: float) -> datetime.datetime:
    return NOON + datetime.timedelta(seconds=seconds)


def test_fold_and_cancel_guard(spark):
    events = [
        ("a", 1, at(1), "queued", "q", None), ("a", 2, at(2), "running", "r", "m1"), ("a", 3, at(3), "running", "r2", None), ("a", 4, at(4), "succeeded", "s", None),
        ("b", 1, at(1), "running", "r", None), ("b", 2, at(2), "canceling", "c", None), ("b", 3, at(3), "succeeded", "late", "m"), ("b", 4, at(4), "canceled", "end", None), (None, 1, at(1), "running", "r", None),
    ]
    got = {r.run_id: r for r in R.fold_runs(spark.createDataFrame(events, "run_id string, seq int, at timestamp_ntz, status string, phase string, metrics string")).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].started_at, got["a"].finished_at, got["a"].status, got["a"].metrics) == (at(2), at(4), "succeeded", "m1")
    assert (got["b"].started_at, got["b"].finished_at, got["b"].status, got["b"].metrics, got["b"].phase) == (at(1), at(4), "canceled", None, "end")


def test_default_progress(spark):
    df = spark.createDataFrame([("failed",), ("running",)], "s string").select(R.default_progress(F.col("s"), F.col("s")).alias("p"), R.evidence_progress(F.lit(7), F.col("s") == "failed").alias("e"))
    one, two = df.collect()
    assert (one.p.done, one.p.pct, two.p.done, two.p.pct) == (1.0, 100.0, 0.0, 0.0)
    assert (one.e.done, one.e.total, one.e.phase, two.e.phase) == (7.0, 7.0, "drug indications import published", "drug indications import staged")


def test_estimates(spark):
    live = [("a", "running", 5.0, 10.0, None, 20.0, None), ("b", "running", 5.0, 10.0, None, None, at(-40)), ("c", "Succeeded", None, 10.0, 50.0, None, None), ("d", "running", 30.0, 10.0, None, 1.0, None), ("e", "running", None, None, None, None, None), ("f", None, 1.0, 0.0, -5.0, 0.0, None)]
    df = spark.createDataFrame(live, "run_id string, status string, done double, total double, pct double, elapsed_seconds double, started_at timestamp_ntz")
    got = {r.run_id: (r.pct, r.done, r.eta_seconds) for r in R.with_estimates(df, F.lit(NOON).cast("timestamp_ntz")).collect()}
    assert got == {"a": (50.0, 5.0, 20.0), "b": (50.0, 5.0, 40.0), "c": (100.0, 10.0, None), "d": (99.9, 30.0, None), "e": (None, None, None), "f": (0.0, 1.0, None)}


def test_a_given_estimate_stands(spark):
    df = spark.createDataFrame([("a", "running", 7.0), ("b", "failed", 3.0), ("c", "running", -1.0), ("d", "running", float("inf")), ("e", "running", None)], "run_id string, status string, eta_seconds double")
    df = df.withColumns({"done": F.lit(5.0), "total": F.lit(10.0), "pct": F.lit(None).cast("double"), "elapsed_seconds": F.lit(20.0), "started_at": F.lit(None).cast("timestamp_ntz")})
    got = {r.run_id: (r.eta_seconds, r.estimated_finish_at is not None) for r in R.with_estimates(df, F.lit(NOON).cast("timestamp_ntz")).collect()}
    assert got == {"a": (7.0, True), "b": (3.0, True), "c": (-1.0, False), "d": (20.0, True), "e": (20.0, True)}


def test_what_updates_take_over(spark):
    rows_ = [
        ("a", 1, at(0), at(0), "ndc", "s1", "low", 1.0), ("a", 2, at(1), at(5), "", "unknown", "", 2.0), ("a", 3, at(2), at(9), "unknown", None, "unknown", 3.0),
        ("b", 1, at(0), at(0), "ndc", "s1", "low", 1.0), ("b", 2, at(1), None, "label", "s2", None, None),  # neither a start nor counts: begins anew
    ]
    df = spark.createDataFrame(rows_, "run_id string, seq int, updated_at timestamp_ntz, started_at timestamp_ntz, importer string, source string, confidence string, done double").withColumn("total", F.lit(9.0))
    got = rows(R.latest_progress(df, F.lit(at(3)).cast("timestamp_ntz")).select("run_id", "started_at", "importer", "source", "confidence"))
    assert got == [("a", at(0), "ndc", "import-live-progress", "low"), ("b", None, "label", "s2", "live")]


def test_latest_progress(spark):
    rows_ = [("a", 1, at(0), at(0), "ndc", 1.0), ("a", 2, at(60), at(5), "unknown", 2.0), ("b", 1, at(-200), None, "label", 1.0)]
    df = spark.createDataFrame(rows_, "run_id string, seq int, updated_at timestamp_ntz, started_at timestamp_ntz, importer string, done double")
    assert rows(R.latest_progress(df, F.lit(at(100)).cast("timestamp_ntz")).select("run_id", "started_at", "importer", "done")) == [("a", at(0), "ndc", 2.0)]


def test_payloads(spark):
    df = spark.range(1).select(R.progress_json({"done": F.lit(3), "phase": F.lit("p")}).alias("p"), R.estimate_json({}).alias("e"))
    assert json.loads(df.first().p) == {"unit": "run", "done": 3, "message": "p", "phase": "p"} and json.loads(df.first().e) == {"confidence": "live", "source": "import-live-progress"}


def test_overlay(spark):
    runs = spark.createDataFrame([("a", "running", "old", "run", 0.0, 1.0, 0.0, "m"), ("b", "succeeded", "old", "run", 1.0, 1.0, 100.0, "m")], "run_id string, status string, phase string, unit string, done double, total double, pct double, message string")
    live = spark.createDataFrame([("a", "ndc records" + "x" * 200, None, 3.5, None, 35.0, None, 60.0), ("b", "no", "u", 9.0, 9.0, 9.0, "x", 1.0)], "run_id string, phase string, unit string, done double, total double, pct double, message string, eta_seconds double")
    got = {r.run_id: r for r in R.overlay(runs, live).collect()}
    assert got["a"].phase == ("ndc records" + "x" * 200)[:128] and (got["a"].pct, got["a"].done, got["a"].total, got["a"].unit, got["a"].eta_seconds) == (35.0, 3.5, 1.0, "run", 60.0)
    assert (got["b"].phase, got["b"].pct, got["b"].eta_seconds) == ("old", 100.0, None)


def test_listing(spark):
    runs = spark.createDataFrame([(f"{k:03d}", "running" if k % 2 else "failed", "ndc", at(k)) for k in range(260)], "run_id string, status string, importer string, created_at timestamp_ntz")
    assert [R.list_runs(runs, limit=n).count() for n in (None, 0, 5, 9999, -4)] == [50, 50, 5, 200, 1]
    assert [r.run_id for r in R.list_runs(runs, status="failed", importer="ndc", limit=2).collect()] == ["258", "256"] and R.run_by_id(runs, "007").count() == 1


def test_admission(spark):
    runs = spark.createDataFrame([("r1", "running", "k1"), ("r2", "failed", "k2"), ("r3", "queued", None)], "run_id string, status string, idempotency_key string")
    requests = spark.createDataFrame([(1, "k1", at(1)), (2, "k2", at(2)), (3, "k2", at(3)), (4, None, at(4)), (5, None, at(5))], "request_id int, idempotency_key string, requested_at timestamp_ntz")
    got = {r.request_id: (r.run_id, r.is_new) for r in R.admitted(requests, runs).collect()}
    assert got == {1: ("r1", False), 2: ("run-2", True), 3: ("run-2", False), 4: ("run-4", True), 5: ("run-5", True)}


EVENTS = [
    ("a", 1, at(0), "running", "download"), ("a", 2, at(1), "running", "download"), ("a", 3, at(2), "running", "publish"), ("a", 4, at(3), "succeeded", "publish"), ("a", 5, at(4), "running", "publish"),
    ("a", 6, at(8), "running", "publish"), (" ", 7, at(0), "running", "x"), (None, 8, at(0), "running", "x"), ("b", 9, at(0), "failed", None), ("b", 10, at(0), "failed", None), ("b", 11, at(0), None, None),
]
SENT = {1, 3, 4, 6, 9, 10, 11}
KIND = "run_id string, event_id long, ts timestamp, status string, phase string"


def test_throttle(spark):
    assert {r.event_id for r in P.throttled(spark.createDataFrame(EVENTS, KIND)).collect()} == SENT
    assert P.throttled(spark.createDataFrame([], KIND)).count() == 0


def streamed(spark, tmp_path, frames, schema, make, mode):
    source, out = tmp_path / "in", []
    source.mkdir()
    query = None
    for k, rows_ in enumerate(frames):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = make(spark.readStream.schema(schema).parquet(str(source)))
        query = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: out.extend(df.collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    return out


def test_throttle_stream(spark, tmp_path):
    got = streamed(spark, tmp_path, [EVENTS[:5], EVENTS[5:]], KIND, P.throttled_stream, "append")
    assert {r.event_id for r in got} == SENT


def test_hygiene(spark):
    docs = spark.createDataFrame([(1, "an Agentic token = 'abcdefgh1'"), (2, "sk-" + "a" * 20), (3, "x\0 agentic"), (4, None), (5, "postgres://u:p@h"), (6, "agentics")], "id int, text string")
    assert rows(hygiene.scan_texts(docs, "id", "text")) == [("agentic-development-reference", 1), ("database-url-with-password", 5), ("openai-token", 2), ("password-assignment", 1)]
    assert hygiene.scan_texts(docs, "id", "text", skip=spark.createDataFrame([(1,), (2,)], "id int")).count() == 1
    paths = spark.createDataFrame([("a/.codex/AGENTS.md",), ("b/agents.md",), (None,)], "path string")
    assert rows(hygiene.scan_paths(paths, "path").select("problem")) == [("forbidden instruction file",), ("forbidden path component",)]


def test_negative_limits_are_refused():
    with pytest.raises(ValueError):
        from medleaf.operators.lookups import _some

        _some(None, -1)
