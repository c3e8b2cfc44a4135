"""Run ledger queries: events as status events of a run for each user."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.operators import runs as R
from medleaf.plans.bindings import EVENTS, run_events, shared_folder, table
from medleaf.streaming import progress as P

NOW = "2024-01-31 00:00:00"


def run_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.fold_runs(run_events(spark, sf_dir))


RUN_FOLD = f"""
WITH {EVENTS}, g AS (SELECT *, coalesce(max((status = 'canceling')::INT) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM ev),
k AS (SELECT * FROM g WHERE NOT (c = 1 AND status IN ('running', 'succeeded', 'failed', 'dead_letter')))
SELECT run_id, min_by(happened, seq) FILTER (status = 'running') AS started_at, min_by(happened, seq) FILTER (status = 'succeeded') AS finished_at, max_by(status, seq) AS status,
  max_by(phase, seq) AS phase, max_by(happened, seq) AS heartbeat_at, max_by(metrics, seq) FILTER (metrics IS NOT NULL) AS metrics, count(*) AS events FROM k GROUP BY run_id
"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as runs."""
    state = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"), F.col("o_orderpriority").alias("importer"), F.col("o_orderdate").alias("created_at"),
        F.when(state == "O", "running").when(state == "P", "queued").otherwise("succeeded").alias("status"), F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("idempotency_key"),
        F.col("o_orderpriority").alias("phase"), F.lit("run").alias("unit"), (F.col("o_orderkey") % 50).cast("double").alias("done"), F.lit(50.0).alias("total"),
    )


_RUNS = """
r AS (SELECT 'run-' || o_orderkey AS run_id, o_orderpriority AS importer, o_orderdate AS created_at, CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'P' THEN 'queued' ELSE 'succeeded' END AS status,
  'k' || o_custkey AS idempotency_key, o_orderpriority AS phase, 'run' AS unit, (o_orderkey % 50)::DOUBLE AS done, 50.0::DOUBLE AS total FROM orders)"""


def run_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.list_runs(_runs(spark, sf_dir), status="running", importer="5-LOW", limit=1000).select("run_id", "created_at", "status")


def run_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.run_by_id(_runs(spark, sf_dir), "run-42").select("run_id", "created_at", "status", "importer")


def _updates(events: DataFrame) -> DataFrame:
    """Events as progress updates of the runs with the users' numbers."""
    kind, id_ = F.col("event_type"), F.col("event_id")
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), id_.alias("seq"), F.col("ts").alias("updated_at"),
        F.when(kind == "signup", F.col("ts")).alias("started_at"), F.when(kind == "error", "unknown").otherwise(kind).alias("importer"), F.lit("running").alias("status"), kind.alias("phase"),
        F.lit("rows").alias("unit"), F.when(id_ % 7 != 0, F.round("value")).alias("done"), F.lit(20.0).alias("total"), F.lit(None).cast("double").alias("pct"), F.lit(None).cast("double").alias("elapsed_seconds"),
        F.when(id_ % 3 == 0, "unknown").when(id_ % 3 == 1, F.concat(F.lit("src-"), kind)).alias("source"), F.when(id_ % 5 == 0, "").when(id_ % 5 == 1, "low").alias("confidence"),
        F.when(id_ % 11 == 0, F.col("value") - 3).alias("eta_seconds"),
    )


# An update with neither a start nor both counts, whose importer is known, takes nothing over from those before it; nor does
# one more than two days after the one before.
_LIVE = """
u AS (SELECT 'run-' || user_id AS run_id, event_id AS seq, ts, event_type, CASE WHEN event_id % 7 <> 0 THEN round(value) END AS done, CASE event_id % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'src-' || event_type ELSE 'import-live-progress' END AS source,
  CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'low' ELSE 'live' END AS confidence, CASE WHEN event_id % 11 = 0 THEN value - 3 END AS eta FROM events),
b AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run_id ORDER BY seq)) > 172800000000 AS gap FROM u),
a AS (SELECT *, max(seq) FILTER ((event_type NOT IN ('signup', 'error') AND done IS NULL) OR gap) OVER (PARTITION BY run_id) AS anew FROM b),
l AS (SELECT run_id, max_by(ts, seq) AS updated_at, min(ts) FILTER (event_type = 'signup') AS started_at, coalesce(max_by(event_type, seq) FILTER (event_type <> 'error'), 'unknown') AS importer,
  coalesce(max_by(source, seq) FILTER (source <> 'unknown'), 'unknown') AS source, coalesce(max_by(confidence, seq) FILTER (confidence <> ''), '') AS confidence,
  max_by(event_type, seq) AS phase, arg_max_null(done, seq) AS done, 20.0::DOUBLE AS total, arg_max_null(eta, seq) AS eta FROM a WHERE anew IS NULL OR seq >= anew GROUP BY run_id)"""


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest_progress(_updates(table(spark, sf_dir, "events")), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))


def latest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last update of each run that is not stale a day after the last event of most."""
    updates = _updates(table(spark, sf_dir, "events"))
    now = F.lit(str(updates.agg(F.max("updated_at")).first()[0])).cast("timestamp_ntz")
    return R.latest_progress(updates, now).select("run_id", "updated_at", "started_at", "importer", "source", "confidence", "phase", "done")


def eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentage and time left of every run's last update."""
    rows = R.with_estimates(_latest(spark, sf_dir), F.lit(NOW).cast("timestamp_ntz"))
    return rows.select("run_id", F.round("pct", 6).alias("pct"), "done", F.round("eta_seconds", 3).alias("eta_seconds"), F.date_trunc("second", "estimated_finish_at").cast("timestamp_ntz").alias("finish_second"))


ETA = f"""
WITH {_LIVE}, e AS (SELECT run_id, done, greatest(0.0, least(done / total * 100, 99.9)) AS pct, coalesce(eta, CASE WHEN total > done AND done > 0 AND started_at < TIMESTAMP '2024-01-31'
    THEN (total - done) * ((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(started_at)) / 1e6 / done) END) AS eta FROM l)
SELECT run_id, round(CASE WHEN done IS NOT NULL THEN pct END, 6) AS pct, done, round(eta, 3) AS eta_seconds,
  CASE WHEN eta >= 0 THEN date_trunc('second', make_timestamp(epoch_us(TIMESTAMP '2024-01-31') + round(eta * 1e6)::BIGINT)) END AS finish_second FROM e
"""


def run_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as runs under the live progress of the users' events."""
    rows = R.overlay(_runs(spark, sf_dir), _latest(spark, sf_dir))
    return rows.select("run_id", "status", "phase", "unit", "done", "total", "message", "updated_at", "eta_seconds", "confidence", "source", "estimate_updated_at")


RUN_OVERLAY = f"""
WITH {_RUNS}, {_LIVE}, j AS (SELECT r.*, status <> 'succeeded' AND l.run_id IS NOT NULL AS live, l.phase AS p, l.done AS d, l.total AS t, l.updated_at, l.eta, l.confidence, l.source FROM r LEFT JOIN l USING (run_id))
SELECT run_id, status, CASE WHEN live THEN p ELSE phase END AS phase, CASE WHEN live THEN 'rows' ELSE unit END AS unit, CASE WHEN live THEN coalesce(d, done) ELSE done END AS done, CASE WHEN live THEN t ELSE total END AS total,
  CASE WHEN live THEN p END AS message, CASE WHEN live THEN updated_at END AS updated_at, CASE WHEN live THEN eta END AS eta_seconds,
  CASE WHEN live THEN coalesce(nullif(confidence, ''), 'live') END AS confidence, CASE WHEN live THEN source END AS source, CASE WHEN live THEN updated_at END AS estimate_updated_at FROM j
"""


def default_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of runs that say none: of orders by their state, and as evidence runs over as many labels as the order's key."""
    runs = _runs(spark, sf_dir)
    ours, theirs = R.default_progress(F.col("status"), F.col("importer")), R.evidence_progress(F.when(F.col("done") > 0, F.col("done")), F.col("status") == "succeeded")
    return runs.select("run_id", *[ours[c].alias(c) for c in ("unit", "done", "total", "pct", "message")], *[theirs[c].alias(f"evidence_{c}") for c in ("done", "total", "pct", "phase")])


DEFAULT_PROGRESS = f"""
WITH {_RUNS} SELECT run_id, 'run' AS unit, CASE WHEN status = 'succeeded' THEN 1.0 ELSE 0.0 END::DOUBLE AS done, 1.0::DOUBLE AS total, CASE WHEN status = 'succeeded' THEN 100.0 ELSE 0.0 END::DOUBLE AS pct, importer AS message,
  done AS evidence_done, done AS evidence_total, 100.0::DOUBLE AS evidence_pct, 'drug indications import ' || CASE WHEN status = 'succeeded' THEN 'published' ELSE 'staged' END AS evidence_phase FROM r
"""


def live_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live progress of every run from its updates as a stream, read to its end."""
    path = f"{shared_folder(spark)}/live-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    updates = _updates(events).withColumnRenamed("seq", "event_id")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    P.read_to_end(spark, P.live_progress_stream(updates).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{path}/state"))
    out = spark.read.schema(f"{P.LIVE}, batch int").option("basePath", f"{path}/out").parquet(f"{path}/out")
    shown = [c for c in ("updated_at", "started_at", "importer", "source", "confidence", "phase", "unit", "done", "pct", "eta_seconds", "estimated_finish_at")]
    last = out.groupBy("run_id").agg(F.max_by(F.struct(*shown), "batch").alias("r")).select("run_id", "r.*")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("updated_at", "started_at")}
    finish = F.date_trunc("second", "estimated_finish_at").cast("timestamp_ntz")
    return last.withColumns({**times, "pct": F.round("pct", 6), "eta_seconds": F.round("eta_seconds", 3), "finish_second": finish}).drop("estimated_finish_at")


LIVE_PROGRESS = f"""
WITH {_LIVE}, e AS (SELECT *, coalesce(eta, CASE WHEN total > done AND done > 0 AND started_at < updated_at THEN (total - done) * ((epoch_us(updated_at) - epoch_us(started_at)) / 1e6 / done) END) AS left_ FROM l)
SELECT run_id, updated_at, started_at, importer, source, confidence, phase, 'rows' AS unit, done, CASE WHEN done IS NOT NULL THEN round(greatest(0.0, least(done / total * 100, 99.9)), 6) END AS pct, round(left_, 3) AS eta_seconds,
  CASE WHEN left_ >= 0 THEN date_trunc('second', make_timestamp(epoch_us(updated_at) + round(left_ * 1e6)::BIGINT)) END AS finish_second FROM e
"""


def progress_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of every event as JSON, null fields left out."""
    rows = _updates(table(spark, sf_dir, "events"))
    done = F.when(F.col("seq") % 3 != 0, F.col("done").cast("long"))
    return rows.select("seq", R.progress_json({"unit": F.when(F.col("seq") % 2 == 0, F.col("unit")), "done": done, "phase": F.col("phase")}).alias("progress"), R.estimate_json({"eta_seconds": done}).alias("estimate"))


def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests to run, with their users' numbers as keys; orders as the runs that there are."""
    requests = table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col("ts").alias("requested_at"), F.when(F.col("event_type") != "error", F.concat(F.lit("k"), F.col("user_id").cast("string"))).alias("idempotency_key"))
    return R.admitted(requests, _runs(spark, sf_dir)).select("request_id", "run_id", "is_new")


ADMISSION = f"""
WITH {_RUNS}, a AS (SELECT idempotency_key, min(run_id) AS active FROM r WHERE status IN ('queued', 'starting', 'running', 'finalizing', 'canceling') GROUP BY 1),
q AS (SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN 'k' || user_id END AS k, 'run-' || event_id AS own FROM events),
w AS (SELECT *, first_value(own) OVER (PARTITION BY k ORDER BY ts, event_id) AS leader, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS n FROM q)
SELECT event_id AS request_id, coalesce(active, CASE WHEN k IS NULL THEN own ELSE leader END) AS run_id, active IS NULL AND (k IS NULL OR n = 1) AS is_new FROM w LEFT JOIN a ON a.idempotency_key = w.k
"""

INTERVAL = 86_400.0


def _status_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind.isin("click", "view", "signup"), "running").when(kind == "purchase", "succeeded").otherwise("running")
    return events.select(F.col("user_id").alias("run_id"), "event_id", "ts", status.alias("status"), F.when(kind == "error", "b").otherwise("a").alias("phase"))


def throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which no alike one was sent within a day, by run."""
    return P.throttled(_status_events(table(spark, sf_dir, "events")), INTERVAL).select("run_id", "event_id", "status", "phase")


def throttle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream, read to its end."""
    path = f"{shared_folder(spark)}/throttle-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    sent = P.throttled_stream(_status_events(events), INTERVAL)
    query = sent.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(P.EVENT).parquet(f"{path}/out").select("run_id", "event_id", "status", "phase")


THROTTLE = """
WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS run_id, event_id, ts, CASE event_type WHEN 'purchase' THEN 'succeeded' ELSE 'running' END AS status, CASE event_type WHEN 'error' THEN 'b' ELSE 'a' END AS phase,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT run_id, event_id, status, phase, n, true AS sent, CASE WHEN status <> 'succeeded' THEN ts END AS lt, CASE WHEN status <> 'succeeded' THEN phase END AS lp FROM e WHERE n = 1
  UNION ALL
  SELECT e.run_id, e.event_id, e.status, e.phase, e.n, e.status = 'succeeded' OR f.lp IS NULL OR f.lp <> e.phase OR epoch_us(e.ts) - epoch_us(f.lt) >= 86400000000,
    CASE WHEN e.status <> 'succeeded' AND (f.lp IS NULL OR f.lp <> e.phase OR epoch_us(e.ts) - epoch_us(f.lt) >= 86400000000) THEN e.ts ELSE f.lt END,
    CASE WHEN e.status <> 'succeeded' AND (f.lp IS NULL OR f.lp <> e.phase OR epoch_us(e.ts) - epoch_us(f.lt) >= 86400000000) THEN e.phase ELSE f.lp END
  FROM f JOIN e ON e.run_id = f.run_id AND e.n = f.n + 1)
SELECT run_id, event_id, status, phase FROM f WHERE sent
"""

RUN_QUERIES = {
    "run_fold": (run_fold, RUN_FOLD),
    "run_list": (run_list, f"WITH {_RUNS} SELECT run_id, created_at, status FROM r WHERE status = 'running' AND importer = '5-LOW' ORDER BY created_at DESC, run_id LIMIT 200"),
    "run_lookup": (run_lookup, f"WITH {_RUNS} SELECT run_id, created_at, status, importer FROM r WHERE run_id = 'run-42'"),
    "latest_progress": (
        latest_progress,
        f"WITH {_LIVE} SELECT run_id, updated_at, started_at, importer, source, confidence, phase, done FROM l WHERE epoch_us((SELECT max(ts) FROM events)) - epoch_us(updated_at) <= 90000000",
    ),
    "eta": (eta, ETA),
    "run_overlay": (run_overlay, RUN_OVERLAY),
    "default_progress": (default_progress, DEFAULT_PROGRESS),
    "live_progress": (live_progress, LIVE_PROGRESS),
    "progress_payload": (
        progress_payload,
        """SELECT event_id AS seq, '{"unit":"' || CASE WHEN event_id % 2 = 0 THEN 'rows' ELSE 'run' END || '"' || CASE WHEN event_id % 3 <> 0 AND event_id % 7 <> 0 THEN ',"done":' || round(value)::BIGINT ELSE '' END || ',"message":"' || event_type || '","phase":"' || event_type || '"}' AS progress,
        '{' || CASE WHEN event_id % 3 <> 0 AND event_id % 7 <> 0 THEN '"eta_seconds":' || round(value)::BIGINT || ',' ELSE '' END || '"confidence":"live","source":"import-live-progress"}' AS estimate FROM events""",
    ),
    "admission": (admission, ADMISSION),
    "throttle": (throttle, THROTTLE),
    "throttle_stream": (throttle_stream, THROTTLE),
}
