"""The ledger of import runs: status events folded into runs, progress, estimates, listing and admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.functions.text import blank_to_null

#: Fixed values.
TERMINAL = ("succeeded", "failed", "canceled", "dead_letter")
TERMINAL_LIVE = (*TERMINAL, "cancelled")
GUARDED = ("running", "succeeded", "failed", "dead_letter")
CANCELING = ("canceling", "canceled")
ACTIVE = ("queued", "starting", "running", "finalizing", "canceling")
DEFAULTS = {"importer": "unknown", "source": "import-live-progress", "confidence": "live"}
STALE_SECONDS, KEEP_SECONDS, PHASE_LENGTH, RUNS, MOST_RUNS = 90, 172_800, 128, 50, 200


def within_cancel_guard(events: DataFrame, run: str = "run_id", seq: str = "seq") -> DataFrame:
    """Drops what follows a cancellation, except further cancellations."""
    before = W.partitionBy(run).orderBy(seq).rowsBetween(W.unboundedPreceding, -1)
    canceled = F.max(F.col("status").isin(*CANCELING)).over(before)
    return events.withColumn("__c", F.coalesce(canceled, F.lit(False))).filter(~(F.col("__c") & F.col("status").isin(*GUARDED))).drop("__c")


def fold_runs(events: DataFrame, run: str = "run_id", seq: str = "seq", at: str = "at") -> DataFrame:
    """One row for each run from its events (run_id, seq, at, status, phase, metrics): first start and finish, last status,
    phase and heartbeat, last metrics that are not null.
    """
    kept = within_cancel_guard(events.filter(F.col(run).isNotNull()), run, seq)
    ended = F.col("status").isin(*TERMINAL)
    first = lambda when: F.min_by(F.when(when, F.col(at)), F.when(when, F.col(seq)))
    known = F.col("metrics").isNotNull()
    return kept.groupBy(run).agg(
        first(F.col("status") == "running").alias("started_at"), first(ended).alias("finished_at"),
        F.max_by("status", seq).alias("status"), F.max_by("phase", seq).alias("phase"), F.max_by(at, seq).alias("heartbeat_at"),
        F.max_by(F.when(known, F.col("metrics")), F.when(known, F.col(seq))).alias("metrics"), F.count("*").alias("events"),
    )


def default_progress(status: Column, message: Column) -> Column:
    ended = F.when(status.isin(*TERMINAL), 1.0).otherwise(0.0)
    return F.struct(F.lit("run").alias("unit"), ended.alias("done"), F.lit(1.0).alias("total"), (ended * 100).alias("pct"), message.alias("message"))


def evidence_progress(scanned: Column, published: Column) -> Column:
    """Progress of a finished evidence run."""
    n = F.coalesce(scanned, F.lit(0)).cast("double")
    phase = F.concat(F.lit("drug indications import "), F.when(F.coalesce(published, F.lit(False)), "published").otherwise("staged"))
    return F.struct(F.lit("labels").alias("unit"), n.alias("done"), n.alias("total"), F.lit(100.0).alias("pct"), F.lit("succeeded").alias("message"), phase.alias("phase"))


def list_runs(runs: DataFrame, status: str | None = None, importer: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest runs first; limit 1 to 200, 50 if it is none or 0."""
    rows = runs if status is None else runs.filter(F.col("status") == status)
    rows = rows if importer is None else rows.filter(F.col("importer") == importer)
    return rows.orderBy(F.desc_nulls_last("created_at"), "run_id").limit(max(1, min(limit or RUNS, MOST_RUNS)))


def run_by_id(runs: DataFrame, run_id: object) -> DataFrame:
    return runs.filter(F.col("run_id") == run_id)


def percent(pct: Column, done: Column, total: Column, terminal: Column) -> Column:
    """Given, or done / total; 0 to 99.9, and 100 for a run that has ended."""
    found = F.coalesce(pct, F.when(total > 0, F.try_divide(done, total) * 100))
    return F.when(found.isNull(), None).when(terminal, 100.0).otherwise(F.greatest(F.lit(0.0), F.least(found, F.lit(99.9))))


def done_at_end(done: Column, total: Column, terminal: Column) -> Column:
    return F.when(terminal, F.coalesce(done, total)).otherwise(done)


def eta_seconds(done: Column, total: Column, elapsed: Column, terminal: Column) -> Column:
    """What is left at the rate so far; null where nothing or everything is done."""
    going = ~terminal & (total > done) & (done > 0) & (elapsed > 0)
    return F.when(going, (total - done) * F.try_divide(elapsed, done))


def elapsed_seconds(given: Column, started_at: Column, now: Column) -> Column:
    since = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(started_at.cast("timestamp"))) / 1e6
    return F.coalesce(given, F.greatest(since, F.lit(0.0)))


def finish_at(now: Column, eta: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(now.cast("timestamp")) + F.round(eta * 1e6).cast("long"))


def with_estimates(live: DataFrame, now: Column) -> DataFrame:
    """Normal percentage, done count and estimate of every progress row (done, total, pct, elapsed_seconds, started_at).

    A finite eta_seconds that is there already stands, for runs that have ended too; one below 0 sets no
    estimated_finish_at, and without an estimate the one that is there stands.
    """
    ended = F.coalesce(F.lower("status").isin(*TERMINAL_LIVE), F.lit(False))
    out = live.withColumns({"pct": percent(F.col("pct"), F.col("done"), F.col("total"), ended), "__done": F.col("done")})
    spent = elapsed_seconds(F.col("elapsed_seconds"), F.col("started_at"), now)
    found = eta_seconds(F.col("__done"), F.col("total"), spent, ended)
    if "eta_seconds" in live.columns:
        own = F.col("eta_seconds").cast("double")
        found = F.coalesce(F.when(~F.isnan(own) & (F.abs(own) != float("inf")), own), found)
    out = out.withColumns({"eta_seconds": found, "done": done_at_end(F.col("__done"), F.col("total"), ended)})
    finish = F.when(F.col("eta_seconds") >= 0, finish_at(now, F.col("eta_seconds")))
    finish = F.coalesce(finish, F.col("estimated_finish_at").cast("timestamp")) if "estimated_finish_at" in live.columns else finish
    return out.withColumn("estimated_finish_at", finish).drop("__done")


def after_last_gap(updates: DataFrame, run: str, at: str, keep_seconds: int = KEEP_SECONDS) -> DataFrame:
    """Updates after the last time that a run had none for longer than keep_seconds.

    Gaps show between the days on which a run has updates: as days are no longer than keep_seconds, none lies within one.
    Days are aggregated first, so that a run's updates do not meet in one task.
    """
    day = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (keep_seconds * 1_000_000 / 2)).alias("__day")
    days = updates.groupBy(run, day).agg(F.min(at).alias("__low"), F.max(at).alias("__high"))
    before = F.lag("__high").over(W.partitionBy(run).orderBy("__day"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    gap = micros(F.col("__low")) - micros(before) > keep_seconds * 1_000_000
    since = days.withColumn("__gap", gap).groupBy(run).agg(F.max(F.when(F.col("__gap"), F.col("__low"))).alias("__since"))
    return updates.join(since, run).filter(F.col("__since").isNull() | (F.col(at) >= F.col("__since"))).drop("__since")


def latest_progress(updates: DataFrame, now: Column, run: str = "run_id", seq: str = "seq", at: str = "updated_at") -> DataFrame:
    """The last update of each run, with its earliest start and its last known importer, source and confidence; hidden
    when it is stale.

    An update takes over from those before it if it has a start, or done and total counts, or no known importer; any other
    one begins anew, and so does one that comes more than KEEP_SECONDS after the one before, as progress is kept no longer.
    A source or confidence that is not given is DEFAULTS', one that is empty or "unknown" is taken over.
    """
    carried = [c for c in ("importer", "source", "confidence") if c in updates.columns]
    names = [c for c in updates.columns if c not in (run, seq, "started_at", *carried)]
    filled = {c: F.coalesce(F.col(c), F.lit(DEFAULTS[c])) for c in carried}
    counted = F.col("done").isNotNull() & F.col("total").isNotNull() if {"done", "total"} <= set(updates.columns) else F.lit(False)
    joins = F.col("started_at").isNotNull() | counted | (filled["importer"] == "unknown")
    rows = after_last_gap(updates, run, at).withColumns(filled)
    anew = rows.groupBy(run).agg(F.max(F.when(~joins, F.col(seq))).alias("__from"))
    rows = rows.join(anew, run).filter(F.col("__from").isNull() | (F.col(seq) >= F.col("__from")))
    known = {c: ~F.col(c).isin("", "unknown") for c in carried}
    last = rows.groupBy(run).agg(
        *[F.max_by(c, seq).alias(c) for c in names], F.min("started_at").alias("started_at"),
        *[F.coalesce(F.max_by(F.when(known[c], F.col(c)), F.when(known[c], F.col(seq))), F.max_by(c, seq)).alias(c) for c in carried],
    )
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(at).cast("timestamp"))
    return last.filter(age <= STALE_SECONDS * 1_000_000)


def progress_json(live: dict[str, Column]) -> Column:
    """Progress of a run as JSON, without null fields."""
    get = lambda k: live.get(k, F.lit(None).cast("string"))
    return F.to_json(F.struct(
        F.coalesce(get("unit"), F.lit("run")).alias("unit"), get("done").alias("done"), get("total").alias("total"), get("pct").alias("pct"),
        F.coalesce(get("message"), get("phase"), F.lit("running")).alias("message"), get("phase").alias("phase"), get("updated_at").alias("updated_at"),
    ))


def estimate_json(live: dict[str, Column]) -> Column:
    get = lambda k: live.get(k, F.lit(None).cast("string"))
    return F.to_json(F.struct(
        get("eta_seconds").alias("eta_seconds"), get("estimated_finish_at").alias("estimated_finish_at"), F.coalesce(get("confidence"), F.lit("live")).alias("confidence"),
        F.coalesce(get("source"), F.lit("import-live-progress")).alias("source"), get("updated_at").alias("updated_at"),
    ))


def overlay(runs: DataFrame, live: DataFrame) -> DataFrame:
    """Runs (run_id, status, phase, unit, done, total, pct, message) with live progress over the stored one, where the run is
    active and live progress is there; columns that runs lack count as null.

    Counts that live progress lacks are the stored ones; unit, message and the estimate (eta_seconds,
    estimated_finish_at, confidence, source, estimate_updated_at) are the live ones, with their defaults.
    """
    text = lambda c: blank_to_null(F.col(c).cast("string"))
    names = ["phase", "unit", "done", "total", "pct", "message", "updated_at", "eta_seconds", "estimated_finish_at", "confidence", "source"]
    have = set(live.columns)
    now = live.select("run_id", F.lit(True).alias("__live"), *[(F.col(c) if c in have else F.lit(None).cast("string")).alias(f"live_{c}") for c in names])
    out = runs.join(now, "run_id", "left")
    active = F.coalesce(F.col("status").isin(*ACTIVE) & F.col("__live"), F.lit(False))
    stored = {c: F.col(c) if c in runs.columns else F.lit(None) for c in (*names, "estimate_updated_at")}
    shown = {c: F.coalesce(F.col(f"live_{c}"), stored[c]) for c in ("done", "total", "pct", "updated_at")}
    shown |= {"unit": F.coalesce(text("live_unit"), F.lit("run")), "message": F.coalesce(text("live_message"), text("live_phase"), F.lit("running"))}
    shown |= {"phase": F.coalesce(F.substring(text("live_phase"), 1, PHASE_LENGTH), stored["phase"])}
    shown |= {c: F.col(f"live_{c}") for c in ("eta_seconds", "estimated_finish_at")}
    shown |= {c: F.coalesce(text(f"live_{c}"), F.lit(DEFAULTS[c])) for c in ("confidence", "source")} | {"estimate_updated_at": F.col("live_updated_at")}
    return out.withColumns({c: F.when(active, v).otherwise(stored[c]) for c, v in shown.items()}).drop("__live", *[f"live_{c}" for c in names])


def admitted(requests: DataFrame, runs: DataFrame, key: str = "idempotency_key", order: str = "requested_at") -> DataFrame:
    """Every request with the run it gets: that of an active run with its key, else that of the first request with it.

    Adds run_id and is_new. Requests without a key are always new. The first request of a key is an aggregate, so that
    no key's requests meet in one task.
    """
    active = runs.filter(F.col("status").isin(*ACTIVE) & F.col(key).isNotNull()).groupBy(key).agg(F.min("run_id").alias("active_run"))
    own = F.concat(F.lit("run-"), F.col("request_id").cast("string"))
    keyed, free = requests.filter(F.col(key).isNotNull()), requests.filter(F.col(key).isNull())
    leaders = keyed.groupBy(key).agg(F.min(F.struct(order, "request_id")).alias("__first"))
    leaders = leaders.join(active, key, "left").select(key, "active_run", F.concat(F.lit("run-"), F.col("__first.request_id").cast("string")).alias("leader"))
    out = keyed.join(leaders, key)
    out = out.withColumns({"run_id": F.coalesce("active_run", "leader"), "is_new": F.col("active_run").isNull() & (F.col("leader") == own)})
    names = [*requests.columns, "run_id", "is_new"]
    return out.select(*names).unionByName(free.withColumns({"run_id": own, "is_new": F.lit(True)}).select(*names))
