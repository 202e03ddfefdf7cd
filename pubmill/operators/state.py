"""Incremental state: baselines, evidence-checked upserts, reconciliation, checkpoints, proofs and gates.

State is a keyed table; each function gives the next one, or the rows that say why
it may not change. Who writes it replaces the table in one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Results of a search that end it, and all that an attempt may report.
CONCLUDED = ("SEARCHED_WITH", "SEARCHED_WITHOUT", "NOTHING_NEW")
ATTEMPTED = (*CONCLUDED, "PARTIAL", "FAILED")


def baseline(found: DataFrame, existing: DataFrame | None = None, force: bool = False) -> DataFrame:
    """(key, payload, seen) of found (key, ord, payload), each key once by least ord; refused where a baseline exists, unless forced."""
    if existing is not None and not force and existing.limit(1).count():
        raise ValueError("a baseline exists")
    return found.where("key is not null").groupBy("key").agg(F.min_by("payload", "ord").alias("payload"), F.count("*").alias("seen"))


def promote(state: DataFrame, reviewed: DataFrame) -> DataFrame:
    """state (key, status, last) after a review (key, last): reviewed keys are ACTIVE, and no date goes back."""
    newest = reviewed.groupBy("key").agg(F.max("last").alias("until"), F.count("*").alias("reviews"))
    j = state.join(newest, "key", "left")
    return j.select("key", F.when(F.col("reviews") > 0, "ACTIVE").otherwise(F.col("status")).alias("status"), F.greatest("last", "until").alias("last"))


def evidence_valid(status: Column, found: Column, origin: Column, reference: Column, error: Column) -> Column:
    """Whether an attempt may stand: a concluded one needs a reference, a real origin, a count that fits its status and no error; a failed one a reason. Null is no."""
    count = F.when(status == "NOTHING_NEW", F.coalesce(found, F.lit(0)) == 0).when(status == "SEARCHED_WITH", found > 0).when(status == "SEARCHED_WITHOUT", found == 0)
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    done = ~blank(reference) & ~blank(origin) & (origin != "NONE") & count & blank(error)
    other = (F.coalesce(found, F.lit(0)) >= 0) & ((status != "FAILED") | ~blank(error))
    return F.coalesce(F.when(status.isin(*CONCLUDED), done).when(status.isin(*ATTEMPTED), other), F.lit(False))


def upsert(events: DataFrame) -> DataFrame:
    """(key, status, found, expected, attempts, rejected) after events (key, ord, status, found, origin, reference, error, expected), in order of ord.

    An event without valid evidence is rejected. One equal to the row changes nothing.
    A concluded row is replaced only by an event that expects more documents; another
    is rejected. What is taken counts as an attempt. The order decides, so a key's
    events are folded in one place, as one array: those of a day and source, some dozens.
    ``upsert_stream`` holds one row a key however many there are.
    """
    same = ["status", "found", "origin", "reference", "error", "expected"]
    state = F.struct(F.lit(None).cast("string").alias("status"), F.lit(None).cast("long").alias("found"), F.lit(None).cast("long").alias("expected"), F.lit(None).cast("string").alias("print"), F.lit(0).cast("long").alias("attempts"), F.lit(0).cast("long").alias("rejected"))
    valid = evidence_valid(F.col("status"), F.col("found"), F.col("origin"), F.col("reference"), F.col("error"))
    own = F.to_json(F.struct(*same), {"ignoreNullFields": "false"})
    one = F.struct("ord", valid.alias("valid"), "status", F.col("found").cast("long").alias("found"), F.col("expected").cast("long").alias("expected"), own.alias("print"))
    listed = events.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("events"))

    def step(s, e):
        grown = F.coalesce(e["expected"], F.lit(0)) > F.coalesce(s["expected"], F.lit(0))
        closed = F.coalesce(s["status"].isin(*CONCLUDED), F.lit(False))
        repeat = F.coalesce(s["print"] == e["print"], F.lit(False))
        taken = F.struct(e["status"].alias("status"), e["found"].alias("found"), e["expected"].alias("expected"), e["print"].alias("print"), (s["attempts"] + 1).alias("attempts"), s["rejected"].alias("rejected"))
        refused = F.struct(s["status"].alias("status"), s["found"].alias("found"), s["expected"].alias("expected"), s["print"].alias("print"), s["attempts"].alias("attempts"), (s["rejected"] + 1).alias("rejected"))
        return F.when(~e["valid"], refused).when(repeat, s).when(closed & ~grown, refused).otherwise(taken)

    done = listed.select("key", F.aggregate("events", state, step).alias("s"))
    return done.select("key", "s.status", "s.found", "s.expected", "s.attempts", "s.rejected")


def upsert_stream(events: DataFrame) -> DataFrame:
    """``upsert`` as a stream: after each batch the rows of its keys. Within a batch events are taken in order of ord; a replayed one changes nothing.

    The state of a key is its row; each key's events of one batch pass through in chunks.
    """
    columns = ["status", "found", "expected", "print", "attempts", "rejected"]
    valid = evidence_valid(F.col("status"), F.col("found"), F.col("origin"), F.col("reference"), F.col("error"))
    own = F.to_json(F.struct("status", "found", "origin", "reference", "error", "expected"), {"ignoreNullFields": "false"})
    rows = events.select("key", F.col("ord").cast("long").alias("ord"), valid.alias("valid"), "status", F.col("found").cast("long").alias("found"), F.col("expected").cast("long").alias("expected"), own.alias("print"))

    def fold(key, frames: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        status, found, expected, printed, attempts, rejected = held.get if held.exists else (None, None, None, None, 0, 0)
        none = lambda x: None if x is None or pd.isna(x) else int(x)
        for frame in sorted(frames, key=lambda f: f["ord"].min()):
            for e in frame.sort_values("ord").itertuples(index=False):
                if e.valid and e.print == printed:
                    continue
                if not e.valid or (status in CONCLUDED and (none(e.expected) or 0) <= (expected or 0)):
                    rejected += 1
                else:
                    status, found, expected, printed, attempts = e.status, none(e.found), none(e.expected), e.print, attempts + 1
        held.update((status, found, expected, printed, attempts, rejected))
        yield pd.DataFrame([(key[0], status, found, expected, attempts, rejected)], columns=["key", "status", "found", "expected", "attempts", "rejected"])

    schema = "status string, found long, expected long, print string, attempts long, rejected long"
    assert [c.split()[0] for c in schema.split(", ")] == columns
    return rows.groupBy("key").applyInPandasWithState(fold, "key long, status string, found long, expected long, attempts long, rejected long", schema, "update", "NoTimeout")


def discover(known: DataFrame, remote: DataFrame) -> DataFrame:
    """(key, url, status) of documents (url): known ones (key, status) keep theirs, unseen ones are NEW_PENDING; no remote document at all is an error."""
    if not remote.limit(1).count():
        raise ValueError("no document found: a source without any is a failure, not an absence")
    fresh = remote.where("url is not null").select(F.sha2("url", 256).alias("key"), "url").distinct()
    return fresh.join(known.select("key", "status"), "key", "left").select("key", "url", F.coalesce("status", F.lit("NEW_PENDING")).alias("status"))


def pending_documents(state: DataFrame, journal: DataFrame) -> DataFrame:
    """Documents to process: pending ones without a journal entry (key), in order of address."""
    return state.where("status = 'NEW_PENDING'").join(journal.select("key"), "key", "left_anti").orderBy("url").select("key", "url")


def reconcile(universe: DataFrame, counts: DataFrame, covered: Column) -> DataFrame:
    """(process, source, status) for every process and source: by its count (process, source, found), only where the day is covered; else PENDING.

    A count for a process outside the universe gives a row FOREIGN.
    """
    j = universe.withColumn("__in", F.lit(True)).join(counts, ["process", "source"], "full_outer")
    status = F.when(F.col("__in").isNull(), "FOREIGN").when(~covered, "PENDING").when(F.coalesce("found", F.lit(0)) > 0, "SEARCHED_WITH").otherwise("SEARCHED_WITHOUT")
    return j.select("process", "source", status.alias("status"))


def checkpoints(events: DataFrame) -> DataFrame:
    """(run, stages) of events (run, stage, at, status): completed stages, each once, in the order in which they were first completed."""
    first = events.where("status = 'DONE'").groupBy("run", "stage").agg(F.min("at").alias("at"))
    return first.groupBy("run").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "stage"))), lambda x: x["stage"]).alias("stages"))


def reusable(wanted: DataFrame, made: DataFrame, on: list[str]) -> DataFrame:
    """wanted (on, rows) with reuse: whether the latest artefact (on, rows, at) of the same signature, day and purpose has as many rows."""
    last = made.groupBy(*on).agg(F.max_by("rows", "at").alias("__rows"))
    return wanted.join(last, on, "left").withColumn("reuse", F.coalesce(F.col("rows") == F.col("__rows"), F.lit(False))).drop("__rows")


def contingency_proof(universe: DataFrame, audits: DataFrame, pagination: DataFrame, failures: DataFrame) -> DataFrame:
    """(process, proven): exactly one audit row and one complete pagination row of the day (day_ok), and no failure."""
    once = lambda df, c: df.groupBy("process").agg(F.count("*").alias("k"), F.bool_and(c).alias("ok")).where("k = 1 and ok").select("process")
    good = once(audits, F.col("day_ok")).join(once(pagination, F.col("complete") & F.col("day_ok")), "process").join(failures.select("process").distinct(), "process", "left_anti")
    return universe.select("process").join(good.withColumn("proven", F.lit(True)), "process", "left").select("process", F.coalesce("proven", F.lit(False)).alias("proven"))


def run_status(events: DataFrame) -> DataFrame:
    """(run, progress, status) of events (run, stage, at, status, progress): progress stays within 0 to 100; ERROR, then PARTIAL, else DONE by each stage's last event."""
    last = events.groupBy("run", "stage").agg(F.max_by("status", "at").alias("status"), F.max("progress").alias("progress"))
    status = F.when(F.count_if(F.col("status") == "ERROR") > 0, "ERROR").when(F.count_if(F.col("status") != "DONE") > 0, "PARTIAL").otherwise("DONE")
    return last.groupBy("run").agg(F.least(F.greatest(F.max("progress"), F.lit(0)), F.lit(100)).cast("long").alias("progress"), status.alias("status"))


def send_gate(days: DataFrame, sends: DataFrame) -> DataFrame:
    """(day, version, verdict) of days (day, content, complete, pending) and sends (day, version, state).

    A version is a hash of the content. BLOCKED while a send of the day is undetermined,
    NOT_READY unless complete with nothing pending, SENT if this version went out, else SEND.
    """
    days = days.withColumn("version", F.sha2("content", 256))
    sure = sends.groupBy("day").agg(F.bool_or(F.col("state") == "UNDETERMINED").alias("open"))
    sent = sends.where("state = 'SENT'").select("day", "version", F.lit(True).alias("sent")).distinct()
    j = days.join(sure, "day", "left").join(sent, ["day", "version"], "left")
    verdict = F.when(F.coalesce("open", F.lit(False)), "BLOCKED").when(~F.col("complete") | F.col("pending"), "NOT_READY").when(F.coalesce("sent", F.lit(False)), "SENT").otherwise("SEND")
    return j.select("day", "version", verdict.alias("verdict"))


def required_coverage(done: DataFrame, keys: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """(key, each group, full): a key covers a group when all of its sources are done (key, source); full when it covers every group."""
    held = done.groupBy("key").agg(F.collect_set("source").alias("sources"))
    j = keys.select("key").join(held, "key", "left").withColumn("sources", F.coalesce("sources", F.array().cast("array<string>")))
    parts = {g: F.size(F.array_except(F.lit(s), F.col("sources"))) == 0 for g, s in groups.items()}
    every = None
    for c in parts.values():
        every = c if every is None else every & c
    return j.select("key", *(c.alias(g) for g, c in parts.items()), every.alias("full"))


def should_run(exists: Column, valid: Column, forced: Column) -> Column:
    """RUN, RERUN, FORCED or SKIP from whether a result exists and is valid."""
    return F.when(forced, "FORCED").when(~exists, "RUN").when(~F.coalesce(valid, F.lit(False)), "RERUN").otherwise("SKIP")


def completeness(checks: DataFrame, *keys: str) -> DataFrame:
    """(keys, n_ok, share, status, worst) of checks (keys, required, state): COMPLETE when every required one is OK, PARTIAL when some are, else PENDING."""
    order = F.lit(["OK", "PENDING", "INCOMPLETE", "INVALID"])
    need, fine = F.col("required"), F.col("required") & (F.col("state") == "OK")
    counted = checks.groupBy(*keys).agg(F.count_if(need).alias("n"), F.count_if(fine).alias("n_ok"), F.max(F.array_position(order, F.col("state"))).alias("place"))
    status = F.when(F.col("n_ok") == F.col("n"), "COMPLETE").when(F.col("n_ok") > 0, "PARTIAL").otherwise("PENDING")
    share = F.round(F.when(F.col("n") > 0, F.lit(100.0) * F.col("n_ok") / F.col("n")).otherwise(0.0), 2)
    return counted.select(*keys, F.col("n_ok").cast("long").alias("n_ok"), share.alias("share"), status.alias("status"), F.element_at(order, F.col("place").cast("int")).alias("worst"))


def delivery(grid: DataFrame, valid: Column) -> DataFrame:
    """(day, modality) of grid (day, process, source, status): COMPLETE only where every cell is concluded with valid evidence; null is not."""
    sure = F.coalesce(F.col("status").isin(*CONCLUDED) & valid, F.lit(False))
    return grid.groupBy("day").agg(F.when(F.bool_and(sure), "COMPLETE").when(F.bool_or(sure), "PARTIAL").otherwise("NONE").alias("modality"))
