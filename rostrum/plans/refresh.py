"""The daily refresh: landed bodies to documents to turns, behind gates, with a ledger."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators import documents as X
from rostrum.operators.aggregates import speech_category
from rostrum.sources.tables import append_new, lost_fields, parse_bodies, publish

#: A run halts above this share of named speakers without a person.
MOST_UNLINKED = 0.05
RECHECK_DAYS, STALE_HOURS = 14, 12


def unlinked_share(linked: Column, unlinked: Column) -> Column:
    """Null where no one is named."""
    return F.try_divide(unlinked, linked + unlinked)


def probe_start(latest: date, today: date) -> date:
    """The day after the latest stored, but at least RECHECK_DAYS back."""
    return min(latest + timedelta(days=1), today - timedelta(days=RECHECK_DAYS))


class Halted(Exception):
    """A gate stopped the run; nothing of its batch is published."""


@dataclass
class Gates:
    """What a batch must pass before it is published."""

    allowed_parliaments: set[int] = field(default_factory=set)
    most_unlinked: float = MOST_UNLINKED
    #: Top-level fields of bodies that some column takes; a body with a value in any other field halts the run. None asks for nothing.
    mapped_fields: list[str] | None = None

    def check(self, bodies: DataFrame, turns: DataFrame) -> dict:
        shapes = {r["shape"]: r["count"] for r in bodies.groupBy("shape").count().collect()}
        if shapes and set(shapes) == {"ERROR"}:
            raise Halted("every body is an error")
        if shapes.get("UNREADABLE"):
            raise Halted(f"{shapes['UNREADABLE']} bodies can't be read")
        if self.mapped_fields is not None:
            lost = lost_fields(bodies.where(F.col("shape") != "ERROR"), self.mapped_fields).orderBy("field").limit(20).collect()
            if lost:
                raise Halted("fields that nothing takes: " + ", ".join(f"{r['field']} ({r['bodies']})" for r in lost))
        parliaments = {r[0] for r in bodies.select("parliament").distinct().collect()}
        if self.allowed_parliaments and not parliaments <= self.allowed_parliaments:
            raise Halted(f"unexpected Parliaments {sorted(parliaments - self.allowed_parliaments)}")
        kinds = turns.select(speech_category(F.col("speaker"), F.col("speaker_id")).alias("c")).agg(F.count(F.when(F.col("c") == "linked", 1)).alias("linked"), F.count(F.when(F.col("c") == "named_unlinked", 1)).alias("unlinked")).first()
        named = kinds["linked"] + kinds["unlinked"]
        if named and kinds["unlinked"] / named > self.most_unlinked:
            raise Halted(f"{kinds['unlinked']} of {named} named speakers are unlinked")
        return {"shapes": shapes, **kinds.asDict()}


def turns_of(bodies: DataFrame, speakers: DataFrame) -> DataFrame:
    """(report_id, ordinal, speaker, speaker_id, kind, transcript) of parsed bodies."""
    rendered = X.html_lines(bodies.where("content is not null"), "report_id", "content")
    turns = X.split_turns(rendered, "report_id")
    return turns.join(speakers.select(F.col("name").alias("speaker"), "speaker_id"), "speaker", "left").select("report_id", "ordinal", "speaker", "speaker_id", "kind", "transcript")


def changed_reports(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """(report_id): stored reports whose content now differs; they raise an alert and are not rewritten."""
    digest = lambda df, name: df.select("report_id", F.sha2(F.col("content").cast("binary"), 256).alias(name))
    return digest(stored, "a").join(digest(fetched, "b"), "report_id").where("a <> b").select("report_id")


def held_rows(bodies: DataFrame, today: date) -> DataFrame:
    """Reports without a text: kept back and tried again; due for an alert once they are 13 or 14 days old."""
    age = F.datediff(F.lit(today), F.col("sitting_day"))
    return bodies.where(F.col("content").isNull() | (F.col("content") == "")).select("report_id", "sitting_day", age.between(13, 14).alias("is_alert_due"))


LEDGER = "run_id string, started_at timestamp, at timestamp, status string, reports long, turns long, note string, held long"


def _note(spark: SparkSession, store: str, run: dict, status: str, **more) -> dict:  # noqa: ANN003
    """Appends what a run has come to; a run has a row when it begins and one when it ends."""
    row = run | {"at": datetime.now(timezone.utc), "status": status} | more
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(f"{store}/ledger")
    return row


def refresh(spark: SparkSession, landing: DataFrame, speakers: DataFrame, store: str, gates: Gates | None = None, today: date | None = None) -> dict:
    """One run over landed rows (report_id, sitting_day, parliament, body).

    Only unseen reports are written, so a second run over the same landing adds nothing. The
    gates see the batch before anything is published; a halted run leaves the tables as they
    were. The ledger says RUNNING from the start and at the end SUCCEEDED, HALTED, or FAILED with
    the error, which is raised again; a run that died stays RUNNING (see `stale_runs`).
    """
    today = today or datetime.now(timezone.utc).date()
    run = {"run_id": uuid.uuid4().hex, "started_at": datetime.now(timezone.utc), "reports": 0, "turns": 0, "note": "", "held": 0}
    _note(spark, store, run, "RUNNING")
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/documents")
        has_store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        parsed = parse_bodies(landing)
        new = parsed.join(spark.read.parquet(f"{store}/documents").select("report_id"), "report_id", "left_anti") if has_store else parsed
        batch = spark.read.parquet(publish(new, f"{store}/batch"))
        run["held"] = held_rows(batch, today).count()
        ready = batch.where("content is not null and content <> ''")
        turns = spark.read.parquet(publish(turns_of(ready, speakers), f"{store}/batch_turns"))
        (gates or Gates()).check(batch, turns)
        append_new(turns, f"{store}/turns", ["report_id", "ordinal"])
        append_new(ready.select("report_id", "sitting_day", "parliament", "content"), f"{store}/documents", ["report_id"])
        return _note(spark, store, run, "SUCCEEDED", reports=ready.count(), turns=turns.count())
    except Halted as halt:
        return _note(spark, store, run, "HALTED", note=str(halt))
    except Exception as error:
        _note(spark, store, run, "FAILED", note=f"{type(error).__name__}: {str(error)[:500]}")
        raise


def runs(ledger: DataFrame) -> DataFrame:
    """A row a run: the last that its ledger says."""
    last = F.max_by(F.struct(*ledger.columns), F.struct("at", F.col("status") != "RUNNING"))
    return ledger.groupBy("run_id").agg(last.alias("r")).select("r.*")


def stale_runs(ledger: DataFrame, now: Column, hours: int = STALE_HOURS) -> DataFrame:
    """Runs that began so long ago and have not ended."""
    return runs(ledger).where((F.col("status") == "RUNNING") & (F.col("started_at") < now - F.expr(f"interval {hours} hours")))


def is_fresh(ledger: DataFrame, last: int = 14) -> DataFrame:
    """(is_fresh): whether the last runs that have ended all succeeded."""
    ended = runs(ledger).where("status <> 'RUNNING'").orderBy(F.col("started_at").desc()).limit(last)
    return ended.agg((F.coalesce(F.bool_and(F.col("status") == "SUCCEEDED"), F.lit(False)) & (F.count("*") == last)).alias("is_fresh"))
