"""Streams over landed files: the refresh by micro-batches, and windows over events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def landed(spark: SparkSession, folder: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], available_now: bool = True) -> StreamingQuery:
    """each(batch, id) for every micro-batch, once in effect if `each` skips ids or keys it has written."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windowed_counts(events: DataFrame, time: str, by: list[str], width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(window_start, by, n): counts in tumbling or sliding windows; rows later than the watermark are dropped."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    counted = events.withWatermark(time, late).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, time: str, by: list[str], gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(session_start, session_end, by, n)."""
    counted = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def first_per_key(events: DataFrame, time: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def office_range_stream(attendance: DataFrame) -> DataFrame:
    """(speaker, office, first_place, last_place, sittings) whenever a speaker's range grows.

    attendance: speaker long, office string, place int (the sitting's rank). The state is the
    open range; a row that isn't the next place with the same office opens a new one. Rows of a
    speaker must come in the order of their sittings across batches.
    """

    def extend(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        office, first, last, n = state.get if state.exists else ("", 0, -2, 0)
        rows = pd.concat(batches).sort_values("place")
        out = []
        for at, held in zip(rows["place"], rows["office"], strict=True):
            if held == office and at == last:
                continue
            first, n = (first, n + 1) if held == office and at == last + 1 else (int(at), 1)
            office, last = held, int(at)
            if out and out[-1][1:3] == (office, first):
                out.pop()
            out.append((key[0], office, first, last, n))
        state.update((office, first, last, n))
        yield pd.DataFrame(out, columns=["speaker", "office", "first_place", "last_place", "sittings"])

    return attendance.groupBy("speaker").applyInPandasWithState(extend, "speaker long, office string, first_place int, last_place int, sittings int", "office string, first int, last int, n int", "append", GroupStateTimeout.NoTimeout)


#: Days after its sitting on which a report that still has no text is reported.
ALERT_DAYS = (13, 14)


def held_report_stream(probes: DataFrame, late: str = "0 seconds", days: tuple[int, ...] = ALERT_DAYS) -> DataFrame:
    """(report_id, event, day) of reports that are found before their text is there.

    probes: report_id, sitting_day date, probed_at timestamp, has_text. A report found without a
    text is HELD, and RETRIED each time it is found so again; with its text it is RELEASED, or
    TAKEN if it never was held; later finds of it say nothing. While it is held, a timer of event
    time goes off on each of the days after its sitting, also when nobody asks for it: ALERT with
    that day. An alert whose day is past when the report is first found comes at once.
    """
    fields = "report_id long, event string, day date"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sitting, alerts, done = state.get if state.exists else ("", 0, False)
        out: list[tuple] = []

        def due(until: pd.Timestamp) -> None:
            nonlocal alerts
            while not done and alerts < len(days) and (at := pd.Timestamp(sitting) + pd.Timedelta(days=days[alerts])) <= until:
                out.append((key[0], "ALERT", at.date()))
                alerts += 1

        if state.hasTimedOut:
            due(pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms"))
        else:
            rows = pd.concat(batches).sort_values("probed_at", kind="stable")
            for day, at, has_text in zip(rows["sitting_day"], rows["probed_at"], rows["has_text"], strict=True):
                if done:
                    continue
                known, sitting = bool(sitting), str(day)
                at = pd.Timestamp(at)
                due(at)
                done = bool(has_text)
                out.append((key[0], ("RELEASED" if known else "TAKEN") if done else "RETRIED" if known else "HELD", at.date()))
        state.update((sitting, alerts, done))
        if not done and alerts < len(days):
            state.setTimeoutTimestamp(max(int((pd.Timestamp(sitting) + pd.Timedelta(days=days[alerts])).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["report_id", "event", "day"])

    stamped = probes.withWatermark("probed_at", late)
    return stamped.groupBy("report_id").applyInPandasWithState(step, fields, "sitting string, alerts int, done boolean", "append", GroupStateTimeout.EventTimeTimeout)
