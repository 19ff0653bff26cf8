"""Streams drained over landed files."""

import datetime

from rostrum.streaming import landing as L


def test_office_ranges_across_batches(spark, tmp_path):
    schema = "speaker long, office string, place int"
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], schema).write.parquet(land)
    stream = L.office_range_stream(L.landed(spark, land, schema))
    for rows in ([(1, "A", 1), (1, "A", 2), (2, "B", 1)], [(1, "A", 3), (1, "C", 4), (2, "B", 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(1, "A", 1, 2, 2), (1, "A", 1, 3, 3), (1, "C", 4, 4, 1), (2, "B", 1, 1, 1), (2, "B", 3, 3, 1)]


def test_batches_run_once(spark, tmp_path):
    land = str(tmp_path / "in")
    spark.range(10).write.parquet(land)
    seen = []
    for _ in range(2):
        L.run_batches(L.landed(spark, land, "id long"), str(tmp_path / "check"), lambda df, k: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 10


def test_sessions(spark, tmp_path):
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda m: datetime.datetime(2024, 1, 1, 0, 0) + datetime.timedelta(minutes=m)
    spark.createDataFrame([(1, at(0)), (1, at(10)), (1, at(100)), (2, at(500))], "user long, ts timestamp").write.parquet(land)
    stream = L.sessions(L.landed(spark, land, "user long, ts timestamp"), "ts", ["user"])
    stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [1, 2]


def test_first_per_key(spark, tmp_path):
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(1, at), (1, at), (2, at)], "user long, ts timestamp").coalesce(1).write.parquet(land)
    stream = L.first_per_key(L.landed(spark, land, "user long, ts timestamp"), "ts", ["user"])
    stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r.user for r in spark.read.parquet(out).collect()) == [1, 2]


def test_held_reports_over_batches(spark, tmp_path):
    """A report without a text is kept, asked for again, reported on days 13 and 14, and released once."""
    schema = "report_id long, sitting_day date, probed_at timestamp, has_text boolean"
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], schema).write.parquet(land)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    probe = lambda report, sat, at, text: (report, day(sat), datetime.datetime(2024, 1, 1, 6) + datetime.timedelta(days=at), text)
    stream = L.held_report_stream(L.landed(spark, land, schema))
    batches = [
        [probe(1, 0, 1, False), probe(2, 0, 1, True), probe(3, 0, 1, False)],
        [probe(1, 0, 2, False), probe(3, 0, 2, True), probe(2, 0, 2, True)],
        [probe(4, 10, 13, False)],  # nobody asks for 1; its timer does
        [probe(1, 0, 15, True), probe(5, 0, 15, False)],
        [probe(1, 0, 16, True), probe(4, 10, 16, True)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination()
    got = {}
    for r in spark.read.parquet(out).collect():
        got.setdefault(r.report_id, []).append((r.event, r.day))
    assert {k: sorted(v, key=lambda e: (e[1], e[0])) for k, v in got.items()} == {
        1: [("HELD", day(1)), ("RETRIED", day(2)), ("ALERT", day(13)), ("ALERT", day(14)), ("RELEASED", day(15))],
        2: [("TAKEN", day(1))],
        3: [("HELD", day(1)), ("RELEASED", day(2))],
        4: [("HELD", day(13)), ("RELEASED", day(16))],
        5: [("ALERT", day(13)), ("ALERT", day(14)), ("HELD", day(15))],
    }
