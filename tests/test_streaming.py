from datetime import datetime as D

from cohortloom.operators.catalog import latest
from cohortloom.streaming import ingest

SCHEMA = "seq long, key string, state string, at timestamp_ntz"


def test_log_is_written_once(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
    put([(1, "a", "NEW", D(2024, 1, 1)), (2, "b", "NEW", D(2024, 1, 1))])
    for _ in range(2):  # the second start finds nothing new
        ingest.append_log(ingest.stream_events(spark, source, SCHEMA, 1), log, mark).awaitTermination()
    put([(3, "a", "DONE", D(2024, 1, 2))])
    ingest.append_log(ingest.stream_events(spark, source, SCHEMA), log, mark).awaitTermination()
    rows = spark.read.parquet(log)
    assert rows.count() == 3
    assert {r.key: r.state for r in latest(rows.drop("batch"), ["key"], ["seq"]).collect()} == {"a": "DONE", "b": "NEW"}


def test_windows_and_states(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(i, f"k{i % 2}", f"s{i}", D(2024, 1, 1, i % 3, 5)) for i in range(9)], SCHEMA).write.parquet(source)
    stream = ingest.stream_events(spark, source, SCHEMA)
    counts = ingest.stage_counts(stream, "at", "key").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert spark.table("counts").groupBy().sum("n").first()[0] == 9
    states = ingest.current_states(stream, "key", "seq", "state").writeStream.outputMode("complete").format("memory").queryName("states").trigger(availableNow=True).start()
    states.awaitTermination()
    assert {r.key: r.state for r in spark.table("states").collect()} == {"k0": "s8", "k1": "s7"}


def test_batch_work_alongside_a_stream(spark, tmp_path):
    source, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    for i in range(3):
        spark.createDataFrame([(i, f"k{i}", "NEW", D(2024, 1, 1))], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    seen = set()

    def step():
        import os

        ready = {d for d in (os.listdir(log) if os.path.isdir(log) else []) if os.path.exists(f"{log}/{d}/_SUCCESS")} - seen
        if not ready:
            return False
        seen.add(ready.pop())
        return True

    assert ingest.alongside(ingest.append_log(ingest.stream_events(spark, source, SCHEMA, 1), log, mark), step, 0.05) == len(seen) == 3
