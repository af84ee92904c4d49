"""The input of the streaming queries: slices of several files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeledger.operators import finalize
from lakeledger.operators import tasks as TK
from lakeledger.plans import queries  # noqa: F401  it registers the others
from lakeledger.plans import runlog_queries as RQ
from lakeledger.plans import stream_queries as SQ
from lakeledger.sources import runlog as RL

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ROWS = 600


@pytest.fixture
def sf_dir(spark, tmp_path, monkeypatch):
    """A small table whose slices take four files."""
    monkeypatch.setattr(SQ, "ROWS_A_FILE", 20, raising=False)
    rng, start = random.Random(5), dt.datetime(2024, 1, 1)
    kinds = ["signup", "view", "purchase", "error", "click", "view"]
    times = sorted(rng.sample(range(30 * 86400), ROWS))  # ids follow the time
    rows = [(i, start + dt.timedelta(seconds=s), rng.randrange(25), rng.choice(kinds), 1.0, "{}") for i, s in enumerate(times)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("deal, n_rows", [(SQ._event_files, ROWS), (SQ._in_turn, ROWS), (SQ._late_files, ROWS + 86),
                                          (SQ._again_files, ROWS + 120)])
def test_a_slice_has_several_files_and_is_one_batch(spark, sf_dir, tmp_path, deal, n_rows):
    path, schema, *per = deal(spark, sf_dir)
    table = spark.read.schema(schema).parquet(path)
    assert table.count() == n_rows
    assert table.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 60
    batches = []
    q = (SQ._stream(spark, path, schema, *per).writeStream.foreachBatch(lambda b, i: batches.append(b.count()))
         .option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(batches) == SQ.SLICES and sum(batches) == n_rows


def log_of(spark, sf_dir):
    return RL.from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


@pytest.mark.parametrize("query", [SQ.stream_tasks, SQ.stream_tasks_late])
def test_tasks_of_large_slices_equal_the_replay(spark, sf_dir, query):
    want = SQ._task_columns(TK.replay_tasks(log_of(spark, sf_dir), now=RQ.NOW))
    assert sorted(map(str, query(spark, sf_dir).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("query, in_turn", [(SQ.stream_timeout_alerts, True), (SQ.stream_timeout_alerts_late, False)])
def test_alerts_of_large_slices_equal_the_replay(spark, sf_dir, tmp_path, monkeypatch, query, in_turn):
    monkeypatch.setattr(SQ, "new_run_dir", lambda _, label: f"{tmp_path}/{label}")
    got = query(spark, sf_dir).collect()
    want = finalize.timeout_alerts(TK.timeout_history(log_of(spark, sf_dir), now=RQ.NOW), TK.C.TASK_TIMEOUT_HOURS)
    want = want.withColumn("tags", F.array_join("tags", ",")).select(*got[0].__fields__)
    assert sorted(map(str, got)) == sorted(map(str, want.collect()))
    # the sweep's row moves the watermark only after all events
    late = spark.read.parquet(f"{tmp_path}/stream-timeouts/landed/late").count()
    assert late == 0 if in_turn else late > 0
    assert len(spark.read.parquet(f"{tmp_path}/stream-timeouts/landed/clock").collect()) == SQ.SLICES + 1
