"""Streams give what the batch forms give, over several batches and after a restart."""

import datetime as dt
import random

from cadastra.streaming import ledger as L


def _events(n=400):
    rng = random.Random(1)
    t0 = dt.datetime(2024, 1, 1)
    return [(rng.randint(1, 9), i, t0 + dt.timedelta(minutes=i), rng.choice([-7.5, -2.0, 0.0, 1.0, 4.25]), rng.choice(["a", "b", "", None])) for i in range(n)]


def test_ledger_rules(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t, 5.0, "x"), (1, 2, t, -6.0, "x"), (1, 3, t, 0.0, "x"), (1, 4, t, 1.0, None), (1, 5, t, -5.0, "x")]
    out = L.ledger(spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp, amount double, provenance string")).orderBy("event_id").collect()
    assert [(r["reason"], r["balance"]) for r in out] == [(None, 5.0), ("overdraft", 5.0), ("zero_amount", 5.0), ("no_provenance", 5.0), (None, 0.0)]


def test_ledger_stream_equals_batch_over_restarts(spark, tmp_path):
    rows = _events()
    schema = "user_id long, event_id long, ts timestamp, amount double, provenance string"
    source = f"{tmp_path}/in"
    for part in (rows[:150], rows[150:300], rows[300:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        out = L.run_once(L.ledger(stream), f"{tmp_path}/out", f"{tmp_path}/state")
    batch = L.ledger(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, out.drop("ts").collect()), key=str) == sorted(map(tuple, batch.drop("ts").collect()), key=str)


def test_claims(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, 10, t, "claim"), (1, 2, 11, t, "claim"), (1, 3, 11, t, "release"), (1, 4, 10, t, "release"), (1, 5, 11, t, "claim")]
    schema = "structure_id long, event_id long, user_id long, ts timestamp, action string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    out = L.run_once(L.claims(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/state").orderBy("event_id").collect()
    assert [(r["accepted"], r["holder"]) for r in out] == [(True, 10), (False, 10), (False, 10), (True, None), (True, 11)]


def test_upsert_keeps_newest_values(spark, tmp_path):
    schema = "k long, seq long, a string, b long"
    source = f"{tmp_path}/in"
    for part in ([(1, 1, "x", 5), (2, 1, "y", None)], [(1, 2, None, 6), (2, 2, "z", 1)], [(1, 3, "w", None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(L.upsert_latest(f"{tmp_path}/t", "k", ["seq"]))
        q.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    out = {r["k"]: (r["a"], r["b"]) for r in spark.read.schema(schema).parquet(f"{tmp_path}/t/v2").collect()}
    assert out == {1: ("w", 6), 2: ("z", 1)}
