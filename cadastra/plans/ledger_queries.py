"""Queries on ledger and claim events: batch forms, and the streams that give the same."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadastra.streaming import ledger as L

from .derived import read
from .registry import query


def _folder(spark, label: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _stream(spark, sf_dir: str, name: str):
    """A table as a file stream; a pattern, because a stream's path may not be one file."""
    return spark.readStream.schema(read(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _amounts(events):
    """Signed amounts: purchases debit three times their value, the rest credit; every 17th has no provenance."""
    sign = F.when(F.col("event_type") == "purchase", -3.0).otherwise(1.0)
    return events.select("user_id", "event_id", "ts", F.round(sign * F.col("value"), 2).alias("amount"), F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("provenance"))


def _claim_events(events):
    return events.select((F.col("event_id") % 40).alias("structure_id"), "event_id", "user_id", "ts", F.when(F.col("event_type") == "click", "release").otherwise("claim").alias("action"))


@query()
def t1_ledger(spark, sf_dir):
    """Balances without overdraft from the event stream."""
    events = _stream(spark, sf_dir, "events")
    where = _folder(spark, "ledger")
    return L.run_once(L.ledger(_amounts(events)), f"{where}/out", f"{where}/state")


@query()
def t2_claims(spark, sf_dir):
    """At most one holder of each structure."""
    events = _stream(spark, sf_dir, "events")
    where = _folder(spark, "claims")
    return L.run_once(L.claims(_claim_events(events)), f"{where}/out", f"{where}/state")


@query("""WITH s AS (SELECT event_id % 40 AS structure_id, event_id, ts, event_type AS status, lag(event_type) OVER (PARTITION BY event_id % 40 ORDER BY ts, event_id) AS previous FROM events)
SELECT structure_id, event_id, CASE WHEN previous IS NULL THEN 'created' WHEN status = 'click' AND previous <> 'click' THEN 'released' WHEN status <> previous THEN 'status_changed' ELSE 'unchanged' END AS change FROM s""")
def t3_claim_history(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("structure_id", F.col("event_id") % 40)
    p = e.withColumn("previous", F.lag("event_type").over(W.partitionBy("structure_id").orderBy("ts", "event_id")))
    s = F.col("event_type")
    change = F.when(F.col("previous").isNull(), "created").when((s == "click") & (F.col("previous") != "click"), "released").when(s != F.col("previous"), "status_changed").otherwise("unchanged")
    return p.select("structure_id", "event_id", change.alias("change"))


@query("SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(CASE WHEN event_id % 3 = 0 THEN value END, (ts, event_id)) FILTER (event_id % 3 = 0) AS value FROM events GROUP BY 1")
def t4_upsert(spark, sf_dir):
    """Newest non-null value of each field."""
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return L.merged(e, "user_id", ["ts", "event_id"]).select("user_id", "event_type", "value")


@query("""SELECT doc_id, concat_ws(',', CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty_body' END, CASE WHEN length(trim(coalesce(text, ''))) > 2000 THEN 'too_long' END, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'bad_visibility' END) AS reasons FROM documents""")
def t5_post_validation(spark, sf_dir):
    visibility = F.when(F.col("lang") == "en", "public").when(F.col("lang") == "de", "unlisted").when(F.col("lang") == "fr", "private").otherwise("other")
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"), visibility.alias("visibility"), F.col("doc_id").alias("structure_id"), F.lit(None).cast("string").alias("tile_id"))
    return d.select("doc_id", F.array_join(L.post_reasons(), ",").alias("reasons"))


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'de') OR doc_id % 7 = 3")
def t6_visibility(spark, sf_dir):
    visibility = F.when(F.col("lang") == "en", "public").when(F.col("lang") == "de", "unlisted").otherwise("private")
    d = read(spark, sf_dir, "documents").select("doc_id", visibility.alias("visibility"), (F.col("doc_id") % 7).alias("user_id"))
    return L.visible(d, 3).select("doc_id")


@query("SELECT l_returnflag AS classification, count(*) AS n FROM lineitem GROUP BY 1")
def t8_streaming_histogram(spark, sf_dir):
    """Class histogram of a file stream, written batch by batch and read as the newest complete one."""
    stream = _stream(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("classification")).agg(F.count("*").alias("n"))
    where = _folder(spark, "histogram")
    write = lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{where}/out")
    stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


@query("""SELECT o_orderkey, o_orderstatus, c.c_name AS holder, CASE WHEN c.c_custkey IS NULL THEN 'free' ELSE 'claimed' END AS claim_status FROM orders LEFT JOIN customer c ON o_custkey = c.c_custkey AND o_orderstatus = 'O'""")
def j33_claim_status(spark, sf_dir):
    """Structures with their active claim and holder; the condition is part of the join."""
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    j = o.join(c, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderstatus") == "O"), "left")
    return j.select("o_orderkey", "o_orderstatus", F.col("c_name").alias("holder"), F.when(F.col("c_custkey").isNull(), "free").otherwise("claimed").alias("claim_status"))


@query("SELECT user_id, CAST(epoch(time_bucket(INTERVAL 6 HOUR, ts)) AS BIGINT) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def t_windowed_totals(spark, sf_dir):
    """Six-hour totals under a watermark."""
    e = read(spark, sf_dir, "events").withWatermark("ts", "1 hour")
    return e.groupBy("user_id", F.window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select("user_id", F.unix_timestamp("w.start").alias("start"), "n", "total")
