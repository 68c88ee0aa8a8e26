"""Ledger and claims as keyed state: balances without overdraft, one active claim for each structure.

Events of one key are applied in the order of (ts, event_id) within a micro-batch; state carries over batches, so a replay of
the same files in the same batches gives the same decisions, after a restart too."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DECISIONS = "user_id long, event_id long, ts timestamp, amount double, accepted boolean, reason string, balance double"
CLAIMS = "structure_id long, event_id long, user_id long, action string, accepted boolean, reason string, holder long"


def apply_amounts(rows: pd.DataFrame, balance: float) -> tuple[pd.DataFrame, float]:
    """Decide events in order: zero amounts, missing provenance and overdrafts are rejected."""
    rows = rows.sort_values(["ts", "event_id"], kind="stable")
    accepted, reasons, balances = [], [], []
    for amount, source in zip(rows["amount"], rows["provenance"], strict=True):
        reason = "zero_amount" if not amount or amount != amount else "no_provenance" if not isinstance(source, str) or not source.strip() else "overdraft" if balance + amount < 0 else None
        if reason is None:
            balance = round(balance + amount, 2)
        accepted.append(reason is None)
        reasons.append(reason)
        balances.append(balance)
    out = rows[["user_id", "event_id", "ts", "amount"]].assign(accepted=accepted, reason=reasons, balance=balances)
    return out, balance


def _ledger(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    balance = state.get[0] if state.exists else 0.0
    out, balance = apply_amounts(pd.concat(list(batches)), balance)
    state.update((balance,))
    yield out


def ledger(events: DataFrame) -> DataFrame:
    """Decisions on events(user_id, event_id, ts, amount, provenance), a stream or a table."""
    keep = events.select("user_id", "event_id", "ts", F.col("amount").cast("double").alias("amount"), "provenance")
    if keep.isStreaming:
        return keep.groupBy("user_id").applyInPandasWithState(_ledger, DECISIONS, "balance double", "append", GroupStateTimeout.NoTimeout)
    return keep.groupBy("user_id").applyInPandas(lambda pdf: apply_amounts(pdf, 0.0)[0], DECISIONS)


def apply_claims(rows: pd.DataFrame, holder: int | None) -> tuple[pd.DataFrame, int | None]:
    """A claim needs a free structure, a release its holder."""
    rows = rows.sort_values(["ts", "event_id"], kind="stable")
    out = []
    for r in rows.itertuples():
        free = holder is None
        ok = free if r.action == "claim" else holder == r.user_id
        reason = None if ok else "already_claimed" if r.action == "claim" else "not_holder"
        if ok:
            holder = int(r.user_id) if r.action == "claim" else None
        out.append((r.structure_id, r.event_id, r.user_id, r.action, ok, reason, holder))
    frame = pd.DataFrame(out, columns=["structure_id", "event_id", "user_id", "action", "accepted", "reason", "holder"])
    return frame.astype({"holder": "Int64"}), holder


def _claims(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    holder = state.get[0] if state.exists else None
    out, holder = apply_claims(pd.concat(list(batches)), None if holder is None or holder < 0 else holder)
    state.update((-1 if holder is None else holder,))
    yield out


def claims(events: DataFrame) -> DataFrame:
    """Decisions on events(structure_id, event_id, user_id, ts, action claim or release)."""
    keep = events.select("structure_id", "event_id", "user_id", "ts", "action")
    if keep.isStreaming:
        return keep.groupBy("structure_id").applyInPandasWithState(_claims, CLAIMS, "holder long", "append", GroupStateTimeout.NoTimeout)
    return keep.groupBy("structure_id").applyInPandas(lambda pdf: apply_claims(pdf, None)[0], CLAIMS)


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Work off what has arrived, into Parquet at path; run again later, it goes on from the checkpoint."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def upsert_latest(path: str, key: str, order: list[str]):
    """foreachBatch function: keep for each key the newest non-null value of each field in Parquet at path.

    Two folders alternate, so a failed batch leaves the last complete table."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        last = f"{path}/v{epoch - 1}"
        rows = batch
        if epoch > 0:
            rows = spark.read.schema(batch.schema).parquet(last).unionByName(batch)
        merged(rows, key, order).select(batch.columns).write.mode("overwrite").parquet(f"{path}/v{epoch}")

    return merge


def merged(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    rank = F.struct(*order)
    fields = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in fields))


def visible(posts: DataFrame, viewer) -> DataFrame:
    """Public and unlisted posts, and the viewer's own."""
    return posts.where(F.col("visibility").isin("public", "unlisted") | (F.col("user_id") == viewer))


def post_reasons() -> F.Column:
    """Why a post is rejected; empty for good ones."""
    text = F.trim(F.coalesce(F.col("body"), F.lit("")))
    return F.array_compact(
        F.array(
            F.when(text == "", F.lit("empty_body")),
            F.when(F.length(text) > 2000, F.lit("too_long")),
            F.when(~F.coalesce(F.col("visibility"), F.lit("")).isin("public", "unlisted", "private"), F.lit("bad_visibility")),
            F.when(F.col("structure_id").isNull() & F.col("tile_id").isNull(), F.lit("no_anchor")),
        )
    )
