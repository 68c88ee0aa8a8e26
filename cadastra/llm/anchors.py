"""Packed postings: what the substring operators send to reducers, as arrays instead of a row for each position.

A task combines its postings before it sends them (`combined`): what it can tell by itself (two texts have this hash) it marks
as found, and of such a hash it sends one posting only, for the others to know. So a passage that a third of all texts hold
reaches its reducer once for each task, not once for each text. Reducers (`found_in`) find the rest. The number of parts
follows the bytes of the input, not the number of shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

PACKED = "p int, hash binary, owner binary, pos binary, extra binary"
LAST_ID = (1 << 63) - 1
FLUSH = 2_000_000
BYTES_PER_PART = 64 << 20
#: Rules. What is found: hashes of two or more texts; hashes of two or more places; windows that a smaller rank has too.
TEXTS, PLACES, LATER = "texts", "places", "later"


def keyed(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """id (null: the largest, with missing), tk (a 64-bit key of the text) and text of docs; equal texts are a class from here on."""
    text = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(id_).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("tk"), text.alias("text"), F.col(id_).isNull().alias("missing"))


def parts_for(rows: DataFrame) -> int:
    """How many parts the postings of these texts go to: one for each BYTES_PER_PART, and a few for each core."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(4 * rows.sparkSession.sparkContext.defaultParallelism, size // BYTES_PER_PART + 1)


def _runs(key: np.ndarray) -> np.ndarray:
    """First index of each run of equal values."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def _found(rule: str, hash_: np.ndarray, owner: np.ndarray, rank: np.ndarray, many: np.ndarray | None = None) -> np.ndarray:
    """Which of these postings, in order of hash and each once, are found. many: hashes known to be met elsewhere."""
    at = _runs(hash_)
    if not len(at):
        return np.zeros(0, bool)
    size = np.diff(np.append(at, len(hash_)))
    if rule == LATER:
        return rank > np.repeat(np.minimum.reduceat(rank, at), size)
    some = size > 1 if rule == PLACES else np.minimum.reduceat(owner, at) < np.maximum.reduceat(owner, at)
    if many is not None:
        some |= np.logical_or.reduceat(many, at)
    return np.repeat(some, size)


def _batch(p: np.ndarray, hash_: np.ndarray | None, owner: np.ndarray, pos: np.ndarray, extra: np.ndarray | None) -> pa.RecordBatch:
    at = _runs(p)
    ends = np.append(at[1:], len(p))
    column = lambda x: pa.nulls(len(at), pa.binary()) if x is None else pa.array([x[a:b].tobytes() for a, b in zip(at, ends, strict=False)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(p[at].astype(np.int32)), column(hash_), column(owner), column(pos), column(extra)], names=["p", "hash", "owner", "pos", "extra"])


def _ordered(hash_: np.ndarray, owner: np.ndarray, pos: np.ndarray, extra: np.ndarray) -> list[np.ndarray]:
    """In order of hash, owner and pos; equal postings (of copies) once."""
    order = np.lexsort((pos, owner, hash_))
    hash_, owner, pos, extra = hash_[order], owner[order], pos[order], extra[order]
    new = np.ones(len(order), bool)
    new[1:] = (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1]) | (pos[1:] != pos[:-1])
    return [hash_[new], owner[new], pos[new], extra[new]]


def _bucket(owner: np.ndarray, parts: int) -> np.ndarray:
    return (mix(owner.view(np.uint64).copy()) % np.uint64(parts)).astype(np.int32)


def _combine(held: list[tuple], parts: int, rule: str) -> Iterator[pa.RecordBatch]:
    hash_, owner, pos, rank = (np.concatenate(x) for x in zip(*held, strict=True))
    hash_, owner, pos, rank = _ordered(hash_, owner, pos.astype(np.int32), rank)
    found = _found(rule, hash_, owner, rank)
    send = ~found
    if rule != LATER:
        send[_runs(hash_)] = True
    q = _bucket(owner[found], parts)
    by = np.argsort(q, kind="stable")
    yield _batch(q[by], None, owner[found][by], pos[found][by], None)
    hash_, owner, pos, extra = hash_[send], owner[send], pos[send], rank[send] if rule == LATER else found[send].view(np.uint8)
    p = (mix(hash_ ^ np.uint64(0x5DEECE66D)) % np.uint64(parts)).astype(np.int32)
    by = np.argsort(p, kind="stable")
    yield _batch(p[by], hash_[by], owner[by], pos[by], extra[by])


def combined(postings: Iterable[tuple], parts: int, rule: str) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED from a task's postings (hash, owner, pos, rank), arrays of one length; rank counts for LATER only.

    Rows without hash are what the task found, by bucket of owners. extra: ranks, or whether a hash is met in two places."""
    held, n = [], 0
    for x in postings:
        held.append(x)
        n += len(x[0])
        if n > FLUSH:
            yield from _combine(held, parts, rule)
            held, n = [], 0
    if held:
        yield from _combine(held, parts, rule)


BUCKETS = "q int, owner binary, pos binary"


def found_in(packed: DataFrame, parts: int, rule: str) -> DataFrame:
    """(owner, pos): one row for each owner with all positions that are found, packed."""

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        sent = pdf["hash"].notna()
        column = lambda c, t: np.frombuffer(b"".join(pdf.loc[sent, c]), t)
        hash_, owner, pos, extra = _ordered(column("hash", np.uint64), column("owner", np.int64), column("pos", np.int32), column("extra", np.int64 if rule == LATER else np.uint8))
        many = None if rule == LATER else extra.astype(bool)
        found = _found(rule, hash_, owner, extra, many)
        if many is not None:
            found &= ~many  # these their own tasks have found already
        owner, pos = owner[found], pos[found]
        q = _bucket(owner, parts)
        by = np.argsort(q, kind="stable")
        q, owner, pos = q[by], owner[by], pos[by]
        at = _runs(q)
        cut = lambda x: [y.tobytes() for y in np.split(x, at[1:])] if len(at) else []
        here = pdf.loc[~sent, ["p", "owner", "pos"]].rename(columns={"p": "q"})
        return pd.concat([here, pd.DataFrame({"q": q[at], "owner": cut(owner), "pos": cut(pos)})])

    return packed.groupBy("p").applyInPandas(reduce, BUCKETS).groupBy("q").applyInPandas(_gather, "owner long, pos binary")


def _gather(pdf: pd.DataFrame) -> pd.DataFrame:
    owner, pos = np.frombuffer(b"".join(pdf["owner"]), np.int64), np.frombuffer(b"".join(pdf["pos"]), np.int32)
    order = np.lexsort((pos, owner))
    owner, pos = owner[order], pos[order]
    at = _runs(owner)
    return pd.DataFrame({"owner": owner[at], "pos": [x.tobytes() for x in np.split(pos, at[1:])] if len(at) else []})


def positions(packed) -> np.ndarray:
    return np.frombuffer(packed, np.int32).astype(np.int64) if packed else np.zeros(0, np.int64)
