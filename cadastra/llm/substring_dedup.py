"""Substring dedup by difference-cover anchors.

Words are removed where a window of `window` words covers them that also starts in a document of a smaller id. Anchors, the
hashes of windows of window - period + 1 words, are taken only where the position modulo the period is in a difference
cover: whatever the offsets of two equal windows, some cover position falls on the same word in both, so they share
an anchor that lies in them. Anchors that two different texts have are extended: the full windows around them, and
only these, are hashed and grouped with the least id. That is linear in the anchors however hot a passage is, and compares no
pairs: tasks combine what they hold before they send it (anchors.py). Equal texts are one class: the least id stands for it,
and longer ones of the others go whole. Texts, anchors and windows are equal if their 64-bit hashes are: of 10^12 windows a
few in 10^8 may be taken for others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import LATER, PACKED, TEXTS, combined, found_in, keyed, parts_for, positions
from .common import Words, long_window_hashes, slices, table

PERIOD = 31
#: A perfect difference set modulo 31.
COVER = (1, 5, 11, 24, 25, 27)


def is_cover(cover, period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _anchors(window: int, period: int, cover, parts: int):
    length = window - period + 1
    at = np.zeros(period, bool)
    at[list(cover)] = True

    def postings(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part, data, offs in slices(batch, "text"):
                w = Words(data, offs)
                doc = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
                pos = np.arange(len(doc)) - w.first[:-1][doc]
                h = long_window_hashes(w.hashes(), length)
                pick = np.flatnonzero((pos[: len(h)] + length <= np.diff(w.first)[doc[: len(h)]]) & at[pos[: len(h)] % period])
                pick = pick[np.diff(w.first)[doc[pick]] >= window]
                owner = part.column("tk").to_numpy()[doc[pick]]
                yield h[pick], owner, pos[pick], owner

    return lambda batches: combined(postings(batches), parts, TEXTS)


def _extend(window: int, period: int, parts: int):
    def postings(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part, data, offs in slices(batch, "text"):
                w = Words(data, offs)
                h = long_window_hashes(w.hashes(), window)
                hashes, docs, starts = [], [], []
                for d, found in enumerate(part.column("pos").to_pylist()):
                    n = int(w.first[d + 1] - w.first[d])
                    mark = np.zeros(n + period + 1, np.int32)
                    p = positions(found)
                    np.add.at(mark, np.maximum(p - period + 1, 0), 1)
                    np.add.at(mark, p + 1, -1)
                    s = np.flatnonzero(np.cumsum(mark)[: max(0, n - window + 1)] > 0)
                    hashes.append(h[w.first[d] + s])
                    docs.append(np.full(len(s), d))
                    starts.append(s)
                doc = np.concatenate(docs)
                yield np.concatenate(hashes), part.column("tk").to_numpy()[doc], np.concatenate(starts), part.column("id").to_numpy()[doc]

    return lambda batches: combined(postings(batches), parts, LATER)


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in slices(batch, "text"):
                w = Words(data, offs)
                whole = data.tobytes()
                n_words, n_removed, digest = [], [], []
                for d, (found, copy) in enumerate(zip(part.column("pos").to_pylist(), part.column("copy").to_pylist(), strict=True)):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    gone = np.zeros(b - a + window + 1, np.int32)
                    p = positions(found)
                    np.add.at(gone, p, 1)
                    np.add.at(gone, p + window, -1)
                    keep = np.cumsum(gone)[: b - a] == 0
                    if copy and b - a >= window:
                        keep[:] = False
                    kept = [whole[s:e] for s, e in zip(w.start[a:b][keep].tolist(), w.end[a:b][keep].tolist(), strict=True)]
                    n_words.append(b - a)
                    n_removed.append(b - a - len(kept))
                    digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())], names=["id", "n_words", "n_removed", "kept_sha256"])

    return run


def substring_dedup(docs: DataFrame, id_: str = "doc_id", text: str = "text", window: int = 50, period: int = PERIOD, cover=COVER) -> DataFrame:
    """One row (id, n_words, n_removed, kept_sha256) for each row of docs.

    Null and empty texts have no words. A null id counts as the largest. Rows with equal ids don't remove each other's
    words. The texts are shuffled once, by id; that exchange serves both the extension and the removal."""
    if not is_cover(cover, period) or period > window:
        raise ValueError("cover is no difference cover of the period, or the period exceeds the window")
    rows = keyed(docs, id_, text)
    parts = parts_for(rows)
    classes = rows.groupBy("tk").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    one = rows.join(classes.select(F.col("first").alias("id"), "tk").hint("shuffle_hash"), ["id", "tk"])  # one text of each class
    marks = found_in(one.select("tk", "text").mapInArrow(_anchors(window, period, cover, parts), PACKED), parts, TEXTS).join(classes, F.col("owner") == F.col("tk"))
    marks = marks.select(F.col("first").alias("id"), "tk", "pos")
    later = found_in(rows.join(marks.hint("shuffle_hash"), ["id", "tk"]).mapInArrow(_extend(window, period, parts), PACKED), parts, LATER)
    later = later.join(classes, F.col("owner") == F.col("tk")).select(F.col("first").alias("id"), "tk", "pos", F.lit(False).alias("copy"))
    copies = rows.select("id", "tk").join(classes.where("first < last"), "tk").where("id > first").select("id", "tk").distinct()
    gone = later.unionByName(copies.select("id", "tk", F.expr("cast(null as binary)").alias("pos"), F.lit(True).alias("copy")))
    out = rows.join(gone.hint("shuffle_hash"), ["id", "tk"], "left").select(F.when(~F.col("missing"), F.col("id")).alias("id"), "text", "pos", F.coalesce("copy", F.lit(False)).alias("copy"))
    return out.mapInArrow(_remove(window), "id long, n_words long, n_removed long, kept_sha256 string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).withColumnRenamed("id", "doc_id")
