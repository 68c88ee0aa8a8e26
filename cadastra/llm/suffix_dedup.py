"""Suffix-array dedup: remove every byte that a repeated string of `length` bytes covers.

Sorting all suffixes of a corpus in one array doesn't split over tasks, so repeats are first brought together. Every window
of `length` bytes selects the least k-byte hash in it; equal windows select equal bytes at the same offset. Only windows
whose selected bytes occur more than once can repeat, and these windows, as segments around the selected bytes, go to the
bucket of that hash. Equal segments are combined before they are shuffled. Each part of buckets builds its suffix
array in two stages (suffix_array.py): suffixes smaller than their successors are sorted directly, the others induced by
bucket scans; adjacent common prefixes of `length` bytes or more are the repeats. Buckets with more than `most_segments`
different segments, which one task shouldn't gather, are divided by the bytes next to the selected ones before they are
sorted. Texts, selected bytes and whole segments are equal if their 64-bit hashes are; windows are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import PACKED, PLACES, combined, found_in, keyed, parts_for, positions
from .common import cut, mix, prefix_hash, signed, slices, span_hash, table, windowed
from .suffix_array import equal_neighbours, suffix_order

GRAM = 32


def _sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the least value (the leftmost of equal ones) in each run of `width` values."""
    n = len(h) - width + 1
    best = np.arange(len(h))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(h[right] < h[left], right, left)
        span += step
    return best[:n]


def selections(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For runs of windows with one selection: first window, number of windows, selected position, its hash."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, np.zeros(0, np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    h = span_hash(prefix_hash(data), at, at + GRAM)
    pick = _sliding_argmin(h, length - GRAM + 1)
    whole = np.zeros(len(data) + 1, np.int32)  # windows that lie in one text
    a, b = offs[:-1], np.maximum(offs[1:] - length + 1, offs[:-1])
    np.add.at(whole, a, 1)
    np.add.at(whole, b, -1)
    window = np.flatnonzero(np.cumsum(whole)[: len(pick)] > 0)
    if not len(window):
        return empty, empty, empty, np.zeros(0, np.uint64)
    pick = pick[window]
    first = np.ones(len(window), bool)
    first[1:] = (pick[1:] != pick[:-1]) | (window[1:] != window[:-1] + 1)
    start = np.flatnonzero(first)
    return window[start], np.diff(np.append(start, len(window))), pick[start], h[pick[start]]


def _anchors(length: int, parts: int):
    def postings(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            owners = batch.column("tk").to_numpy()
            for rows, base, data, offs in windowed(batch, "text", length):
                first, _, _, h = selections(data, offs, length)
                doc = np.searchsorted(offs, first, "right") - 1
                owner = owners[rows[doc]]
                yield h, owner, first - offs[doc] + base, owner

    return lambda batches: combined(postings(batches), parts, PLACES)


ITEMS = "tk long, first int, last int, runs binary, n int, hash long, at int, segment binary, sh long"


def start_runs(start: np.ndarray) -> np.ndarray:
    """Rising starts as (first, step, count) rows: places that follow each other at one distance are one row."""
    step = np.diff(start)
    new = np.ones(len(start), bool)  # where a row begins: at a step unlike the one before, after which the next may be any
    k = 1
    while k < len(start):
        same = np.flatnonzero(step[k - 1 :] != step[k - 1])
        end = k - 1 + (int(same[0]) if len(same) else len(step) - k + 1)
        new[k : end + 1] = False
        k = end + 2
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(start)))
    return np.stack([start[at], np.where(count > 1, start[np.minimum(at + 1, len(start) - 1)] - start[at], 1), count], 1).astype(np.int32)


def run_starts(runs: np.ndarray) -> np.ndarray:
    first, step, count = runs.astype(np.int64).T
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first, count) + np.repeat(step, count) * nth


def _segments(length: int):
    """Each different segment of a text, or of a stretch of a long one, once, with the runs of places where it begins: a text of one
    byte, or of a repeated phrase, gives as many as its period has bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found = batch.column("tk").to_numpy(), batch.column("pos")
            long_row, marks = -1, np.zeros(0, np.int64)
            for rows, base, data, offs in windowed(batch, "text", length):
                first, n, pick, h = selections(data, offs, length)
                doc = np.searchsorted(offs, first, "right") - 1
                keep = np.zeros(len(data) + 1, bool)
                for d, row in enumerate(rows.tolist()):
                    if row != long_row:
                        long_row, marks = row, positions(found[row].as_py())
                    inside = marks[np.searchsorted(marks, base) : np.searchsorted(marks, base + int(offs[d + 1] - offs[d]))]
                    keep[inside - base + offs[d]] = True
                yes = keep[first]
                first, n, pick, h, doc = first[yes], n[yes], pick[yes], h[yes], doc[yes]
                end = first + n - 1 + length
                sh = signed(mix(span_hash(prefix_hash(data), first, end) ^ (pick - first).astype(np.uint64)))
                order = np.lexsort((first, sh, doc))
                new = np.ones(len(order), bool)
                new[1:] = (sh[order][1:] != sh[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                at = np.flatnonzero(new)
                ends = np.append(at[1:], len(order))
                start = (first - offs[doc] + base)[order]
                one = order[at]
                whole = data.tobytes()
                for i in range(0, max(len(at), 1), 8192):
                    some = slice(i, i + 8192)
                    k = one[some]
                    runs = [start_runs(start[a:b]).tobytes() for a, b in zip(at[some].tolist(), ends[some].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(owners[rows[doc[k]]]), pa.array(start[at[some]].astype(np.int32)), pa.array(start[ends[some] - 1].astype(np.int32)), pa.array(runs, pa.binary()), pa.array(n[k].astype(np.int32)), pa.array(signed(h[k])),
                            pa.array((pick[k] - first[k]).astype(np.int32)), pa.array([whole[a:b] for a, b in zip(first[k].tolist(), end[k].tolist(), strict=True)], pa.binary()), pa.array(sh[k]),
                        ],
                        names=["tk", "first", "last", "runs", "n", "hash", "at", "segment", "sh"],
                    )

    return run


def _sort_part(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The repeated windows of different segments: their numbers, from each segment's start. Segments of different buckets
        may share windows too; it does no harm."""
        n = pdf["n"].to_numpy(np.int64)
        sizes = n - 1 + length
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        text = np.frombuffer(b"".join(pdf["segment"]), np.uint8)
        edge = np.zeros(len(text) + 1, np.int32)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + n, -1)
        wanted = np.cumsum(edge)[:-1] > 0
        order = suffix_order(text, wanted, length)
        same = equal_neighbours(text, order, length)
        twice = np.zeros(len(text), bool)
        twice[order[:-1][same]] = True
        twice[order[1:][same]] = True
        marks = [np.flatnonzero(twice[a : a + k]).astype(np.int32) for a, k in zip(begin.tolist(), n.tolist(), strict=True)]
        out = pdf[["hash", "sh", "k", "n"]].assign(marks=[m.tobytes() for m in marks])
        return out[[len(m) > 0 for m in marks]]

    return run


def _divided(todo: DataFrame, length: int) -> DataFrame:
    """The segments of buckets that are too large, each as two: windows that begin up to `mid` bytes before the anchor, with the
    bytes that they all have after it, and the others, with the bytes that they all have before it."""
    mid, last = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"), F.col("n") - 1
    after = F.struct(
        F.xxhash64("key", F.lit(1), F.substring("segment", F.col("at") + GRAM + 1, F.lit(length - GRAM) - mid)).alias("key"), F.greatest(F.lit(0), F.col("at") - mid).alias("a"), last.alias("b"),
        F.col("lo").alias("lo"), mid.alias("hi"),
    )
    before = F.struct(
        F.xxhash64("key", F.lit(2), F.substring("segment", F.col("at") - mid, mid + 1)).alias("key"), F.lit(0).alias("a"), F.least(last, F.col("at") - mid - 1).alias("b"),
        (mid + 1).alias("lo"), F.col("hi").alias("hi"),
    )
    each = todo.withColumn("x", F.explode(F.array(after, before))).where("x.a <= x.b")
    return each.select(
        "hash", "sh", F.substring("segment", F.col("x.a") + 1, F.col("x.b") - F.col("x.a") + length).alias("segment"), (F.col("x.b") - F.col("x.a") + 1).alias("n"),
        (F.col("at") - F.col("x.a")).alias("at"), (F.col("k") + F.col("x.a")).alias("k"), "x.key", "x.lo", "x.hi",
    )


def _repeats(segments: DataFrame, length: int, most_segments: int, per_part: int = 40_000) -> DataFrame:
    """(hash, sh, k, n, marks): windows (from the k-th of a segment on, n in all; marks tells which, null all) that occur in two
    or more different segments of a bucket.

    A bucket of more than most_segments segments is divided by what its windows have in common, again and again, until each
    part is small enough to sort or holds one window, known byte by byte, of each of its segments: then all are equal."""
    cores = segments.sparkSession.sparkContext.defaultParallelism
    parts = max(4 * cores, segments.count() // per_part + 1)
    todo = segments.select("hash", "sh", "segment", "n", "at", F.lit(0).alias("k"), F.col("hash").alias("key"), F.lit(0).alias("lo"), F.lit(length - GRAM).alias("hi"))
    out = []
    while True:
        sizes = cut(todo.groupBy("key", "lo", "hi").agg(F.count("*").alias("m")).where("m > 1"), "suffix-sizes")
        of = lambda which: todo.join(sizes.where(which).select("key"), "key", "left_semi")  # noqa: B023, E731
        sort = of(f"lo < hi AND m <= {most_segments}").select("hash", "sh", "segment", "n", "k", F.pmod(F.xxhash64("key"), F.lit(parts)).alias("p"))
        out.append(sort.groupBy("p").applyInPandas(_sort_part(length), "hash long, sh long, k int, n int, marks binary"))
        if len(out) > 1:
            out.append(of("lo = hi").select("hash", "sh", "k", "n", F.lit(None).cast("binary").alias("marks")))
        large = f"lo < hi AND m > {most_segments}"
        if sizes.where(large).isEmpty():
            return reduce(DataFrame.unionByName, out)
        todo = cut(_divided(of(large), length), "suffix-divided")


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in slices(batch, "text"):
                whole = data.tobytes()
                out = []
                for d, (found, copies) in enumerate(zip(part.column("found").to_pylist(), part.column("copies").to_pylist(), strict=True)):
                    a, b = int(offs[d]), int(offs[d + 1])
                    n = b - a
                    if copies and n >= length:
                        out.append((n, n, 1, hashlib.sha256(b"").hexdigest()))
                        continue
                    edge = np.zeros(n + length + 1, np.int32)
                    for x in found or ():
                        p = np.arange(x["n"]) if x["marks"] is None else np.frombuffer(x["marks"], np.int32).astype(np.int64)
                        starts = run_starts(np.frombuffer(x["runs"], np.int32).reshape(-1, 3)) + x["k"]
                        short, long_ = (p, starts) if len(p) < len(starts) else (starts, p)
                        for y in short.tolist():  # either has each value once
                            edge[long_ + y] += 1
                            edge[long_ + y + length] -= 1
                    gone = np.cumsum(edge)[:n] > 0
                    text = data[a:b][~gone].tobytes() if gone.any() else whole[a:b]
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                    out.append((n, int(gone.sum()), spans, hashlib.sha256(text).hexdigest()))
                n_bytes, removed, spans, digest = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return run


def suffix_dedup(docs: DataFrame, id_: str = "doc_id", text: str = "text", length: int = 200, most_segments: int = 20_000) -> DataFrame:
    """One row (id, n_bytes, n_removed, n_spans, kept_sha256) for each row of docs.

    Null and empty texts have no bytes. Rows of equal texts, repeated rows too, repeat each other: from `length` bytes on
    they go whole. length is at least 40."""
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    rows = keyed(docs, id_, text)
    parts = parts_for(rows)
    classes = rows.groupBy("tk").agg(F.min("id").alias("id"), (F.count("*") > 1).alias("copies"))
    one = rows.join(classes.select("id", "tk").hint("shuffle_hash"), ["id", "tk"])  # one text of each class
    marks = found_in(one.select("tk", "text").mapInArrow(_anchors(length, parts), PACKED), parts, PLACES).join(classes, F.col("owner") == F.col("tk")).select("id", "tk", "pos")
    # Rows that repeat the least id of their class would give their items twice; items are made distinct by segment below.
    items = rows.join(marks.hint("shuffle_hash"), ["id", "tk"]).select("tk", "text", "pos").mapInArrow(_segments(length), ITEMS)
    items = cut(items, "suffix-items")
    segments = items.groupBy("hash", "sh").agg(*(F.first(c).alias(c) for c in ("segment", "n", "at")), F.min(F.struct("tk", "first")).alias("lo"), F.max(F.struct("tk", "last")).alias("hi"))
    segments = cut(segments.select("hash", "sh", "segment", "n", "at", ((F.col("lo.tk") != F.col("hi.tk")) | (F.col("lo.first") != F.col("hi.last"))).alias("twice")), "suffix-segments")
    # Of segments that occur twice all windows repeat, known without sorting.
    partial = _repeats(segments, length, most_segments).join(segments.where("not twice").select("hash", "sh"), ["hash", "sh"], "left_semi")
    found = partial.unionByName(segments.where("twice").select("hash", "sh", F.lit(0).alias("k"), "n", F.lit(None).cast("binary").alias("marks")))
    per_text = items.select("hash", "sh", "tk", "runs").join(found, ["hash", "sh"])
    per_text = per_text.groupBy("tk").agg(F.collect_list(F.struct("runs", "k", "n", "marks")).alias("found"))
    gone = classes.join(per_text, "tk", "left").where("copies OR found IS NOT NULL").select("tk", "found", "copies", F.col("id").alias("_id"))
    # Copies go whole or, if short, not at all, so only the one row of a class without copies needs what was found.
    keys = rows.select("id", "tk").join(gone.where("copies").select("tk"), "tk").select("id", "tk").distinct()
    info = keys.select("id", "tk", F.lit(None).cast("array<struct<runs:binary,k:int,n:int,marks:binary>>").alias("found"), F.lit(True).alias("copies")).unionByName(
        gone.where("not copies").select(F.col("_id").alias("id"), "tk", "found", "copies")
    )
    out = rows.join(info.hint("shuffle_hash"), ["id", "tk"], "left").select(F.when(~F.col("missing"), F.col("id")).alias("id"), "text", "found", F.coalesce("copies", F.lit(False)).alias("copies"))
    return out.mapInArrow(_remove(length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs).withColumnRenamed("id", "doc_id")
