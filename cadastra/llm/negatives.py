"""Hard-negative mining by LEMP-style coordinate pruning.

Rows lie in blocks of one label (or a few small ones) and like length, the norm; anchors, the queries, lie in such chunks too. Pairs of
chunk and block are formed from their ids, and only where labels fit and the block's longest row can reach a score that counts; a task
holds one block and a few chunks at a time. In a block each coordinate has a list of rows sorted by their direction there. The score
that an anchor needs gives the least cosine, hence for each of its focus coordinates, its largest, a range in which a row's direction
must lie; the rows in the intersection of these ranges are verified by exact integer products. Where the ranges leave most of a block,
as they do at cosines far below 0.7, all of it is verified in one product.

It is searched thrice: for a first bound among the longest block of the anchor's label, for the nearest rows of the same label
(positives), and for rows of other labels whose scores lie in the windows that positives open. Each search keeps the best few of
each anchor, window and block, so what tasks give doesn't grow with groups of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table
from .whitening import _matrix, finite_vectors, fixed_point

_SLACK = 1e-9
_LEAST, _MOST = -(1 << 62), (1 << 62) - 1
_FIELDS = "part int, number int, rows int, dims int, longest double, first int, last int, least long, id binary, known binary, row binary, label binary, q binary, low binary, high binary"
_TYPES = {"part": pa.int32(), "number": pa.int32(), "rows": pa.int32(), "dims": pa.int32(), "longest": pa.float64(), "first": pa.int32(), "last": pa.int32(), "least": pa.int64()}


class Block:
    """Rows (id, row, label, q, windows) with sorted coordinate lists of their directions, made when they are first asked for."""

    def __init__(self, id_: np.ndarray, known: np.ndarray, row: np.ndarray, label: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.id, self.known, self.row, self.label, self.q, self.low, self.high = id_, known, row, label, q, low, high
        self.largest = int(np.abs(q).max()) if q.size else 0
        self.length = np.sqrt((q.astype(float) ** 2).sum(1))
        self.longest = float(self.length.max())
        self._lists: tuple[np.ndarray, np.ndarray] | None = None

    def row_of_table(self, part: int, number: int) -> dict:
        open_ = self.low[self.low <= self.high]
        small = np.int16 if self.largest < 1 << 15 else np.int64
        plain = {"id": self.id, "known": self.known, "row": self.row, "label": self.label, "q": self.q.astype(small), "low": self.low, "high": self.high}
        about = {"part": part, "number": number, "rows": len(self.id), "dims": self.q.shape[1], "longest": self.longest, "first": int(self.label.min()), "last": int(self.label.max())}
        return about | {"least": int(open_.min()) if open_.size else None} | {c: v.tobytes() for c, v in plain.items()}

    @classmethod
    def of_table(cls, r: dict) -> Block:
        n = r["rows"]
        ints = {c: np.frombuffer(r[c], np.int64) for c in ("id", "row", "low", "high")}
        small = np.int16 if len(r["q"]) < 8 * n * r["dims"] else np.int64
        q = np.frombuffer(r["q"], small).reshape(n, r["dims"]).astype(np.int64)
        return cls(ints["id"], np.frombuffer(r["known"], bool), ints["row"], np.frombuffer(r["label"], np.int32), q, ints["low"].reshape(n, -1), ints["high"].reshape(n, -1))

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate, rows in the order of their direction there, and these rising values."""
        if self._lists is None:
            direction = self.q / np.where(self.length > 0, self.length, 1.0)[:, None]
            order = np.argsort(direction, axis=0, kind="stable")
            self._lists = order.T.copy(), np.take_along_axis(direction, order, 0).T.copy()
        return self._lists

    def within(self, anchor: np.ndarray, length: float, least: int, focus: int) -> np.ndarray | None:
        """Rows whose score with the anchor may reach `least`, by the ranges of its focus coordinates; None if those leave more
        than half of the block. No score above 0 is reached by rows, or an anchor, of length 0."""
        if least <= 0:
            return None
        cosine = least / (length * self.longest) if length * self.longest > 0 else np.inf
        if cosine > 1 + _SLACK:
            return np.zeros(0, np.int64)
        unit = anchor[: self.q.shape[1]] / length
        focused = np.argsort(-np.abs(unit), kind="stable")[:focus]
        angle, reach = np.arccos(np.clip(unit[focused], -1, 1)), np.arccos(min(1.0, cosine))
        low, high = np.cos(np.minimum(np.pi, angle + reach)) - _SLACK, np.cos(np.maximum(0.0, angle - reach)) + _SLACK
        order, values = self.lists()
        ends = [(c, int(np.searchsorted(values[c], a)), int(np.searchsorted(values[c], b, "right"))) for c, a, b in zip(focused.tolist(), low, high, strict=True)]
        ends.sort(key=lambda r: r[2] - r[1])
        if ends[0][2] - ends[0][1] > 0.9 * len(self.id):
            return None
        found = order[ends[0][0]][ends[0][1] : ends[0][2]]
        inside = np.zeros(len(self.id), bool)
        for c, a, b in ends[1:]:
            inside[:] = False
            inside[order[c][a:b]] = True
            found = found[inside[found]]
        return found if 2 * len(found) <= len(self.id) else None


def _packing(most_rows: int, most_bytes: int):
    """Pack sorted rows into blocks of at most most_rows, and of about most_bytes of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        rows = dims = 0

        def close() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            ids = t.column("id")
            columns = [ids.fill_null(0).to_numpy(), ~ids.is_null().to_numpy(), t.column("row").to_numpy(), t.column("label").to_numpy()]
            vectors = [np.vstack([_matrix(b, c, d) for b in held]).astype(np.int64) for c, d in (("q", dims), ("low", windows), ("high", windows))]
            r = Block(*columns, *vectors).row_of_table(part, number)
            return pa.RecordBatch.from_arrays([pa.array([v], _TYPES.get(c, pa.binary())) for c, v in r.items()], names=list(r))

        for batch in batches:
            sizes = np.asarray(batch.column("q").value_lengths())
            windows = int(np.asarray(batch.column("low").value_lengths()).max()) if batch.num_rows else 0
            at = 0
            while at < batch.num_rows:
                wide = max(dims, int(sizes[at : at + most_rows].max()))
                room = max(1, min(most_rows, most_bytes // (8 * max(wide, 1)))) - rows
                if room <= 0:
                    yield close()
                    held, rows, dims, number = [], 0, 0, number + 1
                    continue
                held.append(batch.slice(at, room))
                rows, dims, at = rows + held[-1].num_rows, wide, at + held[-1].num_rows
        if rows:
            yield close()

    return run


def blocks(rows: DataFrame, most_rows: int, most_bytes: int = 4 << 20) -> DataFrame:
    """Blocks of rows(id, row, label, q, low, high), sorted by label and falling length. Ranges of both are cut by Spark from a sample
    of the data, so a label with a third of all rows lies in many of them. rows must be a written table."""
    length = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    parts = -(-rows.count() // (4 * most_rows))
    order = ["label", F.desc("length"), "row"]
    spread = rows.withColumn("length", length).repartitionByRange(max(parts, 1), *order).sortWithinPartitions(*order)
    return cut(spread.select("id", "row", "label", "q", "low", "high").mapInArrow(_packing(most_rows, most_bytes), _FIELDS), "negatives-blocks")


def _scores(block: Block, rows: np.ndarray | slice, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products, anchors x rows; missing entries are zeros."""
    dims = min(block.q.shape[1], anchors.shape[1])
    q, anchors = block.q[rows, :dims], anchors[:, :dims]
    bound = block.largest * int(np.abs(anchors).max() if anchors.size else 0) * max(dims, 1)
    if bound < 1 << 53:
        return (anchors.astype(float) @ q.T.astype(float)).astype(np.int64)
    if bound < 1 << 62:
        return anchors @ q.T
    wide = anchors.astype(object) @ q.T.astype(object)
    if any(abs(v) >= _MOST for v in wide.ravel()):
        raise OverflowError("a score is too large for a long")
    return wide.astype(np.int64)


def _best(block: Block, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores, then smaller ids, null last, then rows."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = at[scores >= np.partition(scores, len(scores) - k)[len(scores) - k]]
    r = rows[at]
    return at[np.lexsort((block.row[r], block.id[r], ~block.known[r], -scores[at]))[:k]]


def meet(block: Block, chunk: Block, k: int, focus: int, same: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """The k best rows of a block, of the same label as the anchor or of others, for each anchor of a chunk and each of its windows:
    (anchor's row, window, places in the block, scores)."""
    open_ = chunk.low <= chunk.high
    least = np.where(open_, chunk.low, _MOST).min(1)

    def kept(a: int, rows: np.ndarray, scores: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        fits = (block.label[rows] == chunk.label[a]) == same
        fits &= (scores >= least[a]) & (block.row[rows] != chunk.row[a])
        rows, scores = rows[fits], scores[fits]
        for w in np.flatnonzero(open_[a]):
            inside = np.flatnonzero((scores >= chunk.low[a, w]) & (scores <= chunk.high[a, w]))
            if len(inside):
                best = inside[_best(block, rows[inside], scores[inside], k)]
                yield np.full(len(best), chunk.row[a]), np.full(len(best), w), rows[best], scores[best]

    whole = []
    for a in np.flatnonzero(open_.any(1)):
        rows = block.within(chunk.q[a], chunk.length[a], int(least[a]), focus)
        if rows is None:
            whole.append(a)
        elif len(rows):
            yield from kept(a, rows, _scores(block, rows, chunk.q[a : a + 1])[0])
    every = np.arange(len(block.id))
    for at in range(0, len(whole), 128):
        some = whole[at : at + 128]
        for a, scores in zip(some, _scores(block, slice(None), chunk.q[some]), strict=True):
            yield from kept(a, every, scores)


def _pairs(chunks: DataFrame, held: DataFrame, same: bool) -> DataFrame:
    """(c_part, c_number, part, number): every chunk of the query set meets every block whose labels fit and whose longest row can
    reach a window of it. Only ids and bounds meet here, part by part; there are far fewer blocks than rows."""
    parts = (held.agg(F.max("part")).first()[0] or 0) + 1
    about = ["part", "number", "first", "last", "longest"]
    c = chunks.where("least is not null").select(*(F.col(x).alias(f"c_{x}") for x in about), "least", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    labels = F.expr("first <= c_last and c_first <= last" if same else "not (first = last and c_first = c_last and first = c_first)")
    reach = F.expr(f"least <= 0 or least <= c_longest * longest * (1 + {_SLACK})")
    return c.join(held.select(*about), "part").where(labels & reach).select("c_part", "c_number", "part", "number")


def search(pairs: DataFrame, chunks: DataFrame, held: DataFrame, k: int, focus: int, same: bool, group: int = 16) -> DataFrame:
    """(anchor_row, w, row, id, score): the k best rows of all paired blocks for each anchor and window, with rank from 1."""
    deal = F.floor((F.row_number().over(W.partitionBy("part", "number").orderBy("c_part", "c_number")) - 1) / group)
    dealt = cut(pairs.withColumn("deal", deal), "negatives-pairs")
    payload = ["rows", "dims", "id", "known", "row", "label", "q", "low", "high"]
    left = dealt.join(chunks.select(F.col("part").alias("c_part"), F.col("number").alias("c_number"), *payload), ["c_part", "c_number"])
    right = dealt.select("part", "number", "deal").distinct().join(held.select("part", "number", *payload), ["part", "number"])

    def run(key: tuple, some: pa.Table, one: pa.Table) -> pa.Table:
        block, out = Block.of_table(one.to_pylist()[0]), []
        for at in range(some.num_rows):
            out.extend(meet(block, Block.of_table(some.slice(at, 1).to_pylist()[0]), k, focus, same))
        anchor, w, rows, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else np.zeros((4, 0), np.int64)
        ids = pa.array(block.id[rows], mask=~block.known[rows])
        return pa.table([pa.array(anchor), pa.array(w), pa.array(block.row[rows]), ids, pa.array(score)], names=["anchor_row", "w", "row", "id", "score"])

    keys = ["part", "number", "deal"]
    right = right.withColumnsRenamed({c: f"b_{c}" for c in keys})
    found = left.groupBy(*keys).cogroup(right.groupBy(*(f"b_{c}" for c in keys))).applyInArrow(run, "anchor_row long, w long, row long, id long, score long")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window; each block gave k at most."""
    order = W.partitionBy("anchor_row", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: F.Column, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100), focus: int = 6, block_rows: int = 4096, chunk_rows: int = 1024) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows(id, label int, q array<long>).

    Positives are an anchor's first `positives` other rows of its label by score, the inner product; its negatives for a positive
    the first `negatives` rows of other labels whose score is at most the positive's and low[0] / low[1] of it or more. Equal
    scores go by smaller id, null last. A positive of negative score has no negatives. Rows with a null label or vector take no
    part; repeated rows are rows of their own; short vectors are filled up with zeros. No anchors, no result."""
    never = {"low": F.array().cast("array<long>"), "high": F.array().cast("array<long>")}
    known = rows.where("label is not null and q is not null").select("id", F.monotonically_increasing_id().alias("row"), F.col("label").cast("int").alias("label"), "q", is_anchor.alias("anchor"))
    known = cut(known, "negatives-rows")
    anchors = known.where("anchor").drop("anchor")
    held = blocks(known.drop("anchor").withColumns(never), block_rows)

    def chunks(windows: DataFrame, n: int) -> DataFrame:
        """Anchors with n windows each, from windows(row, w, low, high)."""
        each = windows.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(F.col("w").cast("int"), F.struct("low", "high")))).alias("open"))  # n at most
        bound = lambda c, shut: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at("open", i)[c], F.lit(shut).cast("long")))
        ready = anchors.join(each, "row").select("id", "row", "label", "q", bound("low", 1).alias("low"), bound("high", 0).alias("high"))
        return blocks(cut(ready, "negatives-anchors"), chunk_rows)

    open_ = anchors.select("row", F.lit(0).alias("w"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"))
    wide = chunks(open_, 1)
    # A first bound: the best rows of the label's longest block, or of two where a chunk holds two labels.
    longest = held.groupBy("first").agg(F.max_by(F.struct("part", "number"), F.struct("longest", "part", "number")).alias("b")).select("b.part", "b.number")
    pairs = _pairs(wide, held, same=True)
    seeds = cut(search(pairs.join(longest, ["part", "number"], "left_semi"), wide, held, positives, focus, same=True), "negatives-seeds")
    bounds = seeds.groupBy("anchor_row").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    bounds = open_.join(bounds, F.col("row") == F.col("anchor_row"), "left").select("row", "w", F.when(F.col("n") >= positives, F.col("score")).otherwise(F.lit(_LEAST)).alias("low"), "high")
    bounded = chunks(bounds, 1)
    more = search(_pairs(bounded, held, same=True).join(longest, ["part", "number"], "left_anti"), bounded, held, positives, focus, same=True)
    nearest = cut(ranked(seeds.drop("rank").unionByName(more.drop("rank")), positives).withColumnRenamed("rank", "place"), "negatives-positives")
    a, b = low
    least = F.expr(f"(score div {b}) * {a} + ((score % {b}) * {a} + {b - 1}) div {b}")  # rounded up, without overflow
    windows = nearest.where("score >= 0").select(F.col("anchor_row").alias("row"), (F.col("place") - 1).alias("w"), least.alias("low"), F.col("score").alias("high"))
    asked = chunks(windows, positives)
    found = search(_pairs(asked, held, same=False), asked, held, negatives, focus, same=False)
    opened = nearest.select("anchor_row", (F.col("place") - 1).cast("long").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("id").alias("anchor_id"), F.col("row").alias("anchor_row"))
    out = found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(opened, ["anchor_row", "w"]).join(named, "anchor_row")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").where("label is not null"), "embedding")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives(rows.select(F.col("vec_id").alias("id"), label.alias("label"), fixed_point("embedding", 256.0, 0).alias("q")), F.coalesce(F.col("id") % 100 == 0, F.lit(False)))


OP12_SQL = """
with finite as (
    select vec_id, label, list_transform(embedding, lambda c : c::double) as v from embeddings where label is not null and embedding is not null
), kept as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(v, lambda c : floor(256 * c)) as q
    from finite where len(list_filter(v, lambda c : c is null or not isfinite(c))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, cast(list_inner_product(a.q, r.q) as bigint) as score
    from kept a join kept r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), positives as (
    select anchor_id, id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as int) as rank,
    id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""
