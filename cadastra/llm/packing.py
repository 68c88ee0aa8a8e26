"""Best-fit packing of tokenised documents into sequences of a fixed length, by best-two-fit.

Pieces differ for packing in their lengths only, and there are at most `size` lengths. So three jobs do it: tasks tokenise texts and
write one short row a piece; how many pieces each length has, `size` numbers at most, goes to the driver, where `best_two_fit` plans
bins for counts (equal bins are planned once, with how often they come, so a plan doesn't grow with the corpus); then pieces are
numbered within their length, and a number tells the bin and the place in it. No task holds more than a batch of rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table

_GAP = re.compile(rb"[\t-\r ]")
_BITS = 46


class Encoder:
    """Token ids of words as packed little-endian 32-bit numbers. Words end at ASCII white space, where the tokenizer's pre-tokens
    end too, so their ids joined are the ids of the text. Words met lately are remembered, short ones only, in two generations of
    about `most`: when the younger is full it becomes the older, and words that are met again move up."""

    def __init__(self, json: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.known, self.older = Tokenizer.from_str(json), most, {}, {}
        mark = self._ids(" \0 ")
        self.mark = int(mark[0]) if len(mark) == 1 else None

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encode different words in one call, told apart by a mark between them; those that hold the mark, and all where its id
        isn't found once between any two, are encoded one by one."""
        plain = [w for w in words if b"\0" not in w] if self.mark is not None else []
        ids = self._ids(b" \0 ".join(plain).decode("utf-8", "replace")) if plain else np.zeros(0, "<u4")
        cuts = np.flatnonzero(ids == self.mark) if plain else ids
        found, packed = {}, ids.tobytes()
        if plain and len(cuts) == len(plain) - 1:
            found = {w: packed[a:b] for w, a, b in zip(plain, [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(packed)], strict=True)}
        return found | {w: self._ids(w.decode("utf-8", "replace")).tobytes() for w in words if w not in found}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.known) >= self.most:
            self.older, self.known = self.known, {}
        words = [t.split() for t in texts]
        ids = [list(map(self.known.get, w)) for w in words]
        fresh = {w for ws, ps in zip(words, ids, strict=True) if None in ps for w, p in zip(ws, ps, strict=True) if p is None}
        if fresh:
            again = {w: p for w in fresh if (p := self.older.get(w)) is not None}
            new = again | self._learn([w for w in fresh if w not in again])
            self.known.update((w, p) for w, p in new.items() if len(w) <= 64)
            ids = [[new[w] if p is None else p for w, p in zip(ws, ps, strict=True)] if None in ps else ps for ws, ps in zip(words, ids, strict=True)]
        return list(map(b"".join, ids))

    def parts(self, text: bytes, span: int = 1 << 20) -> Iterator[bytes]:
        """Packed ids of a text, some `span` bytes of it at a time."""
        at = 0
        while at < len(text):
            gap = _GAP.search(text, at + span) if at + span < len(text) else None
            end = gap.start() if gap else len(text)
            yield self.encode([text[at:end]])[0]
            at = end


@lru_cache(maxsize=2)
def _encoder(json: str) -> Encoder:
    return Encoder(json)


def pieces_of(parts: Iterable[bytes], size: int, end: int) -> Iterator[bytes]:
    """Packed ids of a document, closed by the id `end`, in pieces of `size` ids; the last may be shorter."""
    left, step = b"", 4 * size
    for part in parts:
        left += part
        whole = max(0, len(left) - 1) // step * step
        yield from (left[at : at + step] for at in range(0, whole, step))
        left = left[whole:]
    left += int(end).to_bytes(4, "little")
    yield from (left[at : at + step] for at in range(0, len(left), step))


def _grouped(texts: list[bytes], span: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about 1 MB together, or of a longer one."""
    at, held = 0, 0
    for k, text in enumerate(texts):
        if k > at and held + len(text) > span:
            yield at, k
            at, held = k, 0
        held += len(text)
    if texts:
        yield at, len(texts)


def token_pieces(docs: DataFrame, tokenizer: str, id_: str = "doc_id", text: str = "text", size: int = 4096, end: int = 1, ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32) for each piece of each row; with `ids` also their token ids.

    tokenizer is the path of a file of the tokenizers library; the driver reads it. It must not join words over ASCII white space.
    A null text is empty; an empty one is the closing id alone. Ids may be null or repeated. A word without white space is
    encoded as a whole, whatever its length; of other long texts tasks hold the bytes and some 1 MB in work."""
    json = docs.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(json.value)
        names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
        for batch in batches:
            texts = [x or b"" for x in batch.column("text").cast(pa.large_binary()).to_pylist()]
            id_values = batch.column("id").to_pylist()
            for first, last in _grouped(texts):
                group = [[x] for x in encoder.encode(texts[first:last])] if last - first > 1 else [encoder.parts(texts[first])]
                rows, held = [], 0
                for id_value, parts in zip(id_values[first:last], group, strict=True):
                    for piece, packed in enumerate(pieces_of(parts, size, end)):
                        rows.append((id_value, piece, piece * size, len(packed) // 4, zlib.crc32(packed), *[packed] * ids))
                        held += len(packed) if ids else 64
                        if held > 4 << 20:
                            yield _batch(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    fields = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, fields)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    arrays = [pa.array(c, pa.int32() if n == "piece" else pa.int64()) for n, c in zip(names[:5], cols, strict=False)]
    if len(names) > 5:
        offsets = np.concatenate([[0], np.cumsum(cols[3])]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(cols[5]), "<i4"))))
    return pa.RecordBatch.from_arrays(arrays, names=names)


Plan = list[tuple[list[tuple[int, int]], int]]


def best_two_fit(counts: np.ndarray, size: int, two: bool = True) -> Plan:
    """Bins of at most `size` for counts[l] pieces of length l, as (content, times), content as (length, copies) by falling length.

    Each bin is filled greedily, the largest piece that fits first. If room is left in a bin of several pieces, its smallest goes
    back if two other pieces fill the widened gap better, the pair of the largest sum. A bin is repeated as long as counts can't
    change any of its decisions, so the plan is that of packing piece by piece. Without `two` it's first-fit by falling length."""
    counts, out = counts.astype(np.int64).copy(), []
    lengths = np.flatnonzero(counts)
    while True:
        lengths = lengths[counts[lengths] > 0]
        if not len(lengths):
            return out
        held: dict[int, int] = {}
        gap, upto = size, len(lengths)
        while upto:
            upto = int(np.searchsorted(lengths[:upto], gap, "right"))
            if not upto:
                break
            upto -= 1
            length = int(lengths[upto])
            held[length] = int(min(counts[length], gap // length))
            gap -= length * held[length]
        used = dict(held)
        smallest = min(held)
        if two and gap and sum(held.values()) > 1 and (pair := _pair(counts, lengths, held, gap + smallest, smallest)):
            held[smallest] -= 1
            for length in pair:
                held[length] = held.get(length, 0) + 1
        held = {length: n for length, n in held.items() if n}
        times = max(1, 1 + min((int(counts[length]) - used.get(length, 0) - n - 2) // n for length, n in held.items()))
        for length, n in held.items():
            counts[length] -= n * times
        out.append((sorted(held.items(), reverse=True), times))


def _pair(counts: np.ndarray, lengths: np.ndarray, held: dict[int, int], gap: int, more_than: int) -> tuple[int, int] | None:
    """Two pieces that aren't in the bin, of the largest sum up to gap, if above more_than; of equal sums that with the largest piece."""
    a = lengths[: np.searchsorted(lengths, gap)]
    left = counts[a].copy()
    for length, n in held.items():
        at = np.searchsorted(a, length)
        if at < len(a) and a[at] == length:
            left[at] -= n
    a, left = a[left > 0], left[left > 0]
    if not len(a):
        return None
    b = np.searchsorted(a, np.minimum(gap - a, a), "right") - 1
    b -= (b == np.arange(len(a))) & (left < 2)
    sums = np.where(b >= 0, a + a[b], 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(a[best]), int(a[b[best]])) if sums[best] > more_than else None


def plan_bins(counts: np.ndarray, size: int) -> Plan:
    """Best-two-fit, or first-fit by falling length where that needs fewer bins (together they have the better bound)."""
    plans = [best_two_fit(counts, size), best_two_fit(counts, size, two=False)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def places(plan: Plan) -> dict[str, np.ndarray]:
    """Runs of numbers within a length that lie alike: by key (length and first number), copies a bin, first bin, offset in it."""
    rows, first, seen = [], 0, {}
    for content, times in plan:
        offset = 0
        for length, n in content:
            base = seen.get(length, 0)
            rows.append(((length << _BITS) + base, n, first, offset))
            seen[length] = base + n * times
            offset += n * length
        first += times
    cols = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    return dict(zip(("key", "copies", "first", "offset"), cols, strict=True))


def pack(pieces: DataFrame, size: int = 4096, bucket_rows: int = 20_000) -> DataFrame:
    """pieces(id, piece, start, length, ids_crc32, ...) with sequence_id and offset: where each lies in sequences of at most `size`.

    Sequences have no gaps. Equal pieces are told apart by nothing but their number, so ids may be null or repeated. No rows, no
    result. pieces must be a written table, since it is read twice. Columns named bucket, before, number are taken."""
    total, lengths = pieces.agg(F.count("*"), F.max("length")).first()
    if not total:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if lengths > size:
        raise ValueError(f"a piece of {lengths} is longer than {size}")
    bucket = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(-(-total // bucket_rows)))
    dealt = pieces.withColumn("bucket", bucket)
    held = cut(dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")), "packing-counts")
    counts = np.zeros(size + 1, np.int64)
    for length, n in held.groupBy("length").agg(F.sum("n")).collect():  # at most `size` rows
        counts[length] = n
    plan = pieces.sparkSession.sparkContext.broadcast(places(plan_bins(counts, size)))
    before = F.sum("n").over(W.partitionBy("length").orderBy("bucket")) - F.col("n")
    starts = held.select("length", "bucket", before.alias("before"))
    number = F.row_number().over(W.partitionBy("length", "bucket").orderBy("id", "piece", "start", "ids_crc32"))
    numbered = dealt.withColumn("number", number.cast("long") - 1).join(starts, ["length", "bucket"])
    names = pieces.columns
    numbered = numbered.select(*names, (F.col("number") + F.col("before")).alias("number"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(p["key"], (length << _BITS) + number, "right") - 1
            bin_, copy = np.divmod(number - (p["key"][at] & ((1 << _BITS) - 1)), p["copies"][at])
            found = [pa.array(p["first"][at] + bin_), pa.array(p["offset"][at] + copy * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *found], names=[*names, "sequence_id", "offset"])

    schema = pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return numbered.mapInArrow(put, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, parts) for pieces with token ids: whole sequences to train on, and the (id, piece, offset) of each part."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "id", "piece", "ids")))
    gathered = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return gathered.select("sequence_id", "length", F.flatten("parts.ids").alias("ids"), F.transform("parts", lambda x: x.dropFields("ids")).alias("parts"))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 4096, ids: bool = False, **rule) -> DataFrame:
    """Tokenise docs and pack all of them; other columns of docs aren't carried along."""
    return pack(cut(token_pieces(docs, tokenizer, size=size, ids=ids, **rule), "packing-pieces"), size)


def op11_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, tokenizer).withColumnRenamed("id", "doc_id")
