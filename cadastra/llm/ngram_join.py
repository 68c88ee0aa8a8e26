"""N-gram Jaccard join by T-occurrence search, DivideSkip style.

Two sets link when 100 * |A & B| >= 75 * |A | B|. A partner of a set of n shingles shares at least T = ceil(0.75 n) of them,
so it occurs in at least T of the set's n inverted lists. With the L longest lists set aside, it must still occur T - L times
in the short ones: these are merged and counted, only what reaches T - L is looked up in the long lists by binary search, and
what reaches the overlap that a link needs is retained.

1. One scan: the set's size and signature (equal sets are one class from here on), a histogram of the set over hash bins, and
   a fixed-size sketch of document frequencies, which orders the lists of a corpus from short to long.
2. Second scan: postings of the short lists, dealt by token; a list that the sketch knows to be long is dealt over several
   parts. Here L = T - 1, so that one common short list brings two sets together.
3. Every list names three leaders (its two sets of the most common shingles, which of near copies are the least edited, and
   its rarest). Leaders are queries, members their candidates.
4. Queries and candidates meet in blocks of bounded size. A block builds its inverted lists and answers each query with the
   T-occurrence search, where L = T / (MU log2(longest list) + 1), as the authors of DivideSkip advise. Components follow.
5. Only lists that still hold several components are searched further: sets outside a list's largest component are the queries,
   the list's sets of possible sizes their candidates, thinned by the position bound (what two sets can still share from their
   first common shingle on) and by the histograms' bound on the overlap, both exact; then as in 4.

A large group of near copies thus costs its size, not its square, and no link between different components is missed. Shingles
and sets are equal if their 64-bit hashes are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators.graph import connected_components

from .common import LOWER, Words, cut, mix, signed, slices, table, window_hashes

SHINGLE = 5
SKETCH_BITS = 20
SKETCH_PARTS = 64
POSTINGS_PER_PART = 1_000_000
LIST_LIMIT = 200_000
BLOCK_SHINGLES = 400_000
INDEX_SHINGLES = 1_000_000
MU = 0.0085
_SUM = np.uint64(0x9E3779B97F4A7C15)


def least_overlap(n):
    """T: the least overlap of a set of n with a partner."""
    return -(-3 * n // 4)


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer than SHINGLE words has one, of all its words."""
    w = Words(LOWER[data], offs)
    h = w.hashes()
    s = window_hashes(h, SHINGLE)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(s[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(window_hashes(h[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Lists:
    """Inverted lists of a block of sets: for each shingle the numbers of the sets that hold it, in order."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(token, kind="stable")
        token, self.member = token[order], np.repeat(np.arange(len(sets)), self.size)[order]
        first = np.ones(len(token), bool)
        first[1:] = token[1:] != token[:-1]
        self.start = np.append(np.flatnonzero(first), len(token))
        self.token = token[self.start[:-1]]
        self.key = (np.cumsum(first) - 1) * len(sets) + self.member  # list and member, for probes

    def partners(self, query: np.ndarray) -> np.ndarray:
        """Numbers of the sets that link with the query, whose shingles all have lists here (it is one of the sets)."""
        n, need = len(query), least_overlap(len(query))
        lists = np.searchsorted(self.token, query)
        length = self.start[lists + 1] - self.start[lists]
        skip = min(need - 1, int(need / (MU * math.log2(max(2, length.max())) + 1)))
        lists = lists[np.argsort(length, kind="stable")]
        short, long_ = lists[: n - skip], lists[n - skip :]
        begin, length = self.start[short], self.start[short + 1] - self.start[short]
        at = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(length.sum())
        merged = np.sort(self.member[at], kind="stable")  # lists are runs in order: the sort merges them
        first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, count = merged[first], np.diff(np.append(first, len(merged)))
        keep = (count >= need - skip) & (self.size[found] >= need) & (4 * n >= 3 * self.size[found])
        found, count = found[keep], count[keep]
        step = max(1, 2_000_000 // max(1, skip))
        for a in range(0, len(found) if skip else 0, step):
            wanted = (long_[:, None] * len(self.size) + found[a : a + step]).ravel()
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            count[a : a + step] += (self.key[at] == wanted).reshape(skip, -1).sum(0)
        return found[175 * count >= 75 * (n + self.size[found])]


def histogram(s: np.ndarray) -> np.ndarray:
    """Set sizes by hash bin; the number of bins is the power of two below half the size, from 1 to 4096."""
    bits = min(12, max(0, int(len(s) // 2).bit_length() - 1))
    return np.minimum(np.bincount((s >> np.uint64(64 - bits) if bits else s * np.uint64(0)).astype(np.int64), minlength=1 << bits), 65535).astype(np.uint16)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the overlap of two sets, from their histograms folded to the fewer bins."""
    if len(a) > len(b):
        a, b = b, a
    b = b.reshape(len(a), -1).sum(1)  # wider than 16 bits
    return int(np.minimum(a, b).sum(dtype=np.int64))


def _signature(s: np.ndarray) -> np.uint64:
    return mix(s * _SUM + np.uint64(1)).sum(dtype=np.uint64) ^ np.uint64(len(s))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "rk", "n", "sig", "bins", "part", "counts"]
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        for part, data, offs in slices(batch, "text"):
            sets = shingle_sets(data, offs)
            tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            np.add(counts, np.bincount((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS), out=counts, casting="unsafe")
            n = len(sets)
            sig = signed(mix(np.array([_signature(s) for s in sets], np.uint64)))
            bins = pa.array([histogram(s).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("rk"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig), bins, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names
            )
    packed = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SKETCH_PARTS)]
    none = [pa.nulls(SKETCH_PARTS, pa.int64())] * 4 + [pa.nulls(SKETCH_PARTS, pa.binary())]
    yield pa.RecordBatch.from_arrays([*none, pa.array(range(SKETCH_PARTS), pa.int32()), pa.array(packed, pa.binary())], names=names)


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for p, c in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64)
            sums[p] = sums[p] + x if p in sums else x
    out = [(p, zlib.compress(np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes(), 1)) for p, x in sums.items()]
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([c for _, c in out], pa.binary())], names=["part", "counts"])


def frequency_steps(described: DataFrame) -> np.ndarray:
    """The sketch: for each hash bin, the number of shingles in steps of a twelfth octave. 2 MB, whatever the input."""
    rows = described.where("part IS NOT NULL").select("part", "counts").repartition("part").mapInArrow(_add_counts, "part int, counts binary").collect()
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.float64)
    for r in rows:
        counts[r["part"]] += np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return np.floor(12 * np.log2(counts.ravel() + 1)).astype(np.uint16)


def _shares(token: np.ndarray, limit: int) -> np.ndarray:
    """Over how many parts a list is dealt, by the frequency that its token begins with."""
    return np.ceil(np.exp2((token >> np.uint64(48)).astype(np.float64) / 12) / limit).astype(np.uint64)


def _postings(steps, parts: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = steps.value
        for batch in batches:
            for _, data, offs in slices(batch, "text"):
                token, owner, size, rest, common = [], [], [], [], []
                for s in shingle_sets(data, offs):
                    n = len(s)
                    if not n:
                        continue
                    keep = n - least_overlap(n) + 1
                    steps_of = step[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    ordered = (steps_of.astype(np.uint64) << np.uint64(48)) | (s & np.uint64((1 << 48) - 1))
                    token.append(np.sort(np.partition(ordered, keep - 1)[:keep]))
                    rest.append(np.arange(n, n - keep, -1, np.int32))
                    owner.append(np.full(keep, _signature(s), np.uint64))
                    size.append(np.full(keep, n, np.int32))
                    common.append(np.full(keep, int(16 * steps_of.mean()), np.uint16))
                if not token:
                    continue
                token, owner, size, rest, common = np.concatenate(token), mix(np.concatenate(owner)), np.concatenate(size), np.concatenate(rest), np.concatenate(common)
                part = (mix(token + (owner % _shares(token, limit)) * _SUM) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((owner, token, part))
                token, owner, size, rest, common, part = token[order], owner[order], size[order], rest[order], common[order], part[order]
                new = np.ones(len(token), bool)  # copies within a run give one posting
                new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
                token, owner, size, rest, common, part = token[new], owner[new], size[new], rest[new], common[new], part[new]
                at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                ends = np.append(at[1:], len(part))
                pack = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(part[at].astype(np.int32)), pack(token), pack(signed(owner)), pack(size), pack(rest), pack(common)], names=["p", "token", "sig", "n", "rest", "common"])

    return run


LISTS = "list long, sub int, token long, sigs array<long>, sizes array<int>, rests array<int>"


def _merge(limit: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The lists of one part, the most common set last. Lists with the same members once, by their first token; of a list
        that is dealt over parts (sub: the part, else -1) the share that is here, though it be one set."""
        column = lambda c, t: np.frombuffer(b"".join(pdf[c]), t)
        token, sig, size, rest, common = column("token", np.uint64), column("sig", np.int64), column("n", np.int32), column("rest", np.int32), column("common", np.uint16)
        dealt = _shares(token, limit) > 1
        order = np.argsort(token, kind="stable")
        again = token[order][1:] == token[order][:-1]
        order = order[np.concatenate([again, [False]]) | np.concatenate([[False], again]) | dealt[order]] if len(order) else order
        order = order[np.lexsort((sig[order], common[order], token[order]))]
        token, sig, size, rest, dealt = token[order], sig[order], size[order], rest[order], dealt[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])
        token, sig, size, rest, dealt = token[new], sig[new], size[new], rest[new], dealt[new]
        at = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        ends = np.append(at[1:], len(token)) if len(at) else at
        sums = np.add.reduceat(mix(sig.view(np.uint64).copy()), at) if len(at) else at
        seen, out, here = set(), [], int(pdf["p"].iloc[0])
        for a, b, s in zip(at.tolist(), ends.tolist(), sums.tolist(), strict=True):
            if dealt[a]:
                out.append((int(signed(mix(token[a : a + 1].copy()))[0]), here, signed(token[a : a + 1])[0], sig[a:b].tolist(), size[a:b].tolist(), rest[a:b].tolist()))
            elif b - a > 1 and s not in seen:
                seen.add(s)
                out.append((np.uint64(s).astype(np.int64), -1, signed(token[a : a + 1])[0], sig[a:b].tolist(), size[a:b].tolist(), rest[a:b].tolist()))
        return pd.DataFrame(out, columns=["list", "sub", "token", "sigs", "sizes", "rests"])

    return run


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (q, block, sig, text) in order of q and block: a query (sig = q) and its candidates. Whole blocks are gathered to
    about INDEX_SHINGLES, indexed together, and each query is answered from all sets there."""
    queries: list[int] = []
    sets: dict[int, np.ndarray] = {}
    held, last = 0, None

    def answer() -> pa.RecordBatch:
        names = np.fromiter(sets, np.int64, len(sets))
        lists = Lists(list(sets.values()))
        u, v = [], []
        for q in dict.fromkeys(queries):
            found = names[lists.partners(sets[q])]
            v.append(found[found != q])
            u.append(np.full(len(v[-1]), q))
        join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([join(u), join(v)], names=["u", "v"])

    for batch in batches:
        for part, data, offs in slices(batch, "text"):
            keys = zip(*(part.column(c).to_pylist() for c in ("q", "block", "sig")), strict=True)
            for (q, block, sig), s in zip(keys, shingle_sets(data, offs), strict=True):
                if (q, block) != last and held > INDEX_SHINGLES:
                    yield answer()
                    queries, sets, held = [], {}, 0
                last = (q, block)
                if sig not in sets:
                    sets[sig] = s
                    held += len(s)
                if sig == q:
                    queries.append(q)
    yield answer()


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose histograms allow the overlap that a link needs."""
    for batch in batches:
        ok = []
        for na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_q", "n_d", "bins_q", "bins_d")), strict=True):
            ok.append(overlap_bound(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)) * 175 >= 75 * (na + nb))
        yield batch.select(["q", "d"]).filter(pa.array(ok, pa.bool_()))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair (q, d) once, whichever of the two asks."""
    return pairs.groupBy(F.least("q", "d").alias("a"), F.greatest("q", "d").alias("b")).agg(F.max("q").alias("q")).select("q", F.when(F.col("q") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("d"))


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (u, v) of classes: each query's links among the candidates that pairs (q, d) give it, and among what else its
    block holds. A query of many candidates is asked in several blocks; a class is read from one of its texts."""
    sized = pairs.join(classes.select(F.col("sig").alias("d"), "n"), "d")
    blocks = sized.groupBy("q").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    dealt = sized.join(blocks, "q").select("q", F.pmod(F.xxhash64("d"), "blocks").alias("block"), "d")
    asked = dealt.select("q", "block", F.explode(F.array("q", "d")).alias("sig")).distinct()
    texts = docs.select("rk", "text").dropDuplicates(["rk"])
    rows = asked.join(classes.select("sig", "rk"), "sig").join(texts, "rk").select("q", "block", "sig", "text")
    rows = rows.repartition("q", "block").sortWithinPartitions("q", "block")
    return cut(rows.mapInArrow(_search, "u long, v long").distinct(), "ngram-links")


def ngram_components(docs: DataFrame, id_: str = "doc_id", text: str = "text", list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row (id, n_shingles, component_id) for each row of docs; other columns are not read.

    component_id is the least id that is reachable by links, the own included; rows without an id link like others, but lend
    no id (null if no row of a component has one). Null and empty texts, and texts of separators only, have no shingles and
    link with nothing; repeated rows link with each other; no rows, no result. Lists of more than list_limit sets are dealt
    over several parts."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_).cast("long").alias("id"), F.xxhash64(F.col(id_).cast("long"), F.col(text)).alias("rk"), F.col(text).alias("text"))
    described = cut(docs.mapInArrow(_describe, "id long, rk long, n long, sig long, bins binary, part int, counts binary"), "ngram-sets")
    steps = spark.sparkContext.broadcast(frequency_steps(described))
    sets = described.where("part IS NULL")
    postings = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * 0.75) + 1)).first()[0] or 0
    parts = max(4 * spark.sparkContext.defaultParallelism, int(postings // POSTINGS_PER_PART) + 1)
    lists = docs.mapInArrow(_postings(steps, parts, list_limit), "p int, token binary, sig binary, n binary, rest binary, common binary")
    lists = lists.groupBy("p").applyInPandas(_merge(list_limit), LISTS)
    # Tokens are unsigned: flipping the sign bit puts them in order. The first token of equal lists has the widest bound.
    first_token = F.col("token").bitwiseXOR(F.lit(-(1 << 63)))
    lists = lists.groupBy("list", "sub").agg(F.min_by(F.struct("sigs", "sizes", "rests"), first_token).alias("l")).select("list", "sub", "l.*")
    lists = cut(lists, "ngram-lists")

    classes = sets.where("n > 0").groupBy("sig").agg(F.min("id").alias("id"), F.min("rk").alias("rk"), F.min("n").alias("n"))
    members = F.arrays_zip("sigs", "sizes", "rests")
    at = lambda k: F.struct(F.element_at("sizes", k).alias("n"), F.element_at("rests", k).alias("rest"), F.element_at("sigs", k).alias("sig"))
    leaders = F.array_distinct(F.array(at(-1), F.when(F.size("sigs") > 1, at(-2)).otherwise(at(-1)), at(1)))
    star = lists.select(F.explode(leaders).alias("l"), members.alias("m")).select("l", F.explode("m").alias("m"))
    star = star.select("l.*", F.col("m.sigs").alias("d"), F.col("m.sizes").alias("n_d"), F.col("m.rests").alias("rest_d"))
    # The shares of a dealt list meet through their leaders.
    heads = lists.where("sub >= 0").select("list", F.explode(leaders).alias("l")).select("list", "l.*")
    chief = heads.groupBy("list").agg(F.max(F.struct("n", "rest", "sig")).alias("c"))
    star = star.unionByName(chief.join(heads, "list").select("c.*", F.col("sig").alias("d"), F.col("n").alias("n_d"), F.col("rest").alias("rest_d")))
    star = star.where("sig != d AND 175L * least(rest, rest_d) >= 75L * (n + n_d)")
    star = _once(star.select(F.col("sig").alias("q"), "d"))
    first = _links(cut(star, "ngram-star"), classes, docs)
    near = connected_components(first, cut)

    open_ = lists.select("list", F.explode(members).alias("m")).select("list", F.col("m.sigs").alias("sig"), F.col("m.sizes").alias("n"), F.col("m.rests").alias("rest"))
    open_ = open_.join(near.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    open_ = cut(open_, "ngram-members")
    per = open_.groupBy("list", "component").agg(F.count("*").alias("m"))
    several = per.groupBy("list").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.sum("m").alias("m"), F.count("*").alias("c")).where("c > 1")
    rows = open_.join(several.select("list", "main", F.ceil(F.col("m") / 20_000).alias("salts")), "list")
    band = lambda n: F.floor(F.log(n) / math.log(4 / 3))
    asks = rows.where("component != main").withColumn("band", F.explode(F.sequence(band(F.ceil(F.col("n") * 0.75)), band(F.floor(F.col("n") / 0.75)))))
    asks = asks.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    asks = asks.select("list", "band", "salt", F.col("sig").alias("q"), F.col("n").alias("n_q"), F.col("rest").alias("rest_q"), F.col("component").alias("component_q"))
    held = rows.select("list", band(F.col("n")).alias("band"), F.pmod(F.xxhash64("sig"), "salts").alias("salt"), F.col("sig").alias("d"), "n", "rest", "component")
    pairs = asks.join(held, ["list", "band", "salt"]).where("component != component_q AND 175L * least(rest, rest_q) >= 75L * (n + n_q)")
    pairs = _once(pairs.select("q", "d"))
    bins = sets.where("n > 0").select("sig", "n", "bins").dropDuplicates(["sig"])
    of = lambda side: bins.select(*(F.col(c).alias(side if c == "sig" else f"{c}_{side}") for c in bins.columns))
    pairs = pairs.join(of("q"), "q").join(of("d"), "d").mapInArrow(_possible, "q long, d long")
    second = _links(cut(pairs, "ngram-pairs"), classes, docs)
    reach = connected_components(first.unionByName(second), cut)

    classes = classes.join(reach.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    named = classes.join(least, "component").select("sig", "component_id")
    out = sets.select("id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")).join(named, "sig", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_components(docs).withColumnRenamed("id", "doc_id")
