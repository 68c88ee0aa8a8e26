"""Packing: token ids against the tokenizer's own, plans against packing piece by piece, and whole sequences."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastra.llm import packing
from cadastra.llm.packing import Encoder, best_two_fit, op11_packing, pack, pack_documents, pieces_of, plan_bins, sequences, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = list("abc ÉΣσ'sſ\t\n\x0b\x00\x1c\x85\xa0é İ12٣!?") + ["<|endoftext|>", " ", "'re", "　", "東", "é", "́"]


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(open(PATH, encoding="utf-8").read(), most=50)


def one_by_one(counts, size, two):
    """Best-two-fit, a piece and a bin at a time, over all pairs."""
    counts, bins = list(counts), []
    while sum(counts):
        content, gap = [], size
        for length in range(size, 0, -1):
            while counts[length] and length <= gap:
                counts[length] -= 1
                gap -= length
                content.append(length)
        if two and gap and len(content) > 1:
            s = min(content)
            pairs = [(x + y, x, y) for x in range(1, size + 1) for y in range(1, x + 1) if s < x + y <= gap + s and counts[x] and counts[y] and (x != y or counts[x] > 1)]
            if pairs:
                _, x, y = max(pairs)
                content.remove(s)
                content += [x, y]
                counts[s] += 1
                counts[x] -= 1
                counts[y] -= 1
        bins.append(sorted(content, reverse=True))
    return bins


def test_ids_are_the_tokenizers_own(own, encoder):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 30)))
        want = own.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == want
        size = rng.choice([1, 2, 3, 5, 50])
        got = [np.frombuffer(p, "<u4").tolist() for p in pieces_of(encoder.parts(text.encode(), rng.choice([1, 3, 1 << 20])), size, 1)]
        assert sum(got, []) == [*want, 1] and all(len(p) == size for p in got[:-1]) and 1 <= len(got[-1]) <= size


def test_words_are_encoded_without_a_mark(own, encoder):
    mark, encoder.mark = encoder.mark, None
    words = [b"abc", b"\xc3\xa9t\xc3\xa9!", b"it's"]
    assert {w: np.frombuffer(p, "<u4").tolist() for w, p in encoder._learn(words).items()} == {w: own.encode(w.decode(), add_special_tokens=False).ids for w in words}
    encoder.mark = mark


def test_plans_are_those_of_packing_one_by_one():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.choice([7, 12, 20])
        counts = np.array([0] + [rng.choice([0, 0, 1, 2, 5, 30, 100]) for _ in range(size)])
        for two in (True, False):
            plan = best_two_fit(counts, size, two)
            assert [[length for length, n in content for _ in range(n)] for content, times in plan for _ in range(times)] == one_by_one(counts, size, two)


def test_a_plan_does_not_grow_with_the_corpus():
    counts = np.random.default_rng(0).integers(1, 1000, 257)
    counts[0] = 0
    few, many = plan_bins(counts, 256), plan_bins(counts * 10**7, 256)
    assert len(many) < 4 * len(few) + 1000
    total = int((counts * np.arange(257)).sum()) * 10**7
    assert -(-total // 256) <= sum(times for _, times in many) <= total / 256 * 1.02


def test_two_pieces_replace_the_smallest():
    counts = np.bincount([6, 3, 2, 2], minlength=11)
    assert best_two_fit(counts, 10) == [([(6, 1), (2, 2)], 1), ([(3, 1)], 1)]
    assert best_two_fit(counts, 10, two=False) == [([(6, 1), (3, 1)], 1), ([(2, 2)], 1)]


def whole(rows, size):
    """Every sequence is gapless from 0 and holds at most size."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_documents_packed(spark, own):
    rng = random.Random(3)
    texts = [None, "", " \n", "a" * 9000, "x y " * 7000, "the end <|endoftext|>", *[" ".join(rng.choices(["the", "of", "cat", "zürich", "42", "東京"], k=rng.randint(1, 700))) for _ in range(150)]]
    rows = [(k % 120 if k % 13 else None, t, "own", k) for k, t in enumerate([*texts, *texts[:40]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, sequence_id int").repartition(5)
    got = pack_documents(docs, PATH, size=512, ids=True).collect()
    want = collections.Counter()
    for d, t, _, _ in rows:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            want[d, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert collections.Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got) == want
    total = sum(n * k[3] for k, n in want.items())
    assert -(-total // 512) <= whole(got, 512) <= total / 512 * 1.05 + 1


def test_sequences_hold_their_parts(spark):
    docs = spark.createDataFrame([(k, "w " * k) for k in range(60)], "doc_id long, text string")
    packed = pack_documents(docs, PATH, size=64, ids=True)
    ids = {(r["id"], r["piece"]): r["ids"] for r in packed.collect()}
    rows = sequences(packed).collect()
    assert all(len(r["ids"]) == r["length"] and sum((ids[p["id"], p["piece"]] for p in r["parts"]), []) == r["ids"] for r in rows)
    assert sum(len(r["parts"]) for r in rows) == len(ids)


def test_buckets_number_pieces_once(spark, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', int(id % 9))").alias("text")).unionByName(spark.createDataFrame([(7, "w")] * 500, "doc_id long, text string"))
    pieces = packing.cut(token_pieces(docs, PATH, size=16), "test-pieces")
    rows = pack(pieces, 16, bucket_rows=100).collect()
    assert len(rows) == 3500 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3500
    assert whole(rows, 16) == -(-sum(r["length"] for r in rows) // 16)


def test_no_documents(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_query(spark):
    out = op11_packing(spark, "/root/testdata/sf0.001")
    assert out.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]
    rows = out.collect()
    assert whole(rows, 4096) <= sum(r["length"] for r in rows) / 4096 * 1.05 + 1
