"""Texts of little entropy, long texts in stretches, letters, and the largest id."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from cadastra.llm.common import windowed
from cadastra.llm.language_id import identify_languages
from cadastra.llm.substring_dedup import substring_dedup
from cadastra.llm.suffix_dedup import _segments, run_starts, selections, start_runs, suffix_dedup

from .test_text_operators import brute_bytes, frame


def test_runs_of_starts():
    rng = np.random.default_rng(0)
    for _ in range(500):
        start = np.unique(rng.integers(0, rng.choice([5, 30, 300]), rng.integers(1, 40)))
        assert run_starts(start_runs(start)).tolist() == start.tolist()
    assert start_runs(np.arange(10**6)).tolist() == [[0, 1, 10**6]]


def test_stretches_hold_every_window_once():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abc", k=n)) for n in (0, 5, 700, 40, 2000, 199, 200, 301)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for most in (100, 250, 1000, 10_000):
        seen = []
        for rows, base, data, offs in windowed(batch, "text", 200, most):
            first, n, pick, h = selections(data, offs, 200)
            doc = np.searchsorted(offs, first, "right") - 1
            for f, k, p, d, x in zip(first, n, pick, doc, h, strict=True):
                seen += [(int(rows[d]), int(base + f + i - offs[d]), int(base + p - offs[d]), int(x)) for i in range(k)]
        assert len(seen) == len(set(seen)) == sum(max(0, len(t) - 199) for t in texts)
        whole = whole if most != 100 else sorted(seen)
        assert sorted(seen) == whole


def test_segments_follow_the_period():
    """A megabyte of one byte is one segment, of a word five."""
    texts = ["x" * 1_000_000, "word " * 200_000]
    every = np.arange(1_000_000, dtype=np.int32).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts), pa.array([every, every], pa.binary())], names=["tk", "text", "pos"])
    rows = pa.Table.from_batches(list(_segments(200)([batch]))).to_pylist()
    assert [sum(r["tk"] == k for r in rows) for k in (1, 2)] == [1, 5] or sum(len(r["segment"]) for r in rows) < 20_000


@pytest.mark.parametrize("most", [20_000, 1])
def test_low_entropy_equals_brute_force(spark, most):
    rng = random.Random(2)
    rows = [(1, "x" * 700), (2, "ab" * 300 + "c"), (3, "word " * 90), (4, "".join(rng.choices("xy", k=600))), (5, "x" * 250 + "y" * 300 + "x" * 230), (6, "y" * 199), (7, "abc" * 80 + "x" * 210 + "abc" * 90), ((1 << 63) - 1, "z" * 400), (None, "ab" * 130)]
    found = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup(frame(spark, rows), most_segments=most).collect()}
    assert found == brute_bytes(rows, 200)


def test_texts_of_megabytes(spark):
    """A passage across the end of a stretch, and megabytes of padding, in time that follows the bytes."""
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage, edge = letters(300), (2 << 20) - 64
    long_ = letters(edge - 150) + "A" + passage + "B" + letters(400_000)
    rows = [(1, long_), (2, "C" + passage + "D"), (3, "=" * 6_000_000), (4, letters(50_000)), (5, "word " * 500_000)]
    began = time.time()
    got = {r["id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup(frame(spark, rows)).collect()}
    assert got == {1: (300, 1), 2: (300, 1), 3: (6_000_000, 1), 4: (0, 0), 5: (2_500_000, 1)} and time.time() - began < 120


def test_the_largest_id_stays(spark):
    last = (1 << 63) - 1
    rows = [(last, " ".join(f"w{i}" for i in range(60))), (None, "short"), (4, "x")]
    for f in (suffix_dedup, substring_dedup):
        assert {r["id"] for r in f(frame(spark, rows)).collect()} == {last, None, 4}


def test_numbers_are_no_letters(spark):
    rows = [(1, "½ ² ³", None), (2, "Ⅻ 12 _", None), (3, "ß", None), (4, "東", None), *((10 + k, t, lang) for k, (t, lang) in enumerate([("the cat", "en"), ("le chat", "fr")] * 6))]
    got = {r["id"]: r["lang_pred"] for r in identify_languages(frame(spark, rows, "doc_id long, text string, lang string")).collect()}
    assert got[1] == got[2] == "und" and {got[3], got[4]} <= {"en", "fr"}
