"""Hard negatives against all scores of small tables, and the coordinate ranges against exact scores."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import negatives
from cadastra.llm.negatives import Block, hard_negatives, op12_negatives

SCHEMA = "id long, label int, q array<long>"


def block(q, low=0, high=0):
    n = len(q)
    return Block(np.arange(n), np.ones(n, bool), np.arange(n), np.zeros(n, np.int32), np.array(q, np.int64), np.full((n, 1), low), np.full((n, 1), high))


def brute(rows, every=10, k=5):
    """All scores of all rows. Rows of the table are told apart, whatever their ids."""
    rows = [(i, label, q, r) for r, (i, label, q) in enumerate(rows) if label is not None and q is not None]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda s, i: (-s, i is None, i or 0)
    out = collections.Counter()
    for i, label, q, r in rows:
        if i is None or i % every:
            continue
        scored = [(score(q, p), j, other) for j, other, p, t in rows if t != r]
        for ps, pid, _ in sorted((x for x in scored if x[2] == label), key=lambda x: order(*x[:2]))[:k]:
            fits = sorted((x for x in scored if x[2] != label and 80 * ps <= 100 * x[0] <= 100 * ps), key=lambda x: order(*x[:2]))
            out.update((i, pid, rank, nid, ps, ns) for rank, (ns, nid, _) in enumerate(fits[:k], 1))
    return out


def found(spark, rows, **rule):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = hard_negatives(df, F.coalesce(F.col("id") % 10 == 0, F.lit(False)), block_rows=32, chunk_rows=8, **rule)
    return collections.Counter(tuple(r) for r in out.collect())


def clusters(seed, n, dims, labels=4, spread=12):
    """Rows around few centres that labels share, so that windows aren't empty; long and short ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (6, dims))
    q = centres[rng.integers(0, 6, n)] * rng.integers(1, 4, (n, 1)) + rng.integers(-spread, spread, (n, dims))
    return [(k, int(rng.integers(0, labels)), [int(v) for v in row]) for k, row in enumerate(q)]


@pytest.mark.parametrize("dims", [1, 2, 6, 20])
def test_ranges_lose_no_row(dims):
    rng = np.random.default_rng(dims)
    pruned = 0
    for _ in range(60):
        q = rng.integers(-40, 40, (200, dims)) * rng.integers(0, 5, (200, 1))
        anchor = rng.integers(-40, 40, dims)
        q[:3] = 5 * anchor + rng.integers(-9, 9, (3, dims))
        b = block(q)
        scores = q @ anchor
        for least in {int(x) for x in np.quantile(scores, [0.5, 0.9, 0.99, 1])} | {int(scores.max()) + 1, 1, 0, -5}:
            rows = b.within(anchor, float(np.sqrt((anchor.astype(float) ** 2).sum())), least, 4)
            assert rows is None or {*np.flatnonzero(scores >= least)} <= {*rows.tolist()}
            assert least > 0 or rows is None
            pruned += rows is not None
    assert pruned > 30


def test_ranges_prune_near_copies():
    rng = np.random.default_rng(0)
    q = rng.normal(size=(3000, 64))
    q[:20] = q[0] + rng.normal(size=(20, 64)) * 0.1
    b = block(np.floor(512 * q / np.sqrt((q**2).sum(1))[:, None]))
    anchor = b.q[0]
    rows = b.within(anchor, b.length[0], int(0.97 * b.length[0] ** 2), 6)
    assert {*range(20)} <= {*rows.tolist()} and len(rows) < 300


@pytest.mark.parametrize("seed", range(3))
def test_all_negatives_are_found(spark, seed):
    rows = clusters(seed, 260, [3, 12, 40][seed])
    want = brute(rows)
    assert found(spark, rows) == want and len(want) > 100


def test_nulls_ties_repeated_rows_and_lengths(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 0, 10, 20, *range(30)]), rng.choice([None, 0, 1, 1, 2, -3]), rng.choice([None, [], [0, 0], [3], [3, 4], [3, 4, 0], [2, 1, 5], [-1, 2], [6, 8]])) for _ in range(140)]
    rows += rows[:30]
    want = brute(rows)
    assert found(spark, rows) == want and len(want) > 100


def test_one_label_has_most_rows_and_all_are_copies(spark):
    rows = [(k, 0 if k % 9 else 1, [5, 7, 1]) for k in range(400)]
    assert found(spark, rows) == brute(rows)


def test_large_numbers_are_exact(spark):
    rows = [(k, k % 2, [(1 << 30) + k, (1 << 29) - 3 * k, 7]) for k in range(40)]
    assert found(spark, rows) == brute(rows)
    with pytest.raises(OverflowError):
        list(negatives.meet(block([[1 << 40]]), block([[1 << 40]], 0, 1 << 60), 5, 3, True))


def test_no_positives_no_negatives_no_rows(spark):
    assert not found(spark, [])
    # An anchor alone in its label, one without other labels in its window, and a positive of negative score.
    assert not found(spark, [(0, 1, [1, 2]), (10, 2, [100, 2]), (1, 2, [90, 2]), (20, 3, [1, -900]), (2, 3, [-1, 900])])


def test_other_columns_and_other_numbers_of_results(spark):
    rows = clusters(9, 120, 5)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", row string, score int")
    out = hard_negatives(df, F.col("id") % 10 == 0, positives=3, negatives=3, block_rows=16, chunk_rows=4)
    assert collections.Counter(tuple(r) for r in out.collect()) == brute(rows, k=3)


def test_query(spark, tmp_path):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(450, 6)).astype(np.float32)
    rows = [(k, [float(x) for x in r], k % 10) for k, r in enumerate(v)] + [(700, None, 1), (800, [float("nan")] * 6, 1), (900, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (None, [1.0] * 6, 2), (1000, [1.0] * 6, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = op12_negatives(spark, str(tmp_path))
    assert out.dtypes == [(c, "int" if c == "rank" else "bigint") for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    plain = [(k, (lab + 1) % 10 if k is not None and k % 7 == 0 else lab, [int(np.floor(256.0 * x)) for x in r]) for k, r, lab in rows if lab is not None and r and all(x is not None and np.isfinite(x) for x in r)]
    assert collections.Counter(tuple(r) for r in out.collect()) == brute(plain, every=100)
