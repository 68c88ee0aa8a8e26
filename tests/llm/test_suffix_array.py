import numpy as np

from cadastra.llm.suffix_array import equal_neighbours, suffix_order


def test_order_and_common_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(120):
        n = int(rng.integers(1, 300))
        text = rng.integers(97, 97 + rng.integers(1, 4), n).astype(np.uint8)
        if trial % 3 == 0:
            text = np.tile(text[: max(1, n // 3)], 3)
        depth, data = 16, text.tobytes()
        wanted = rng.random(len(text)) < 0.7
        wanted[max(0, len(text) - depth + 1) :] = False
        order = suffix_order(text, wanted, depth)
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        keys = [data[i : i + depth] for i in order]
        assert keys == sorted(keys)
        assert equal_neighbours(text, order, depth).tolist() == [a == b for a, b in zip(keys, keys[1:], strict=False)]
