import numpy as np

from cadastra.llm.boosting import fit
from cadastra.llm.recurrent import Net


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    net = Net.new(3, 4, seed=2)
    for p in net.parameters():
        p[...] = p * 0.7
    for name in ("inputs", "state", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    x, y = rng.integers(1, 20, (6, 5)), np.array([0, 1, 2, 1, 0])
    weight = np.ones((6, 5))
    _, grads = net.gradients(x, y, weight)
    for p, g in zip(net.parameters(), grads, strict=True):
        for k in np.argsort(-np.abs(g).ravel())[:6]:
            at = np.unravel_index(k, p.shape)
            old = p[at]
            p[at] = old + 1e-3
            up = net.gradients(x, y, weight)[0]
            p[at] = old - 1e-3
            down = net.gradients(x, y, weight)[0]
            p[at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_probabilities_follow_the_trained_pass():
    net = Net.new(3, 4, seed=1)
    x = np.random.default_rng(3).integers(0, 256, (9, 7)).astype(np.uint8)
    p = net.probabilities(x)
    loss, _ = net.gradients(x, np.zeros(7, int), np.ones((9, 7), np.float32))
    assert abs(-np.log(p[0]).mean() - loss) < 1e-4


def test_boosting_learns_and_survives_constants():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert np.allclose(fit(np.zeros((0, 5)), np.zeros(0)).score(x[:3]), 0.5)
    assert (fit(x[:50], np.ones(50)).score(x[:3]) > 0.9).all()
