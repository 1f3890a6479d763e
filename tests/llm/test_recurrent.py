import itertools

import numpy as np
import pytest

from spoolwire.llm import crf, recurrent


@pytest.mark.parametrize(("kind", "gates"), [(recurrent.GRU, 3), (recurrent.LSTM, 4)])
@pytest.mark.parametrize("backward", [False, True])
def test_gradients_match_differences(kind, gates, backward, monkeypatch):
    monkeypatch.setattr(recurrent, "F4", np.float64)
    rng = np.random.default_rng(3)
    e, u = rng.standard_normal((gates * 3, 5)), rng.standard_normal((gates * 3, 3))
    x, weight = rng.integers(0, 5, (6, 4)), rng.standard_normal((6, 3, 4))

    def loss(e, u):
        out = np.empty((6, 3, 4))
        kind(e, u).run(x, out, backward)
        return (out * weight).sum()

    tape = []
    net = kind(e, u)
    net.run(x, np.empty((6, 3, 4)), backward, tape)
    de, du = net.grads(x, weight, tape)
    for param, grad in ((e, de), (u, du)):
        for at in [(0, 0), (3, 1), (7, 2), (gates * 3 - 1, 2)]:
            step = np.zeros_like(param)
            step[at] = 1e-6
            hi, lo = (loss(e + s, u) if param is e else loss(e, u + s) for s in (step, -step))
            assert abs((hi - lo) / 2e-6 - grad[at]) < 1e-5


def test_crf_against_all_paths():
    rng = np.random.default_rng(4)
    for scale in (0.3, 3.0):
        emit, trans = (rng.standard_normal((5, 3, 6)) * scale).astype(np.float32), rng.standard_normal((3, 3)).astype(np.float32)
        emit[:, 0] += 1
        gold = rng.integers(0, 3, (5, 6))
        nll, d_emit, d_trans = crf.loss_grads(emit, trans, gold)
        paths = np.array(list(itertools.product(range(3), repeat=5)))

        def scores(emit, trans, n):
            return np.array([emit[range(5), p, n].sum() + trans[p[:-1], p[1:]].sum() for p in paths])

        best = np.stack([paths[scores(emit, trans, n).argmax()] for n in range(6)], axis=1)
        assert np.array_equal(crf.decode(emit, trans), best)

        def loss(emit, trans):
            total = 0
            for n in range(6):
                s = scores(emit, trans, n)
                total += np.log(np.exp(s - s.max()).sum()) + s.max() - s[(paths == gold[:, n]).all(axis=1)][0]
            return total / 6

        assert abs(loss(emit, trans) - nll) < 1e-4
        step = np.zeros_like(emit, np.float64)
        step[2, 1, 3] = 1e-5
        assert abs((loss(emit + step, trans) - loss(emit - step, trans)) / 2e-5 - d_emit[2, 1, 3]) < 1e-4
        step = np.zeros_like(trans, np.float64)
        step[1, 2] = 1e-5
        assert abs((loss(emit, trans + step) - loss(emit, trans - step)) / 2e-5 - d_trans[1, 2]) < 1e-4
