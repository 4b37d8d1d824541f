"""The recurrent part works on arrays by feature, then token, whose steps are long runs of memory; its values are those of the plain recurrence."""

import numpy as np
import pytest

from methframe.llm import gru_lm


def plain(m, tokens):
    """Log-probability of one document, token by token."""
    p, n = m.p, m.hidden
    h, before, total = np.zeros(n), m.end, 0.0
    for t in tokens:
        g, u = p["read"][before], h @ p["carry"]
        z, r = (1 / (1 + np.exp(-(g[a : a + n] + u[a : a + n]))) for a in (0, n))
        new = np.tanh(g[2 * n :] + r * u[2 * n :])
        h = z * (h - new) + new
        x = h @ p["write"] + p["bias"]
        c = m.class_of[t]
        total += x[c] - np.log(np.exp(x).sum())
        if m.first <= c < len(p["bias"]) - 1:
            y = h @ p["inner"][c - m.first] + p["inner_bias"][c - m.first]
            total += y[m.member_of[t]] - np.log(np.exp(y).sum())
        before = t
    return total


def test_values_and_layout(monkeypatch):
    m = gru_lm.Recurrent(5, 8, hidden=4, seed=3, class_of=np.array([0, 1, 2, 2, 2, 2, 3, 3, 4]), member_of=np.array([0, 0, 0, 1, 2, 3, 0, 1, 0]), first=2)
    shapes, window = [], gru_lm.Recurrent._window
    monkeypatch.setattr(gru_lm.Recurrent, "_window", lambda self, source, target, active, h, *rest: shapes.append((h.shape, active[0])) or window(self, source, target, active, h, *rest))
    begin = np.array([0, 40, 41, 41, 58])
    tokens = np.random.default_rng(1).integers(0, 9, 58).astype(np.uint16)
    got = m.run(tokens, begin)
    assert got == pytest.approx([plain(m, tokens[a:b]) for a, b in zip(begin, begin[1:])], rel=1e-4)
    assert shapes and all(shape == (4, most) for shape, most in shapes)
