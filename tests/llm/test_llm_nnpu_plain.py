"""The non-negative estimator against a plain-Python one whose gradient is a finite difference."""

import math
import random

import pytest

from starloom.llm import toxicity


def plain_fit(pos, unl, prior, steps, rate=0.02, decay=3e-4):
    """(weights, intercept, steps on which the non-negative part was below zero)."""
    vocab = sorted({f for d in pos for f in d if sum(f in e for e in pos) >= 2})

    def mean_loss(docs, w, sign):
        total = 0.0
        for d in docs:
            z = w[-1] + sum(w[i] for i, f in enumerate(vocab) if f in d)
            total += math.log1p(math.exp(-sign * z))
        return total / len(docs)

    def clean_part(w):
        return mean_loss(unl, w, -1) - prior * mean_loss(pos, w, -1)

    def objective(w, below):
        penalty = decay / 2 * sum(x * x for x in w[:-1])
        return penalty + (-clean_part(w) if below else prior * mean_loss(pos, w, 1) + clean_part(w))

    w = [0.0] * len(vocab) + [math.log(prior / (1 - prior))]
    m, v, negatives = [0.0] * len(w), [0.0] * len(w), 0
    for t in range(1, steps + 1):
        below = clean_part(w) < 0
        negatives += below
        grad = []
        for i in range(len(w)):
            up, down = list(w), list(w)
            up[i] += 1e-5
            down[i] -= 1e-5
            grad.append((objective(up, below) - objective(down, below)) / 2e-5)
        for i, g in enumerate(grad):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (math.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return dict(zip(vocab, w)), w[-1], negatives


def sample(seed, share):
    rng = random.Random(seed)

    def doc(toxic):
        return {f"w{rng.randrange(4)}" for _ in range(2)} | ({rng.choice(["bad", "vile"])} if toxic else set())
    return [doc(True) for _ in range(8)], [doc(rng.random() < share) for _ in range(14)]


@pytest.mark.parametrize("seed, share, prior, goes_negative", [
    (1, 0.5, 0.1, False),   # a prior below the true share
    (2, 0.0, 0.5, True),    # a prior far above the true share: the second term turns negative
])
def test_fit_follows_the_estimator(seed, share, prior, goes_negative):
    pos, unl = sample(seed, share)
    want, bias, negatives = plain_fit(pos, unl, prior, 200)
    assert (negatives > 0) == goes_negative
    got, got_bias = toxicity.fit(pos, unl, prior, steps=200)
    assert got.keys() == want.keys()
    assert got_bias == pytest.approx(bias, abs=2e-4)
    for f in want:
        assert got[f] == pytest.approx(want[f], abs=2e-4), f
