"""SetSketch near duplicates against all pairs, its registers and its likelihood."""

import random
import re

import numpy as np
import pytest

from starloom.llm import setsketch as K

SCHEMA = "doc_id long, text string, node string, regs long, grp int, label string, kept int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))} if ws else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        r = root(k)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(d, len(sets[k]), least[root(k)], least[root(k)] == d) for k, (d, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, None, "y", 2) for d, t in rows], SCHEMA).repartition(5)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def varied(rng, words, share):
    return [rng.choice("qrst") * rng.randint(3, 6) if rng.random() < share else w for w in words]


def corpus(seed=2):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    texts = []
    for n in (30, 80, 250):
        base = [rng.choice(vocab) for _ in range(n)]
        texts += [" ".join(varied(rng, base, share)) for share in (0.0, 0.01, 0.02, 0.03, 0.05, 0.1) for _ in range(6)]
    # a chain: neighbours are linked, its ends share little
    words = [rng.choice(vocab) for _ in range(400)]
    texts += [" ".join(words[k:k + 200]) for k in range(0, 200, 10)]
    # around the threshold: a set and a part of it, 79 to 81 of 100
    words = [f"w{k}" for k in range(103)]
    texts += [" ".join(words[:k]) for k in (82, 83, 84, 103)]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    texts += [texts[3].upper().lower(), texts[3].title(), texts[5] + " \n", "", "", None, " \t", "one", "ONE", "one two three",
              "one two three four", "x " * 3000, "x x x x", "z" * 4000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [rows[0], rows[0], (None, texts[1]), (None, "seen nowhere else at all"), (None, None), (rows[2][0], texts[40])]


def test_components_equal_brute_force(spark):
    rows = corpus()
    assert result(K.near_components(frame(spark, rows))) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("small", [1, 64])
def test_groups_of_many_blocks(spark, monkeypatch, small):
    """Blocks of a few nodes: classes that meet by their heads, and classes that only meet block by block."""
    monkeypatch.setattr(K, "BLOCK", 4)
    monkeypatch.setattr(K, "SMALL", small)
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join(varied(rng, base, share)) for share in (0.01, 0.02, 0.04, 0.06) for _ in range(12)]
    words = [f"v{k}" for k in range(300)]
    texts += [" ".join(words[k:k + 150]) for k in range(0, 150, 6)]
    rows = list(enumerate(texts))
    assert result(K.near_components(frame(spark, rows))) == sorted(brute(rows), key=repr)


def test_empty_table(spark):
    assert K.near_components(frame(spark, [])).count() == 0
    assert result(K.near_components(frame(spark, [(1, None), (2, "")]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    a, b = np.unique(pool[:9000]), np.unique(pool[1000:10_000])
    ra, rb, rab = K.registers([a, b, np.union1d(a, b)])
    assert (K.merge(ra, rb) == rab).all()
    # independent pairs of several similarities, sizes unequal
    for share in (0.5, 0.7, 0.8, 0.9, 0.99):
        got = []
        for _ in range(30):
            x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            y = np.append(x[:int(1000 * share)], rng.integers(0, 1 << 63, 60, dtype=np.uint64))
            regs = K.registers([np.unique(x), np.unique(y)])
            size = np.array([len(np.unique(x)), len(np.unique(y))])
            likely, possible = K.estimate(regs, size, np.array([0]), np.array([1]))
            true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            assert possible[0] or true < K.THRESHOLD
            if size.min() >= K.THRESHOLD * size.max():
                got.append(likely[0] - true)
        assert not got or abs(np.mean(got)) < 0.03
