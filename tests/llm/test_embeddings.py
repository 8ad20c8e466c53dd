import math
import random

import numpy as np

from civitas.llm.components import components
from civitas.llm.embeddings import encode, near_vectors, rotation, upper_bounds


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def test_components(spark):
    chance = random.Random(1)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(170)]
    edges += [(n, n + 1) for n in range(1000, 1040)] + [(2000, n) for n in range(2001, 2060)]
    edges += [(5, 5), (None, 1)]
    frame = spark.createDataFrame(edges, "a long, b long")
    real = [e for e in edges if None not in e and e[0] != e[1]]
    expected = union_find({n for e in real for n in e}, real)
    assert {r.node: r.component for r in components(frame).collect()} == expected
    assert components(frame.limit(0)).count() == 0


def brute(rows, threshold=0.95):
    good = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, float)
            good[n] = x / np.abs(x).max()
            good[n] /= np.linalg.norm(good[n])
    links = {n: [m for m in good if m != n and len(good[m]) == len(good[n]) and good[n] @ good[m] >= threshold] for n in good}
    root = union_find([rows[n][0] for n in good], [(rows[n][0], rows[m][0]) for n in links for m in links[n]])
    out = []
    for n, (i, _) in enumerate(rows):
        c = root[i] if n in good else i
        out.append((i, len(links.get(n, ())), c, i is not None and i == c))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((120, 24)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, (base[i] * 3 + r.standard_normal(24) * 0.2).tolist()) for i in range(40)]
    rows += [(300 + i, (base[7] + r.standard_normal(24) * 0.02).tolist()) for i in range(60)]
    rows += [(400 + i, base[9].tolist()) for i in range(30)] + [(400, base[9].tolist())]
    bad = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] * 24]
    rows += [(500 + i, v) for i, v in enumerate(bad)] + [(None, base[9].tolist()), (600, [1.0, 2.0]), (601, [2.0, 4.0])]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<float>, kept int")
    floats = [(r.vec_id, r.embedding) for r in frame.collect()]
    for block in (1000, 16):
        got = near_vectors(frame, recall=0.99999, block=block)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(floats)
    assert near_vectors(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(3)
    x = r.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + r.standard_normal(x.shape) * 0.04
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    code, factor, keys = encode(x, 16, 3)
    assert keys.shape == (400, 3) and keys.max() < 1 << 16
    exact = x @ y.T
    bound = upper_bounds(x, code, factor, y)
    assert (bound >= exact).mean() > 0.9999 and np.diag(bound >= exact).all()
    spread = np.sqrt(1 - factor**2) / factor / math.sqrt(63)
    assert abs((bound - 4 * spread[:, None] - exact).mean()) < 0.005
    assert np.allclose(rotation(0, 64) @ rotation(0, 64).T, np.eye(64))


def test_recall_at_the_threshold(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((400, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = r.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = near_vectors(frame).filter("vec_id >= 400 and component_id = vec_id - 400").count()
    assert found >= 0.97 * 400
