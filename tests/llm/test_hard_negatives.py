import math
import random
from collections import defaultdict

import numpy as np
import pytest

from civitas.llm.hard_negatives import Heaps, hard_negatives, strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 47), (70, 65, 129), (5, 200, 300), (40, 0, 40)])
def test_strassen_is_exact(shape):
    m, n, p = shape
    r = np.random.default_rng(m + n + p)
    a, b = r.integers(-(1 << 25), 1 << 25, (m, n)), r.integers(-(1 << 25), 1 << 25, (n, p))
    assert (strassen(a, b, leaf=8) == (a.astype(object) @ b.astype(object) if n else 0)).all()


def test_heaps_merge_like_sorting():
    chance = random.Random(5)
    heaps, all_rows = Heaps(7, 3), defaultdict(list)
    for _ in range(20):
        rows = [(chance.randrange(6), chance.randrange(9) - 4, chance.randrange(10**6)) for _ in range(12)]
        for s, score, i in rows:
            all_rows[s].append((score, i))
        heaps.merge(*np.array(rows).T)
    slot, score, ids = heaps.rows()
    got = defaultdict(list)
    for s, x, i in zip(slot.tolist(), score.tolist(), ids.tolist()):
        got[s].append((x, i))
    assert got == {s: sorted(v, key=lambda e: (-e[0], e[1]))[:3] for s, v in all_rows.items()}


def brute(rows, every=100, k=5):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [max(-(2**21), min(2**21, math.floor(256 * x))) for x in v]
        kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    given = {i: ((label + 1) % 10 if i % 7 == 0 else label, v) for i, (label, v) in kept.items()}
    out = []
    for a, (label, v) in given.items():
        if a % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), i, other)
            for i, (other, w) in given.items() if i != a and len(w) == len(v)
        ]
        for minus, positive, _ in sorted(s for s in scored if s[2] == label)[:k]:
            p = -minus
            near = sorted(s for s in scored if s[2] != label and 80 * p <= -100 * s[0] <= 100 * p)[:k]
            out += [(a, positive, n, i, p, -score) for n, (score, i, _) in enumerate(near, 1)]
    return sorted(out)


def rows_of(seed, count, dims=12):
    r = np.random.default_rng(seed)
    rows = [(i, (r.standard_normal(dims) * 0.3 + 0.2).astype(np.float32).tolist(), int(r.integers(0, 4))) for i in range(count)]
    # ties, a label of a third of all rows, other lengths, everything that takes no part
    rows += [(1000 + i, rows[3][1], 1) for i in range(count // 2)]
    rows += [(2000 + 100 * i, rows[i][1][:5], i % 2) for i in range(4)] + [(2101 + i, rows[i][1][:5], i % 2) for i in range(20)]
    bad = [None, [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1)]
    rows += [(3000 + 100 * i, v, 1) for i, v in enumerate(bad)]
    rows += [(None, rows[0][1], 1), (4000, rows[0][1], None), (4100, [3e38] * dims, 2), (4101, [3e38] * dims, 2), (4102, [3e38] * dims, 1)]
    return [*rows, (5000, [], 1), (5001, [], 1), (5002, [], 3), (0, rows[1][1], 0), (7, rows[1][1], 0)]


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_against_brute_force(spark, block):
    rows = rows_of(1, 320)
    frame = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, label int, rank int")
    got = hard_negatives(frame, block_bytes=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == brute([(r.vec_id, r.embedding, r.label) for r in frame.collect()]) and len(found) > 40


def test_empty_tables_and_no_anchor(spark):
    frame = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(frame).count() == 0 and hard_negatives(frame.limit(0)).count() == 0
