import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitas.llm.resampling import bucket_counts, feature_buckets, noise, radix_places, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_buckets(text, longest=2, buckets=10_000):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % buckets for r in runs]


TEXTS = [None, "", "One", "one TWO three", "Épée ÄB 4x_y-z É", "a " * 30_000, "x" * 100_000, "日本 語"]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_features(spark, longest):
    for text in TEXTS:
        n, found = feature_buckets((text or "").encode(), longest, 977)
        want = plain_buckets(text, longest, 977)
        assert n == want[0] and Counter(found.tolist()) == Counter(want[1])
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    want = Counter(b for t in TEXTS for b in plain_buckets(t, longest, 977)[1])
    assert bucket_counts(frame, longest, 977).tolist() == [want[b] for b in range(977)]


@pytest.mark.parametrize("digit,block", [(3, 50), (12, 1 << 20)])
def test_radix_places_equal_sorting(spark, digit, block):
    chance = random.Random(2)
    edge = [0, -1, 1, 2**63 - 1, -(2**63), None]
    rows = [(chance.choice([*edge, 5, 5, 5]), chance.choice([*edge, chance.randrange(99)]), i) for i in range(700)]
    frame = spark.createDataFrame(rows, "a long, b long, i int").repartition(5)
    got = radix_places(frame, [("a", True), ("b", False)], digit, block).orderBy("place").collect()
    assert [r.place for r in got] == list(range(700)) and sorted(r.i for r in got) == list(range(700))
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0))
    assert [(r.a, r.b) for r in got] == [r[:2] for r in want]


def test_radix_places_of_equal_keys_and_of_nothing(spark):
    frame = spark.range(40).select(F.lit(3).cast("long").alias("a"), "id")
    assert sorted(r.place for r in radix_places(frame, [("a", False)]).collect()) == list(range(40))
    assert radix_places(frame.limit(0), [("a", False)]).count() == 0


def test_resample_against_plain(spark):
    chance = random.Random(7)
    pool = [f"w{n}" for n in range(40)] + ["The", "é"]
    docs = [(n, " ".join(chance.choices(pool, k=chance.randrange(0, 60)))) for n in range(300)]
    docs += [(5, docs[5][1]), (900, None), (None, docs[7][1] + " q" * 20), (901, "w1 " * 20_000)]
    target = [(n, " ".join(chance.choices(pool[:9], k=30))) for n in range(20)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, rank int")
    got = resample(frame, spark.createDataFrame(target, "item_id long, text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    s, t = np.zeros(10_000), np.zeros(10_000)
    for into, rows in ((s, docs), (t, target)):
        for _, text in rows:
            np.add.at(into, plain_buckets(text)[1], 1)
    gains = np.floor(1000 * np.log((t + 1) * (s.sum() + 10_000) / ((s + 1) * (t.sum() + 10_000)))).astype(int)
    want = []
    for doc_id, text in docs:
        n, found = plain_buckets(text)
        weight = int(gains[found].sum()) // len(found) if found else 0
        want.append((doc_id, len(found), weight, weight + noise(doc_id, 7), n))
    entered = sorted((w for w in want if w[4] >= 20), key=lambda w: (-w[3], w[0] is None, w[0]))
    drawn = entered[: 25 * len(entered) // 100]
    rows = got.collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in rows) == Counter(want)
    ranked = sorted((r for r in rows if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(w[0], w[3]) for w in drawn]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    none = docs.limit(0)
    assert resample(none, none).count() == 0 and resample(none, docs).count() == 0
    assert [tuple(r)[:2] for r in resample(docs, none).collect()] == [(1, 59)]
