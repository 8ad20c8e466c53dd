import random

import numpy as np

from civitas.llm.order_minhash import (
    BAG,
    GRAM,
    WordHashes,
    bag,
    bit_distance,
    edit_distance,
    grams,
    near_texts,
    possible_pairs,
    similar,
    sketch,
)
from tests_llm_plain import classes, plain_distance


def test_banded_distance_equals_full_table():
    chance = random.Random(1)
    for _ in range(1500):
        a = [chance.randrange(4) for _ in range(chance.randint(0, 14))]
        b = list(a) if chance.random() < 0.6 else [chance.randrange(4) for _ in range(chance.randint(0, 14))]
        for _ in range(chance.randint(0, 4)):
            at = chance.randint(0, len(b))
            b[at : at + chance.randint(0, 2)] = [chance.randrange(4)] * chance.randint(0, 2)
        exact = plain_distance(a, b)
        for most in (0, 1, 3, 20):
            expected = exact if exact <= most else None
            assert edit_distance(a, b, most) == expected, (a, b, most)
            assert bit_distance(a, b, most) == expected, (a, b, most)


def test_sketches_keep_text_order_and_label_occurrences():
    words = np.arange(100, dtype=np.uint64)
    assert len(grams(words)) == 100 - GRAM + 1
    assert len(np.unique(grams(np.zeros(40, np.uint64)))) == 36
    turned = np.concatenate([words[50:], words[:50]])
    agree = (sketch(grams(words)) == sketch(grams(turned))).mean()
    assert 0.2 < agree < 0.8  # same grams, other order for about half of the pairs
    assert (sketch(grams(words)) == sketch(grams(words.copy()))).all()


def test_whole_query_against_brute_force(spark):
    chance = random.Random(3)
    vocabulary = [f"w{n}" for n in range(3000)]
    passage = chance.choices(vocabulary, k=30)
    texts = []
    for d in range(40):
        words = chance.choices(vocabulary, k=chance.randint(40, 90))
        if d % 2:
            words[10:10] = passage
        texts.append((d, " ".join(words)))
        for c in range(chance.randint(0, 3)):
            copy = list(words)
            for _ in range(chance.randint(0, len(copy) // 12)):
                copy[chance.randrange(len(copy))] = chance.choice(vocabulary)
            texts.append((100 + d * 10 + c, " ".join(copy)))
    texts += [(900, ""), (901, ""), (902, "one two"), (903, "one two"), (904, "  ")]
    frame = spark.createDataFrame([(*t, "x") for t in texts] + [(None, texts[0][1], "x"), (905, None, "x")],
                                  "doc_id long, text string, class_id string")
    got = near_texts(frame).collect()
    found = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert found == classes([*texts, (905, "")])
    assert [(r.class_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert all(r.kept == (r.doc_id == r.class_id) for r in got if r.doc_id is not None)


def test_edges(spark):
    frame = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "x " * 30000), (3, "y " + "x " * 29999)],
                                  "doc_id long, text string")
    assert sorted((r.doc_id, r.class_id) for r in near_texts(frame).collect()) == [(1, 1), (1, 1), (2, 2), (3, 2)]
    assert near_texts(frame.limit(0)).count() == 0
    assert similar("A b", "a B") and not similar("a", "b")


def test_bags_rule_out_no_similar_pair():
    chance, hashes = random.Random(5), WordHashes()
    texts = [[f"w{chance.randrange(40)}" for _ in range(chance.randint(1, 60))] for _ in range(30)]
    texts += [["of"] * 400, ["of"] * 350 + ["to"] * 50]
    for words in list(texts):
        copy = list(words)
        for _ in range(chance.randint(0, len(copy) // 5)):
            copy[chance.randrange(len(copy))] = "new"
        texts.append(copy)
    bags = np.stack([bag(np.array([hashes[w] for w in t], np.uint64)) for t in texts])
    assert bags.shape[1] == BAG
    size, n = np.array([len(t) for t in texts]), len(texts)
    for sides in (np.zeros(n, int), np.arange(n) % 2):
        got = possible_pairs(size, np.arange(n), sides, bags, 0.8)
        got = {frozenset(p) for p in zip(*(x.tolist() for x in got), strict=True)}
        for i in range(n):
            for j in range(i):
                if similar(" ".join(texts[i]), " ".join(texts[j])) and (sides[i] != sides[j] or not sides.any()):
                    assert {i, j} in got
        assert len(got) < n * n / 4


def test_members_that_no_leader_reaches(spark):
    chance = random.Random(7)
    vocabulary = [f"w{n}" for n in range(5000)]
    texts = []
    # copies edited at different places; the original's id is not the smallest
    for group in range(3):
        words = chance.choices(vocabulary, k=100)
        texts.append((100 * group + 50, " ".join(words)))
        for c in range(24):
            at = c * 85 // 23
            copy = words[:at] + chance.choices(vocabulary, k=15) + words[at + 15 :]
            texts.append((100 * group + c, " ".join(copy)))
    # versions that drift, in no order of ids
    words, ids = chance.choices(vocabulary, k=80), list(range(1000, 1030))
    chance.shuffle(ids)
    for number, at in zip(ids, [n * 37 % 70 for n in range(30)], strict=True):
        words = words[:at] + chance.choices(vocabulary, k=10) + words[at + 10 :]
        texts.append((number, " ".join(words)))
    # a bucket crowded by a shared passage
    passage = chance.choices(vocabulary, k=70)
    for d in range(40):
        own = chance.choices(vocabulary, k=30)
        texts.append((2000 + d, " ".join(passage + own)))
        if d % 4 == 3:
            texts.append((2100 + d, " ".join(passage + own[:25] + chance.choices(vocabulary, k=5))))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    expected = classes(texts)
    for block in (2048, 7):
        assert {r.doc_id: r.class_id for r in near_texts(frame, block=block).collect()} == expected


def test_texts_and_sketches_stay_in_place_without_broadcasts(spark, monkeypatch):
    """Where lists of ids are too large for a broadcast, sketches and bags moved with every row."""
    from civitas.llm import order_minhash
    from civitas.llm.common import stage as plain

    plans = []

    def noted(frame, label, *more, **named):
        plans.append((label, frame._jdf.queryExecution().executedPlan().toString()))
        return plain(frame, label, *more, **named)

    monkeypatch.setattr(order_minhash, "stage", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = [f"w{n}" for n in range(90)]
        texts = [(d, " ".join(words[: 80 + d % 7])) for d in range(21)] + [(50, "other text here")]
        found = {r.doc_id: r.class_id for r in near_texts(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == classes(texts)
    members = next(plan for label, plan in plans if label == "members")
    assert "Exchange" not in members


def test_intermediate_tables_are_deleted(spark):
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.iterdir()), {t.name for t in spark.catalog.listTables()}
    texts = [(d, f"a b c d e f g {d // 2}") for d in range(8)]
    got = near_texts(spark.createDataFrame(texts, "doc_id long, text string"))
    left = {p.name.rsplit("-", 5)[0] for p in set(root.iterdir()) - before[0]}
    assert left == {"classes"} and {t.name for t in spark.catalog.listTables()} == before[1]
    assert {r.doc_id: r.class_id for r in got.collect()} == classes(texts)
