import random

import numpy as np

from civitas.llm.toxicity import Link, _features, fit_chain, toxicity


def corpus(count, seed):
    chance = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ast", "ore", "ind", "ump", "elt", "irk")]
    rows = []
    for d in range(count):
        text = chance.choices(words, k=chance.randint(5, 80))
        toxic = d % 6 == 0
        junk = d % 5 == 0
        if toxic:
            text.insert(chance.randrange(len(text)), "vile" + chance.choice(["st", "ly", "ness", ""]))
        rows.append((d, " ".join(w.upper() + "!!" if junk else w for w in text), 1 - junk, int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(900, 1)
    docs = spark.createDataFrame([(r[0], r[1], "z") for r in rows], "doc_id long, text string, rejected string")
    labels = spark.createDataFrame(
        [(r[0], r[2], r[3]) for r in rows if r[0] < 600], "doc_id long, quality int, toxic int"
    )
    found = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    held = [r for r in rows if r[0] >= 600]
    assert np.mean([found[r[0]].rejected == bool(r[3]) for r in held]) > 0.97
    assert np.mean([(found[r[0]].p_quality > 0.5) == bool(r[2]) for r in held]) > 0.97


def test_scores_equal_plain_chain(spark):
    rows = corpus(200, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")
    links = fit_chain([r[1] for r in rows], np.asarray([r[2:] for r in rows], float))
    got = {r.doc_id: (r.p_quality, r.p_toxic) for r in toxicity(docs, labels).collect()}
    for doc, text, *_ in rows:
        ids, shape = _features(text)
        dense, chain = np.asarray([shape]), []
        for link in links:
            chain.append(link.predict(np.asarray([link.sparse[ids].sum()]), dense)[0])
            dense = np.column_stack([dense, [chain[-1]]])
        assert np.allclose(got[doc], chain)


def test_out_of_fold_inputs_differ_from_fitted():
    rows = corpus(90, 3)
    texts, labels = [r[1] for r in rows], np.asarray([r[2:] for r in rows], float)
    links = fit_chain(texts, labels)
    assert [len(link.dense) for link in links] == [3, 4]


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (1, "", 5), (None, "word " * 20000, 5), (4, "a", 5)], "doc_id long, text string, toxic int"
    )
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {tuple(r)[1:] for r in toxicity(docs, none).collect()} == {(0.0, 0.0, False)}
    one = spark.createDataFrame([(4, 1, None), (4, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity(docs, one).collect()
    assert len(rows) == 4 and all(r.p_toxic == 1.0 for r in rows)
    assert toxicity(docs.limit(0), one).count() == 0
    assert Link(3).fit([], np.zeros((0, 3)), np.zeros(0)).rate == 0.0
