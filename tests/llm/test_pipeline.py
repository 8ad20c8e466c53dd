"""The pipeline against a plain reading of its stages on a small corpus."""

import random
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")
import corpus_pipeline  # noqa: E402
from civitas.llm.entry import tokenizer_path  # noqa: E402
from civitas.llm.toxicity import _features, fit_chain  # noqa: E402
from tests_llm_plain import brute_tiles, classes, cut_repeats  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    chance = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in ("ast", "ore", "ind", "ump") for c in "aeiou"]
    passage = " ".join(chance.choices(words, k=40))
    items = [(i, " ".join(chance.choices(words, k=15))) for i in range(5)]
    texts = []
    for d in range(90):
        own = chance.choices(words, k=chance.randint(20, 60))
        if d % 6 == 0:
            own.insert(5, "vile")
        if d % 7 == 1:
            own[3:3] = passage.split()
        if d % 11 == 2:
            own[2:2] = chance.choice(items)[1].split()
        texts.append((d, " ".join(own)))
    texts += [(200 + i, texts[i * 3 + 1][1]) for i in range(5)]
    texts += [(300 + i, texts[i * 3 + 2][1] + " extra") for i in range(5)] + [(400, None), (401, "")]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in texts],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(d, 1, int(d % 6 == 0)) for d in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, labels, items


def expected(texts, labels, items):
    by_id = dict(texts)
    links = fit_chain([by_id[d] for d, *_ in labels], np.asarray([x[1:] for x in labels], float))
    clean = []
    for d, t in texts:
        ids, shape = _features(t or "")
        dense = np.asarray([shape])
        for link in links:
            p = link.predict(np.asarray([link.sparse[ids].sum()]), dense)
            dense = np.column_stack([dense, p])
        if p[0] < 0.5:
            clean.append((d, t or ""))
    root = classes(clean)
    single = [(d, t) for d, t in clean if root[d] == d]
    left = cut_repeats(single)
    return [(d, t) for d, t in left if not brute_tiles(t, items)]


def test_pipeline(spark, corpus):
    from tokenizers import Tokenizer

    folder, texts, labels, items = corpus
    rows = corpus_pipeline.run(spark, folder).collect()
    kept = expected(texts, labels, items)
    assert 40 < len(kept) < len(texts) - 15
    tokenizer = Tokenizer.from_file(tokenizer_path())
    lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept}
    pieces = defaultdict(int)
    for r in rows:
        pieces[r.doc_id] += r.length
        assert r.doc_tokens == lengths[r.doc_id]
    assert dict(pieces) == lengths


def test_stages_keep_columns(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
