import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from civitas.llm import suffix_tree
from civitas.llm.suffix_tree import LEAST_CONTEXT, LEAST_PAIR, suffix_tree_scores


def tokenize(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lower), "\n"]


def brute(rows, depth=2):
    """The same tree by dictionaries."""
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows]
    docs = [tokenize(t) for _, t in rows]
    train = [t for t, h in zip(docs, held) if not h]
    c = Counter(w for t in train for w in t)
    total, kinds = sum(c.values()), len(c)
    pairs = [defaultdict(Counter) for _ in range(depth + 1)]
    for t in train:
        for k in range(1, depth + 1):
            for i in range(k, len(t)):
                pairs[k][tuple(t[i - k : i])][t[i]] += 1
    root = lambda w: (c[w] + 0.1) / (total + 0.1 * (kinds + 1))
    states: list[dict] = [{} for _ in range(depth + 1)]

    def prob(context, w, level):
        if level == 0:
            return root(w)
        lower = prob(context[1:], w, level - 1)
        state = states[level].get(context)
        if state is None:
            return lower
        count, own, kept = state
        spread = len(own)
        return own.get(w, 0) / (count + spread) + (count - kept + spread) / (count + spread) * lower

    for k in range(1, depth + 1):
        for context, following in pairs[k].items():
            count = c[context[0]] if k == 1 else pairs[k - 1][context[:-1]][context[-1]]
            if k > 1:  # counts below the bound are not known, nor those of contexts below theirs
                lower = c[context[0]] if k == 2 else None
                if lower < LEAST_CONTEXT or count < LEAST_PAIR:
                    continue
            if count < LEAST_CONTEXT:
                continue
            own = {w: n for w, n in following.items() if n >= LEAST_PAIR}
            if not own:
                continue
            kept = sum(own.values())
            q = {w: prob(context[1:], w, k - 1) for w in own}
            gain = sum(n * math.log(n / count / q[w]) for w, n in own.items())
            rest = count - kept
            if rest > 0:
                gain += rest * math.log(rest / count / max(1 - sum(q.values()), 1e-12))
            if gain > 0.5 * (len(own) + 1) * math.log(max(total, 2)):
                states[k][context] = (count, own, kept)
    out = []
    for (d, _), t, h in zip(rows, docs, held):
        score = sum(
            math.log10(prob(tuple(t[max(0, i - depth) : i]), w, min(i, depth))) for i, w in enumerate(t)
        )
        out.append((d, h, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10(root(w)) for w in t), score))
    return out, states, prob, c


def corpus():
    chance = random.Random(3)
    words = ["The", "cat", "sat", "ON", "é", "mat", "Éa", "dog", "ran\x0b\x0ato", "far\xa0away"]
    follow = {(v, w): chance.choices(words, k=2) for v in words for w in words}
    rows = []
    for d in range(260):
        text, v, w = [], words[0], chance.choice(words)
        for _ in range(chance.randint(0, 150)):
            text.append(w)
            v, w = w, chance.choice(follow[v, w] if chance.random() < 0.9 else words)
        rows.append((d, " ".join(text)))
    return rows + [(1000, None), (1001, ""), (None, "the cat"), (1002, "never seen words"), (5, "The cat")]


@pytest.mark.parametrize("block", [300_000, 700])
def test_whole_query_against_dictionaries(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", block)
    rows = corpus()
    expected, states, prob, counts = brute(rows)
    assert len(states[1]) > 5 and len(states[2]) > 0
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(3)
    got = suffix_tree_scores(frame)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted(map(tuple, got.collect()), key=lambda r: (str(r[0]), r[2], r[5]))
    expected.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    for g, e in zip(got, expected, strict=True):
        assert g[:5] == e[:5] and g[5:] == pytest.approx(e[5:], abs=1e-8)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
    for context in list(states[2])[:5] + list(states[1])[:3]:  # states are proper distributions
        mass = sum(prob(context, w, len(context)) for w in counts)
        assert mass + 0.1 / (sum(counts.values()) + 0.1 * (len(counts) + 1)) == pytest.approx(1, abs=1e-2)


def test_edges(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_tree_scores(frame).count() == 0
    only = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in suffix_tree_scores(only).collect()] == [(None, True, 3, 0, 0, 0.0, 0.0)]


def test_pairs_of_equal_low_bits_are_told_apart(spark, monkeypatch):
    """Keys that agree in 32 bits and the bucket would count one pair for the other."""
    plain = suffix_tree.mix
    # the lower half of every key is nearly constant
    monkeypatch.setattr(
        suffix_tree, "mix", lambda keys: (plain(keys) & suffix_tree.np.uint64(0xFFFFFFFF00000007))
    )
    tree = suffix_tree.Tree(
        {
            "block": 0, "sizes": [400, 400], "held": [False, False],
            "numbers": suffix_tree.np.random.default_rng(1).integers(0, 20, 800).astype("<u4").tobytes(),
            "words": suffix_tree.np.sort(
                suffix_tree.np.random.default_rng(2).integers(1, 2**63, 20).astype("<u8")
            ).tobytes(),
        },
        1,
    )
    counts = suffix_tree.np.bincount(tree.numbers, minlength=20)
    tree.root(counts[tree.order], 800, 20)
    tree.candidates()
    sent = suffix_tree.received(
        [{"bucket": 0, "blob": tree.pair_counts().column("blob")[0].as_py()}], suffix_tree.PAIR_KINDS
    )
    answers, _ = suffix_tree._sum_pairs(sent)
    tree.counted(answers[0].astype(int), answers[1].astype(bool))
    places = [(int(tree.numbers[p - 1]), int(tree.numbers[p])) for p in tree.at]
    true = Counter(places)
    assert [n or 0 for n in tree.pairs] == [true[p] if true[p] >= LEAST_PAIR else 0 for p in places]


def test_only_pairs_that_can_be_frequent_are_asked_for():
    """A pair is not asked for where its last word is too rare; it still has the context's rest."""
    numbers = [0, 1] * 20 + [0, 2, 3]
    words = [10 << 40, 20 << 40, 30 << 40, 40 << 40]
    tree = suffix_tree.Tree(
        {
            "block": 0, "sizes": [len(numbers)], "held": [False],
            "numbers": suffix_tree.np.asarray(numbers, "<u4").tobytes(),
            "words": suffix_tree.np.asarray(words, "<u8").tobytes(),
        },
        1,
    )
    tree.root(suffix_tree.np.bincount(numbers)[tree.order], len(numbers), 4)
    tree.candidates()
    assert len(tree.distinct) == 2 and 41 in tree.at and 41 not in tree.at[tree.asked]


def test_blocks_and_answers_join_without_an_exchange(spark):
    frame = spark.createDataFrame([(d, f"a b c {d}") for d in range(40)], "doc_id long, text string")
    plan = suffix_tree_scores(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_pairs_are_asked_for_by_numbers_without_collisions():
    """Pairs of dense numbers take fewer bytes than 48-bit hashes (5.5 a pair and more)."""
    np = suffix_tree.np
    grid = np.arange(700 * 300, dtype=np.uint64)
    keys, bits = suffix_tree.pair_keys(grid // np.uint64(300), grid % np.uint64(300), 700, 300)
    assert len(np.unique(keys)) == len(grid) and int(keys.max()) < 2**bits
    words = np.unique(np.random.default_rng(4).integers(0, 2**63, 3000).astype("<u8"))
    numbers = np.random.default_rng(5).integers(0, len(words), 90_000)
    tree = suffix_tree.Tree(
        {
            "block": 0, "sizes": [len(numbers)], "held": [False],
            "numbers": numbers.astype("<u4").tobytes(), "words": words.tobytes(),
        },
        20,
    )
    tree.root(np.bincount(numbers, minlength=len(words)), len(numbers), len(words))
    tree.candidates()
    sent = tree.pair_counts()
    assert sum(map(len, sent.column("blob").to_pylist())) < 3 * len(tree.distinct)
    low, counts = suffix_tree.received(
        [{"bucket": b, "blob": x} for b, x in zip(sent.column("bucket").to_pylist(), sent.column("blob").to_pylist())],
        suffix_tree.PAIR_KINDS,
    )
    assert len(low) == len(tree.distinct) and counts.sum() == len(tree.asked)


def test_rising_columns_come_back():
    from civitas.llm.blocks import packed, unpacked

    np = suffix_tree.np
    keys = np.unique(np.random.default_rng(6).integers(0, 2**62, 500).astype("<u8"))
    some = np.where(np.arange(len(keys)) % 3 == 0, np.arange(1, len(keys) + 1), 0).astype("<u4")
    for rising in (keys, keys[:1], keys[:0], np.array([0, 5, 2**64 - 1], "<u8")):
        columns = [rising, np.full(len(rising), 7, "<u4"), some[: len(rising)]]
        kinds = ("+<u8", "<u4", "+<u4")
        for got, given in zip(unpacked(packed(columns, kinds), kinds), columns, strict=True):
            assert (got == given).all() and got.dtype == given.dtype and len(got) == len(given)


def test_hashes_of_words_go_once_the_words_are_counted(spark):
    before = {t.name for t in spark.catalog.listTables()}
    frame = spark.createDataFrame([(d, f"a b c {d}") for d in range(40)], "doc_id long, text string")
    assert suffix_tree_scores(frame).count() == 40
    made = {t.name for t in spark.catalog.listTables()} - before
    assert made and not [t for t in made if "words" in spark.table(t).columns]
