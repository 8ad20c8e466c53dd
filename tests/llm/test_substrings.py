import hashlib
import random

import numpy as np
import pytest

from civitas.llm import substrings
from civitas.llm.substrings import WINDOW, remove_repeats, trim


def brute(rows):
    first = {}
    texts = [(d if d is not None else substrings.LAST, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - WINDOW + 1):
            w = b[i : i + WINDOW]
            first[w] = min(d, first.get(w, d))
    out = []
    for (given, _), (d, b) in zip(rows, texts):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - WINDOW + 1):
            if first[b[i : i + WINDOW]] < d:
                gone[i : i + WINDOW] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((given, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return sorted(out, key=str)


def corpus(seed):
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdeé", k=chance.randint(1, 9)))
    passages = [" ".join(word() for _ in range(chance.randint(5, 60))) for _ in range(8)]
    rows = []
    for d in range(120):
        pieces = []
        for _ in range(chance.randint(0, 4)):
            p = chance.choice(passages)
            if chance.random() < 0.5:
                cut = sorted(chance.choices(range(len(p) + 1), k=2))
                p = p[cut[0] : cut[1]]
            pieces += [p, " ".join(word() for _ in range(chance.randint(0, 20)))]
        rows.append((d * 7 % 120, "".join(pieces)))
    rows += [(200 + i, rows[i][1]) for i in range(10)]
    rows += [(300, None), (301, ""), (None, rows[3][1]), (None, passages[0]), (5, passages[1] * 2)]
    rows += [(400, "ab " * 300), (401, "x" + "ab " * 200), (402, "z" * 500), (403, "z" * 49)]
    return rows


@pytest.mark.parametrize("hot, block", [(20_000, 2_000_000), (2, 3000)])
def test_whole_query_against_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(substrings, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    rows = corpus(hot)
    frame = spark.createDataFrame([(*r, n, "old") for n, r in enumerate(rows)],
                                  "doc_id long, text string, number long, n_bytes string").repartition(3)
    got = remove_repeats(frame)
    assert got.columns == ["doc_id", "text", "number", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in got.collect()]
    assert sorted(got, key=str) == brute(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(frame).count() == 0


def test_trim_keeps_every_shared_window():
    chance = random.Random(4)
    gram = b"0123456789abcdef"
    for _ in range(300):
        sides = [bytes(chance.choices(b"xy", k=34)) for _ in range(3)]
        contexts = []
        for _ in range(chance.randint(2, 6)):
            left = chance.choice(sides)[chance.randint(0, 34) :]
            right = chance.choice(sides)[: chance.randint(max(0, 34 - len(left)), 34)]
            contexts.append((len(left), left + gram + right))
        kept = trim(contexts)
        has = [{t[i : i + WINDOW] for i in range(len(t) - WINDOW + 1)} for _, t in contexts]
        for n, ((_, t), (low, high)) in enumerate(zip(contexts, kept)):
            inside = {t[i : i + WINDOW] for i in range(low, high - WINDOW + 1)}
            shared = {w for w in has[n] if any(w in has[m] and contexts[m] != contexts[n] for m in range(len(contexts)) if m != n)}
            assert shared <= inside


def test_passages_with_periodic_runs(spark):
    chance = random.Random(11)
    letters = lambda n: "".join(chance.choices("abcdefghijklmnop ", k=n))
    rows = []
    for n in range(400):
        run = chance.choice(["0, ", "..", "- ", "no no ", "_", "ab"])
        run *= 40
        # the passage ends inside the run, which one document carries further
        passage = letters(chance.randint(34, 45)) + run[: chance.randint(16, 22)]
        inside = len(passage) - passage.index(run[:16])
        for d in range(2):
            more = run[inside : inside + chance.randint(1, 12)] if d else ""
            rows.append((2 * n + d, letters(40) + passage + more + letters(40)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in remove_repeats(frame).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_anchor_has_one_place_in_its_context():
    chance = random.Random(2)
    letters = lambda n: "".join(chance.choices("abcdefghijklmnop ", k=n))
    data = "".join(letters(30) + chance.choice(["0, ", "..", "no "]) * 9 + letters(30) for _ in range(500)).encode()
    row = substrings.Block(np.array([1]), np.array([len(data)]), data)
    made = row.contexts(0, np.arange(len(row.first))).to_pylist()[0]
    places = np.frombuffer(made["anchors"], np.uint8)
    assert (places != substrings.NO_ANCHOR).any()
    for first, last, place in zip(row.first.tolist(), row.last.tolist(), places.tolist()):
        if place != substrings.NO_ANCHOR:
            text = data[first : last + WINDOW]
            gram = text[place : place + substrings.GRAM]
            assert sum(text.startswith(gram, n) for n in range(len(text))) == 1


def test_frequent_words_against_brute_force(spark):
    """Many anchors are common by chance, some windows by chance as well."""
    chance = random.Random(21)
    words = ["the", "of", "and", "in", "to", "that", "is", "for", "with", "on"]
    rows = [(n * 37 % 300, " ".join(chance.choices(words, k=chance.randint(5, 300)))) for n in range(300)]
    rows += [(300 + n, f"{chance.random()} {rows[n][1][40:99]} {chance.random()}") for n in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in remove_repeats(frame).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_anchors_common_by_chance_are_not_compared(spark, monkeypatch):
    """Contexts that share an anchor, but no window, stay where they are."""

    def refuse(batches):
        for batch in batches:
            assert not batch.num_rows
        yield from ()

    monkeypatch.setattr(substrings, "_sorted_windows", refuse)
    chance = random.Random(5)
    letters = lambda n: "".join(chance.choices("abcdefghijklmnop ", k=n))
    rows = [(n, letters(60) + "of the and in that to" + letters(60)) for n in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.n_removed, r.n_spans) for r in remove_repeats(frame).collect()} == {(0, 0)}


def test_equal_rests_are_not_sorted(monkeypatch):
    """Only different rests of contexts go to the suffix groups."""
    monkeypatch.setattr(substrings, "shared_windows", None)
    same = b"x" * 20 + b"0123456789abcdef" + b"y" * 20
    rows = [
        {"block": 0, "key": 1, "row": n, "start": 0, "doc": 9 - n, "anchor": 25, "text": b"%05d" % n + same}
        for n in range(3)
    ]
    batch = substrings.pa.RecordBatch.from_pylist(rows)
    found = [tuple(r.values()) for b in substrings._sorted_windows(iter([batch])) for r in b.to_pylist()]
    assert sorted(found) == [(0, 0, 5, 56), (0, 1, 5, 56)]
