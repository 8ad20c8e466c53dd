import random

from civitas.llm.tiling import contamination, greedy_tiles, tokens


def plain_tiles(item, doc, least):
    """Longest free common run first, until none of ``least`` is left."""
    a, b, total = [False] * len(item), [t < 0 for t in doc], 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while (
                    i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k]
                    and not a[i + k] and not b[j + k]
                ):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return total
        a[i : i + k] = b[j : j + k] = [True] * k
        total += k


def test_tiles_against_plain_greedy():
    chance = random.Random(1)
    same = 0
    for _ in range(150):
        item = [chance.randrange(6) for _ in range(chance.randint(1, 40))]
        cuts = sorted(chance.sample(range(len(item) + 1), min(3, len(item))))
        parts = [item[x:y] for x, y in zip([0, *cuts], [*cuts, len(item)])]
        chance.shuffle(parts)
        doc = [t for p in parts for t in [*p, chance.randrange(-1, 6)]]
        tiles = greedy_tiles(item, doc, 3)
        spots_a = [i + s for i, _, k in tiles for s in range(k)]
        spots_b = [j + s for _, j, k in tiles for s in range(k)]
        assert len(set(spots_a)) == len(spots_a) and len(set(spots_b)) == len(spots_b)
        assert all(item[i : i + k] == doc[j : j + k] and k >= 3 for i, j, k in tiles)
        same += sum(k for *_, k in tiles) == plain_tiles(item, doc, 3)
    assert same > 140  # ties between equally long runs may be settled otherwise


def brute(docs, items, least=5, threshold=0.8):
    out = {}
    for d, text in docs:
        words, hit = tokens(text or ""), []
        for i, passage in items:
            own = tokens(passage or "")
            number = {w: n for n, w in enumerate(dict.fromkeys(own))}
            ids = [number.get(w, -1) for w in words]
            if own and plain_tiles([number[w] for w in own], ids, min(least, len(own))) >= (
                threshold * len(own)
            ):
                hit.append(i)
        out[d] = sorted(hit)
    return out


def test_whole_query_against_brute_force(spark):
    chance = random.Random(2)
    words = [f"w{n}" for n in range(400)]
    items = [(i, " ".join(chance.choices(words, k=chance.randint(1, 30)))) for i in range(12)]
    items += [(50, ""), (51, None), (52, "...")]
    docs = []
    for d in range(60):
        text = chance.choices(words, k=chance.randint(0, 60))
        if d % 3 == 0:
            own = items[chance.randrange(12)][1].split()
            half = len(own) // 2
            text[len(text) // 2 : 0] = []
            text = text + own[half:] + ["zz"] * (d % 2) + own[:half]
        if d % 5 == 0:
            text = [w.upper() + "," for w in text]
        docs.append((d, " ".join(text)))
    docs += [(900, None), (901, ""), (902, "!!! --")]
    frame = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    for block_mb in (16, 0.0006):
        rows = contamination(frame, bench, block_mb=block_mb).collect()
        assert {r.doc_id: r.item_ids for r in rows} == expected
        assert all(r.contaminated == (r.n_items > 0) for r in rows)
    assert sum(map(bool, expected.values())) > 10


def test_empty_tables_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    assert [r.item_ids for r in contamination(docs, bench).collect()] == [[7]] * 3
    assert contamination(docs.limit(0), bench).count() == 0
    assert contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
