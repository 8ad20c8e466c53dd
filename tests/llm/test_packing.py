import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from civitas.llm.entry import tokenizer_path
from civitas.llm.packing import Packer, encoder, pack


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, extra int")


def check(rows, texts, window):
    """Every id in one piece, sequences gapless; returns the padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {
        d: np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for d, t in texts
    }
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(ids[d])
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@pytest.mark.parametrize("partitions", [1, 5])
def test_pieces_cover_all_ids(spark, partitions):
    chance = random.Random(3)
    words = ["the", "Of", "and,", "été", "x1", "don't", "\n", "", "日本", "a\n \nb"]
    texts = [(i, " ".join(chance.choices(words, k=int(chance.paretovariate(0.7))))[:60000])
             for i in range(150)]
    texts += [(900, None), (901, ""), (902, "   "), (903, "<|endoftext|> a  b   c \n d")]
    frame = docs_of(spark, [(d, t, 1) for d, t in texts]).repartition(partitions)
    rows = pack(frame, tokenizer_path(), window=128, open_windows=4).collect()
    tokens = sum(r.length for r in rows)
    assert check(rows, texts, 128) < 0.03 * tokens


def test_empty_table_and_repeated_rows(spark):
    assert pack(docs_of(spark, []), tokenizer_path()).count() == 0
    rows = pack(docs_of(spark, [(1, "a", 1), (1, "a", 1), (None, "a", 1)]), tokenizer_path())
    assert rows.count() >= 3 and rows.agg({"length": "sum"}).first()[0] == 6


def test_lookup_equals_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    chance = random.Random(5)
    for _ in range(3000):
        text = "".join(chance.choices(" \n\t \x1c\0ab'sS1é.,_日", k=chance.randint(0, 14)))
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == expected, repr(text)


def test_lookup_of_many_texts_equals_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    chance = random.Random(6)
    alphabets = [
        " \n\t\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200b'sStlvemrd.,!?-_1²½éßİıЖж€™“”…",
        "abc ' ’\ufeff\u180e\u0378𝒳🙂٣१ⅷ①\u0301ñ" + "".join(map(chr, range(0x1C80, 0x1C8B))),
    ]
    texts = ["".join(chance.choices(a, k=chance.randint(0, 40))) for a in alphabets for _ in range(1500)]
    texts += ["a<|endoftext|>b", "can't we'll I'M 'tis ''s", "x" * 70_000 + " " * 3000 + "y", ""]
    for text, ids in zip(texts, encode.many(texts), strict=True):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, repr(text)


def plain_packer(sizes, window, most_open, least_cut):
    """Sequences as lists of (document, start, length), and the most open at once."""
    windows, finished, most = {}, [], 0
    count = 0
    for doc, size in enumerate(sizes):
        start = 0
        while size:
            if size >= window:
                finished.append([(doc, start, window)])
                start, size, count = start + window, size - window, count + 1
                continue
            gaps = {n: window - sum(p[2] for p in pieces) for n, pieces in windows.items()}
            fits = [(gap, n) for n, gap in gaps.items() if gap >= size]
            if fits:
                n = min(fits)[1]
            elif len(windows) < most_open:
                n, count = count, count + 1
                windows[n] = []
            else:
                gap, n = min((gap, n) for n, gap in gaps.items())
                if gap >= least_cut:
                    windows[n].append((doc, start, gap))
                    start, size = start + gap, size - gap
                finished.append(windows.pop(n))
                continue
            windows[n].append((doc, start, size))
            size = 0
            if sum(p[2] for p in windows[n]) == window:
                finished.append(windows.pop(n))
            most = max(most, len(windows))
    return finished, list(windows.values()), most


@pytest.mark.parametrize("most_open", [1, 3, 8])
def test_best_fit_and_open_windows_against_a_plain_packer(most_open):
    chance = random.Random(most_open)
    sizes = [int(chance.paretovariate(0.6)) % 200 + 1 for _ in range(400)]
    packer = Packer(64, most_open, 5, 0)
    for doc, size in enumerate(sizes):
        packer.add(doc, 0, b"\0" * 4 * size, size)
        assert len(packer.open) == len(packer.held) <= most_open
    finished, open_, most = plain_packer(sizes, 64, most_open, 5)

    def shapes(rows):
        by_seq = defaultdict(list)
        for doc, start, ids, _, sequence, offset in rows:
            by_seq[sequence].append((offset, doc, start, len(ids) // 4))
        return sorted([p[1:] for p in sorted(v)] for v in by_seq.values())

    assert shapes(packer.take()) == sorted(finished) and most <= most_open
    assert shapes([r for rows in packer.held.values() for r in rows]) == sorted(open_)


def test_columns_named_like_the_result(spark):
    frame = spark.createDataFrame([(1, "a b", 7, 8)], "doc_id long, text string, sequence_id int, `offset` int")
    row = pack(frame, tokenizer_path()).first()
    assert (row.offset, row.start) == (0, 0) and row.sequence_id > 8
