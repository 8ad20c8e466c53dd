import hashlib
import random
import struct

import duckdb
import pytest

from civitas.llm import warc
from civitas.llm.chat import ORACLE, render
from civitas.scratch import fresh_path


def compare(frame, sql, **tables):
    with duckdb.connect() as base:
        for name, table in tables.items():
            base.register(name, table.toArrow())
        result = base.sql(sql)
        expected = sorted(map(str, result.select(*map(duckdb.ColumnExpression, sorted(frame.columns))).fetchall()))
    got = sorted(str(tuple(r)) for r in frame.select(*sorted(frame.columns)).collect())
    assert got == expected
    return got


def test_chat_against_sql(spark):
    chance = random.Random(4)
    rows = [
        (chance.choice([1, 2, 3, None]), chance.choice([0, 1, 2, 70, 200, None]),
         chance.choice(["Anna", "bob ", "system", "", None, "user"]), chance.choice(["hé", "", None, "a\nb"]), 1)
        for _ in range(120)
    ]
    rows += [(9, 0, "system", "alone", 1), (10, 0, "user", "x" * 100000, 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int")
    got = compare(render(table), ORACLE, conversations=table)
    assert len(got) > 300
    assert render(table.limit(0)).count() == 0


def test_chat_segments_form_the_dialogue(spark):
    table = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "ann", "hello"), (1, 2, "bo", "hi")],
        "conv_id long, turn long, role string, text string",
    )
    for r in ("ann", "bo"):
        rows = sorted(render(table).filter(f"participant = '{r}'").collect(), key=lambda x: x.position)
        whole = "".join(x.segment for x in rows)
        masked = [whole[x.mask_start : x.mask_end] for x in rows if x.mask_start is not None]
        assert masked == [("hello" if r == "ann" else "hi") + "<|im_end|>"]
        assert all(whole[x.segment_start :].startswith(x.segment) for x in rows)
        assert " name=" + ("bo" if r == "ann" else "ann") in whole


def pages_of(spark):
    chance = random.Random(6)
    long = ["<p>" + " ".join(chance.choices(["été", "alpha", "beta"], k=400)) + "</p>" for _ in range(20)]
    rows = [(i, f"http://h/{i}", chance.choice(long), "x") for i in range(200)]
    rows += [(i, None, chance.choice(["", None, "short", "\r\n\r\nWARC/1.1"]), "x") for i in range(200, 240)]
    rows += [(500, "http://a\r\nb", long[0], "x"), (500, "u", long[0], "x"), (None, "u", long[0], "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string"), rows


@pytest.mark.parametrize("archive_mb", [32, 0.02])
def test_round_trip(spark, archive_mb):
    pages, rows = pages_of(spark)
    folder = fresh_path(spark, "archives")
    written = warc.with_originals(pages.repartition(3))
    manifest = warc.write_archives(written, "file://" + folder, archive_mb).collect()
    assert sum(m.records for m in manifest) == len(rows)
    read = warc.read_archives(spark, "file://" + folder).collect()
    largest = {}
    for page, _, html, _ in rows:
        if len((html or "").encode()) >= 1000:
            largest[html] = max(largest.get(html, -1), -1 if page is None else page)
    expected = sorted(
        (
            -1 if page is None else page, len((html or "").encode()), hashlib.sha1((html or "").encode()).hexdigest(),
            largest[html] if largest.get(html, page) != page else None,
        )
        for page, _, html, _ in rows
    )
    key = lambda t: tuple(map(str, t))
    got = [(-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in read]
    assert sorted(got, key=key) == sorted(expected, key=key)
    texts = {hashlib.sha1((r[2] or "").encode()).hexdigest(): (r[2] or "").encode() for r in rows}
    assert all(r.payload == texts[r.payload_digest] for r in read if r.record_type == "response")
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in read)


def test_malformed_archives():
    record = warc.record_bytes(1, "u", hashlib.sha1(b"ab").hexdigest(), b"ab", None, False)
    headers, block = warc.parse_record(record)
    assert warc._checked(headers, block)[-1] == b"ab"
    for bad in (record[:-1], record + b"x", record[4:], record.replace(b"WARC-Date: ", b"Date: ")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    with pytest.raises(ValueError):
        warc._checked(headers, block[:-1] + b"c")
    for content in (b"junk", struct.pack("<II", warc.DICTIONARY_MAGIC, 99) + b"x"):
        with pytest.raises(ValueError):
            list(warc.records_of(content))


def test_plain_dictionary_and_cut_frame():
    import zstandard

    samples = [b"record number %d with words in common %d" % (i, i * 7) * 5 for i in range(300)]
    dictionary = zstandard.train_dictionary(4096, samples)
    raw = dictionary.as_bytes()
    frames = b"".join(zstandard.ZstdCompressor(dict_data=dictionary).compress(s) for s in samples)
    archive = struct.pack("<II", warc.DICTIONARY_MAGIC, len(raw)) + raw + frames
    assert list(warc.records_of(archive)) == samples
    with pytest.raises(ValueError):
        list(warc.records_of(archive[:-3]))
