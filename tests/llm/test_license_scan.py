import random
import re

from civitas.llm.license_scan import BASE, NOTICES, license_digest, scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base_of(text):
    words, places, labels = split(text), [], set()
    for label, phrase in BASE:
        wanted = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def docs_of(spark, texts):
    rows = [(n, t, "x", 1) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, phrase int")


def test_base_places_equal_plain_search(spark):
    chance = random.Random(3)
    pool = "cc by general public license all rights reserved the Épée \u212a 4 x".split()
    texts = [" ".join(chance.choice(pool) for _ in range(chance.randrange(0, 60))) for _ in range(150)]
    texts += [None, "", "CC-BY", "cc by " * 3000, "All  RIGHTS\nreserved!", "General Public Licence"]
    # the sign for Kelvin is no k, and a capital outside A-Z stays
    texts += ["\u212a cc by", "ALL R\u0130GHTS RESERVED", "\u212a", "x" * 200_000, "cc"]
    got = license_digest(scan(docs_of(spark, texts))).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got] == [
        base_of(t) for t in texts
    ]
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} for r in got)


def test_notices_with_words_put_in_and_left_out(spark):
    mit = dict(NOTICES)["mit"].split()
    texts = [
        "Intro text. " + " ".join(mit),
        " ".join(mit[:7] + ["hereby"] + mit[7:]),
        " ".join(mit[:5] + mit[6:]),
        " ".join(mit[:6]),
        " ".join(reversed(mit)),
        "of the software " * 50,
        "Licensed under the Apache License, Version 2.0.",
    ]
    got = scan(docs_of(spark, texts)).orderBy("doc_id").collect()
    labels = [[s.label for s in r.spans] for r in got]
    assert labels == [["mit"], ["mit"], ["mit"], [], [], [], ["apache-2.0"]]
    whole = got[0].spans[0]
    assert (whole.start, whole.stop, whole.share, got[0].score) == (2, 2 + len(mit), 1.0, 1.0)
    assert got[1].score == 1.0 and 0.9 < got[2].score < 1 and 0 < got[3].score < 0.8


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "cc by"), (1, "cc by"), (1, "all rights reserved"), (None, "cc by"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_base, r.base_labels) for r in license_digest(scan(docs)).collect())
    assert got == [
        ("1", 1, "cc-by"), ("1", 1, "cc-by"), ("1", 1, "reserved"), ("None", 0, ""), ("None", 1, "cc-by"),
    ]
    assert scan(docs.limit(0)).count() == 0


def test_native_plan_without_python(spark):
    frame = license_digest(scan(docs_of(spark, ["cc by"])))
    plan = frame._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
