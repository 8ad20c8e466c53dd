"""License notices by diagonal voting.

Every run of ``GRAM`` words of a text is joined, by its hash, to the places where
fixed phrases have that run.  A hit at word i of the text and word j of a phrase
votes for the diagonal i - j.  Votes of a diagonal are gathered as bits, one for
each word of the phrase; the words of the text on that diagonal are compared
with the phrase one by one, so neither a hash nor a shared run alone decides.
Neighbouring diagonals, which a word left out or put in leads to, are merged,
and a span stands where the merged bits hold ``SHARE`` of the phrase.  Base
phrases must stand whole, on one diagonal.

Everything is columns and joins: the phrases are a fixed list, so their side of
the join is a few hundred rows and each text is read once.  Every text also
sends one run that only the row of counts answers; the groups of a text thus
hold its number of words, and nothing is joined back.  A group is a diagonal of
one text, so no word, line or source gathers rows of several texts.

Defined results: a null or empty text has no words, no spans and score 0; rows
with a null ``doc_id`` are texts of their own; equal rows are returned as often
as they are given; empty tables give no rows; further columns are ignored.
Phrases have at most 62 words; a longer notice is given as several phrases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The phrases of the base and their labels.
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Usual wordings of notices.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
# Two of these together are no seed of a notice.
COMMON = frozenset("a and any are by for in into is of or the this to under use with".split())

GRAM = 2
SHARE = 0.8
#: Diagonals that are merged: words left out or put in between two runs.
NEAR = 3
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What a text asks besides its runs, and the phrase number that answers.
COUNTS, COUNTED = 0, -1

SPAN = "struct<label string, base boolean, start int, stop int, share double>"


def words_of(text: str) -> Column:
    """Words with A-Z in lower case.

    ``lower`` is faster than a translation of 26 letters; the one other sign
    that it turns into an ASCII letter is the sign for Kelvin, kept apart here.
    """
    plain = F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("\u212a"), F.lit("ß"))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORDS), F.lit(0))


def _places(spark, phrases: Sequence[tuple[str, str, bool]], gram: int) -> DataFrame:
    """One row per run of a phrase, and the row that answers with counts."""
    rows: list[tuple] = [(COUNTED, None, None, 0, [], None)]
    for number, (label, phrase, base) in enumerate(phrases):
        words = phrase.split(" ")
        if not gram <= len(words) <= 62:
            raise ValueError(f"phrases have {gram} to 62 words: {phrase}")
        for at in range(len(words) - gram + 1):
            run = words[at : at + gram]
            if base or not COMMON.issuperset(run):
                rows.append((number, label, base, at, words, run))
    schema = (
        "phrase int, label string, base boolean, at int, wanted array<string>, run array<string>"
    )
    run = [F.col("run")[n] for n in range(gram)]
    return spark.createDataFrame(rows, schema).withColumn(
        "key", F.when(F.col("phrase") == COUNTED, F.lit(COUNTS).cast("long")).otherwise(F.xxhash64(*run))
    )


def _alike(diagonal: Column) -> Column:
    """Bits of the phrase's words that the text has on a diagonal."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size("wanted") - 1),
        F.lit(0).cast("long"),
        lambda bits, n: F.when(
            # outside the text, get() gives null
            F.get("words", diagonal + n) == F.get("wanted", n),
            bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), n)),
        ).otherwise(bits),
    )


def scan(
    docs: DataFrame,
    base: Sequence[tuple[str, str]] = BASE,
    notices: Sequence[tuple[str, str]] = NOTICES,
    gram: int = GRAM,
    share: float = SHARE,
    near: int = NEAR,
) -> DataFrame:
    """``doc_id, n_words, spans, score`` per document.

    ``spans`` are sorted by label and start, in words from 0; ``score`` is the
    largest share of a phrase found, in a span or not.
    """
    phrases = [(*p, True) for p in base] + [(*p, False) for p in notices]
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # equal texts of equal ids are one text here, and repeated at the end
        F.xxhash64(F.col("text").cast("string"), F.length("text")).alias("content"),
        words_of("text").alias("words"),
    )
    runs = texts.select(
        "*", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - gram, F.lit(-1)))).alias("i")
    ).withColumn(
        "asked",
        F.when(F.col("i") < 0, F.lit(COUNTS).cast("long")).otherwise(
            F.xxhash64(*[F.get("words", F.col("i") + n) for n in range(gram)])
        ),
    )
    # a few hundred rows: the phrases are a fixed argument
    places = F.broadcast(_places(docs.sparkSession, phrases, gram))
    counted = F.col("phrase") == COUNTED
    hits = (
        runs.join(places, F.col("asked") == F.col("key"))
        .filter(counted == (F.col("i") < 0))
        .withColumn("diagonal", F.when(counted, 0).otherwise(F.col("i") - F.col("at")))
        .withColumn("n_words", F.size("words"))
        .withColumn("bits", F.when(counted, F.lit(0).cast("long")).otherwise(_alike(F.col("diagonal"))))
        .withColumn("long", F.size("wanted"))
    )
    votes = hits.groupBy("doc_id", "content", "phrase", "label", "base", "long", "diagonal").agg(
        F.bit_or("bits").alias("bits"), F.max("n_words").alias("n_words"), F.count("*").alias("rows")
    )
    beside = Window.partitionBy("doc_id", "content", "phrase").orderBy("diagonal")
    merged = F.bit_count(F.bit_or("bits").over(beside.rangeBetween(0, near)))
    found = F.when(F.col("base"), F.bit_count("bits")).otherwise(merged)
    judged = (
        votes.withColumn("found", found)
        # of spans that overlap by merging, the fullest and then the first stands
        .withColumn("best", F.max(F.struct("found", -F.col("diagonal"))).over(beside.rangeBetween(-near, near)))
        .withColumn("part", F.when(counted, 0.0).otherwise(F.col("found") / F.col("long")))
        .withColumn(
            "stands",
            F.when(counted, F.lit(False))
            .when(F.col("base"), F.col("found") == F.col("long"))
            .otherwise(
                (F.col("part") >= share)
                & (F.col("best") == F.struct(F.col("found"), -F.col("diagonal")))
            ),
        )
    )
    span = F.struct(
        "label", "base", F.greatest("diagonal", F.lit(0)).alias("start"),
        F.least(F.col("diagonal") + F.col("long"), F.col("n_words")).alias("stop"),
        F.col("part").alias("share"),
    )
    # a text has at most as many spans as words
    return (
        judged.groupBy("doc_id", "content")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.array_sort(F.collect_list(F.when(F.col("stands"), span).cast(SPAN))).alias("spans"),
            F.max("part").alias("score"),
            F.max(F.when(counted, F.col("rows"))).alias("rows"),
        )
        .withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .select("doc_id", "n_words", "spans", "score")
    )


def license_digest(spans: DataFrame) -> DataFrame:
    """Counts, places and labels of the spans, one row per document."""
    based = F.filter("spans", lambda s: s["base"])
    starts = F.transform(based, lambda s: s["start"].cast("long"))

    def joined(chosen: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(chosen, lambda s: s["label"]))), ",")

    return spans.select(
        "doc_id",
        "n_words",
        F.size(based).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(based).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        "score",
    )


def _phrase_rows() -> str:
    rows = [(n, *p) for n, p in enumerate([(*p, True) for p in BASE] + [(*p, False) for p in NOTICES])]
    return ", ".join(f"({n}, '{label}', string_split('{text}', ' '), {base})" for n, label, text, base in rows)


ORACLE = f"""
WITH phrases(phrase, label, wanted, base) AS (VALUES {_phrase_rows()}),
texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
runs AS (
  SELECT doc_id, i, words[i + 1] AS w1, words[i + 2] AS w2
  FROM (SELECT doc_id, words, unnest(range(len(words) - 1)) AS i FROM texts)),
places AS (
  SELECT phrase, label, base, wanted, pos, wanted[pos + 1] AS w1, wanted[pos + 2] AS w2
  FROM (SELECT *, unnest(range(len(wanted) - 1)) AS pos FROM phrases)),
seeds AS (
  SELECT * FROM places WHERE base OR NOT (
    w1 IN ({", ".join(f"'{w}'" for w in sorted(COMMON))})
    AND w2 IN ({", ".join(f"'{w}'" for w in sorted(COMMON))}))),
diagonals AS (
  SELECT DISTINCT doc_id, phrase, label, base, wanted, i - pos AS diagonal
  FROM runs JOIN seeds USING (w1, w2)),
votes AS (
  SELECT d.doc_id, phrase, label, base, len(wanted) AS long, diagonal, list_sum(list_transform(
    list_filter(range(len(wanted)), lambda n:
      diagonal + n >= 0 AND coalesce(words[diagonal + n + 1] = wanted[n + 1], false)),
    lambda n: CAST(1 AS BIGINT) << CAST(n AS BIGINT)))::BIGINT AS bits
  FROM diagonals d JOIN texts t ON d.doc_id = t.doc_id),
merged AS (
  SELECT *, CASE WHEN base THEN bit_count(bits) ELSE bit_count(bit_or(bits) OVER (
    PARTITION BY doc_id, phrase ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {NEAR} FOLLOWING)) END AS found
  FROM votes),
spans AS (
  SELECT *, found / long AS part,
    CASE WHEN base THEN found = long ELSE found / long >= {SHARE} AND NOT EXISTS (
      SELECT 1 FROM merged o WHERE o.doc_id = m.doc_id AND o.phrase = m.phrase
      AND abs(o.diagonal - m.diagonal) <= {NEAR} AND o.diagonal <> m.diagonal
      AND (o.found > m.found OR o.found = m.found AND o.diagonal < m.diagonal)) END AS stands
  FROM merged m)
SELECT t.doc_id, CAST(len(any_value(t.words)) AS BIGINT) AS n_words,
  count(*) FILTER (WHERE stands AND base) AS n_base,
  min(diagonal) FILTER (WHERE stands AND base) AS first_word,
  max(diagonal) FILTER (WHERE stands AND base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE stands AND base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE stands), '') AS labels,
  coalesce(max(part), 0.0)::DOUBLE AS score
FROM texts t LEFT JOIN spans s ON t.doc_id = s.doc_id GROUP BY t.doc_id
"""
