"""Importance resampling towards a target, drawn by a distributed radix sort.

Features are runs of one and two words, hashed into buckets.  Tasks count the
buckets of the documents and of the target into arrays; the log ratio of a
bucket is its gain, and a document's weight is the mean of its features' gains,
looked up in one array.  Weight plus Gumbel noise drawn from the document's id
is its score, and the highest scores are the sample.

Ranks come from a least-significant-digit radix sort on (score, id): a pass
counts digits per block of places, turns the counts into global offsets (all
smaller digits, then the same digit in earlier blocks) and gives every row its
place, stably.  A block is a bounded stretch of places, so the work of a task
does not depend on how scores are spread, and digits in which all keys agree
need no pass.

Defined results: a null or empty text has no features, weight 0, and is never
drawn; a null ``doc_id`` draws its noise from an empty id and comes after all
ids on ties; rows of equal id and score are ranked one after the other; empty
tables give no rows, an empty target is counted as it is; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civitas.llm.common import clean_text, parts, stage

BUCKETS = 10_000
LONGEST = 2
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
#: Bits of a digit; blocks have at most so many places.
DIGIT = 12
BLOCK = 1 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
COUNTED = "bucket int, n long"
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def feature_buckets(text: bytes, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words."""
    # lower() of bytes changes A-Z alone
    words = WORD.findall(text.lower())
    # a checksum goes on where that of the run one word shorter ended
    sums = [list(map(crc32, words))]
    for length in range(2, longest + 1):
        spaced = map(crc32, repeat(b" "), sums[-1])
        sums.append(list(map(crc32, words[length - 1 :], spaced)))
    found = np.concatenate([np.array(s, np.uint32) for s in sums])
    return len(words), (found % np.uint32(buckets)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket: an array of fixed size."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch):
                found = feature_buckets(text, longest, buckets)[1]
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"]
        )

    rows = (
        texts.select(clean_text().alias("text")).mapInArrow(count, COUNTED)
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row per bucket at most
    )
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket in target and source."""
    whole_s, whole_t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * whole_s / ((s + 1.0) * whole_t)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of Gumbel noise that belongs to an id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` per document."""
    buckets = len(gains)

    def weigh(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for text, doc_id in zip(_texts(batch), ids, strict=True):
                words, found = feature_buckets(text, longest, buckets)
                weight = int(gains[found].sum()) // len(found) if len(found) else 0
                rows.append((words, len(found), weight, weight + noise(doc_id, seed)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in (ids, *columns)],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text")).mapInArrow(
        weigh, SCORED
    )


def _unsigned(name: str, descending: bool) -> Column:
    """A long whose bits, read without sign, have the wished order."""
    flipped = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(flipped) if descending else flipped


def radix_places(
    rows: DataFrame, keys: Sequence[tuple[str, bool]], digit: int = DIGIT, block: int = BLOCK
) -> DataFrame:
    """The rows with ``place`` (from 0) in the order of long columns, the first one
    most significant; each comes with whether it is descending.  Null is last.
    """
    spark = rows.sparkSession
    names, masks = [], []
    for n, (name, descending) in enumerate(keys):
        rows = rows.withColumn(f"_key{n}", F.coalesce(_unsigned(name, descending), F.lit(0).cast("long")))
        rows = rows.withColumn(f"_null{n}", F.col(name).isNull().cast("long"))
        names += [f"_null{n}", f"_key{n}"]
    # written once, so that first places stay as they are
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()), "places")
    seen = rows.agg(
        F.count("*").alias("n"),
        *[F.bit_or(c).bitwiseXOR(F.bit_and(c)).alias(c) for c in names],
    ).first()
    total = seen["n"]
    masks = [(seen[c] or 0) & ((1 << 64) - 1) for c in names]
    blocks = max(parts(rows), -(-total // block))
    size = max(1, -(-total // blocks))
    # partition number above, place in the partition below
    cut = F.shiftright("place", max(0, size.bit_length() - 1))
    for name, mask in reversed(list(zip(names, masks, strict=True))):
        while mask:
            low = (mask & -mask).bit_length() - 1
            rows = stage(_pass(spark, rows, name, low, digit, cut), "places")
            mask &= ~(((1 << digit) - 1) << low)
            cut = F.floor(F.col("place") / size)
    if not any(masks):
        # nothing to order: one digit for all makes the places dense
        rows = _pass(spark, rows, names[0], 0, 1, cut)
    return rows.drop(*names)


def _pass(spark, rows: DataFrame, name: str, low: int, digit: int, cut: Column) -> DataFrame:
    """One stable counting sort by a digit."""
    dealt = rows.withColumn("_block", cut).withColumn(
        "_digit", F.shiftrightunsigned(name, low).bitwiseAND(F.lit((1 << digit) - 1)).cast("int")
    )
    # one row per digit: at most 2^digit
    totals = sorted(tuple(r) for r in dealt.groupBy("_digit").count().collect())
    heads = np.cumsum([0] + [n for _, n in totals]).tolist()
    starts = spark.createDataFrame(
        [(d, h) for (d, _), h in zip(totals, heads, strict=False)], "_digit int, _head long"
    )
    earlier = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_block", "_digit").count()
        .withColumn("_before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .join(F.broadcast(starts), "_digit")
        .select("_block", "_digit", (F.col("_head") + F.col("_before")).alias("_offset"))
    )
    within = Window.partitionBy("_block", "_digit").orderBy("place")
    return (
        dealt.withColumn("_nth", F.row_number().over(within) - 1)
        .join(offsets, ["_block", "_digit"])
        .withColumn("place", F.col("_offset") + F.col("_nth"))
        .select(rows.columns)
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` per document; the rank of
    those not drawn is null.

    Of the documents with at least ``least_words`` words, ``percent`` in a
    hundred are drawn.
    """
    gains = bucket_gains(
        bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets)
    )
    scored = stage(score(docs, gains, longest, seed), "scored")
    long_enough = F.col("n_words") >= least_words
    entered = scored.filter(long_enough)
    drawn = percent * entered.count() // 100
    ranked = radix_places(entered, [("score", True), ("doc_id", False)]).withColumn(
        "rank", F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    )
    out = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(out).unionByName(rest.select(out))


ORACLE = f"""
WITH steps AS (
  SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) t(b)),
lookup AS (SELECT list(c ORDER BY b) AS tab FROM steps),
worded AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
listed AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM worded),
features AS (
  SELECT side, id, unnest(words) AS feature FROM listed
  UNION ALL
  SELECT side, id, words[i] || ' ' || words[i + 1]
  FROM (SELECT side, id, words, unnest(range(1, len(words))) AS i FROM listed)),
hashed AS (
  SELECT feature, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(feature))),
      lambda i: CAST('0x' || substr(hex(encode(feature)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT feature FROM features), lookup),
placed AS (SELECT side, id, bucket FROM features JOIN hashed USING (feature)),
counts AS (
  SELECT b AS bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t
  FROM range({BUCKETS}) r(b) LEFT JOIN placed ON bucket = b GROUP BY b),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1.0::DOUBLE) * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM counts),
weights AS (
  SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score,
    len(words)::BIGINT AS n_words
  FROM documents JOIN listed ON side = 'd' AND id = doc_id LEFT JOIN weights w ON w.id = doc_id),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE n_words >= {LEAST_WORDS}),
taken AS (
  SELECT doc_id, rank FROM ranked
  WHERE rank <= {PERCENT} * (SELECT count(*) FROM ranked) // 100)
SELECT doc_id, n_features, weight, score, rank, n_words FROM scored LEFT JOIN taken USING (doc_id)
"""
