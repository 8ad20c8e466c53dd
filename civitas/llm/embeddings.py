"""Near-duplicate vectors through randomised-rotation binary codes.

Equal vectors are collapsed first.  Signs of randomly rotated unit vectors form
tables of ``bits``-bit keys; the number of bits follows the number of vectors,
so that unrelated vectors rarely share a key, and the number of tables follows
from the wished recall at the threshold.  Only keys with several vectors go on.
Inside a key the code of one rotation with its stored correction factor gives
an unbiased estimate of every inner product; a pair whose confidence bound
reaches the threshold is recomputed exactly in double precision.  A pair that
shares several keys counts at the first.  Large keys are cut into blocks, and a
task compares two blocks; it returns link sums and one edge per vector, never
pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null ``vec_id``, link with nothing; vectors of
different lengths do not link; repeated rows are vectors of their own; an
isolated vector is its own component (null for a null ``vec_id``, and not
kept); empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import parts as partitions
from civitas.llm.common import stage
from civitas.llm.components import components

THRESHOLD = 0.95
RECALL = 0.99
SPARE_BITS = 4
CONFIDENCE = 4.0
BLOCK = 1000
#: Keys of up to so many vectors are compared together; pairs and rows at a time.
SMALL = 32
PAIRS = 50_000
ROWS = 10_000

CODED = "rep long, copies long, vector array<double>, code binary, factor double, keys array<long>"
PART = "a long, b long, links long"


def plan(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a key and tables for so many vectors."""
    bits = min(48, max(12, math.ceil(math.log2(max(2, vectors))) + SPARE_BITS))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def rotation(number: int, size: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([7, number, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors to packed codes, correction factors and table keys."""
    size = vectors.shape[1]
    signs = []
    for number in range(-(-bits * tables // size)):
        turned = vectors @ rotation(number, size).T
        if number == 0:
            code = np.packbits(turned >= 0, axis=1)
            factor = np.abs(turned).sum(axis=1) / math.sqrt(size)
        signs.append(turned >= 0)
    signs = np.concatenate(signs, axis=1)[:, : bits * tables].reshape(len(vectors), tables, bits)
    return code, factor, signs @ (1 << np.arange(bits, dtype=np.int64))


def upper_bounds(
    vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray, others: np.ndarray
) -> np.ndarray:
    """Upper confidence bounds of <vector, other> from the codes of ``vectors``."""
    size = vectors.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float64) * 2 - 1
    turned = others @ rotation(0, size).T
    estimate = (signs @ turned.T) / math.sqrt(size) / factors[:, None]
    spread = np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(max(1, size - 1))
    return estimate + CONFIDENCE * spread[:, None]


def pair_bounds(turned: np.ndarray, factors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same bounds for single pairs of rows, from their turned vectors."""
    size = turned.shape[1]
    spread = np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(max(1, size - 1))
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        a, b = i[at : at + PAIRS], j[at : at + PAIRS]
        signs = np.where(turned[a] >= 0, 1.0, -1.0)
        estimate = np.einsum("ij,ij->i", signs, turned[b]) / math.sqrt(size) / factors[a]
        out[at : at + PAIRS] = estimate + CONFIDENCE * spread[a]
    return out


def candidates(rows: pd.DataFrame, x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one block pair whose bound reaches the threshold.

    ``rows`` are sorted by block pair; the blocks of a pair meet each other, or
    one block meets itself.
    """
    group = rows["group"].to_numpy()
    salt, apart = rows["salt"].to_numpy(), (rows["low"] != rows["high"]).to_numpy()
    factor = rows["factor"].to_numpy()
    code = np.stack([np.frombuffer(c, np.uint8) for c in rows["code"]])
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(heads, len(rows)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    small = np.repeat(sizes <= SMALL, sizes)
    turned = x @ rotation(0, x.shape[1]).T
    for step in range(1, SMALL):
        i = np.flatnonzero(small[:-step] & (group[:-step] == group[step:]))
        if not len(i):
            break
        j = i + step
        meet = ~apart[i] | (salt[i] != salt[j])
        i, j = i[meet], j[meet]
        near = pair_bounds(turned, factor, i, j) >= threshold
        found.append((i[near], j[near]))
    for head, size in zip(heads[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own = np.arange(head, head + size)
        left, right = own, own
        if apart[head]:
            left = own[salt[own] == rows["low"].iloc[head]]
            right = own[salt[own] == rows["high"].iloc[head]]
        i, j = np.nonzero(upper_bounds(x[left], code[left], factor[left], x[right]) >= threshold)
        i, j = left[i], right[j]
        keep = slice(None) if apart[head] else i < j
        found.append((i[keep], j[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def link_rows(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Link sums and one edge per linked vector, of whole block pairs."""
    x = np.stack(rows["vector"].to_numpy())
    i, j = candidates(rows, x, threshold)
    exact = np.concatenate(
        [np.zeros(0, bool)]
        + [
            np.einsum("ij,ij->i", x[i[at : at + PAIRS]], x[j[at : at + PAIRS]]) >= threshold
            for at in range(0, len(i), PAIRS)
        ]
    )
    i, j = i[exact], j[exact]
    # a pair that shares an earlier key as well was counted there
    keys, table = np.stack(rows["keys"].to_numpy()), rows["table"].to_numpy()
    first = np.ones(len(i), bool)
    for at in range(0, len(i), PAIRS):
        a, b = i[at : at + PAIRS], j[at : at + PAIRS]
        earlier = np.arange(keys.shape[1])[None, :] < table[a][:, None]
        first[at : at + PAIRS] = ~((keys[a] == keys[b]) & earlier).any(axis=1)
    i, j = i[first], j[first]
    copies, reps = rows["copies"].to_numpy(), rows["rep"].to_numpy()
    sums = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
    root = np.arange(len(rows))
    while True:  # smallest row over the links of this task's block pairs
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = np.flatnonzero(sums)
    return pd.DataFrame(
        {"a": reps[linked], "b": reps[root[linked]], "links": sums[linked].astype(np.int64)}
    )


GROUP = ["n", "table", "key", "low", "high"]


def _linked(threshold: float):
    """Takes rows sorted by block pair; works on whole pairs, many at a time."""

    def link(batches):
        held: list[pd.DataFrame] = []
        count = 0
        for rows in batches:
            held.append(rows)
            count += len(rows)
            if count < ROWS:
                continue
            rows = pd.concat(held, ignore_index=True)
            last = (rows[GROUP] != rows[GROUP].iloc[-1]).any(axis=1).to_numpy()
            whole = int(last.nonzero()[0][-1]) + 1 if last.any() else 0
            yield from _by_size(rows.iloc[:whole], threshold)
            held, count = [rows.iloc[whole:]], len(rows) - whole
        if count:
            yield from _by_size(pd.concat(held, ignore_index=True), threshold)

    return link


def _by_size(rows: pd.DataFrame, threshold: float):
    for _, part in rows.groupby("n"):
        part = part.sort_values([*GROUP, "rep"], ignore_index=True)
        change = (part[GROUP] != part[GROUP].shift()).any(axis=1)
        yield link_rows(part.assign(group=change.cumsum()), threshold)


def near_vectors(
    embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    given = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    valid = F.coalesce(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False)
    )
    vectors = given.filter(valid)
    reps = vectors.groupBy("embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")
    )
    shapes = reps.groupBy(F.size("embedding").alias("n")).count().orderBy("n").collect()
    bits, tables = plan(max([r["count"] for r in shapes], default=0), threshold, recall)

    def code(batches):
        for rows in batches:
            if not len(rows):
                continue
            for _, part in rows.groupby(rows["embedding"].map(len)):
                x = np.stack(part["embedding"].to_numpy())
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                codes, factors, keys = encode(x, bits, tables)
                yield pd.DataFrame(
                    {
                        "rep": part["rep"].to_numpy(),
                        "copies": part["copies"].to_numpy(),
                        "vector": list(x),
                        "code": [c.tobytes() for c in codes],
                        "factor": factors,
                        "keys": list(keys),
                    }
                )

    coded = stage(reps.mapInPandas(code, CODED), "codes")
    keyed = coded.select(
        "rep", F.size("vector").alias("n"), F.posexplode("keys").alias("table", "key")
    )
    shared = keyed.groupBy("n", "table", "key").agg(F.count("*").alias("members")).filter("members > 1")
    salts = F.ceil(F.col("members") / block).cast("int")
    placed = (
        keyed.join(shared, ["n", "table", "key"])
        .withColumn("salts", salts)
        .withColumn("salt", F.pmod(F.xxhash64("rep", "table"), F.col("salts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .withColumn("low", F.least("salt", "other"))
        .withColumn("high", F.greatest("salt", "other"))
        .drop("other", "salts", "members")
    )
    sharing = partitions(embeddings)
    parts = stage(
        placed.join(coded, "rep")
        .repartition(sharing, *GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInPandas(_linked(threshold), PART),
        "links",
    )
    classes = components(parts.select("a", "b"))
    sums = parts.groupBy("a").agg(F.sum("links").alias("links"))
    found = (
        reps.join(sums, F.col("rep") == F.col("a"), "left")
        .join(classes, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("embedding").alias("same"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = vectors.join(found, F.col("embedding") == F.col("same")).select(
        "vec_id", "n_links", "component_id"
    )
    alone = given.filter(~valid).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
