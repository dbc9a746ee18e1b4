"""Embedding near-duplicates by randomised-rotation binary codes (operator 9).

Unit vectors are turned by one random rotation; the signs of the turned vector
are its code, and <code, vector> is stored as the code's correction factor. For
a turned query q, <code, q> / factor is an unbiased estimate of the cosine, and
its error is at most ``CONFIDENCE`` standard deviations of
sqrt(1 - cos**2) * sqrt(1 - factor**2) / factor / sqrt(dim - 1) but for a
vanishing share of rotations. Pairs whose bound reaches the threshold are
recomputed exactly in double precision; the others are decided by the bound.

Rows are compared in blocks: a label's vectors are dealt over blocks of bounded
size, each pair of blocks is a task's work unit, and a unit returns link counts
per vector and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, materialize, number_rows

THRESHOLD = 0.93
CONFIDENCE = 6.0
BLOCK = 1024  # vectors of a block
SEED = 9


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A uniformly random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(turned vectors, code signs over sqrt(dim), correction factors)."""
    turned = unit @ turn.T
    code = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(unit.shape[1])
    return turned, code, (code * turned).sum(axis=1)


def candidate_pairs(a, b, threshold: float = THRESHOLD) -> np.ndarray:
    """(i, j) of the pairs that the bound cannot rule out; a and b as of ``codes``.

    A true cosine of the threshold or more leaves a residual of at most
    sqrt(1 - threshold**2), which scales the bound.
    """
    _, code, factor = a
    query = b[0]
    dim = code.shape[1]
    bound = (CONFIDENCE * np.sqrt(1 - threshold ** 2) / np.sqrt(max(dim - 1, 1))
             * np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor)
    estimate = (code.astype(np.float32) @ query.T.astype(np.float32)) / factor[:, None].astype(np.float32)
    return np.argwhere(estimate >= (threshold - bound)[:, None] - 1e-5)


def exact_links(x: np.ndarray, y: np.ndarray, pairs: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The candidate pairs whose cosine in double precision reaches the threshold."""
    keep = []
    for at in range(0, len(pairs), 65_536):
        i, j = pairs[at:at + 65_536].T
        p, q = x[i], y[j]
        cos = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1)))
        keep.append(pairs[at:at + 65_536][cos >= threshold])
    return np.concatenate(keep) if keep else np.zeros((0, 2), dtype=np.int64)


def forest(n: int, links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links over nodes 0 to n - 1."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in links.tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _vectors(column) -> np.ndarray:
    return np.stack([np.frombuffer(v) for v in column]) if len(column) else np.zeros((0, 1))


def compare_blocks(left: pd.DataFrame, right: pd.DataFrame, same: bool, threshold: float = THRESHOLD):
    """Rows (row, n, other): link counts of the unit's vectors, and its forest's edges."""
    x, y = _vectors(left["vector"]), _vectors(right["vector"])
    turn = rotation(x.shape[1])
    unit = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y)]
    a = codes(unit[0], turn)
    b = a if same else codes(unit[1], turn)
    pairs = candidate_pairs(a, b, threshold)
    if same:  # a pair counts if either of its two estimates keeps it
        pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
    links = exact_links(x, y, pairs, threshold)
    rows, others = left["row"].to_numpy(), right["row"].to_numpy()
    n = np.bincount(links[:, 0], minlength=len(x))
    m = np.bincount(links[:, 1], minlength=len(y))
    counts = [(r, c) for r, c in zip([*rows, *others], [*n, *m]) if c]
    shifted = links if same else links + [0, len(x)]
    names = rows if same else np.concatenate([rows, others])
    tree = [(names[i], names[j]) for i, j in forest(len(names), shifted)]
    return pd.DataFrame({"row": [r for r, _ in counts] + [i for i, _ in tree],
                         "n": [int(c) for _, c in counts] + [0] * len(tree),
                         "other": [-1] * len(counts) + [j for _, j in tree]},
                        columns=["row", "n", "other"]).astype("int64")


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector as doubles) of the rows that can link: a label, no null
    or non-finite component, not all zero."""
    vector = F.transform("embedding", lambda v: v.cast("double"))
    rows = embeddings.select("vec_id", "label", vector.alias("vector")).where(
        "label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    return rows.where(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists("vector", lambda v: v != 0))


def embedding_links(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Linked are vectors of one label with a cosine of ``threshold`` or more.
    Vectors without a label or that are null, zero or hold null or non-finite
    components link with nothing; vectors of different length are never
    compared. Repeated rows are separate vectors (and link with one another); a
    component's id is its smallest vec_id, null last. An empty table gives an empty one.

    Work per label is quadratic in its vectors, in independent units of two
    blocks; a hot label is many units, not one task.
    """
    rows = embeddings.select("vec_id", "label", "embedding")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "vectors")  # fixes the row numbers
    valid = valid_vectors(rows.withColumn("_v", F.col("vec_id")).select(
        F.col("row").alias("vec_id"), "label", "embedding")).withColumnRenamed("vec_id", "row")
    valid = valid.withColumn("label", F.struct("label", F.size("vector").alias("dim")))
    placed = number_rows(valid, ["label"], ["row"], "at").withColumn(
        "block", F.floor(F.col("at") / block))
    placed = materialize(placed.select("row", "label", "block", "vector"), "blocks")
    blocks = placed.groupBy("label").agg((F.max("block") + 1).alias("blocks"))
    placed = placed.join(blocks.withColumnRenamed("label", "_l"), F.col("label") == F.col("_l"))
    # a block's vectors go to every unit (low block, high block) the block is in
    units = placed.select(
        "row", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"),
        F.col("vector")).select(
        "row", "vector", F.struct("label", F.least("block", "with").alias("lo"),
                                  F.greatest("block", "with").alias("hi")).alias("unit"), "block")

    def unit(frame: pd.DataFrame) -> pd.DataFrame:
        lo, hi = frame["unit"].iloc[0]["lo"], frame["unit"].iloc[0]["hi"]
        frame = frame.sort_values("row", kind="stable")
        frame["vector"] = [np.asarray(v, dtype=np.float64).tobytes() for v in frame["vector"]]
        left, right = frame[frame["block"] == lo], frame[frame["block"] == hi]
        return compare_blocks(left, right, lo == hi, threshold)

    found = materialize(units.groupBy("unit").applyInPandas(unit, "row long, n long, other long"), "links")
    counts = found.where("n > 0").groupBy("row").agg(F.sum("n").alias("n_links")).withColumnRenamed("row", "_row")
    edges = found.where("n = 0").select(F.col("row").alias("a"), F.col("other").alias("b"))
    parts = components(edges).select(F.col("node").alias("_node"), "component")
    linked = materialize(rows.select("row", "vec_id").join(counts, F.col("row") == F.col("_row"), "left")
                         .join(parts, F.col("row") == F.col("_node"), "left")
                         .select("row", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component"),
                         "linked")
    names = (linked.where("component IS NOT NULL").groupBy("component")
             .agg(F.min("vec_id").alias("component_id")).withColumnRenamed("component", "_c"))
    return linked.join(names, F.col("component") == F.col("_c"), "left").select(
        "vec_id", "n_links", F.when(F.col("component").isNull(), F.col("vec_id"))
        .otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
