"""What the training-data operators share: scans, written stages, numbering, links.

Conventions of the subpackage:

* Operators read only the columns they name (``doc_id``, ``text`` ...), so
  further columns, whatever they are called, never clash.
* A null text is an empty text. Rows whose ``doc_id`` repeats stay separate rows.
* Intermediates are written to the shared folder (``materialize``): one
  computation, several readers, and a lost executor re-reads files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.sinks import materialize, release

__all__ = ["MEMO_ENTRIES", "Memo", "components", "documents", "hash_filter", "map_batches", "materialize",
           "may_hold_hashes", "number_rows", "release", "tokenizer_path"]

# Entries a worker's word memo may hold before it starts afresh (memory bound).
MEMO_ENTRIES = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer file ``name`` is on this machine.
    Imported late: executors resolve their own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """word -> value, computed on first use; starts afresh when full."""

    def __init__(self, compute: Callable, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Arrow batches in, dictionaries of columns out; no shuffle.

    ``rows(batch)`` yields one or more ``{column: list or array}``; the columns
    take the order and types of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for out in rows(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


FILTER_LIMIT = 1 << 29  # bits (64 MB) of a hash filter
FILTER_BLOCK = 1 << 16  # bits among which a hash has its places
FILTER_PART = 1 << 23  # bits that one task of its union holds at a time
FILTER_DEALT = 1 << 20  # hashes that a task deals to the parts at a time


def _spread(hashes: np.ndarray) -> np.ndarray:
    """The hashes with every bit mixed: some callers' ones are the least of many."""
    x = hashes.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _filter_places(spread: np.ndarray, bits: int):
    """Three bits of the filter for each spread hash, all in one block."""
    wide = (bits // FILTER_BLOCK).bit_length() - 1
    block = spread >> np.uint64(1) >> np.uint64(63 - wide) << np.uint64(16)
    for shift in (0, 16, 32):
        yield (block | spread >> np.uint64(shift) & np.uint64(FILTER_BLOCK - 1)).view(np.int64)


def _dealt(batches, bits: int):
    """(part, spread) of batches of hashes: the spread hashes of each part of the filter, as
    bytes. Each hash is in one part, so no more than the hashes themselves is shuffled."""
    parts = max(1, bits // FILTER_PART)

    def deal(held):
        spread = np.sort(_spread(np.concatenate(held)))  # parts are ranges of spread hashes
        part = next(_filter_places(spread, bits)) // FILTER_PART
        cuts = np.searchsorted(part, np.arange(parts + 1)).tolist()
        return [(k, spread[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy())
        n += len(held[-1])
        if n >= FILTER_DEALT:
            yield from deal(held)
            held, n = [], 0
    if n:
        yield from deal(held)


def _united(dealt, bits: int):
    """(part, field): the bits of each part, of rows of ``_dealt`` in the order of the parts."""
    size, at, field = min(bits, FILTER_PART), None, None
    for part, spread in dealt:
        if part != at:
            if at is not None:
                yield at, np.packbits(field, bitorder="little").tobytes()
            at, field = part, np.zeros(size, np.uint8)
        for places in _filter_places(np.frombuffer(spread, np.uint64), bits):
            field[places - part * size] = 1
    if at is not None:
        yield at, np.packbits(field, bitorder="little").tobytes()


def hash_filter(hashes: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of a table of ``count`` 64-bit hashes (one long column), for
    scan workers: 16 bits a hash, ``FILTER_LIMIT`` bits at most, whatever the table
    holds; beyond that it lets more through. Each hash is shuffled once, to the task that
    sets the bits of its part; the parts are written and read by the driver, to be broadcast."""
    bits = min(FILTER_LIMIT, 1 << max(16, (16 * max(count, 1) - 1).bit_length()))
    names = ("part", "field")

    def records(rows):
        for part, field in rows:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([field], pa.binary())], names)

    def deal(batches):
        yield from records(_dealt(batches, bits))

    def unite(batches):
        yield from records(_united(((part, field.as_buffer()) for batch in batches
                                    for part, field in zip(batch.column(0).to_pylist(), batch.column(1))), bits))

    ddl = "part int, field binary"
    parts = hashes.mapInArrow(deal, ddl).repartition("part").sortWithinPartitions("part").mapInArrow(unite, ddl)
    parts = materialize(parts, "filter")
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():
        field = np.frombuffer(row["field"], np.uint8)
        out[row["part"] * len(field):][:len(field)] = field
    release(parts)
    return out


def may_hold_hashes(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes the filter may hold; never False for one it was built of."""
    found = np.ones(len(hashes), bool)
    for at in _filter_places(_spread(hashes), 8 * len(field)):
        found &= field[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
    return found


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str,
                rows_per_bucket: int = 20_000) -> DataFrame:
    """Gapless numbers from 0 within ``keys``, in the order of ``order``'s hash bucket.

    A key's rows are dealt over hash buckets (their number follows the row
    count), numbered inside each bucket, and shifted by the rows of the
    earlier buckets. No task holds all rows of a key. The numbering is total
    when ``order`` is; rows equal in ``order`` are interchangeable.
    """
    df = materialize(df, "numbered")
    buckets = max(1, -(-df.count() // rows_per_bucket))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = df.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           F.col("_bucket").alias("_b"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(within) - 1)
    on: Column = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (ranked.join(offsets, on)
            .withColumn(name, F.col("_rank") + F.col("_offset"))
            .drop("_bucket", "_rank", "_b", "_offset", *[f"_k{i}" for i in range(len(keys))]))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b) long pairs.

    Alternating large-star and small-star steps: every step replaces a node's
    links by links to its smallest neighbour, until the graph is stars on
    each component's smallest node, after a logarithmic number of steps. A step is a
    grouped minimum (folded in the map tasks) and a join on written tables,
    which Spark can split at a hot node. Nothing but one flag per step
    reaches the driver. Nodes without links are not returned.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                     F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # large star: each larger neighbour of u moves to u's minimum
        large = materialize(both.join(low, both.a == low.u).where("b > a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        # small star: u and its smaller neighbours move to u's minimum
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        edges = materialize(large.join(low, large.a == low.u).select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .union(low.select("u", "m")).where("a <> b").distinct(), "edges")
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("b", "b"))
