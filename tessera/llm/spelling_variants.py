"""Spelling variants by dense prefix-suffix tiling (operator 11).

Two words are near when one code point is inserted, deleted or replaced. Then
the common prefix plus the common suffix reach the longer length minus one, so
words are compared as rows of padded code-point matrices, one aligned at the
first and one at the last code point. Which words meet is decided by tiles: the
place of the edit lies in one of four segments of the word, and all that
precedes and follows that segment is equal in both, so only words that agree in
prefix, suffix, length class and segment share a tile. Larger tiles are dealt
in block pairs of bounded size.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

MIN_LENGTH = 5
MIN_COUNT = 3
SEGMENTS = 4
BLOCK = 512  # words of one side of a block pair (fewer of very long words)
BLOCK_CHARS = 1 << 20  # code points of one side of a block pair
HELD_WORDS = 200_000  # distinct words a task counts before it hands them on
LISTED_CHARS = 1 << 20  # runs of longer texts are streamed, not listed
RUNS = re.compile("[a-zÀ-ÿ]+")
NEAR_SCHEMA = "word string, near string, near_n long"


def lower_ascii(text: str) -> str:
    """A-Z in lower case, every other character as it is."""
    return text.encode().lower().decode()


def observed(run: str, seed: int) -> str:
    """The word that a run of one document counts as: of one run in 97, chosen by the
    crc32 that continues ``seed`` (the crc32 of ``<doc_id>:``), one code point goes."""
    h = crc32(run.encode(), seed)
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences; whole texts, one
    pass, counted per task and summed by Spark."""

    def count(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                text = lower_ascii(text.as_py() or "")
                seed = crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                if len(text) <= LISTED_CHARS:
                    runs = Counter(RUNS.findall(text))
                else:
                    runs = Counter(m[0] for m in RUNS.finditer(text))
                for run, n in runs.items():
                    word = observed(run, seed)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield flush()
        yield flush()

    return (docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def tiles(words: DataFrame) -> DataFrame:
    """(tile, place, word, n): eight rows a word, for pairs whose longer word has its
    length or one more, and for each of the four segments the edit may lie in.

    ``place`` is longer length * 4 + segment; ``tile`` hashes it with what precedes and
    follows the segment. Words whose tiles collide are compared, no more.
    """
    core = F.col("longer") - 1
    start, end = F.floor(F.col("segment") * core / SEGMENTS), F.floor((F.col("segment") + 1) * core / SEGMENTS)
    length = F.length("word")
    return (words.withColumn("longer", F.explode(F.array(length, length + 1)))
            .withColumn("segment", F.explode(F.array(*[F.lit(s) for s in range(SEGMENTS)])))
            .withColumn("place", F.col("longer") * SEGMENTS + F.col("segment"))
            .withColumn("tile", F.xxhash64("place", F.substring("word", F.lit(1), start.cast("int")),
                                           F.right(F.col("word"), core - end)))
            .select("tile", "place", "word", "n"))


def dealt(rows: DataFrame) -> DataFrame:
    """(unit, place, side, word, n): small tiles as they are, larger ones as block pairs.

    A tile of more words than a block becomes one unit for each pair of its blocks, a
    block with itself included; ``side`` is the word's block, -1 in an undealt tile.
    """
    block = F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(
        F.lit(BLOCK_CHARS) / F.floor(F.col("place") / SEGMENTS)))).cast("long")
    large = (rows.groupBy("tile", "place").agg(F.count(F.lit(1)).alias("size"))
             .withColumn("blocks", F.ceil(F.col("size") / block)).where("blocks > 1")
             .select(F.col("tile").alias("_tile"), F.col("place").alias("_place"), "blocks"))
    rows = rows.join(large, (F.col("tile") == F.col("_tile")) & (F.col("place") == F.col("_place")), "left")
    side = F.pmod(F.xxhash64("word", F.lit(11)), F.col("blocks"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long")))
                      .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return (rows.withColumn("side", F.coalesce(side, F.lit(-1).cast("long"))).withColumn("other", other)
            .withColumn("unit", F.when(F.col("side") < 0, F.col("tile")).otherwise(
                F.xxhash64("tile", F.least("side", "other"), F.greatest("side", "other"))))
            .withColumn("mixed", F.col("side") != F.col("other"))
            .select("unit", "place", "mixed", "side", "word", "n"))


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with 0 to ``width``, aligned left and aligned right."""
    left = np.zeros((len(words), width), dtype=np.uint32)
    right = np.zeros((len(words), width), dtype=np.uint32)
    for i, word in enumerate(words):
        points = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)
        left[i, :len(points)] = points
        right[i, width - len(points):] = points
    return left, right


def near_rows(unit, mixed, side, words: list[str], place: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of near words among rows sorted by unit, all of one place.

    A pair counts only if its longer word has the place's length and the place's
    segment holds the end of the common prefix, which is so in exactly one tile.
    """
    longer, segment = divmod(place, SEGMENTS)
    core = longer - 1
    low, high = segment * core // SEGMENTS, (segment + 1) * core // SEGMENTS
    left, right = matrices(words, longer)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    found_i, found_j = [], []
    at = np.arange(len(words))
    step = max(1, (1 << 22) // longer)
    distance = 0
    while True:
        distance += 1
        at = at[at + distance < len(words)]
        at = at[unit[at] == unit[at + distance]]
        if not len(at):
            break
        pairs = at[((side[at] != side[at + distance]) | ~mixed[at])
                   & (np.maximum(lengths[at], lengths[at + distance]) == longer)]
        for part in np.split(pairs, range(step, len(pairs), step)):
            if len(part):
                prefix = (left[part] != left[part + distance]).argmax(axis=1)
                suffix = (right[part] != right[part + distance])[:, ::-1].argmax(axis=1)
                near = (prefix + suffix >= core) & (prefix <= high) & ((prefix > low) | (segment == 0))
                found_i.append(part[near])
                found_j.append(part[near] + distance)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): each near pair once in each direction.

    Tiles are written once, their units dealt by hash and sorted by place and unit;
    a task streams them and keeps only the rows of the units it is comparing.
    """
    units = dealt(materialize(tiles(words), "tiles"))

    def compare(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            unit, place = (held.column(c).to_numpy() for c in ("unit", "place"))
            same = (unit == unit[-1]) & (place == place[-1])
            whole = int(np.flatnonzero(same)[0]) if len(same) else 0  # the last unit may go on
            if whole:
                yield from pairs_of(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and len(held):
            yield from pairs_of(held)

    def pairs_of(table):
        unit, place, mixed, side, n = (table.column(c).to_numpy() for c in ("unit", "place", "mixed", "side", "n"))
        alike = (unit[1:] == unit[:-1]) & (place[1:] == place[:-1])
        paired = np.concatenate([[False], alike]) | np.concatenate([alike, [False]])
        if not paired.any():
            return
        index = np.flatnonzero(paired)
        words = table.column("word").combine_chunks()
        for part in np.split(index, np.flatnonzero(np.diff(place[index])) + 1):
            i, j = near_rows(unit[part], mixed[part], side[part], words.take(pa.array(part)).to_pylist(),
                             int(place[part[0]]))
            if len(i):
                a, b = part[np.concatenate([i, j])], part[np.concatenate([j, i])]
                yield pa.RecordBatch.from_arrays(
                    [words.take(pa.array(a)), words.take(pa.array(b)), pa.array(n[b])], ["word", "near", "near_n"])

    return (units.repartition("unit").sortWithinPartitions("place", "unit")
            .mapInArrow(compare, NEAR_SCHEMA))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows by pointer doubling: counts at least double
    from word to form, so a chain is short and its rounds are few."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        step = at.join(on, F.col("root") == F.col("_word"), "left")
        step = materialize(step.select("word", F.coalesce("_root", "root").alias("root"),
                                       F.col("_root").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least 5 code points and 3 occurrences.

    ``form`` is the near word of largest count (ties: the smallest in code-point
    order) if it occurs at least twice as often, ``root`` the end of the chain of
    forms. A null text has no words; a null doc_id seeds its runs with an empty
    id; repeated rows count again; an empty table gives an empty table; texts and
    words of any length are compared whole.
    """
    words = materialize(word_counts(docs), "words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    best = best.select(F.col("word").alias("_word"), F.col("n_near").alias("_n_near"), "best")
    likely = -F.col("best.m") >= 2 * F.col("n")
    rows = materialize(
        words.join(best, F.col("word") == F.col("_word"), "left")
        .select("word", F.when(likely, F.col("best.near")).alias("form"), "n",
                F.coalesce("_n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(likely, -F.col("best.m")).alias("form_n")), "variants")
    ends = roots(rows.where("form IS NOT NULL")).select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    return rows.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
