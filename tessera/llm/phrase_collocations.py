"""Phrase collocations counted over a prefix-free parse (operator 12).

Words whose hash ends in zero bits trigger the end of a chunk, so equal passages
fall into equal chunks wherever they stand. A chunk carries the next words of
its piece as an overlap; every phrase belongs to the chunk in which it starts,
so it is counted once. Spark folds equal chunks into a dictionary with
frequencies, and phrases are counted inside the distinct chunks, weighted.

Lengths are counted one after the other: a phrase is made only if the two
phrases one word shorter inside it may be frequent, which a Bloom filter of
bounded size answers; a wrong yes costs a row, never a count. Most pairs of frequent
words are rare, so pairs are first counted by a 64-bit hash, and only those whose
hash is frequent are made: two that share a hash can but let each other through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from functools import cached_property
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import hash_filter, materialize, may_hold_hashes, release

LONGEST = 4
MIN_COUNT = 30
TOP = 2000
TRIGGER_MASK = 31  # one word in 32 ends a chunk
CHUNK_WORDS = 256  # a chunk ends here at the latest
BLOOM_BITS_EACH = 16
BLOOM_LIMIT = 1 << 29  # bits (64 MB): beyond it the filter lets more through
BLOOM_BLOCK = 1 << 16  # bits of a block built in Spark
HELD_TOKENS = 1_500_000  # tokens a task counts at a time
BREAK = b"\n"
# A-Z to a-z, tab to space, piece ends to the break byte.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b" " + BREAK * 9)
MIX = np.uint64(0x9E3779B97F4A7C15)


def chunks_of(text: str, overlap: int = LONGEST - 1):
    """(chunk, own) of a text: space-joined words and breaks, of which the first ``own`` are
    the chunk's, the rest the overlap, which ends before a break."""
    tokens = [t for t in text.encode().translate(FOLD).replace(BREAK, b" \n ").split(b" ") if t]
    start = 0
    for end in [i + 1 for i, t in enumerate(tokens) if not crc32(t) & TRIGGER_MASK] + [len(tokens)]:
        while start < end:
            stop = min(end, start + CHUNK_WORDS)
            upto = stop
            while upto < min(stop + overlap, len(tokens)) and tokens[upto] != BREAK:
                upto += 1
            own = stop - start
            if upto > start + 1 or tokens[start] != BREAK:
                yield b" ".join(tokens[start:upto]), own
            start = stop


def parse(docs: DataFrame) -> DataFrame:
    """(lang, chunk, own, times): the dictionary of distinct chunks, per language."""

    def chunk(batches):
        for batch in batches:
            held: Counter = Counter()
            for lang, text in zip(*batch.columns):
                lang = lang.as_py()
                held.update((lang, *c) for c in chunks_of(text.as_py() or ""))
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array(list(held.values()), pa.int64())],
                ["lang", "chunk", "own", "times"])

    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    return (docs.select(lang, "text").mapInArrow(chunk, "lang string, chunk binary, own int, times long")
            .groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times")))


class Bloom:
    """Bits of phrase hashes; ``None`` lets everything through."""

    def __init__(self, bits: np.ndarray | None):
        self.bits = bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(hashes), dtype=bool)
        found = np.ones(len(hashes), dtype=bool)
        for at in slots(hashes, 8 * len(self.bits)):
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def slots(hashes: np.ndarray, bits: int):
    """Three bit numbers below ``bits`` (a power of two) for each hash."""
    for shift in (0, 21, 35):
        yield ((hashes >> np.uint64(shift)) & np.uint64(bits - 1)).astype(np.int64)


def continued(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases that go on with ``words`` (hashes of words)."""
    mixed = (hashes ^ words) * MIX
    return mixed ^ (mixed >> np.uint64(29))


def word_hashes(words) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words, dtype=object), categorize=False)


def bloom_of(phrases: DataFrame, count: int) -> Bloom:
    """A filter of (lang, phrase) rows. Tasks set bits, Spark ORs them by block; what
    reaches the driver is the bits, whose number is the smaller of 16 a phrase and
    ``BLOOM_LIMIT``."""
    bits = min(BLOOM_LIMIT, 1 << max(16, int(BLOOM_BITS_EACH * max(count, 1) - 1).bit_length()))

    def place(batches):
        for batch in batches:
            if len(batch):
                langs, texts = (c.to_pylist() for c in batch.columns)
                words = [t.split(" ") for t in texts]
                hashes = word_hashes(langs)
                for k in range(len(words[0])):
                    hashes = continued(hashes, word_hashes([w[k] for w in words]))
                at = np.unique(np.concatenate(list(slots(hashes, bits))))
                for block in np.split(at, np.flatnonzero(np.diff(at // BLOOM_BLOCK)) + 1):
                    field = np.zeros(BLOOM_BLOCK // 8, dtype=np.uint8)
                    np.bitwise_or.at(field, block % BLOOM_BLOCK >> 3, (1 << (block & 7)).astype(np.uint8))
                    yield pa.RecordBatch.from_pydict({"block": [int(block[0] // BLOOM_BLOCK)],
                                                      "field": [field.tobytes()]},
                                                     schema=pa.schema([("block", pa.int64()), ("field", pa.binary())]))

    def union(batches):
        fields: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, field in zip(*(c.to_pylist() for c in batch.columns)):
                mine = fields.setdefault(block, np.zeros(BLOOM_BLOCK // 8, dtype=np.uint8))
                mine |= np.frombuffer(field, dtype=np.uint8)
        yield pa.RecordBatch.from_pydict({"block": list(fields), "field": [f.tobytes() for f in fields.values()]},
                                         schema=pa.schema([("block", pa.int64()), ("field", pa.binary())]))

    schema = "block long, field binary"
    parts = phrases.select("lang", "phrase").mapInArrow(place, schema).repartition("block").mapInArrow(union, schema)
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        at = row["block"] * BLOOM_BLOCK // 8
        out[at:at + BLOOM_BLOCK // 8] = np.frombuffer(row["field"], dtype=np.uint8)[:len(out) - at]
    return Bloom(out)


class Tokens:
    """The words of a table of chunks one after the other: ``ids`` of ``words``, whether the
    place is one of its chunk's ``own``, and where its piece ends (``stop``)."""

    def __init__(self, table: pa.Table):
        tokens = pc.split_pattern(table.column("chunk").cast(pa.string()).combine_chunks(), " ")
        offsets = tokens.offsets.to_numpy()
        offsets = offsets - offsets[0]
        lengths = np.diff(offsets)
        flat = tokens.flatten().dictionary_encode()
        self.words, self.ids = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False)
        langs = table.column("lang").combine_chunks().dictionary_encode()
        self.langs = langs.dictionary
        self.lang_ids = np.repeat(langs.indices.to_numpy(zero_copy_only=False), lengths)
        self.times = np.repeat(table.column("times").to_numpy(), lengths)
        self.at = np.arange(len(self.ids))
        self.own = self.at < np.repeat(offsets[:-1] + table.column("own").to_numpy(), lengths)
        # the next break or chunk end at or after each token
        ends = np.repeat(offsets[1:], lengths)
        is_break = self.ids == pc.index(self.words, pa.scalar("\n")).as_py()
        nearest = np.where(is_break, self.at, np.iinfo(np.int64).max)
        self.stop = np.minimum(ends, np.minimum.accumulate(nearest[::-1])[::-1]) if len(self.ids) else ends

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return word_hashes(self.words.to_pylist())[self.ids]

    @cached_property
    def lang_hashes(self) -> np.ndarray:
        return word_hashes(self.langs.to_pylist())

    def hashes(self, start: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words that start there."""
        out = self.lang_hashes[self.lang_ids[start]]
        for k in range(size):
            out = continued(out, self.word_hashes[start + k])
        return out

    def starts(self, size: int, shorter: Callable | None = None) -> np.ndarray:
        """Own places where phrases of ``size`` words start of which both shorter ones pass."""
        start = np.flatnonzero(self.own & (self.at + size <= self.stop))
        if shorter is None or size == 1:
            return start
        inner = np.flatnonzero(self.at + size - 1 <= self.stop)
        passed = np.zeros(len(self.ids) + 1, dtype=bool)
        passed[inner] = shorter(self.hashes(inner, size - 1))
        return start[passed[start] & passed[start + 1]]

    def counted(self, start: np.ndarray, size: int) -> pa.RecordBatch:
        """(lang, phrase, size, n) of the phrases of ``size`` words that start there."""
        code = self.lang_ids[start].astype(np.int64)
        distinct = code[:0]
        for k in range(size):  # exact codes: each step numbers the distinct pairs (code so far, next word)
            code, distinct = pd.factorize(code * np.int64(len(self.words)) + self.ids[start + k])
        counts = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(counts, code, self.times[start])
        sample = np.zeros(len(counts), dtype=np.int64)
        sample[code] = start
        parts = [self.words.take(pa.array(self.ids[sample + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang_ids[sample])), phrase.cast(pa.string()),
             pa.array(np.full(len(counts), size, np.int32)), pa.array(counts)], ["lang", "phrase", "size", "n"])

    def counted_hashes(self, start: np.ndarray, size: int) -> pa.RecordBatch:
        """(h, n) of the phrases of ``size`` words that start there, by their hash."""
        code, distinct = pd.factorize(self.hashes(start, size).view(np.int64))
        counts = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(counts, code, self.times[start])
        return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(counts)], ["h", "n"])


def count_phrases(table: pa.Table, size: int, shorter: Callable) -> pa.RecordBatch:
    """(lang, phrase, size, n) of the phrases of ``size`` words that start in own words of the chunks."""
    tokens = Tokens(table)
    return tokens.counted(tokens.starts(size, shorter), size)


def over_chunks(chunks: DataFrame, counted: Callable, schema: str) -> DataFrame:
    """The batches that ``counted`` gives for the ``Tokens`` of a part of the dictionary at a time."""

    def run(batches):
        held, tokens = [], 0
        for batch in batches:
            held.append(batch)
            tokens += batch.column("chunk").nbytes // 6
            if tokens >= HELD_TOKENS:
                yield from counted(Tokens(pa.Table.from_batches(held)))
                held, tokens = [], 0
        if held:
            yield from counted(Tokens(pa.Table.from_batches(held)))

    return chunks.select("lang", "chunk", "own", "times").mapInArrow(run, schema)


def phrase_counts(chunks: DataFrame, sizes: Sequence[int], known: int = 0, bits: np.ndarray | None = None,
                  passes: Callable | None = None) -> DataFrame:
    """(lang, phrase, size, n) over the dictionary, not yet limited to frequent phrases.

    ``passes(bits, hashes)`` tells which phrases of ``known`` words may be frequent: those
    of that size, and of one word more, are made only where it lets theirs through.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(bits)

    def counted(tokens):
        shorter = lambda hashes: passes(shared.value, hashes)
        for size in sizes:
            start = tokens.starts(size, shorter if size == known + 1 else None)
            if size == known:
                start = start[shorter(tokens.hashes(start, size))]
            yield tokens.counted(start, size)

    return (over_chunks(chunks, counted, "lang string, phrase string, size int, n long")
            .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")))


def in_bloom(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    return Bloom(bits)(hashes)


def frequent_pairs(chunks: DataFrame, words: Bloom, min_count: int) -> DataFrame:
    """(h), written: hashes of pairs of words that occur ``min_count`` times, those of all
    frequent pairs among them."""
    shared = chunks.sparkSession.sparkContext.broadcast(words.bits)

    def counted(tokens):
        yield tokens.counted_hashes(tokens.starts(2, Bloom(shared.value)), 2)

    pairs = over_chunks(chunks, counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return materialize(pairs.where(F.col("n") >= min_count).select("h"), "pairs")


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) with f >= ``min_count`` and up to ``longest`` words; (lang, n) of all words)."""

    def kept(counts):
        return counts.where(F.col("n") >= min_count).select("lang", "phrase", "size", F.col("n").alias("f"))

    chunks = materialize(parse(docs), "chunks")
    words = materialize(phrase_counts(chunks, [1]), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = shorter = materialize(kept(words), "phrases")
    if longest > 1:
        # pairs by their hash, then those whose hash is frequent in the pass that counts triples, too
        pairs = frequent_pairs(chunks, bloom_of(shorter, shorter.count()), min_count)
        field = hash_filter(pairs, pairs.count())
        release(pairs)
        found = phrase_counts(chunks, range(2, min(longest, 3) + 1), 2, field, may_hold_hashes)
        found = materialize(kept(found), "phrases")
        frequent, shorter = frequent.union(found), found.where("size = 3")
    for size in range(4, longest + 1):
        bits = bloom_of(shorter, shorter.count()).bits
        shorter = materialize(kept(phrase_counts(chunks, [size], size - 1, bits, in_bloom)), "phrases")
        frequent = frequent.union(shorter)
    return frequent, totals


def part(phrase, start, length):
    """Words ``start`` (from 1) to ``start + length - 1`` of a phrase."""
    return F.array_join(F.slice(F.split(phrase, " "), start, length), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    A null lang is ``und``, a null or empty text has no words; repeated rows count
    again; an empty table gives an empty table. Texts of any length are counted
    whole; counts are longs and scores exact decimals. Ranks are total: score and
    a descending, then the phrase's bytes.
    """
    frequent, totals = frequent_phrases(docs, longest, min_count)
    # every phrase of two words or more with the largest count of a longer one around it
    inner = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda length: F.transform(F.sequence(F.lit(1), F.col("size") - length + 1),
                                   lambda at: part(F.col("phrase"), at, length)))))
    around = (frequent.where("size > 2").select("lang", inner.alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("around")))
    many = F.col("around").isNotNull() & (F.col("around").cast("decimal(30,0)") * 100 >= F.col("a").cast("decimal(30,0)") * 80)
    candidates = (frequent.where("size > 1").withColumnRenamed("f", "a")
                  .join(around, ["lang", "phrase"], "left").where(~many))
    cuts = candidates.select("lang", "phrase", "size", "a",
                             F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    of = lambda name, alias: frequent.select(F.col("lang"), F.col("phrase").alias(name), F.col("f").alias(alias))
    cuts = (cuts.withColumn("_left", part(F.col("phrase"), F.lit(1), F.col("cut")))
            .withColumn("_right", part(F.col("phrase"), F.col("cut") + 1, F.col("size") - F.col("cut")))
            .join(of("_left", "l"), ["lang", "_left"]).join(of("_right", "r"), ["lang", "_right"]))
    cuts = cuts.withColumn("score", F.expr(
        "(2000000 * CAST(a AS DECIMAL(28,0))) div (CAST(l AS DECIMAL(28,0)) + CAST(r AS DECIMAL(28,0)))"))
    least = F.min(F.struct("score", "cut", "l", "r")).alias("least")
    scored = (cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), least)
              .select("lang", "phrase", "a", "least.l", "least.r", "least.score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within hashed parts of a language, then among what they leave
    scored = (scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
              .withColumn("_first", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
              .where(F.col("_first") <= top))
    ranked = (scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
