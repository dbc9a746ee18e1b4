"""MinHash near-duplicates by BagMinHash (operator 8).

A document is the multiset of its five-word shingles. The weight axis of a
shingle is cut into dyadic blocks (0,1], (1,2], (2,4], (4,8] ...; each block of
each shingle is a Poisson process of points, dealt over the signature's slots,
whose seed depends on shingle and block alone. A shingle that occurs w times owns
the points below w: whole blocks, and of the block that w cuts those points
whose level, found by halving the block, lies below w. A slot keeps its smallest
point, so two documents agree in a slot with probability
sum(min weights) / sum(max weights). Points are drawn in ascending order and a
process stops once it has passed the document's largest slot.

Equal texts are one class from the start. Signatures are cut into bands;
documents that share a band are verified on their multisets, first against the
leading members of the band's bucket. Those who are still in different
components of their bucket are then compared exactly, in blocks of bounded size
whose overlaps are one matrix product; a block returns only the links that join
components, so pairs are never listed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, hash_filter, map_batches, materialize, may_hold_hashes, release

WORDS = 5
SIMILARITY = 0.8
SLOTS = 64
BAND_ROWS = 4  # 16 bands: a pair at 0.8 shares one with probability 0.9998
LEADERS = 2  # members of each bucket that all others are compared with first
BLOCK_ROWS = 256  # members of a bucket that a task compares with as many others
BLOCK_BYTES = 16 << 20  # bytes of their multisets
ESTIMATE_MARGIN = 0.2  # four standard deviations of a 64-slot estimate at 0.8
BATCH_WORDS = 200_000  # words whose signatures a task draws together

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], memo: dict) -> np.ndarray:
    out = np.empty(len(words), dtype=np.uint64)
    for i, w in enumerate(words):
        h = memo.get(w)
        if h is None:
            if len(memo) > 1_000_000:
                memo.clear()
            h = memo[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        out[i] = h
    return out


def shingles(words: list[bytes], memo: dict) -> np.ndarray:
    """64-bit hashes of all five-word windows; fewer words make one shingle, none
    make none."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = word_hashes(words, memo)
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, len(h) if len(h) < WORDS else WORDS, dtype=np.uint64)
    for k in range(min(WORDS, len(h))):
        out = _mix(out ^ h[k:k + n])
    return out


def _blocks(counts: np.ndarray):
    """The dyadic blocks each weight reaches: (place, block number, lower bound, length)."""
    place, block, low, length = [np.arange(len(counts))], [np.zeros(len(counts), np.int64)], [
        np.zeros(len(counts), np.int64)], [np.ones(len(counts), np.int64)]
    j, start = 1, 1
    more = np.flatnonzero(counts > 1)
    while len(more):
        place.append(more)
        block.append(np.full(len(more), j))
        low.append(np.full(len(more), start))
        length.append(np.full(len(more), start))
        start *= 2
        j += 1
        more = more[counts[more] > start]
    return tuple(map(np.concatenate, (place, block, low, length)))


def signatures_of(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """Per multiset of hashes the slots' smallest points, as 32-bit fingerprints.
    All multisets advance together, a point of each live process a round."""
    keys = np.concatenate([b for b, _ in bags])
    counts = np.concatenate([c for _, c in bags])
    owner = np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags])
    place, block, low, length = _blocks(counts)
    best = np.full(len(bags) * slots, np.inf)
    mark = np.zeros(len(bags) * slots, dtype=np.uint64)
    state = _mix(keys[place] ^ _mix(block.astype(np.uint64)))
    weight, owner, time = counts[place], owner[place], np.zeros(len(place))
    while len(state):
        # the next point of each process: waiting time, slot, level within the block
        state = _mix(state)
        time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / length
        on = time < best.reshape(-1, slots).max(axis=1)[owner]
        state, time, weight, owner = state[on], time[on], weight[on], owner[on]
        low, length = low[on], length[on]
        draw = _mix(state ^ _MIX[1])
        at = owner * slots + (draw % np.uint64(slots)).astype(np.int64)
        mine = np.ones(len(at), dtype=bool)
        deep = np.flatnonzero(length > 1)
        if len(deep):  # halve the block until one unit of weight is left
            lower, size, bits = low[deep], length[deep], _mix(draw[deep])
            while (size > 1).any():
                half = size > 1
                size = np.where(half, size >> 1, size)
                lower = np.where(half & ((bits & np.uint64(1)) == 1), lower + size, lower)
                bits = bits >> np.uint64(1)
            mine[deep] = lower < weight[deep]
        np.minimum.at(best, at[mine], time[mine])
        won = mine & (time == best[at])
        mark[at[won]] = draw[won]
    return (mark >> np.uint64(32)).astype(np.uint32).reshape(len(bags), slots)


def signature(bag: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return signatures_of([(bag, counts)], slots)[0]


def multiset(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def similarity(a: tuple, b: tuple) -> float:
    """sum(min) / sum(max) of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, sig) of each document with a word; digest names its word sequence."""
    memo: dict = {}

    def rows(batch):
        ids, digests, bags, size = [], [], [], 0
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (text.as_py() or "").encode().split()
            if i is None or not words:
                continue
            ids.append(i)
            digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            bags.append(multiset(shingles(words, memo)))
            size += len(words)
            if size > BATCH_WORDS:
                yield {"doc_id": ids, "digest": digests, "sig": [x.tobytes() for x in signatures_of(bags)]}
                ids, digests, bags, size = [], [], [], 0
        if bags:
            yield {"doc_id": ids, "digest": digests, "sig": [x.tobytes() for x in signatures_of(bags)]}

    return map_batches(docs.select("doc_id", "text"), rows, "doc_id long, digest binary, sig binary")


def _bands(texts: DataFrame) -> DataFrame:
    """(key, rep): one row per band; the key is of the band's number and slots."""
    width = 4 * BAND_ROWS
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 1 + b * width, width))
                     for b in range(SLOTS // BAND_ROWS)])
    return texts.select("rep", F.explode(keys).alias("key"))


def _agreement(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Keeps pairs whose signatures agree in enough slots."""
    pairs = (pairs.join(texts.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
             .join(texts.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b"))
    least = int((SIMILARITY - ESTIMATE_MARGIN) * SLOTS)

    def rows(batch):
        if not len(batch):
            return
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, SLOTS) for c in (2, 3))
        on = (a == b).sum(axis=1) >= least
        keep = batch.filter(pa.array(on))
        yield {"a": keep.column(0), "b": keep.column(1)}

    return map_batches(pairs.select("a", "b", "sig_a", "sig_b"), rows, "a long, b long")


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs whose multisets overlap enough."""
    left = bags.select(F.col("rep").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("rep").alias("b"), F.col("bag").alias("bag_b"))

    def rows(batch):
        out = {"a": [], "b": []}
        for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if similarity(*(multiset(np.frombuffer(z, np.uint64)) for z in (x, y))) >= SIMILARITY:
                out["a"].append(a)
                out["b"].append(b)
        yield out

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")
    return map_batches(joined, rows, "a long, b long")


def _texts_of(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, text) of the documents in the written table ``reps``. A filter of their ids
    drops most other texts in the scan workers, the exact join the few it lets through."""
    field = docs.sparkSession.sparkContext.broadcast(hash_filter(reps.select(F.xxhash64("rep").alias("h")), reps.count()))

    def rows(batch):
        some = batch.filter(pa.array(may_hold_hashes(field.value, batch.column(2).to_numpy())))
        yield {"rep": some.column(0), "text": some.column(1)}

    held = map_batches(docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("h")), rows,
                       "rep long, text string")
    return held.join(reps.select("rep"), "rep", "left_semi")


def _bags(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, bag, size): sorted shingle hashes of the texts of the documents in ``reps``."""
    memo: dict = {}

    def rows(batch):
        bags = [np.sort(shingles((t.as_py() or "").encode().split(), memo)).tobytes() for t in batch.column(1)]
        some = [k for k, b in enumerate(bags) if b]  # a repeated doc_id may have a text without words too
        yield {"rep": batch.column(0).take(pa.array(some, pa.int64())), "bag": [bags[k] for k in some],
               "size": [len(bags[k]) for k in some]}

    return map_batches(_texts_of(docs, reps).distinct(), rows, "rep long, bag binary, size long")


def _with_component(rows: DataFrame, comp: DataFrame, column: str = "rep") -> DataFrame:
    named = comp.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return (rows.join(named, F.col(column) == F.col("_node"), "left")
            .withColumn("component", F.coalesce("_component", F.col(column))).drop("_node", "_component"))


def _members(texts: DataFrame) -> DataFrame:
    """(rep, keys, weight): the buckets each text shares with others, and their sizes' sum.
    The text that others were copied from shares more buckets with them than they
    share with one another, so weight tells the middle of a group."""
    bands = _bands(texts)
    shared = (bands.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("n"))
              .where("lo < hi").select(F.col("key").alias("bucket"), "n"))
    return bands.join(shared, F.col("key") == F.col("bucket")).groupBy("rep").agg(
        F.collect_set("key").alias("keys"), F.sum("n").alias("weight"))


def _leaders(rows: DataFrame, n: int) -> DataFrame:
    """(bucket, lead): a bucket's members are dealt by hash into ``n`` parts, and the
    heaviest of each part leads."""
    part = F.pmod(F.xxhash64("rep"), F.lit(n))
    picks = [F.max(F.when(part == i, F.struct("weight", "rep"))) for i in range(n)]
    found = rows.groupBy("key").agg(F.array_compact(F.array(*picks)).alias("picks"))
    return found.select(F.col("key").alias("bucket"), F.explode("picks").alias("p")).select(
        "bucket", F.col("p.rep").alias("lead"))


def _blocks_of(rows: DataFrame, bags: DataFrame) -> DataFrame:
    """(key, i, j, left, right, rep, component, bag): the members outside their bucket's
    largest component, ``left`` in blocks i, meet all its members, ``right`` in blocks j; a
    member on both sides of a pair of blocks is one row there. A bucket in one component
    has no rows, and of buckets that hold the same members only one has."""
    sizes = rows.join(bags.select("rep", "size"), "rep")
    names = [F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"h{i}") for i in range(2)]
    by = sizes.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), *names)
    tops = by.groupBy("key").agg(F.max(F.struct("n", "component", "bytes")).alias("top"), F.sum("n").alias("n"),
                                 F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("held"),
                                 F.bit_xor("h0").alias("h0"), F.bit_xor("h1").alias("h1")).where("held > 1")
    # equal members have equal components, so the other columns are equal too
    tops = tops.groupBy("h0", "h1", "n", "bytes", "top").agg(F.min("key").alias("key"))

    def parts(n, size):
        return F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_BYTES))

    tops = materialize(tops.select(
        F.col("key").alias("bucket"), F.col("top.component").alias("top"), parts(F.col("n"), F.col("bytes")).alias("all"),
        parts(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("out")), "open")
    met = rows.join(tops, F.col("key") == F.col("bucket"))
    mark = F.xxhash64("rep", F.lit(1))
    sides = [met.where(where).select(
        "key", i.alias("i"), j.alias("j"), F.lit(outside).alias("left"), F.lit(not outside).alias("right"), "rep",
        "component")
        for where, outside, i, j in (
            ("component <> top", True, F.pmod(mark, F.col("out")), F.explode(F.expr("sequence(0L, `all` - 1)"))),
            ("true", False, F.explode(F.expr("sequence(0L, out - 1)")), F.pmod(mark, F.col("all"))))]
    placed = sides[0].union(sides[1]).groupBy("key", "i", "j", "rep", "component").agg(
        F.max("left").alias("left"), F.max("right").alias("right"))
    return placed.join(bags.select("rep", "bag"), "rep")


def _elements(bag: bytes) -> np.ndarray:
    """A sorted multiset as a set: each occurrence is marked with its number."""
    h = np.frombuffer(bag, np.uint64)
    at = np.arange(len(h))
    first = np.maximum.accumulate(np.where(np.concatenate([[True], h[1:] != h[:-1]]), at, 0))
    return h ^ _mix((at - first).astype(np.uint64))


def _block_links(frame: pd.DataFrame) -> pd.DataFrame:
    """(a, b): links between components that join members of the block, a forest of them."""
    sets = [_elements(b) for b in frame["bag"]]
    size = np.array([len(x) for x in sets])
    comp = frame["component"].to_numpy()
    left, right = (np.flatnonzero(frame[side].to_numpy()) for side in ("left", "right"))
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    times = np.bincount(place)
    shared = (np.cumsum(times > 1) - 1)[place]  # elements of one member overlap with nothing
    on = times[place] > 1
    shared, owner = shared[on], owner[on]
    by = np.argsort(shared, kind="stable")
    shared, owner = shared[by], owner[by]
    both = np.zeros((len(left), len(right)))
    width = int(shared[-1]) + 1 if len(shared) else 0
    for at in range(0, width, 4096):
        some = slice(*np.searchsorted(shared, [at, at + 4096]))
        holds = np.zeros((len(sets), min(4096, width - at)), np.float32)
        holds[owner[some], shared[some] - at] = 1
        both += holds[left] @ holds[right].T
    near = both / (size[left][:, None] + size[right][None] - both) >= SIMILARITY
    near &= comp[left][:, None] != comp[right][None]
    root: dict[int, int] = {}

    def top(x):
        while x in root:
            x = root[x]
        return x

    out = []
    for x, y in zip(*np.nonzero(near)):
        a, b = top(int(comp[left[x]])), top(int(comp[right[y]]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), kept.

    Linked are documents whose five-word multisets overlap by 0.8 or more; a
    class is what links connect. Equal word sequences of any length are linked.
    Texts without words (null, empty, white space) are linked with nothing.
    Rows that repeat a doc_id share a class; a null doc_id is a class of its
    own (class_id null) and kept. ``kept``: the row's doc_id is its class_id.
    Repeated rows of a kept doc_id are all marked kept; the pipeline's stage
    keeps one.
    """
    sigs = materialize(signatures(docs), "signatures")
    texts = materialize(sigs.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"),
                                                   F.min("sig").alias("sig")), "texts")
    copies = sigs.select("doc_id", "digest").join(
        texts.where("n > 1").select(F.col("digest").alias("_d"), "rep"), F.col("digest") == F.col("_d")
    ).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    members = materialize(_members(texts), "members")
    bags = materialize(_bags(docs, members.select("rep")), "bags")

    rows = members.select("rep", "weight", F.explode("keys").alias("key"))
    few = _leaders(rows, LEADERS)
    pairs = (rows.join(few, F.col("key") == F.col("bucket")).where("rep <> lead")
             .select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct())
    close = materialize(_agreement(pairs, texts), "close")
    comp = materialize(components(_verified(close, bags).union(copies)), "components")
    release(sigs, texts, close)
    # what the leaders have not joined is compared exactly; components stand for the links found
    rows = materialize(_with_component(members, comp).select("rep", "component", F.explode("keys").alias("key")), "rows")
    more = materialize(_blocks_of(rows, bags).groupBy("key", "i", "j").applyInPandas(_block_links, "a long, b long")
                       .distinct(), "links")
    release(members, rows, bags)
    if not more.isEmpty():
        comp = materialize(components(more.union(comp.select("node", "component"))), "components")
    return _with_component(docs.select("doc_id"), comp, "doc_id").select(
        "doc_id", F.col("component").alias("class_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))
