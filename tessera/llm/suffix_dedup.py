"""Suffix-array dedup of byte strings that repeat across documents (operator 10).

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document
with a smaller id. Three steps find all such strings:

1. Anchors. Every ``LENGTH``-byte window has one anchor, the smallest hash among
   its ``GRAM``-byte substrings; equal windows have equal anchors. A run of
   windows with the same anchor is a *context*, its bytes known by two
   independent 64-bit hashes. Anchors are counted over the corpus in buckets of
   their hashes, contexts grouped by Spark aggregates, either folded before the
   shuffle, so no anchor has to fit one task; an anchor met in one document only
   can repeat nowhere.
2. A context met in several documents as a whole settles its windows by the
   smallest of the ids, without its bytes being looked at again.
3. Distinct contexts that share an anchor may still share windows (the ends of
   a repeated passage). Their bytes go to one suffix array per block of anchors,
   built by prefix doubling; adjacent common prefixes of ``LENGTH`` or more bound
   the groups of equal windows. The contexts of an anchor with very many are cut
   anew by longer anchors, and where one of those has very many, too, keyed by
   whole windows and grouped by Spark, so no anchor has to fit one task.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_filter, map_batches, materialize, may_hold_hashes, release
from tessera.sources.sinks import collect_spent

LENGTH = 50
GRAM = 19  # longer ones are shared by chance in fewer documents, but make more contexts
LONG_GRAM = 32  # of the anchors that cut crowded contexts anew
CHUNK_BYTES = 1 << 18  # text bytes whose anchors are looked for at once
BLOCK_BYTES = 1 << 18  # context bytes sorted together
SUFFIX_CONTEXTS = 2_000  # contexts of one anchor that one suffix array takes
BATCH_BYTES = 8 << 20  # text bytes whose contexts a task holds at once
BUCKETS = 12  # bits of an anchor that tell the bucket in which it is counted

_P = np.uint64(0x100000001B3 | 1 << 44)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def _substring_hashes(numbers: np.ndarray, base: np.uint64, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of [begin, end) of a text given as a number per byte, independent of place:
    sums of number * base**i (wrapping), a difference of two sums times a power; the
    length is mixed in."""
    n = max(len(numbers), 2 * CHUNK_BYTES)  # powers of the usual chunks are kept
    sums = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(numbers * _powers(int(base), n)[:len(numbers)], out=sums[1:])
    inverse = _powers(pow(int(base), -1, 1 << 64), n)
    return _mix((sums[end] - sums[begin]) * inverse[begin] + _MIX[0] * (end - begin).astype(np.uint64))


_BYTES = np.arange(1, 257, dtype=np.uint64)
# the second hash: another base over other numbers for the bytes
_P2 = np.uint64(0xD1342543DE82EF95)
_BYTES2 = _mix(_BYTES * _MIX[2])


def _pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _MIX[0]
    x ^= x >> np.uint64(32)
    x += b
    x *= _MIX[1]
    x ^= x >> np.uint64(29)
    x *= _MIX[2]
    x ^= x >> np.uint64(32)
    return x


def _anchors(raw: np.ndarray, gram: int) -> np.ndarray:
    """The smallest hash among the ``gram``-byte substrings (16 to 32) of each window."""
    words = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)).copy()  # 8 bytes from each place on
    low = _pair_hashes(words[:-8], words[8:])
    if gram > 16:
        low = _pair_hashes(low[:16 - gram], low[gram - 16:])
    width, span = 1, LENGTH - gram + 1
    while width < span:  # by doubling
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return low


def context_runs(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(bytes of all texts, place where each text begins, text, anchor hash, first start,
    last start) of the runs of windows of a text that share an anchor, cut to as many
    windows as a ``gram`` lies in; starts count over all texts. Texts are ``LENGTH``
    bytes or longer."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    begins = np.concatenate([[0], ends[:-1]])
    low = _anchors(raw, gram)
    stop = ends - LENGTH + 1
    new = np.empty(len(low), bool)
    new[0] = True
    np.not_equal(low[1:], low[:-1], out=new[1:])
    new[begins] = True
    new[stop[:-1]] = True
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(low)]]) - 1
    text = np.searchsorted(ends, first, side="right")
    whole = first < stop[text]
    first, last, text = first[whole], last[whole], text[whole]
    span = LENGTH - gram + 1
    parts = (last - first) // span + 1
    if parts.max() > 1:  # grams that repeat within a window
        text = np.repeat(text, parts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + within * span
        last = np.minimum(first + span - 1, np.repeat(last, parts))
    return raw, begins, text, low[first], first, last


def context_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the bytes of contexts."""
    return (_substring_hashes(_BYTES[raw], _P, first, last + LENGTH),
            _substring_hashes(_BYTES2[raw], _P2, first, last + LENGTH))


def contexts(data: bytes) -> tuple[np.ndarray, ...]:
    """(anchor hash, two context hashes, first start, last start) of the runs of
    windows of ``data`` that share an anchor; empty if it is too short."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint64, np.int64, np.int64))
    raw, _, _, h, first, last = context_runs([data])
    return (h, *context_hashes(raw, first, last), first, last)


# -- the suffix array --------------------------------------------------------


WORD = 7  # symbols of 9 bits that a word holds


def _words(text: np.ndarray, beyond: int = 0) -> np.ndarray:
    """The ``WORD`` symbols from each place on as one number; 0 stands past the end."""
    t = np.zeros(len(text) + beyond + WORD, np.uint64)
    t[:len(text)] = text
    t[:len(text)] += np.uint64(1)
    two = t[:-1] << np.uint64(9) | t[1:]
    four = two[:-2] << np.uint64(18) | two[2:]
    return four[:-3] << np.uint64(27) | four[3:] & np.uint64((1 << 27) - 1)


def suffix_array(text: np.ndarray, depth: int = LENGTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """Places of ``text`` (integers from 0 to 510), or those ``wanted`` (a flag each), in
    the order of their suffixes, right to ``depth`` symbols (ties beyond keep any order).

    Suffixes are sorted by their first word, then by prefix doubling: those still tied
    are sorted by the rank of the suffix that starts where the known prefix ends.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    words = _words(text)[:n]
    order = np.argsort(words)
    words = words[order]
    head = np.concatenate([[True], words[1:] != words[:-1]])
    rank = np.full(n + 1, -1)
    reach = WORD
    while reach < depth:
        group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[order] = group
        tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(tied):
            break
        step = min(reach, depth - reach)
        if wanted is not None and reach + step == depth:  # no later round needs the others' ranks
            tied = tied[wanted[order[tied]]]
        place = order[tied]
        key = group[tied] << 32 | rank[np.minimum(place + step, n)] + 1
        by = np.argsort(key)
        order[tied], key = place[by], key[by]
        head[tied[1:]] |= key[1:] != key[:-1]
        reach += step
    return order if wanted is None else order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``depth``; 0 for the first."""
    words = _words(text, depth)
    symbols = np.uint64(1) << np.arange(9, 9 * WORD, 9, dtype=np.uint64)
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(0, depth, WORD):
        differ = words[order[live - 1] + k] ^ words[order[live] + k]
        same = differ == 0
        out[live[~same]] = k + WORD - 1 - np.searchsorted(symbols, differ[~same], side="right")
        live = live[same]
    out[live] = depth
    return np.minimum(out, depth)


def repeated_starts(pieces: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start), ascending, of the windows of the pieces that also occur in a piece
    with a smaller owner, by one suffix array over all pieces."""
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8).astype(np.int64)
    text[starts + lengths] = 256  # between two pieces
    piece = np.repeat(np.arange(len(pieces)), lengths + 1)
    order = suffix_array(text, wanted=np.arange(len(text)) - starts[piece] + LENGTH <= lengths[piece])
    if not len(order):
        return order, order
    group = np.cumsum(common_prefixes(text, order) < LENGTH) - 1
    piece = piece[order]
    owner = owners[piece]
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(owner, heads), np.diff(np.concatenate([heads, [len(group)]])))
    hit = np.sort(order[least < owner])
    piece = np.searchsorted(starts, hit, side="right") - 1
    return piece, hit - starts[piece]


# -- the Spark jobs ---------------------------------------------------------


CONTEXTS = "h long, c long, c2 long, doc long, tag long, first int, width int"
OPEN = "anchor long, doc long, tag long, begin long, piece binary"


def _tag(data: bytes) -> int:
    """Length and CRC of a text's bytes: tells the rows of one doc_id apart. Rows that
    agree in it and in the doc_id are taken for the same text."""
    return len(data) << 32 | zlib.crc32(data)


def _tag_column(data):
    return F.shiftleft(F.octet_length(data).cast("long"), 32).bitwiseOR(F.crc32(data))


def _rotated(h: np.ndarray, bits: int) -> np.ndarray:
    """Hashes with their last ``bits`` bits in front; the first ones of least hashes say little."""
    return h << np.uint64(64 - bits) | h >> np.uint64(bits)


def _folded(turned: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each anchor once, ascending, with its smallest and largest document."""
    order = np.argsort(turned)
    turned = turned[order]
    heads = np.flatnonzero(np.concatenate([[True], turned[1:] != turned[:-1]]))
    return turned[heads], np.minimum.reduceat(low[order], heads), np.maximum.reduceat(high[order], heads)


def anchor_buckets(h: np.ndarray, doc: np.ndarray) -> dict:
    """{bucket, held}: for each bucket its rotated anchors, each once, with the smallest
    document and how far the largest is from it, as bytes of equal rank side by side."""
    turned, low, high = _folded(_rotated(h, BUCKETS), doc, doc)
    planes = np.stack([turned, low.view(np.uint64), (high - low).view(np.uint64)]).view(np.uint8)
    planes = np.ascontiguousarray(planes.reshape(3, -1, 8).transpose(0, 2, 1)).reshape(24, -1)
    bucket = (turned >> np.uint64(64 - BUCKETS)).astype(np.int32)
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return {"bucket": bucket[heads],
            "held": [planes[:, a:b].tobytes() for a, b in zip(heads.tolist(), [*heads.tolist()[1:], len(bucket)])]}


def shared_anchors(held: list[bytes]) -> np.ndarray:
    """The anchors that several documents hold, of all ``held`` of one bucket."""
    planes = np.concatenate([np.frombuffer(b, np.uint8).reshape(24, -1) for b in held], axis=1)
    turned, low, far = np.ascontiguousarray(planes.reshape(3, 8, -1).transpose(0, 2, 1)).view(np.uint64)[:, :, 0]
    turned, low, high = _folded(turned, low.view(np.int64), (low + far).view(np.int64))
    return _rotated(turned[low < high], 64 - BUCKETS)


def _context_rows(docs: DataFrame, repeated=None) -> DataFrame:
    """One row per context; with the filter of ``repeated`` anchors, of those that it may
    hold only, so the others leave no scan worker. Without it only anchors and documents are
    told, each anchor once a batch, as one row per bucket of anchors."""
    shared = None if repeated is None else docs.sparkSession.sparkContext.broadcast(repeated)
    names = ("h", "c", "c2", "doc", "tag", "first", "width")

    def rows(batch):
        parts, size = [], 0
        for docs, texts in chunks(batch):
            raw, begins, text, h, first, last = context_runs(texts)
            docs = np.array(docs)
            if shared is None:
                parts.append((h, docs[text]))
            else:
                keep = may_hold_hashes(shared.value, h)
                h, text, first, last = h[keep], text[keep], first[keep], last[keep]
                c, c2 = context_hashes(raw, first, last)
                tags = np.array([_tag(t) for t in texts])
                parts.append((h.view(np.int64), c.view(np.int64), c2.view(np.int64), docs[text], tags[text],
                              first - begins[text], last - first))
            size += len(raw)
            if size >= BATCH_BYTES:
                yield columns(parts)
                parts, size = [], 0
        if parts:
            yield columns(parts)

    def chunks(batch):
        docs, texts, size = [], [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = (text.as_py() or "").encode()
            if doc is None or len(data) < LENGTH:
                continue
            docs.append(doc)
            texts.append(data)
            size += len(data)
            if size >= CHUNK_BYTES:
                yield docs, texts
                docs, texts, size = [], [], 0
        if docs:
            yield docs, texts

    def columns(parts):
        found = list(map(np.concatenate, zip(*parts)))
        return anchor_buckets(*found) if shared is None else dict(zip(names, found))

    schema = CONTEXTS if shared else "bucket int, held binary"
    return map_batches(docs.select("doc_id", "text"), rows, schema)


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(h) of the anchors that at least two documents hold, written. A batch tells an
    anchor once, and a task holds one bucket at a time."""

    def rows(batches):
        at, held = None, []
        for batch in batches:
            for bucket, some in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != at and held:
                    yield out(held)
                    held = []
                at = bucket
                held.append(some.as_py())
        if held:
            yield out(held)

    def out(held):
        return pa.RecordBatch.from_arrays([pa.array(shared_anchors(held).view(np.int64), pa.int64())], ["h"])

    buckets = _context_rows(docs).repartition("bucket").sortWithinPartitions("bucket")
    return materialize(buckets.mapInArrow(rows, "h long"), "anchors")


def kept_contexts(docs: DataFrame) -> DataFrame:
    """The contexts whose anchor two documents hold, written. Contexts are made twice:
    the first pass only counts anchors, the second keeps what the filter of repeated
    anchors lets through; the few that it lets through wrongly settle nothing."""
    anchors = repeated_anchors(docs)
    rows = materialize(_context_rows(docs, hash_filter(anchors, anchors.count())), "contexts")
    release(anchors)
    return rows


def _key():
    """Anchor and first context hash as one number; with the second hash it names a context."""
    return F.col("h").bitwiseXOR(F.col("c"))


def _findings(rows: DataFrame) -> DataFrame:
    """(doc, tag, begin, end, anchor), written: settled byte ranges (anchor null) and open
    contexts (with their anchor) of written context rows.

    A context that a smaller document holds, too, is settled; one that no smaller
    document holds stays open if its anchor has other contexts in other documents.
    """
    least = materialize(rows.groupBy("h", "c", "c2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")),
                        "least")
    # folded before the shuffle, a row per anchor: whether it has several contexts, in several documents
    several = (least.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("low"),
                                      F.max("most").alias("high"))
               .where("n > 1 AND low < high").select(F.col("h").alias("_h")))
    marked = least.join(several, F.col("h") == F.col("_h"), "left").withColumn("several", F.col("_h").isNotNull())
    # contexts of one document whose anchor has no other one say nothing
    told = materialize(marked.where("several OR least < most").select(
        _key().alias("_k"), F.col("c2").alias("_c2"), "h", "least", "several"), "told")
    release(least)
    collect_spent(rows.sparkSession)
    asked = rows.select(_key().alias("k"), "c2", "doc", "tag", "first", "width")
    joined = asked.join(told, (F.col("k") == F.col("_k")) & (F.col("c2") == F.col("_c2")))
    found = materialize(joined.where("doc > least OR several").select(
        "doc", "tag", F.col("first").cast("long").alias("begin"),
        (F.col("first") + F.col("width") + LENGTH).cast("long").alias("end"),
        F.when(F.col("doc") == F.col("least"), F.col("h")).alias("anchor")), "found")
    release(told)
    return found


def _merged(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, begin, end), ascending, of the byte ranges of each row, those that touch as one."""
    if not len(row):
        return row, begin, end
    far = int(end.max()) + 2  # no range of a row reaches the next row's
    order = np.argsort(row * far + begin)
    row, begin, end = row[order], begin[order], end[order]
    reach = np.maximum.accumulate(row * far + end)
    heads = np.flatnonzero(np.concatenate([[True], (row * far + begin)[1:] > reach[:-1]]))
    tails = np.concatenate([heads[1:], [len(row)]]) - 1
    return row[heads], begin[heads], reach[tails] - row[heads] * far


def _suffix_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Byte ranges of the block's contexts that a smaller document repeats."""
    doc, tag, at = (frame[c].to_numpy() for c in ("doc", "tag", "begin"))
    piece, start = repeated_starts(frame["piece"].to_list(), doc)
    piece, begin, end = _merged(piece, start, start + LENGTH)
    return pd.DataFrame({"doc": doc[piece], "tag": tag[piece], "begin": at[piece] + begin, "end": at[piece] + end})


def _crowded(opened: DataFrame) -> DataFrame:
    """(_a): the anchors of more contexts than one suffix array takes, written."""
    return materialize(opened.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > SUFFIX_CONTEXTS).select(F.col("anchor").alias("_a")), "crowded")


def _recut(opened: DataFrame) -> DataFrame:
    """Contexts cut anew by anchors of ``LONG_GRAM`` bytes, of which one window has one, too."""

    def rows(batch):
        doc, tag, at = (batch.column(k).to_numpy() for k in range(3))
        pieces = batch.column(3).to_pylist()
        if pieces:
            raw, begins, text, h, first, last = context_runs(pieces, LONG_GRAM)
            data = raw.tobytes()
            yield {"anchor": h.view(np.int64), "doc": doc[text], "tag": tag[text],
                   "begin": at[text] + first - begins[text],
                   "piece": [data[b:e] for b, e in zip(first.tolist(), (last + LENGTH).tolist())]}

    return map_batches(opened.select("doc", "tag", "begin", "piece"), rows, OPEN)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, tag, begin, end): byte ranges to remove, possibly overlapping. ``tag``
    tells rows of one doc_id apart."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = kept_contexts(docs)
    collect_spent(docs.sparkSession)
    found = _findings(rows)
    release(rows)
    collect_spent(docs.sparkSession)
    source = docs.select(F.col("doc_id").alias("_id"), data.alias("_data"), _tag_column(data).alias("_tag"))
    # one copy of a repeated row is enough to read a context from
    wanted = found.where("anchor IS NOT NULL").distinct()
    opened = materialize(
        wanted.join(source, (F.col("doc") == F.col("_id")) & (F.col("tag") == F.col("_tag")))
        .select("anchor", "doc", "tag", "begin",
                F.expr("substring(_data, cast(begin + 1 as int), cast(end - begin as int))").alias("piece"))
        .distinct(), "open")
    collect_spent(docs.sparkSession)
    many = opened.join(_crowded(opened), F.col("anchor") == F.col("_a"), "left")
    # what a crowded anchor gathers is told apart by longer anchors; those of one document repeat nowhere
    recut = materialize(_recut(many.where("_a IS NOT NULL")), "recut")
    shared = (recut.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"),
                                          F.count(F.lit(1)).alias("n"))
              .where("low < high").select(F.col("anchor").alias("_s"), (F.col("n") > SUFFIX_CONTEXTS).alias("crowded")))
    recut = materialize(recut.join(shared, F.col("anchor") == F.col("_s")).drop("_s"), "shared")
    few = many.where("_a IS NULL").drop("_a").union(recut.where("NOT crowded").drop("crowded"))
    size = opened.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    sorted_ = (few.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
               .groupBy("block").applyInPandas(_suffix_block, "doc long, tag long, begin long, end long"))
    windows = (recut.where("crowded")
               .select("doc", "tag", "begin", "piece",
                       F.explode(F.expr(f"sequence(0, octet_length(piece) - {LENGTH})")).alias("at"))
               .select("doc", "tag", (F.col("begin") + F.col("at")).alias("begin"),
                       F.expr(f"substring(piece, at + 1, {LENGTH})").alias("window")))
    windows = materialize(windows.groupBy("window", "doc", "tag", "begin").agg(F.lit(1).alias("one")), "windows")
    least = materialize(windows.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                        .where("least < most").select(F.col("window").alias("_w"), "least"), "least")
    keyed = (windows.join(least, F.col("window") == F.col("_w")).where("least < doc")
             .select("doc", "tag", "begin", (F.col("begin") + LENGTH).alias("end")))
    return found.where("anchor IS NULL").drop("anchor").union(sorted_).union(keyed)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text of every row.

    Bytes covered by a 50-byte string that also starts in a document with a
    smaller doc_id are removed, judged on the input. ``kept_text`` leaves out
    characters of which a cut left only a part. Null and empty texts have
    nothing to remove, nor do rows without a doc_id; equal doc_ids do not
    remove from one another. Texts are read as whole; a very long one is one row
    of work.
    """
    ranges = repeated_ranges(docs).groupBy("doc", "tag").agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges"))
    source = docs.select("doc_id", "text", _tag_column(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("_tag"))
    joined = source.join(ranges, (F.col("doc_id") == F.col("doc")) & (F.col("_tag") == F.col("tag")), "left")

    def rows(batch):
        out = {"doc_id": batch.column(0), "n_bytes": [], "n_removed": [], "n_spans": [],
               "kept_sha256": [], "kept_text": []}
        lengths = pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy()
        spans = batch.column(2).flatten()
        row, begin, end = _merged(np.repeat(np.arange(len(lengths)), lengths),
                                  *(spans.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)))
        counts = np.bincount(row, minlength=len(lengths)).tolist()
        cuts = iter(zip(begin.tolist(), end.tolist()))
        for text, count in zip(batch.column(1), counts):
            data = (text.as_py() or "").encode()
            kept, at = [], 0
            for begin, end in islice(cuts, count):
                kept.append(data[at:begin])
                at = end
            left = b"".join([*kept, data[at:]])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(left))
            out["n_spans"].append(count)
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            out["kept_text"].append(left.decode(errors="ignore"))
        yield out

    return map_batches(joined.select("doc_id", "text", "ranges"), rows,
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
