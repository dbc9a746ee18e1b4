"""Lexical retrieval packing (operator 6).

Windows are filled with documents about the same things: a seed document asks a
BM25 index for its unused neighbours, which are appended best first until the
window is full; the document that does not fit is cut and its rest seeds the next
window. The index is sharded by a key of the documents' words, so that like texts
lie side by side in its order, and a seed asks the shard at hand: about a million
ids around it in that order. Half of a shard goes on to the next one, so no edge
separates neighbours, and work is in proportion to the corpus.
"""

from __future__ import annotations

import gc
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialize, release, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
K1, B = 1.2, 0.75
INDEX_IDS = 1 << 20  # ids of one index shard: its weights fit a task's memory
INDEX_ROWS = 8192  # documents of one index shard, where they are short
TASK_IDS = 1 << 22  # ids that a task fills windows with
MAX_TASKS = 100_000
FEATURES = 256  # commonest terms that the groups of the shard key look at
GROUPS = 64  # of the shard key
SAMPLE = 2048  # documents that the groups are fitted on
FILLED, STITCHED = 1 << 60, 1 << 61  # first numbers of sequences that tasks fill, and of their stitched rests
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class _Ids(dict):
    """A worker's memo: word or signs -> row of a ragged table of ids."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.data, self.ends = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64)
        self.used = 0

    def add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """New words, their ids one after the other and where each ends."""
        rows = len(self)
        self.data = _room(self.data, self.used + len(ids))
        self.ends = _room(self.ends, rows + len(words))
        self.data[self.used:self.used + len(ids)] = ids
        self.ends[rows:rows + len(words)] = ends + self.used
        self.used += len(ids)
        self.update(zip(words, range(rows, rows + len(words))))


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or a longer copy if it has fewer than ``n`` places."""
    if n <= len(array):
        return array
    out = np.empty(max(n, len(array) + (len(array) >> 1)), array.dtype)
    out[:len(array)] = array
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str | None):
    """A worker's tokenizer, its memo, and how its model spells Latin letters beyond ASCII;
    None if it does not take lower-cased words of Latin letters as they are."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path or tokenizer_path(TOKENIZER))
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    spelling = {ord(c): level.pre_tokenize_str(c)[0][0] for c in _LETTERS if not c.isascii()}
    letters = _LETTERS.lower()
    plain = not any(t.content.isalpha() for t in tokenizer.get_added_tokens_decoder().values())
    if not plain or any([t.id for t in tokenizer.model.tokenize(word.translate(spelling))]
                        != tokenizer.encode(word, add_special_tokens=False).ids for word in (letters, *letters)):
        spelling = None
    return tokenizer, _Ids(), spelling


def _forget_words() -> None:
    """Frees a worker's tokenizer and memo, which later stages have no use for: reused
    workers would hold them beside a shard's index."""
    if _tokenizer.cache_info().currsize:
        _tokenizer.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def _learn(tokenizer, memo: _Ids, missing: list[str]) -> None:
    """Ids of chunks, many in one call: each chunk is normalised, split and merged
    by the tokenizer itself."""
    for at in range(0, len(missing), 20_000):
        chunks = missing[at:at + 20_000]
        got = tokenizer.encode(chunks, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4")
        words = np.array([-1 if w is None else w for w in got.word_ids], dtype=np.int64)
        if len(words) and (words < 0).any():  # special tokens in the text have no word
            alone = [tokenizer.encode(chunk, add_special_tokens=False).ids for chunk in chunks]
            memo.add(chunks, np.fromiter(chain.from_iterable(alone), "<u4"), np.cumsum([len(x) for x in alone]))
        else:
            memo.add(chunks, ids, np.searchsorted(words, np.arange(1, len(chunks) + 1)))


def _learn_words(tokenizer, memo: _Ids, spelling: dict | None, missing: list[str]) -> None:
    """Ids of lower-cased words of Latin letters. Each is one pretoken that the normalizer
    leaves as it is, so the tokenizer's model merges it without either."""
    if spelling is None:
        _learn(tokenizer, memo, missing)
        return
    merge = tokenizer.model.tokenize
    for at in range(0, len(missing), 20_000):
        words = missing[at:at + 20_000]
        got = [[t.id for t in merge(w if w.isascii() else w.translate(spelling))] for w in words]
        memo.add(words, np.fromiter(chain.from_iterable(got), "<u4"),
                 np.cumsum(np.fromiter(map(len, got), np.int64, len(got))))


# Latin letters that lower-case one to one, then ASCII signs without an apostrophe: two
# pretokens, whatever the signs are.
_LETTERS = "".join(filter(str.isalpha, map(chr, [*range(65, 123), *range(0xC0, 0x100)])))
_WORD = f"^[{_LETTERS}]+$"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _parts(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Space-free chunks as a lower-cased word and the signs after it, or as they are and nothing."""
    stem = pc.ascii_rtrim(chunks, characters=_SIGNS)
    word = pc.match_substring_regex(stem, _WORD)
    signs = pc.utf8_ltrim(chunks, characters=_LETTERS)
    return pc.if_else(word, pc.utf8_lower(stem), chunks), pc.if_else(word, signs, "")


def _ragged(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of ids, their bytes one after the other."""
    offsets = np.zeros(len(ends) + 1, np.int64)
    np.multiply(ends, ids.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _run(rows: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of taken rows one after the other, and where each begins, the end last."""
    _, offsets, data = rows.buffers()
    return data or pa.py_buffer(b""), np.frombuffer(offsets, np.int64)[:len(rows) + 1]


MEMO_WORDS = 600_000  # words and groups of signs that a worker remembers
BATCH_CHARS = 1 << 22  # texts whose chunks are looked up together


def _chunk_ids(chunks: pa.Array, path: str | None) -> pa.Array:
    """Ids of distinct chunks."""
    tokenizer, memo, spelling = _tokenizer(path)
    stems, signs = _parts(chunks)
    both = pa.concat_arrays([stems, signs]).dictionary_encode()
    known = both.dictionary.to_numpy(zero_copy_only=False).tolist()
    rows = np.fromiter(map(memo.get, known, repeat(-1)), np.int64, len(known))
    if len(memo) + np.count_nonzero(rows < 0) > MEMO_WORDS:
        memo.clear()
        rows[:] = -1
    at = np.flatnonzero(rows < 0)
    new = both.dictionary.take(pa.array(at))
    word = pc.match_substring_regex(new, _WORD).to_numpy(zero_copy_only=False)
    before = len(memo)
    _learn_words(tokenizer, memo, spelling, new.filter(pa.array(word)).to_numpy(zero_copy_only=False).tolist())
    _learn(tokenizer, memo, new.filter(pa.array(~word)).to_numpy(zero_copy_only=False).tolist())
    rows[np.concatenate([at[word], at[~word]])] = np.arange(before, len(memo))
    codes = rows[both.indices.to_numpy()].reshape(2, -1).T.ravel()
    data, begin = _run(_ragged(memo.data[:memo.used], memo.ends[:len(memo)]).take(pa.array(codes)))
    return pa.Array.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(begin[::2].copy()), data])


def token_bytes(texts: list[str], path: str | None = None) -> list[bytes]:
    """Little-endian 32-bit ids of each text, the end id last. Pieces never reach
    across white space, so a text's ids are those of its chunks in a row."""
    end = END_ID.to_bytes(4, "little")
    out, waiting, size = [], [], 0

    def flush():
        split = pc.split_pattern(pa.array(waiting, pa.large_string()), " ")
        chunks = split.flatten().dictionary_encode()
        data, begin = _run(_chunk_ids(chunks.dictionary.cast(pa.string()), path).take(chunks.indices))
        cuts = begin[split.offsets.to_numpy()].tolist()
        data = memoryview(data)
        out.extend(b"".join((data[a:b], end)) for a, b in zip(cuts, cuts[1:]))
        waiting.clear()

    for text in texts:
        if text.isascii() and "<|" not in text:
            text = text.lower()  # as the tokenizer does; ASCII letters have one form
        waiting.append(text.replace("\n", " "))
        size += len(text)
        if size >= BATCH_CHARS:
            flush()
            size = 0
    if waiting:
        flush()
    return out


def tokenized(docs: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """(node, doc_id, n, ids): a number for each row (fixed once written), and the ids
    of its whole text, 16 bits each. A tokenizer with larger ids is an error."""

    def short(data: bytes) -> bytes:
        wide = np.frombuffer(data, "<u4")
        if wide.max(initial=0) > 0xFFFF:
            raise ValueError("packing takes tokenizers of at most 65,536 ids")
        return wide.astype("<u2").tobytes()

    def rows(batch):
        got = token_bytes([t.as_py() or "" for t in batch.column(1)], tokenizer_file)
        yield {"doc_id": batch.column(0), "n": [len(x) // 4 for x in got], "ids": [short(x) for x in got]}

    return map_batches(docs.select("doc_id", "text"), rows, "doc_id long, n long, ids binary").select(
        F.monotonically_increasing_id().alias("node"), "doc_id", "n", "ids")


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct terms in order, how often each occurs)."""
    ordered = np.sort(ids)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[:len(ids)]
    return ordered[at], np.diff(np.append(at, len(ids)))


SORTED_IDS = 1 << 20  # ids whose documents' distinct terms are found together


def _groups(docs: list[np.ndarray]):
    """(begin, end) of runs of documents of about ``SORTED_IDS`` ids, at most 65,536 documents."""
    begin = size = 0
    for at, ids in enumerate(docs):
        if at > begin and (size + len(ids) > SORTED_IDS or at - begin >= 1 << 16):
            yield begin, at
            begin = at
            size = 0
        size += len(ids)
    if docs:
        yield begin, len(docs)


def _distinct_of(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, how often) of the distinct terms of at most 65,536 documents, in order."""
    owner = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(d) for d in docs])
    key, times = _distinct(owner << np.uint32(16) | np.concatenate(docs))
    return (key >> np.uint32(16)).astype(np.int64), (key & np.uint32(0xFFFF)).astype(np.int64), times


def document_frequencies(ids: DataFrame) -> tuple[np.ndarray, int, float]:
    """(documents per term, documents, mean length) over the whole corpus. A task
    sums its partition and emits one row per term it saw; the result has a row per
    term of the vocabulary at most."""

    def counts(batches):
        _forget_words()
        df, n, tokens = np.zeros(1 << 16, dtype=np.int64), 0, 0
        for batch in batches:
            docs = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(0)]
            n, tokens = n + len(docs), tokens + sum(map(len, docs))
            for begin, end in _groups(docs):
                df += np.bincount(_distinct_of(docs[begin:end])[1], minlength=len(df))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict(
            {"term": [*seen.tolist(), -1, -2], "n": [*df[seen].tolist(), n, tokens]},
            schema=pa.schema([("term", pa.int32()), ("n", pa.int64())]))

    df, totals = np.zeros(1 << 16, dtype=np.int64), {-1: 0, -2: 0}
    for r in ids.select("ids").mapInArrow(counts, "term int, n long").groupBy("term").agg(
            F.sum("n").alias("n")).collect():
        if r["term"] < 0:
            totals[r["term"]] = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, totals[-1], totals[-2] / max(totals[-1], 1)


class Index:
    """The inverted BM25 index of one shard: weights of terms that many documents of
    the shard hold as a matrix, postings of the others."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(docs)
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        key = np.concatenate([d.astype(np.int64) for d in docs]) * self.n + np.repeat(np.arange(self.n), lengths)
        key, tf = np.unique(key, return_counts=True)
        term, doc = np.divmod(key, self.n)
        weight = idf[term] * tf * (K1 + 1) / (tf + (K1 * (1 - B + B * lengths / mean_length))[doc])
        held = np.bincount(term, minlength=len(idf))
        common = np.flatnonzero(held > self.n // 8)
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        dense = self.row[term] >= 0
        self.matrix = np.zeros((len(common), self.n), dtype=np.float32)
        self.matrix[self.row[term[dense]], doc[dense]] = weight[dense]
        self.doc, self.weight = doc[~dense], weight[~dense]
        self.size = np.where(self.row >= 0, 0, held)
        self.begin = np.cumsum(self.size) - self.size

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for all terms of a query document."""
        term = _distinct(ids)[0]
        row = self.row[term]
        asked = np.zeros(len(self.matrix), dtype=np.float32)
        asked[row[row >= 0]] = 1
        size = self.size[term]
        at = np.repeat(self.begin[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return asked @ self.matrix + np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


class Router:
    """Which documents lie near each other in the index: a group by the commonest terms,
    then two terms that consistent weighted sampling draws, so that two documents share
    a drawn term with the probability of their weighted Jaccard similarity."""

    def __init__(self, df: np.ndarray, idf: np.ndarray):
        self.weight = np.where(df > 1, idf, 0)  # a term of one document links it with nothing
        at = np.argsort(-np.where(self.weight > 0, df, 0), kind="stable")[:FEATURES]
        self.column = np.full(len(df), -1)
        self.column[at] = np.arange(len(at))
        self.draws = -np.log(np.random.default_rng(0).uniform(1e-12, 1, (2, len(df))))
        self.centres = np.zeros((1, FEATURES), dtype=np.float32)

    def read(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features of the commonest terms, two drawn terms) of each document; -1 where no
        term counts."""
        features = np.zeros((len(docs), FEATURES), dtype=np.float32)
        drawn = np.full((2, len(docs)), -1)
        for begin, end in _groups(docs):
            doc, term, tf = _distinct_of(docs[begin:end])
            weight = self.weight[term] * tf / (tf + K1)
            on = weight > 0
            doc, term, weight = doc[on] + begin, term[on], weight[on]
            column = self.column[term]
            common = column >= 0
            features[doc[common], column[common]] = weight[common]
            if not len(doc):
                continue
            heads = np.flatnonzero(np.diff(doc, prepend=-1))
            for drawn_, draws in zip(drawn, self.draws):
                value = draws[term] / weight
                least = np.repeat(np.minimum.reduceat(value, heads), np.diff(np.append(heads, len(doc))))
                at = np.flatnonzero(value == least)[::-1]  # the first of equal ones is written last
                drawn_[doc[at]] = term[at]
        return features / np.maximum(np.linalg.norm(features, axis=1, keepdims=True), 1e-9), *drawn

    def fit(self, sample: np.ndarray) -> None:
        """Spherical k-means of a bounded sample's features."""
        if not len(sample):
            return
        self.centres = sample[np.linspace(0, len(sample) - 1, min(GROUPS, len(sample))).astype(int)].copy()
        for _ in range(10):
            group = self.group(sample)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, group, sample)
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            self.centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), self.centres)

    def group(self, features: np.ndarray) -> np.ndarray:
        return np.argmax(features @ self.centres.T, axis=1)


def _rest(data, n: int, window: int) -> np.ndarray:
    """The ids of a document after its whole windows."""
    return np.frombuffer(data.as_buffer(), "<u2")[n // window * window:]


def fitted_router(ids: DataFrame, df: np.ndarray, idf: np.ndarray, window: int) -> Router:
    """The router, its groups fitted on the ``SAMPLE`` documents whose number hashes lowest."""
    router = Router(df, idf)
    order = F.xxhash64("node")
    chosen = [r["node"] for r in ids.select("node").orderBy(order, "node").limit(SAMPLE).collect()]

    def features(batch):
        found = router.read([_rest(x, n, window) for n, x in zip(batch.column(0).to_pylist(), batch.column(1))])[0]
        yield {"features": [x.astype("<f2").tobytes() for x in found]}

    rows = map_batches(ids.where(F.col("node").isin(chosen)).select("n", "ids"), features, "features binary").collect()
    router.fit(np.array([np.frombuffer(r["features"], "<f2") for r in rows], dtype=np.float32).reshape(-1, FEATURES))
    return router


def _routed(ids: DataFrame, router, window: int) -> DataFrame:
    """What documents leave after their whole windows, with the key that the index is
    sharded by."""

    def rows(batch):
        _forget_words()
        node, doc, n, data = batch.columns
        rests = [_rest(x, k, window) for k, x in zip(n.to_pylist(), data)]
        features, first, second = router.value.read(rests)
        yield {"near": router.value.group(features), "first": first, "second": second, "node": node, "doc_id": doc,
               "n": n, "ids": [x.tobytes() for x in rests]}

    return map_batches(ids.where(F.col("n") % window > 0), rows,
                       "near long, first long, second long, node long, doc_id long, n long, ids binary")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _batch(rows, ddl: str) -> pa.RecordBatch:
    """Rows as a batch of the columns "name type, ..."."""
    types = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(name, types[kind]) for name, kind in map(str.split, ddl.split(", "))])
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Filler:
    """Fills a task's windows from the shard of the index at hand.

    ``rows`` are (doc_id, tokens of the document, ids before the first one here, ids) in
    the order of their key. A seed is the first unused row, or the rest of the one that
    the last window cut.
    """

    def __init__(self, idf: np.ndarray, mean_length: float, window: int, base: int):
        self.idf, self.mean_length, self.window, self.sequence = idf, mean_length, window, base
        self.rows: list = []

    def fill(self, ids_left: int, rows_left: int):
        """Pieces of full windows, until no more ids and rows than these are unused, or too
        few for a window; they stay for the next shard."""
        rows, window = self.rows, self.window
        index = Index([r[3] for r in rows], self.idf, self.mean_length)
        left = np.array([len(r[3]) for r in rows], dtype=np.int64)
        total, unused, first, seed = int(left.sum()), len(rows), 0, -1
        while total >= window and (total > ids_left or unused > rows_left):
            while not left[first]:
                first += 1
            seed = first if seed < 0 else seed
            scores = index.scores(rows[seed][3])
            scores[left == 0] = -np.inf
            scores[seed] = np.inf
            best = np.argsort(-scores, kind="stable")
            ends = np.cumsum(left[best])
            last = int(np.searchsorted(ends, window))
            offset, cut = 0, -1
            for at in best[:last + 1].tolist():
                doc_id, tokens, start, ids = rows[at]
                begin, take = len(ids) - int(left[at]), min(int(left[at]), window - offset)
                yield doc_id, start + begin, take, _crc(ids[begin:begin + take]), tokens, self.sequence, offset, False, None
                left[at] -= take
                offset, cut = offset + take, at if left[at] else -1
                unused -= not left[at]
            total, seed, self.sequence = total - window, cut, self.sequence + 1
        order = np.flatnonzero(left)
        if seed >= 0:  # its rest seeds the next window
            order = np.concatenate([[seed], order[order != seed]])
        self.rows = [(d, t, s + len(x) - k, x[len(x) - k:]) for (d, t, s, x), k in (
            (rows[at], int(left[at])) for at in order.tolist())]

    def rest(self):
        """The last window, not full: its pieces with their ids."""
        offset = 0
        for doc_id, tokens, start, ids in self.rows:
            yield doc_id, start, len(ids), 0, tokens, self.sequence, offset, True, ids.tobytes()
            offset += len(ids)


def _filled(routed: DataFrame, idf, mean_length: float, window: int, tokens: int) -> DataFrame:
    """Pieces of all windows; those of a task's last one (``tail``) carry their ids."""
    ddl = f"{PIECES}, tail boolean, ids binary"
    most_ids, most_rows = max(INDEX_IDS, 2 * window), max(INDEX_ROWS, 2 * window)

    def run(batches):
        _forget_words()
        filler = Filler(idf.value, mean_length, window, FILLED + (TaskContext.get().partitionId() << 36))
        size = 0
        for batch in batches:
            for doc_id, n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(x.as_py(), "<u2")
                filler.rows.append((doc_id, n, n - len(ids), ids))
                size += len(ids)
                if size >= most_ids or len(filler.rows) >= most_rows:
                    yield _batch(filler.fill(most_ids // 2, most_rows // 2), ddl)
                    size = sum(len(r[3]) for r in filler.rows)
        if filler.rows:
            yield _batch(filler.fill(0, 0), ddl)
            yield _batch(filler.rest(), ddl)

    key = ["near", "first", "second", "node"]
    tasks = min(max(-(-tokens // TASK_IDS), 1), MAX_TASKS)
    return routed.repartitionByRange(tasks, *key).sortWithinPartitions(*key).select(
        "doc_id", "n", "ids").mapInArrow(run, ddl)


def _stitched(pieces: DataFrame, window: int) -> DataFrame:
    """The tasks' last windows one after the other: cut into full windows, and what is
    left at the end into powers of two, which need no padding."""
    tails = pieces.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    n, total = tails.agg(F.count(F.lit(1)), F.coalesce(F.sum("fill"), F.lit(0))).first()
    buckets = max(1, -(-n // 20_000))
    tails = materialize(tails.select(F.col("sequence_id").alias("tail_id"), "fill",
                                     F.pmod(F.xxhash64("sequence_id"), F.lit(buckets)).alias("bucket")), "tails")
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = tails.groupBy("bucket").agg(F.sum("fill").alias("sum")).select(
        F.col("bucket").alias("b"), F.coalesce(F.sum("sum").over(ahead.orderBy("bucket")), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("fill").over(ahead.partitionBy("bucket").orderBy("tail_id")), F.lit(0))
    tails = tails.withColumn("within", within).join(sums, F.col("bucket") == F.col("b")).select(
        "tail_id", (F.col("before") + F.col("within")).alias("at"))
    full = total // window
    ends = [full * window]
    for bit in range(window.bit_length(), -1, -1):
        if total % window >> bit & 1:
            ends.append(ends[-1] + (1 << bit))

    def rows(batch):
        out = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": [], "sequence_id": [], "offset": []}
        for doc_id, start, tokens, data, at in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.frombuffer(data, "<u2")
            while len(ids):
                if at < ends[0]:
                    q, begin, end = at // window, at // window * window, (at // window + 1) * window
                else:
                    k = int(np.searchsorted(ends, at, side="right"))
                    q, begin, end = full + k - 1, ends[k - 1], ends[k]
                take = min(len(ids), end - at)
                for c, v in zip(out, (doc_id, start, take, _crc(ids[:take]), tokens, STITCHED + q, at - begin)):
                    out[c].append(v)
                start, at, ids = start + take, at + take, ids[take:]
        yield out

    placed = pieces.join(tails, F.col("sequence_id") == F.col("tail_id")).select(
        "doc_id", "start", "doc_tokens", "ids", (F.col("at") + F.col("offset")).alias("at"))
    return map_batches(placed, rows, PIECES)


def _whole_windows(ids: DataFrame, window: int) -> DataFrame:
    """Windows that a long document fills by itself."""

    def run(batches):
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                x, k = np.frombuffer(data.as_buffer(), "<u2"), n // window
                yield _batch(((doc_id, at * window, window, _crc(x[at * window:(at + 1) * window]), n, sequence + at, 0)
                              for at in range(k)), PIECES)
                sequence += k

    return ids.where(F.col("n") >= window).select("doc_id", "n", "ids").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_file: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document (its own end id included, so a null or empty text
    is one id) lies in exactly one piece. Sequences hold at most ``window`` ids;
    those that hold fewer hold a power of two, so none is padded. Repeated rows
    are packed as often as they occur; an empty table gives an empty one. A very
    long text fills windows by itself, and its rest is packed with its neighbours.

    Ids are written once (16 bits each) and document frequencies are counted over
    all of them. The end id, which all documents hold, is no term. Neighbours that
    share no term with the seed come last, in the order of the shard key.
    """
    spark = docs.sparkSession
    ids = materialize(tokenized(docs, tokenizer_file), "ids")
    df, n, mean_length = document_frequencies(ids)
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    idf[END_ID] = 0
    # one number a vocabulary term, and a group's centre for each of GROUPS
    shared = spark.sparkContext.broadcast(idf)
    router = spark.sparkContext.broadcast(fitted_router(ids, df, idf, window))
    filled = materialize(_filled(_routed(ids, router, window), shared, mean_length, window, round(n * mean_length)), "filled")
    whole = materialize(_whole_windows(ids, window), "whole")
    release(ids)
    pieces = filled.where("NOT tail").drop("tail", "ids")
    return whole.union(pieces).union(_stitched(filled.where("tail"), window))
