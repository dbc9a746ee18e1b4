"""SentencePiece encoding with byte spans, and decoding (operator 7).

A text is normalised by longest prefixes of the model's compiled character
map, recording for every normalised byte which source byte it came from. The
normalised text is cut where no piece can reach across (before white space
marks, around line breaks), the parts are merged by the model's piece scores,
and each piece is projected through the recorded alignment to its byte span in
the original text. Parts are merged many at a time in numpy and remembered, as
most words of a corpus repeat.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from tessera.llm.common import map_batches, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
SPAN_SCHEMA = "doc_id long, ids array<int>, begins array<long>, ends array<long>"
WIDE = 48  # symbols; longer parts are merged one by one


class CharacterMap:
    """The compiled character map: a double-array trie over UTF-8 prefixes whose
    values point at zero-ended replacements. An empty map replaces nothing."""

    def __init__(self, blob: bytes = b""):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.replacements = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes consumed, replacement) of the longest prefix at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        # Fixed values (bit layout of a double-array unit): offset in bits 10 and up,
        # shifted by 8 more if bit 9 is set; bit 8 marks a leaf child; value in 31 bits.
        node = units[0] >> 10 << ((units[0] & 512) >> 6)
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units) or units[node] & 0x800000FF != data[end]:
                break
            unit = units[node]
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = end + 1 - at, self.replacements[start:self.replacements.index(b"\0", start)]
        return found


class Model:
    """Pieces, scores and settings of a BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = proto.SentencePiece
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.pieces = [p.piece for p in proto.pieces]
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == kinds.CONTROL}
        self.source_sizes = [len(p.piece.replace(SPACE, " ").encode()) if p.type == kinds.NORMAL else 0
                             for p in proto.pieces]
        self.texts = [p.piece.replace(SPACE, " ") if p.type == kinds.NORMAL else None for p in proto.pieces]
        if len(self.bytes) < 256 or proto.trainer_spec.model_type != 2 or any(
                p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("a BPE model with byte fallback, without user-defined or unused pieces is expected")
        # a part ends before a run of marks, if no piece has a mark after another character
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("pieces that reach across white space are not supported")
        self.cut_lines = not any("\n" in p and p != "\n" for p in normal)
        # symbols: the pieces, then characters that are no piece by themselves
        chars = sorted({c for p in normal for c in p} - {p for p in normal if len(p) == 1})
        self.symbol = {p: i for p, i in normal.items() if len(p) == 1}
        self.symbol.update({c: len(self.pieces) + i for i, c in enumerate(chars)})
        self.other = len(self.pieces) + len(chars)  # any further character: never merges
        known = {**self.symbol, **normal}
        scores = [p.score for p in proto.pieces]
        rank = {s: i for i, s in enumerate(sorted(set(scores), reverse=True))}
        self.merges = {}
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                a, b = known.get(piece[:k]), known.get(piece[k:])
                if a is not None and b is not None:
                    self.merges[a, b] = (rank[scores[i]], i)
        self._hash_merges()

    def _hash_merges(self) -> None:
        """(left, right) -> (rank, merged) as an open-addressing table for numpy."""
        bits = max(4, (4 * len(self.merges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, dtype=np.int64)
        self.ranks = np.zeros(len(self.keys), dtype=np.int32)
        self.made = np.zeros(len(self.keys), dtype=np.int32)
        self.probes = 1
        for (a, b), (rank, made) in self.merges.items():
            key = a << 20 | b
            at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> int(self.shift)
            n = 1
            while self.keys[at] != -1:
                at, n = at + 1, n + 1
            self.probes = max(self.probes, n)
            self.keys[at], self.ranks[at], self.made[at] = key, rank, made

    def _lookup(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        rank = np.full(len(key), np.iinfo(np.int32).max, dtype=np.int32)
        made = np.zeros(len(key), dtype=np.int32)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            found = self.keys[at]
            hit = found == key[open_]
            rank[open_[hit]], made[open_[hit]] = self.ranks[at[hit]], self.made[at[hit]]
            on = ~hit & (found != -1)
            if not on.any():
                break
            at, open_ = at[on] + 1, open_[on]
        return rank, made

    # -- merging ----------------------------------------------------------

    def _ids(self, symbols, part: str) -> list[int]:
        """Symbols that are no pieces become the bytes of their characters."""
        ids, at = [], 0
        for s in symbols:
            n = len(self.pieces[s]) if s < len(self.pieces) else 1
            ids.extend([s] if s < len(self.pieces) else [self.bytes[b] for b in part[at].encode()])
            at += n
        return ids

    def merge_one(self, part: str) -> list[int]:
        """Best score first, leftmost among equals, by a heap: n log n for any length."""
        symbols = [self.symbol.get(c, self.other) for c in part]
        left, right = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        heap = []

        def offer(i):
            j = right[i]
            if j < len(symbols) and (found := self.merges.get((symbols[i], symbols[j]))):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = right[i] if symbols[i] == a else len(symbols)
            if j >= len(symbols) or symbols[j] != b:
                continue
            symbols[i], symbols[j], right[i] = made, None, right[j]
            if right[j] < len(symbols):
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return self._ids([s for s in symbols if s is not None], part)

    def merge_many(self, parts: list[str]) -> list[list[int]]:
        """``merge_one`` of each part; short parts advance together, a merge a round."""
        out: list = [None] * len(parts)
        by_length: dict[int, list[int]] = {}
        for i, part in enumerate(parts):
            by_length.setdefault(-(-len(part) // 6) * 6, []).append(i)
        get, other = self.symbol.get, self.other
        none = np.iinfo(np.int32).max
        for width, places in by_length.items():
            if width > WIDE or len(places) < 8:
                for i in places:
                    out[i] = self.merge_one(parts[i])
                continue
            s = np.full((len(places), width), -1, dtype=np.int64)
            for row, i in enumerate(places):
                s[row, :len(parts[i])] = [get(c, other) for c in parts[i]]
            done = s.copy()
            rows = np.arange(len(s))
            pair = (s[:, :-1] << 20) | s[:, 1:]
            rank, made = self._lookup(np.where(s[:, 1:] < 0, -2, pair).ravel())
            rank, made = rank.reshape(pair.shape), made.reshape(pair.shape)
            cols = np.arange(width)[None]
            while len(s):
                at = rank.argmin(axis=1)  # the leftmost of the best
                r = np.arange(len(s))
                on = rank[r, at] != none
                done[rows[~on]] = s[~on]
                s, rank, made, rows, at = s[on], rank[on], made[on], rows[on], at[on]
                if not len(s):
                    break
                r = np.arange(len(s))
                s[r, at] = made[r, at]
                # close the gap: everything right of the merged pair moves left by one
                take = np.minimum(cols + (cols > at[:, None]), width - 1)
                s = np.take_along_axis(s, take, axis=1)
                s[:, -1] = -1
                take = np.minimum(cols[:, :-1] + (cols[:, :-1] > at[:, None]), width - 2)
                rank, made = np.take_along_axis(rank, take, axis=1), np.take_along_axis(made, take, axis=1)
                rank[:, -1] = none
                for to in (at - 1, at):  # the two pairs beside the merged symbol
                    ok = (to >= 0) & (to < width - 1)
                    a, b = s[r[ok], to[ok]], s[r[ok], to[ok] + 1]
                    new = self._lookup(np.where(b < 0, -2, (a << 20) | b))
                    rank[r[ok], to[ok]], made[r[ok], to[ok]] = new
            lengths = (done >= 0).sum(axis=1).tolist()
            plain = (done < len(self.pieces)).all(axis=1).tolist()  # pieces only
            for row, (i, symbols) in enumerate(zip(places, done.tolist())):
                out[i] = symbols[:lengths[row]] if plain[row] else self._ids(symbols[:lengths[row]], parts[i])
        return out

    # -- normalising ------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, list[int] | None]:
        """(normalised text, source byte of each normalised byte, one past the end
        last). The alignment is None if the text stays byte for byte but for marks
        (one space byte becomes a three-byte mark) and the dummy prefix."""
        if not text:
            return "", None
        if not self.map.units and not self.squeeze:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), None
        data, mark = text.encode(), SPACE.encode()
        out, source = bytearray(), []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:  # one character, as it is
                n = 1 + sum(data[at] >= m for m in (0xC0, 0xE0, 0xF0))
                found = n, data[at:at + n]
            for byte in found[1]:
                if byte == 32:
                    if self.squeeze and (not out or out.endswith(mark)):
                        continue
                    out += mark
                    source += [at] * 3
                else:
                    out.append(byte)
                    source.append(at)
            at += found[0]
        while self.squeeze and out.endswith(mark):
            del out[-3:], source[-3:]
        end = source[-1] if source else 0
        if self.prefix and out:
            out[:0] = mark
            source[:0] = [source[0]] * 3
        return out.decode(), [*source, max(end, len(data))]

    def parts(self, normal: str) -> list[str]:
        """The normalised text cut where no piece reaches across."""
        pattern = _LINES if self.cut_lines else _MARKS
        return pattern.findall(normal)

    # -- results ----------------------------------------------------------

    def spans(self, text: str, normal: str, source: list[int] | None, ids: list[int]):
        """(begins, ends): the source bytes of each piece. The dummy prefix takes
        none; the bytes of one character that has no piece all take the character."""
        if source is None:
            source, at = [], 0
            if self.prefix and normal:
                source = [0, 0, 0]
            for c in text:
                source += [at] * (3 if c == " " else len(c.encode()))
                at += len(c.encode())
            source.append(at)
        begins, ends, at = [], [], 0
        data = normal.encode()
        for i in ids:
            if i in self.byte_of:
                start = at
                while data[start] & 0xC0 == 0x80:
                    start -= 1
                stop = start + 1
                while stop < len(data) and data[stop] & 0xC0 == 0x80:
                    stop += 1
                at += 1
            else:
                start, stop = at, at + len(self.pieces[i].encode())
                at = stop
            begins.append(source[start])
            ends.append(max(source[start], source[stop]))
        return begins, ends

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, marks as spaces without the dummy prefix; bytes that make
        no character become U+FFFD, one by one."""
        texts = [self.texts[i] for i in ids]
        if None not in texts:  # pieces only
            text = "".join(texts)
            return text[1:] if self.prefix and text.startswith(" ") else text
        out, at = [], 0
        while True:
            try:
                special = texts.index(None, at)
            except ValueError:
                break
            out.append("".join(texts[at:special]))
            at, raw = special, bytearray()
            while at < len(ids) and texts[at] is None:
                if ids[at] in self.byte_of:
                    raw.append(self.byte_of[ids[at]])
                else:
                    out.append(_characters(raw))
                    raw = bytearray()
                    if ids[at] == self.unknown:
                        out.append(" ⁇ ")
                    elif ids[at] not in self.silent:
                        out.append(self.pieces[ids[at]].replace(SPACE, " "))
                at += 1
            out.append(_characters(raw))
        text = "".join([*out, *texts[at:]])
        first = next((i for i in ids if i not in self.silent), None)
        if self.prefix and first not in (None, self.unknown) and first not in self.byte_of:
            return text[1:] if self.pieces[first].startswith(SPACE) else text
        return text


def _characters(raw: bytearray) -> str:
    """The bytes as UTF-8; those that make no character become U+FFFD, one by one."""
    out, data = [], bytes(raw)
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as bad:
            out.append(data[:bad.start].decode() + "�")
            data = data[bad.start + 1:]
    return "".join(out)


MEMO_BYTES = 256 << 20  # of a worker's memo
_MARKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_LINES = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


@lru_cache(maxsize=2)
def _model(path: str | None) -> tuple[Model, dict]:
    """A worker's model and memo: part -> (32-bit triples of id, begin and end in
    the part's source, the source's bytes); a mark's source is one space."""
    return Model(path or tokenizer_path(MODEL)), {}


def _learn(model: Model, memo: dict, texts: list[list[str]]) -> None:
    """Puts all parts of ``texts`` into the memo, which starts afresh when it would
    outgrow ``MEMO_BYTES`` (the parts of one group of texts always fit in)."""
    missing = set().union(*texts).difference(memo) if texts else set()
    held = memo.pop(None, 0)
    if held + _weight(missing) > MEMO_BYTES:
        memo.clear()
        held, missing = 0, set().union(*texts)
    memo[None] = held + _weight(missing)
    missing = list(missing)
    sizes = model.source_sizes
    for part, ids in zip(missing, model.merge_many(missing)):
        lengths = [sizes[i] for i in ids]
        if 0 not in lengths:  # pieces only: one after the other
            ends = list(accumulate(lengths))
            begins, at = [0, *ends[:-1]], ends[-1]
        else:
            source, at = [], 0
            for c in part:
                n = len(c.encode())
                source += [at] * n
                at += 1 if c == SPACE else n
            begins, ends = model.spans(part, part, [*source, at], ids)
        memo[part] = (np.array([ids, begins, ends], dtype="<i4").T.tobytes(), at)


def _weight(parts) -> int:
    """Bytes that remembered parts take at most, about: objects, text, 12 a piece."""
    return sum(280 + 13 * len(p) for p in parts)


def _groups(texts, limit: int = 1 << 21):
    """Consecutive texts of about ``limit`` characters (bounds what is listed at once)."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_texts(texts: list[str], model_path: str | None = None):
    """(ids, begins, ends) of each text, as in ``encode``, in a worker."""
    model, memo = _model(model_path)
    normal = [model.normalise(t) for t in texts]
    cut = [model.parts(n) for n, _ in normal]
    _learn(model, memo, cut)
    for text, (normalised, source), parts in zip(texts, normal, cut):
        found = [memo[p] for p in parts]
        got = np.frombuffer(b"".join([f[0] for f in found]), "<i4").reshape(-1, 3)
        if source is None and SPACE not in text:  # parts lie one after the other
            sizes = np.array([f[1] for f in found], dtype=np.int64)
            n_ids = np.array([len(f[0]) // 12 for f in found], dtype=np.int64)
            at = np.repeat(np.cumsum(sizes) - sizes - model.prefix, n_ids)
            begins, ends = np.maximum(got[:, 1] + at, 0), np.maximum(got[:, 2] + at, 0)
        else:
            begins, ends = model.spans(text, normalised, source, got[:, 0].tolist())
        yield got[:, 0], begins, ends


def encode_digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 of every whole text, by
    the encoding of ``encode`` and the decoding of its ids, in one worker a task.

    Ids equal the library's without begin and end ids; the digests are those of
    the ids in decimal joined by commas, of the decoded text, and of the spans
    (all begins, then all ends, as little-endian 64-bit numbers). Null and empty
    texts have no ids. Repeated rows stay repeated; no shuffle. A task holds one model,
    a memo of bounded size and the ids of about two million characters.
    """

    def rows(batch):
        model, _ = _model(model_path)
        done = 0
        for texts in _groups(t.as_py() or "" for t in batch.column(1)):
            out = {"doc_id": batch.column(0).slice(done, len(texts)), "n_tokens": [], "ids_sha256": [],
                   "decoded_sha256": [], "spans_sha256": []}
            done += len(texts)
            for ids, begins, ends in encode_texts(texts, model_path):
                ids = ids.tolist()
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(_sha256(",".join(map(str, ids)).encode()))
                out["decoded_sha256"].append(_sha256(model.decode(ids).encode()))
                out["spans_sha256"].append(_sha256(np.concatenate([begins, ends]).astype("<i8").tobytes()))
            yield out

    return map_batches(docs.select("doc_id", "text"), rows,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, ids, and for each id the half-open byte span of the original text
    (UTF-8) it stands for. Null and empty texts have no ids."""

    def rows(batch):
        done = 0
        for texts in _groups(t.as_py() or "" for t in batch.column(1)):
            ids, begins, ends = zip(*encode_texts(texts, model_path))
            yield {"doc_id": batch.column(0).slice(done, len(texts)), "ids": ids, "begins": begins, "ends": ends}
            done += len(texts)

    return map_batches(docs.select("doc_id", "text"), rows, SPAN_SCHEMA)


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, ids and text of (doc_id, ids); null ids give an empty text."""

    def rows(batch):
        model, _ = _model(model_path)
        yield {"doc_id": batch.column(0), "ids": batch.column(1),
               "text": [model.decode(i.values.to_pylist() if i.is_valid else []) for i in batch.column(1)]}

    return map_batches(encoded.select("doc_id", "ids"), rows, "doc_id long, ids array<int>, text string")
