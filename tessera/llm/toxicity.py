"""Toxicity by noisy-channel deobfuscation (operator 13).

Disguised words are read as the noisy output of a channel that replaces letters
by similar signs, puts separators between them or repeats them. The signs that
a place may stand for form a lattice; Viterbi decoding picks the path with the
best sum of a character language model (trigrams counted over all documents) and
the channel's costs. Documents are scored on the restored text: each word has
the log-odds of its strongest sign (the word itself and its beginnings, counted
over labelled documents), and a logistic regression reads the strongest words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.quality_classifier import held_out_fold
from tessera.llm.spelling_variants import lower_ascii

FIT_ROWS = 40_000  # labelled documents the classifier is fitted on, the smallest by a hash
LEXICON = 100_000  # signs kept, the strongest
MIN_TOXIC = 3  # toxic documents that must hold a sign
PRIOR_WEIGHT = 4.0
THRESHOLD = 0.5
N_STATISTICS = 7
MEMO_TOKENS = 600_000
BATCH_BYTES = 1 << 23  # texts whose tokens are looked up together
MEMO_LENGTH = 48  # longer tokens are not remembered
LM_SMOOTHING = 0.5
# The letters a sign may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = " .-_*"
REPLACED, SEPARATED, REPEATED = 1.5, 0.5, 0.5  # costs of the channel, in nats
LETTER = "a-zà-öø-ÿ"
SPACED = re.compile(rf"(?<!\S)[{LETTER}0-9@$!|+](?:[ .\-_*][{LETTER}0-9@$!|+]){{2,}}(?![^\s.,;:!?])")
# ``SPACED`` for a quick look at whole columns; finds a little more, as all signs beyond ASCII may end a word
_EDGE = r"[\s\x0b\x1c-\x1f\x{80}-\x{10ffff}"
MAY_BE_SPACED = (rf"(?:^|{_EDGE}])[{LETTER}0-9@$!|+](?:[ .\-_*][{LETTER}0-9@$!|+]){{2,}}"
                 rf"(?:$|{_EDGE}.,;:!?])")
MIXED = re.compile(rf"[{LETTER}][0-9@$!|+]+[{LETTER}]|^[0-9@$|+]+[{LETTER}]{{2}}|[{LETTER}]{{2}}[0-9@$|+]{{1,2}}$")
STRETCHED = re.compile(rf"([{LETTER}])\1\1")
CLASSES = 32  # of the language model: blank, a-z, digit, other letter, other sign
_CLASS = np.full(256, 29, dtype=np.int64)
_CLASS[list(b" \t\n\r\x0b\x0c")] = 0
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = 27
_CLASS[192:256] = 28


def classes(text: str) -> np.ndarray:
    return _CLASS[np.frombuffer(text.encode("latin-1", "replace"), dtype=np.uint8)]


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of character classes over all texts. A task sums its rows, Spark
    adds up; the driver gets 32 ** 3 numbers at most."""

    def count(batches):
        total = np.zeros(CLASSES ** 3, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                at = classes(f" {text.as_py() or ''} ")
                total += np.bincount((at[:-2] * CLASSES + at[1:-1]) * CLASSES + at[2:], minlength=CLASSES ** 3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(CLASSES ** 3, dtype=np.float64)
    for row in rows.collect():
        out[row["at"]] = row["n"]
    return out


def character_costs(counts: np.ndarray) -> np.ndarray:
    """-log p(next | two before), trigrams smoothed by bigrams, those by a flat rate."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(axis=0) + LM_SMOOTHING
    two /= two.sum(axis=1, keepdims=True)
    weight = 20.0
    return -np.log((three + weight * two[None]) / (three.sum(axis=2, keepdims=True) + weight))


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each character of a span, what it may stand for and the channel's cost.

    A sign may stand for a letter, a separator between single characters for
    nothing, a letter of a run of three or more for nothing once it repeats.
    """
    runs = {}
    for match in STRETCHED.finditer(span):
        at = match.start()
        while at + 1 < len(span) and span[at + 1] == span[at]:
            at += 1
            runs[at] = True
    single = SPACED.fullmatch(span) is not None
    places = []
    for at, sign in enumerate(span):
        options = [(sign, 0.0)]
        options += [(letter, REPLACED) for letter in LOOKS_LIKE.get(sign, "")]
        if (single and sign in SEPARATORS) or at in runs:
            options.append(("", REPEATED if at in runs else SEPARATED))
        places.append(options)
    return places


def decode(span: str, costs: np.ndarray) -> str:
    """The cheapest path through the span's lattice, read between blanks."""
    states = {(0, 0): 0.0}
    steps = []
    for options in [*lattice(span), [(" ", 0.0)]]:
        following: dict = {}
        back: dict = {}
        for (a, b), so_far in states.items():
            for sign, cost in options:
                if sign:
                    c = int(classes(sign)[0])
                    to, total = (b, c), so_far + cost + costs[a, b, c]
                else:
                    to, total = (a, b), so_far + cost
                if to not in following or total < following[to]:
                    following[to], back[to] = total, ((a, b), sign)
        states = following
        steps.append(back)
    at = min(states, key=states.get)
    out = []
    for back in reversed(steps):
        at, sign = back[at]
        out.append(sign)
    return "".join(reversed(out))[:-1]


def restore_token(token: str, costs: np.ndarray) -> str:
    if STRETCHED.search(token) or (not token.isalpha() and MIXED.search(token)):
        return decode(token, costs)
    return token


def joined(text: str, costs: np.ndarray) -> str:
    """The lower-cased text with its spaced-out words decoded."""
    text = lower_ascii(text)
    return SPACED.sub(lambda m: decode(m[0], costs), text) if SPACED.search(text) else text


def restore(text: str | None, costs: np.ndarray) -> str:
    """The whole text in lower case with every disguised word decoded."""
    return re.sub(r"\S+", lambda m: restore_token(m[0], costs), joined(text or "", costs))


WORD = re.compile(r"[^\W_]+")


def signs(token: str) -> list[int]:
    """Hashes of a restored token's words and of their first four to six bytes."""
    bare = token.strip(".,;:!?")
    out = []
    for word in (bare,) if bare.isalpha() else WORD.findall(bare):
        data = word.encode()
        out.append(crc32(data))
        if len(data) >= 4:
            out.append(crc32(data[:4], 4))
            if len(data) >= 5:
                out.append(crc32(data[:5], 5))
                if len(data) >= 6:
                    out.append(crc32(data[:6], 6))
    return out


class Tokens(dict):
    """token -> value, for short tokens remembered up to a number of entries."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, token):
        value = self.compute(token)
        if len(token) <= MEMO_LENGTH:
            if len(self) >= MEMO_TOKENS:
                self.clear()
            self[token] = value
        return value


def tokens_of(text: str | None, costs: np.ndarray) -> Counter:
    return Counter(joined(text or "", costs).split())


def slices(batch: pa.RecordBatch):
    """The batch in runs of rows of about ``BATCH_BYTES`` of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.unique(np.searchsorted(size, np.arange(0, size[-1], BATCH_BYTES))) if len(size) else size
    for begin, end in zip(cuts.tolist(), [*cuts.tolist()[1:], len(size)]):
        yield batch.slice(begin, end - begin)


def column_tokens(texts: pa.Array, costs: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct tokens, token of each occurrence, its row) of a column: the tokens of
    ``tokens_of`` for many texts at once."""
    texts = pc.ascii_lower(pc.fill_null(texts, ""))
    spaced = pc.match_substring_regex(texts, MAY_BE_SPACED)
    if pc.any(spaced).as_py():
        told = [joined(t, costs) for t in texts.filter(spaced).to_pylist()]
        texts = pc.replace_with_mask(texts, spaced, pa.array(told, texts.type))
    words = pc.utf8_split_whitespace(texts)
    tokens = words.flatten().dictionary_encode()
    code = tokens.indices.to_numpy()
    row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    known = tokens.dictionary.to_numpy(zero_copy_only=False).tolist()
    if "" in known:  # before or after white space at an end
        on = code != known.index("")
        code, row = code[on], row[on]
    return known, code, row


def sign_counts(train: DataFrame, costs: np.ndarray) -> DataFrame:
    """(sign, toxic, clean): labelled documents of each kind that hold the sign."""

    def count(batches):
        memo = Tokens(lambda t: tuple(signs(restore_token(t, costs))))
        for batch in batches:
            held: tuple = ([], [])
            for text, y in zip(*batch.columns):
                seen = set()
                for token in tokens_of(text.as_py(), costs):
                    seen.update(memo[token])
                held[y.as_py()].append(np.fromiter(seen, dtype=np.int64, count=len(seen)))
            for y in (0, 1):
                if held[y]:
                    sign, n = np.unique(np.concatenate(held[y]), return_counts=True)
                    zero = np.zeros(len(n), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sign), pa.array(n if y else zero), pa.array(zero if y else n)],
                        ["sign", "toxic", "clean"])

    return (train.select("text", "y").mapInArrow(count, "sign long, toxic long, clean long")
            .groupBy("sign").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def log_odds(toxic: int, clean: int, share: float) -> float:
    """Log-odds of toxic given the sign, above those of the share; 0 if below."""
    return max(0.0, math.log((toxic + PRIOR_WEIGHT * share) / (clean + PRIOR_WEIGHT * (1 - share)))
               - math.log(share / (1 - share)))


def statistics(docs: DataFrame, costs: np.ndarray, lexicon: dict, share: float, label: str | None = None) -> DataFrame:
    """(doc_id, y, x) of every row: ``N_STATISTICS`` numbers of its strongest words.

    With a ``label`` column, a document's own count is taken out of its signs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def describe(batches):
        known = shared.value

        def weights(token):
            found = [known[s] for s in signs(restore_token(token, costs)) if s in known]
            return None if not found else (
                max(log_odds(a, b, share) for a, b in found),
                max(log_odds(a, max(b - 1, 0), share) for a, b in found),
                max(log_odds(max(a - 1, 0), b, share) for a, b in found))

        memo = Tokens(weights)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"), strongest(part, memo)], ["doc_id", "y", "x"])

    def strongest(part, memo):
        known, code, row = column_tokens(part.column("text"), costs)
        found = [memo[t] for t in known]
        held = np.array([w is not None for w in found], dtype=bool)
        values = np.array([w or (0.0, 0.0, 0.0) for w in found]).reshape(-1, 3)
        total = np.bincount(row, minlength=len(part)).tolist()
        on = held[code] if len(code) else np.zeros(0, dtype=bool)
        key, n = np.unique(row[on] * max(len(known), 1) + code[on], return_counts=True)
        row, code = np.divmod(key, max(len(known), 1))
        pick = 0 if label is None else 1 + part.column("y").to_numpy()[row]
        w = values[code, pick]
        order = np.lexsort([-w, row])
        row, w, n = row[order], w[order], n[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        x = np.zeros((len(part), N_STATISTICS))
        x[row[place < 3], place[place < 3]] = w[place < 3]
        strong = w >= 2
        words = np.bincount(row[strong], minlength=len(part)).tolist()
        times = np.bincount(row[strong], weights=n[strong], minlength=len(part)).tolist()
        x[:, 3:] = [(math.log1p(a), math.log1p(b), math.log1p(c), b / max(1, c)) for a, b, c in zip(words, times, total)]
        return pa.ListArray.from_arrays(np.arange(0, x.size + 1, N_STATISTICS, dtype=np.int32), x.ravel())

    y = F.col(label).cast("int") if label else F.lit(0)
    return docs.select("doc_id", "text", y.alias("y")).mapInArrow(describe, "doc_id long, y int, x array<double>")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights of [1, x] by Newton steps."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)),
                               z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    The character model counts all documents; signs and regression are fitted on
    at most ``FIT_ROWS`` labelled documents outside the held-out fold. With no
    such rows, or one class only, every score is that class's share (0.5 without
    labels). Repeated labels of a document count once (1 if any is); null labels
    are left out. A null or empty text has no words and is scored like any
    other; texts are read whole; repeated rows stay repeated; an empty table
    gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    held_out = held_out_fold(F.col("doc_id"), folds).alias("held_out")
    marks = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("y"))
             .where(~held_out_fold(F.col("doc_id"), folds))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).withColumnRenamed("doc_id", "label_id"))
    # the side is bounded by FIT_ROWS
    train = materialize(docs.join(F.broadcast(marks), F.col("doc_id") == F.col("label_id"))
                        .select("doc_id", "text", "y"), "toxic-train")
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("share")).first()
    if not seen["n"] or seen["share"] in (0.0, 1.0):
        score = F.lit(float(seen["share"]) if seen["n"] else 0.5)
        return docs.select("doc_id", held_out, score.alias("score"),
                           (score >= THRESHOLD).cast("int").alias("predicted"))
    share = float(seen["share"])
    costs = character_costs(character_counts(docs))
    kept = (sign_counts(train, costs).where(F.col("toxic") >= MIN_TOXIC)
            .where(F.col("toxic") * (1 - share) > F.col("clean") * share)
            .orderBy((F.col("toxic") / (F.col("clean") + 1)).desc(), "sign").limit(LEXICON))
    lexicon = {r["sign"]: (r["toxic"], r["clean"]) for r in kept.collect()}
    if seen["n"] > FIT_ROWS:  # ids that repeat in the documents
        train = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(seen["n"])) < FIT_ROWS)
    fit = statistics(train, costs, lexicon, share, "y").select("y", "x").toPandas()
    x = np.array(fit["x"].tolist())
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    w = logistic((x - mean) / scale, fit["y"].to_numpy(dtype=float))
    slopes = w[1:] / scale
    raw = F.lit(float(w[0] - slopes @ mean))
    for k in range(N_STATISTICS):
        raw = raw + F.col("x")[k] * float(slopes[k])
    scored = statistics(docs, costs, lexicon, share).withColumn("score", 1 / (1 + F.exp(-raw)))
    return scored.select("doc_id", held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def restored_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, restored): every text with its disguised words decoded by a character
    model of the same documents; a null text is empty."""
    costs = character_costs(character_counts(docs))

    def rows(batches):
        for batch in batches:
            texts = [restore(t.as_py(), costs) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "restored"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, restored string")
