"""Quality classifier: random Fourier features, ridge scores, isotonic calibration (operator 4).

Documents are described by statistics of their whole text. Cosines of random
projections of the standardised statistics approximate a Gaussian kernel; the
ridge weights solve normal equations that every partition sums for itself and
Spark adds up. Raw scores are calibrated by isotonic regression on a fine
histogram of the training scores.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialize

N_FOURIER = 192
RIDGE = 1e-3
BANDWIDTH = 2.5
SEED = 20
BINS = 2048  # of the calibration histogram
THRESHOLD = 0.3
PUNCTUATION = ".,;:!?\"'()-"
SYMBOLS = "#*$%&|<>{}[]\\/=_~^+@"
N_STATISTICS = 19


def statistics(text: str) -> list[float]:
    """``N_STATISTICS`` numbers describing a whole text; all zero if it is empty."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * N_STATISTICS
    n, chars = len(words), max(len(text), 1)
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    lower = text.lower()
    upper = sum(a != b for a, b in zip(text, lower)) if text != lower and len(lower) == len(text) else 0
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    top = counts.most_common(3)
    punctuation = [text.count(c) for c in PUNCTUATION]
    return [
        np.log1p(n), np.log1p(len(lines)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        len(counts) / n, np.log1p(n) * (1 - len(counts) / n), pairs, top[0][1] / n, sum(c for _, c in top) / n,
        upper / chars, sum(punctuation) / chars, text.count("!") / n, sum(map(text.count, SYMBOLS)) / n,
        text.count("|") / n, sum(map(text.count, "0123456789")) / chars,
        1 - len(set(lines)) / len(lines), n / len(lines) / (10 + n / len(lines)),
        sum(map(text.count, ".?")) / n,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every document; one pass, no shuffle."""

    def rows(batch):
        x = [statistics(t.as_py() or "") for t in batch.column(1)]
        yield {"doc_id": batch.column(0), "x": x}

    return map_batches(docs.select("doc_id", "text"), rows, "doc_id long, x array<double>")


def held_out_fold(doc_id, folds: int = 5):
    """True where crc32 of the id's text leaves no remainder: never trained on."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds == 0


class Fourier:
    """z(x) = [1, sqrt(2/D) cos(W (x - mean) / scale + b)] with W ~ N(0, 1/bandwidth**2)."""

    def __init__(self, mean, scale, n_fourier=N_FOURIER, bandwidth=BANDWIDTH, seed=SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.asarray(mean), np.asarray(scale)
        self.w = rng.normal(0, 1 / bandwidth, (len(self.mean), n_fourier))
        self.b = rng.uniform(0, 2 * np.pi, n_fourier)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        std = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.b)) * np.cos(std @ self.w + self.b)
        return np.hstack([np.ones((len(x), 1)), z])


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), N_STATISTICS)


def normal_equations(train: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over (x, y). A task sums its partition and emits one matrix row
    per feature; Spark adds matrix rows feature by feature in two levels. The
    driver receives one matrix, whose size is set by the parameter alone."""
    d = len(fourier.b) + 1

    def sums(batches):
        import pyarrow as pa

        total = np.zeros((d, d + 1))
        for batch in batches:
            if len(batch):
                z = fourier(_matrix(batch.column(0)))
                total += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        salt = int(np.random.default_rng(zlib.crc32(total.tobytes())).integers(16))
        yield pa.RecordBatch.from_pydict(
            {"i": list(range(d)), "salt": [salt] * d, "row": [r.tobytes() for r in total]},
            schema=pa.schema([("i", pa.int32()), ("salt", pa.int32()), ("row", pa.binary())]))

    def add(frame):
        first = frame.iloc[[0]].copy()
        first["row"] = [np.sum([np.frombuffer(r) for r in frame["row"]], axis=0).tobytes()]
        return first

    schema = "i int, salt int, row binary"
    parts = train.select("x", F.col("y").cast("double")).mapInArrow(sums, schema)
    level = parts.groupBy("i", "salt").applyInPandas(add, schema)
    rows = level.groupBy("i").applyInPandas(add, schema).collect()
    total = np.zeros((d, d + 1))
    for r in rows:
        total[r["i"]] = np.frombuffer(r["row"])
    return total[:, :d], total[:, d]


def isotonic(bins: list[tuple[int, float, float]]) -> list[tuple[int, float]]:
    """Pool adjacent violators over (bin, weight, label sum) in bin order; returns
    (first bin, value) steps."""
    blocks: list[list[float]] = []
    for at, weight, hits in sorted(bins):
        blocks.append([at, weight, hits])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            _, w, h = blocks.pop()
            blocks[-1][1] += w
            blocks[-1][2] += h
    return [(int(at), hits / weight) for at, weight, hits in blocks]


def score_frame(stats: DataFrame, fourier: Fourier, weights: np.ndarray) -> DataFrame:
    """Adds ``raw``, the ridge score."""

    def rows(batch):
        x = _matrix(batch.column("x"))
        raw = fourier(x) @ weights if len(x) else np.zeros(0)
        yield {n: batch.column(n) for n in batch.schema.names} | {"raw": raw}

    fields = ", ".join(f"{n} {t}" for n, t in stats.dtypes)
    return map_batches(stats, rows, f"{fields}, raw double")


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, raw.

    Trained on all labelled rows outside the held-out fold; with none of them
    (or one class only) every score is that class's share, 0.5 without labels.
    Repeated labels of a document count once (their mean); null labels are left
    out. A null or empty text has zero statistics and is scored like any other.
    Repeated documents stay repeated. Statistics are written once and read by
    the fits and the scoring, so texts are scanned once.
    """
    stats = materialize(document_statistics(docs), "statistics").withColumn(
        "held_out", held_out_fold(F.col("doc_id"), folds))
    marks = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.avg("quality").alias("y")).withColumnRenamed("doc_id", "label_id"))
    train = materialize(stats.where(~F.col("held_out"))
                        .join(marks, F.col("doc_id") == F.col("label_id")).select("x", "y"), "train")
    moments = train.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *[
        f(F.col("x")[i]).alias(f"{n}{i}") for i in range(N_STATISTICS)
        for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not moments["n"] or moments["y"] in (0.0, 1.0):
        share = moments["y"] if moments["n"] else 0.5
        scored = stats.withColumn("raw", F.lit(float(share))).withColumn("score", F.lit(float(share)))
    else:
        fourier = Fourier([moments[f"m{i}"] for i in range(N_STATISTICS)],
                          [max(moments[f"s{i}"], 1e-9) for i in range(N_STATISTICS)])
        zz, zy = normal_equations(train, fourier)
        ridge = RIDGE * moments["n"] * np.eye(len(zz))
        ridge[0, 0] = 0
        weights = np.linalg.solve(zz + ridge, zy)
        at = F.least(F.greatest(F.floor((F.col("raw") + 0.5) * (BINS / 2)), F.lit(0)), F.lit(BINS - 1))
        bins = (score_frame(train, fourier, weights).groupBy(at.alias("bin"))
                .agg(F.count(F.lit(1)).alias("w"), F.sum("y").alias("hits")).collect())
        steps = isotonic([(r["bin"], float(r["w"]), float(r["hits"])) for r in bins])
        score = F.lit(steps[0][1])
        scored = score_frame(stats, fourier, weights).withColumn("_bin", at)
        edges = F.array(*[F.lit(s[0]) for s in steps])
        values = F.array(*[F.lit(float(s[1])) for s in steps])
        place = F.size(F.filter(edges, lambda e: e <= F.col("_bin")))
        score = F.element_at(values, F.greatest(place, F.lit(1)))
        scored = scored.withColumn("score", score).drop("_bin")
    return scored.select("doc_id", "held_out", "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "raw")
