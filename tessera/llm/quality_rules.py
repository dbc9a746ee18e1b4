"""Host-level quality rules (operator 3).

Every document gets word and line counts and fails or passes each rule. Rule
failures are summed per host (``source``); a host's rate per rule is shrunk
towards the corpus rate with a beta prior whose strength is estimated from
the spread of the hosts' rates (method of moments), so hosts with few pages are
not judged on noise. A host whose shrunk rate passes the limit is rejected, and
its verdict is joined back to all of its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, materialize
from tessera.sources.sinks import Stages

WORD_BREAKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50  # per cent of the words
MAX_SYMBOL_SHARE = 10  # symbols per 100 words
MAX_DUP_LINE_SHARE = 30  # per cent of the lines with a word
WORD_LENGTH = (2, 20)  # mean code points per word
MAX_HOST_RATE = 0.5

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")
# Repeated lines (licences, menus) occur on good pages: they count for the host only.
HOST_ONLY = ("dup_lines",)


def repeat_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = end = 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def text_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """The counts of ``COUNTS`` for one whole text. ``bytes.split`` breaks at
    exactly the six ASCII white space characters."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    return (len(words), len(text) - sum(map(text.count, WORD_BREAKS)), sum(map(text.count, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeat_words(words))


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, counts) of every document; one pass, no shuffle."""

    def rows(batch):
        counts = [text_counts(t.as_py() or "") for t in batch.column(2)]
        names = [c.split()[0] for c in COUNTS.split(", ")]
        yield {"doc_id": batch.column(0), "host": batch.column(1),
               **dict(zip(names, map(list, zip(*counts)) if counts else [[]] * len(names)))}

    return map_batches(docs.select("doc_id", F.col(host).cast("string").alias("host"), "text"), rows,
                       f"doc_id long, host string, {COUNTS}")


def carried_counts(docs: DataFrame, host: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """``document_counts`` with the columns of ``carry`` beside them, of which only the
    text goes through the workers."""
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def rows(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t or "") for t in texts], columns=names)

    # not taken for deterministic, so that no filter on the counts has the texts counted again
    counts = F.pandas_udf(rows, COUNTS).asNondeterministic()
    return docs.select("doc_id", F.col(host).cast("string").alias("host"), counts("text").alias("_counts"),
                       *carry).select("doc_id", "host", "_counts.*", *carry)


def with_rules(counts: DataFrame) -> DataFrame:
    """One boolean per rule: true where the document fails it."""
    low, high = WORD_LENGTH
    return counts.withColumns({
        "fails_short": F.col("n_words") < MIN_WORDS,
        "fails_repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"),
        "fails_symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_SHARE * F.col("n_words"),
        "fails_dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_SHARE * F.col("n_lines"),
        "fails_word_length": (F.col("word_chars") < low * F.col("n_words"))
        | (F.col("word_chars") > high * F.col("n_words")),
    })


def beta_prior(hosts: DataFrame, rule: str) -> list:
    """One-row aggregates from which ``fit_prior`` takes a rule's prior."""
    n, f = F.col("n_docs"), F.col(f"failed_{rule}")
    return [F.sum(f).alias(f"f_{rule}"), F.sum(f * f / n).alias(f"q_{rule}")]


def fit_prior(hosts: float, docs: float, failed: float, squares: float) -> tuple[float, float]:
    """(mean, strength) of the beta prior.

    ``squares`` is sum(failed**2 / docs) over hosts, so squares - failed**2 / docs
    is the weighted spread of the hosts' rates. What binomial noise explains
    (one part per host) is taken off; the rest is the spread between hosts.
    """
    if not docs:
        return 0.0, 1.0
    mean = failed / docs
    noise = mean * (1 - mean)
    between = (squares - docs * mean * mean - (hosts - 1) * noise) / docs
    if between <= 0:
        return mean, 1e6
    return mean, min(max(noise / between - 1, 1.0), 1e6)


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, failed and shrunk rate per rule, host_rejected) for each
    host. Only the prior (a few sums, one row) passes the driver."""
    hosts = materialize(judged.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.col(f"fails_{r}").cast("long")).alias(f"failed_{r}") for r in RULES]), "hosts")
    sums = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("docs"),
                     *[a for r in RULES for a in beta_prior(hosts, r)]).first()
    for rule in RULES:
        mean, strength = fit_prior(sums["hosts"], sums["docs"] or 0, sums[f"f_{rule}"] or 0,
                                   sums[f"q_{rule}"] or 0.0)
        hosts = hosts.withColumn(f"rate_{rule}", (F.col(f"failed_{rule}") + mean * strength)
                                 / (F.col("n_docs") + strength))
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return hosts.withColumn("host_rejected", worst > max_rate)


def rejected_hosts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(_host, host_rejected) of the hosts that are rejected."""
    return host_verdicts(judged, max_rate).where("host_rejected").select(F.col("host").alias("_host"), "host_rejected")


def quality_rules(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Each document with its counts, rule failures, host verdict and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated
    3-word windows. ``kept``: no rule failed but those of ``HOST_ONLY``, and the host is not
    rejected. A
    null or empty text has 0 words and fails; a document without a host is
    judged by itself only; repeated rows count as often as they occur. The
    counts are written once (narrow rows, no text) and read twice. The verdicts
    of the rejected hosts are joined by Spark's own choice of join: a hot host is
    split by adaptive execution.

    With ``carry``, columns that stay beside each row's verdict (the text, say), texts are
    counted twice instead, for the hosts and for the rows, and only the rejected
    hosts are written: the rows need no key to meet their verdicts by.
    """
    if carry:
        with Stages(docs.sparkSession) as stages:
            rejected = stages.keep(rejected_hosts(with_rules(document_counts(docs, host)), max_rate), "rejected")
        judged = with_rules(carried_counts(docs, host, carry))
    else:
        judged = with_rules(materialize(document_counts(docs, host), "counts"))
        rejected = materialize(rejected_hosts(judged, max_rate), "rejected")
    passed = ~F.col("host_rejected")
    for rule in sorted({*RULES} - {*HOST_ONLY}):
        passed = passed & ~F.col(f"fails_{rule}")
    return (judged.join(rejected, F.col("host") == F.col("_host"), "left").drop("_host")
            .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
            .withColumn("base_failed", F.col("fails_short") | F.col("fails_repeats"))
            .withColumn("kept", passed))
