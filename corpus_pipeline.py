"""From raw documents to packed training sequences: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's documents; all but the last return the columns
of ``documents``. Rows that repeat a doc_id, or have none, are documents of their
own: quality rules judge each row where it stands, the other stages that drop, cut or
mask rows number their input first and run on that row key. What a stage's operator
writes for itself is removed once its verdicts are written. Stages that join the
verdicts to the texts write their output, too, so the numbered rows and the join's
shuffle files are gone when the next stage begins. That output lies there until all
is done, as no stage can know when it was read, so written texts are packed tightly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, materialize
from tessera.llm.near_duplicates import near_duplicate_classes
from tessera.llm.packing import pack
from tessera.llm.quality_rules import quality_rules
from tessera.llm.secret_scan import mask_secrets
from tessera.llm.suffix_dedup import remove_repeats
from tessera.sources.sinks import Stages, collect_spent, release

# Signatures, suffix arrays and packing are beyond SQL; tests hold the stages
# against plain versions instead.
ORACLE_SQL = None

TEXTS = "zstd"  # compression of written texts: two thirds of what Spark's default leaves


def numbered(docs: DataFrame, ordered: bool = True) -> DataFrame:
    """(row, doc): a written row key and the document as a struct, so no column's name can
    clash. ``ordered`` keys follow the doc_id, rows without one last; others cost no
    shuffle."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    if ordered:
        order = [F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.xxhash64("doc.text")]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "rows", TEXTS)
    collect_spent(rows.sparkSession)
    return rows


def by_row(rows: DataFrame) -> DataFrame:
    """The numbered documents' texts and sources with the row key as their doc_id."""
    return rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"), F.col("doc.lang").alias("lang"),
                       F.col("doc.source").alias("source"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that a rule or their host's verdict rejects go, each
    row by its own text. Nothing but the rejected hosts is written."""
    rows = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    return quality_rules(rows, carry=["_doc"]).where("kept").select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: the row with the smallest id of each class stays (a class of
    rows without ids keeps one, too). Texts without words are in no class and stay."""
    with Stages(spark) as stages:
        rows = numbered(docs)
        with Stages(spark) as inner:
            kept = inner.keep(near_duplicate_classes(by_row(rows)).where("kept").select(F.col("doc_id").alias("row")))
        return stages.keep(rows.join(kept, "row", "left_semi").select("doc.*"), compression=TEXTS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated passages go; documents without a word left go as a whole."""
    with Stages(spark) as stages:
        rows = numbered(docs)
        with Stages(spark) as inner:
            left = inner.keep(remove_repeats(by_row(rows)).where("n_removed > 0").select(
                F.col("doc_id").alias("cut_row"), F.col("kept_text").alias("cut")))
        joined = rows.join(left, F.col("row") == F.col("cut_row"), "left")
        kept = joined.where("cut_row IS NULL OR cut RLIKE '[^\\\\s]'")
        was = F.col("cut_row").isNull()
        return stages.keep(kept.select(*[
            F.when(was, F.col(f"doc.`{c}`")).otherwise(
                F.col("cut") if c == "text" else F.length("cut").cast(docs.schema[c].dataType)).alias(c)
            if c in ("text", "n_chars") else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]), compression=TEXTS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: secrets are masked in the text, documents stay."""
    rows = numbered(docs, ordered=False)
    masked = mask_secrets(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"), "doc"))
    same = F.col("text").eqNullSafe(F.col("doc.text"))
    return masked.select(*[
        F.col("text") if c == "text"
        else F.when(same, F.col("doc.n_chars")).otherwise(F.length("text").cast(docs.schema[c].dataType)).alias(c)
        if c == "n_chars" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Retrieval packing: one row per piece of a sequence."""
    return pack(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("secret_scan", hide_secrets),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``. Only they stay: what a stage writes for
    itself, and its input, are removed once its output is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with Stages(spark) as stages:
            before, docs = docs, stages.keep(stage(spark, docs, sf_dir), name, TEXTS)
        release(before)
    return docs
