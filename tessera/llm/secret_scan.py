"""Secret scan with a random forest against false positives (operator 5).

DataFrame functions only. Every whole text is cut into words. Candidates are long
runs of key characters, whatever is assigned to a secret's name, and the
passwords of URLs. Two tables are counted on the same documents: how often a letter
follows another in words, and the words that occur often (the dictionary). A
random forest on the candidate's length, its changes between character classes,
its letters' transitions, how much of it dictionary words cover, the path it
stands in and the words beside it decides which candidates are secrets.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

MIN_LENGTH = 16  # of a candidate without a secret's name before it
MIN_NAMED = 4  # of a value assigned to a secret's name, and of a URL's password
MIN_COUNT = 5  # occurrences that make a word one of the dictionary
TRAIN_ROWS = 20_000  # bound on the findings a forest is fitted on
TREES, DEPTH = 20, 6
HASHED = 64  # places of the hashed words and paths
THRESHOLD = 0.5
MASK = "[SECRET]"

# What names a secret, and issuers' key formats.
NAMES = ("token", "password", "passwd", "secret", "apikey", "api_key", "access_key", "auth", "credential")
KEY_FORMATS = ("AKIA[0-9A-Z]{16}", "gh[pousr]_[0-9A-Za-z]{36}", "xox[baprs]-[0-9A-Za-z-]{10,}",
               "sk_live_[0-9A-Za-z]{24,}", "AIza[0-9A-Za-z_-]{35}")
VALUE = f"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}={{0,2}}"
NAME = "(?i:" + "|".join(NAMES) + ")[A-Za-z0-9_]*"
FREE = "[^\\s\"'`,;&<>()#]"  # characters of a named value
NAMED_IN_WORD = f"{NAME}[\"']?[:=][\"']?({FREE}{{{MIN_NAMED},}})"
NAMED_BEFORE = f"{NAME}[\"']?[:=]$"
URL_PASSWORD = f"://[^/\\s:@]*:([^/\\s@]{{{MIN_NAMED},}})@"
MIXED = "[0-9]|[a-z][A-Z]"  # a long run without either is a word

SHAPE = ("length", "letter_digit", "case_changes", "upper_share", "transition_odds", "dictionary_share",
         "path_marks", "quoted")
NEIGHBOURS = ("before2", "before", "after", "path")
CONTEXT = ("doc_id", "before2", "before", "word", "after", "value")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, before2, before, word, after, value): one row per candidate.

    Words are runs without ASCII white space. Candidates are: runs of 16 or more key
    characters with a digit or a change from lower to upper case; values of four
    characters or more, whatever they hold, that are assigned to a secret's name in the
    word or by the words before it (``name=``, ``name =``); and passwords of URLs.
    """
    words = docs.select("doc_id", F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1).alias("words"))

    def at(i: Column) -> Column:
        inside = (i >= 1) & (i <= F.size("words"))
        return F.when(inside, F.element_at("words", F.when(inside, i).otherwise(1))).otherwise("")

    def assigned(before: Column, before2: Column) -> Column:
        return before.rlike(NAMED_BEFORE) | (before.rlike("^[:=]+$") & before2.rlike(f"{NAME}[\"']?$"))

    def holds(w: Column, before: Column) -> Column:
        long_run = (F.octet_length(w) >= MIN_LENGTH) & w.rlike(MIXED) & w.rlike(VALUE)
        marked = w.rlike("[:=]") & (w.rlike(NAMED_IN_WORD) | w.rlike(URL_PASSWORD))
        # most words end here: only those after a mark are looked at with what precedes them
        after = before.rlike("[:=]$") & (before.rlike(NAMED_BEFORE) | before.rlike("^[:=]+$"))
        return w.isNotNull() & (long_run | marked | after)

    # each word beside the one before it: no look into the whole array for each word
    beside = F.zip_with("words", F.concat(F.array(F.lit("")), F.col("words")), lambda w, p: F.struct(w.alias("w"), p.alias("p")))
    places = F.array_compact(F.transform(beside, lambda s, i: F.when(holds(s["w"], s["p"]), i)))
    placed = words.withColumn("places", places).where(F.size("places") > 0)
    found = F.transform("places", lambda i: F.struct(
        at(i - 1).alias("before2"), at(i).alias("before"), at(i + 1).alias("word"), at(i + 2).alias("after")))
    rows = placed.select("doc_id", F.explode(found).alias("c")).select("doc_id", "c.*")
    word = F.col("word")

    def every(pattern: str) -> Column:
        return F.regexp_extract_all(word, F.lit(pattern), 1)

    bare = F.regexp_extract(word, f"^[\"'`(]*({FREE}{{{MIN_NAMED},}})", 1)
    named = F.concat(every(NAMED_IN_WORD), F.when(assigned(F.col("before"), F.col("before2")), F.array(bare))
                     .otherwise(F.array().cast("array<string>")))
    named = F.transform(named, lambda v: F.regexp_replace(v, "[.!?:]+$", ""))
    # a word may hold several values: each is a finding
    values = F.array_distinct(F.concat(F.filter(every(f"({VALUE})"), lambda v: v.rlike(MIXED)),
                                       F.filter(named, lambda v: F.length(v) >= MIN_NAMED), every(URL_PASSWORD)))
    return rows.withColumn("value", F.explode(values))


def word_counts(docs: DataFrame) -> DataFrame:
    """(term, n): the lower-cased words of letters a to z only, and how often they occur."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    bare = docs.select(F.explode(words).alias("term")).select(F.rtrim(F.col("term"), F.lit(".,;:!?")).alias("term"))
    return bare.where(F.col("term").rlike("^[a-z]{2,15}$")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def transition_odds(terms: DataFrame) -> list[float]:
    """For each of the 26 x 26 pairs of letters the logarithm of how much likelier the
    second follows the first in words than in random letters (one occurrence added)."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("term") - 1), lambda i: F.col("term").substr(i, F.lit(2)))
    rows = terms.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    count = {r["pair"]: r["n"] for r in rows}  # 676 at most
    letters = [chr(97 + i) for i in range(26)]
    first = {a: sum(count.get(a + b, 0) for b in letters) for a in letters}
    return [(count.get(a + b, 0) + 1) * 26 / (first[a] + 26) for a in letters for b in letters]


def _count(column: Column, pattern: str) -> Column:
    return F.regexp_count(column, F.lit(pattern)).cast("double")


def features(found: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ``path`` and the columns of ``SHAPE``, all doubles; ``terms`` of ``word_counts``."""
    value, length = F.col("value"), F.length("value").cast("double")
    prefix = F.expr("substring_index(word, value, 1)")
    odds = F.array(*[F.lit(x) for x in transition_odds(terms)])
    low = F.lower(F.regexp_replace("value", "[^A-Za-z]", " "))
    pairs = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 1, F.lit(1))), lambda i: low.substr(i, F.lit(2))),
                     lambda p: p.rlike("^[a-z]{2}$"))
    total = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.log(F.get(
        F.col("_odds"), (F.ascii(p) - 97) * 26 + F.ascii(p.substr(F.lit(2), F.lit(1))) - 97)))
    shaped = found.withColumn("_odds", odds).withColumns({
        "length": length,
        "letter_digit": _count(value, "(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]") / length,
        "case_changes": _count(value, "(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / length,
        "upper_share": _count(value, "[A-Z]") / length,
        "transition_odds": F.when(F.size(pairs) > 0, total / F.size(pairs)).otherwise(0.0),
        "path_marks": _count(F.col("word"), "[/\\\\.]"),
        "quoted": prefix.rlike("[\"'`]$").cast("double"),
        "path": F.regexp_extract(prefix, "([^/\\\\]*[/\\\\])[^/\\\\]*$", 1),
    }).drop("_odds")
    # runs of letters in the value, joined to the dictionary: the share of it that they cover
    runs = F.split(F.regexp_replace("value", "(?<=[a-z])(?=[A-Z])", " "), "[^A-Za-z]+", -1)
    parts = found.select("value").distinct().select("value", F.explode(runs).alias("run")).where("length(run) > 2")
    known = terms.where(F.col("n") >= MIN_COUNT).select("term")
    covered = parts.join(known, F.lower("run") == F.col("term")).groupBy("value").agg(
        F.sum(F.length("run")).alias("_covered")).withColumnRenamed("value", "_value")
    return (shaped.join(covered, F.col("value") == F.col("_value"), "left")
            .withColumn("dictionary_share", F.coalesce(F.col("_covered"), F.lit(0)) / F.col("length"))
            .drop("_value", "_covered"))


def labelled(found: DataFrame) -> DataFrame:
    """Findings with ``label``: 1 for issuers' key formats, passwords of URLs and values with
    two digits or more assigned to a secret's name, 0 for numbers, mail addresses and
    other URLs. Others stay unlabelled (null) and are left to the forest, which sees none of
    these signs but the neighbouring words."""
    formats = "^(" + "|".join(KEY_FORMATS) + ")$"
    prefix = F.expr("substring_index(word, value, 1)")
    named = prefix.rlike(f"{NAME}[\"']?[:=][\"']?$") | F.col("before").rlike(NAMED_BEFORE) | (
        F.col("before").rlike("^[:=]+$") & F.col("before2").rlike(f"{NAME}[\"']?$"))
    password = F.array_contains(F.regexp_extract_all("word", F.lit(URL_PASSWORD), 1), F.col("value"))
    harmless = F.col("value").rlike("^[0-9_.+/-]+$") | F.col("word").rlike("@|://")
    return found.withColumn("label", F.when(
        F.col("value").rlike(formats) | password | (named & F.col("value").rlike("[0-9].*[0-9]")), 1.0).when(harmless, 0.0))


def _assembled(found: DataFrame) -> DataFrame:
    """``found`` with ``x``: the shape, and neighbours and path hashed into ``HASHED`` places."""
    lower = found.withColumns({f"_{c}": F.lower(c) for c in NEIGHBOURS})
    hashed = FeatureHasher(inputCols=[f"_{c}" for c in NEIGHBOURS], outputCol="_hashed", numFeatures=HASHED).transform(lower)
    return VectorAssembler(inputCols=[*SHAPE, "_hashed"], outputCol="x").transform(hashed)


def fit_forest(findings: DataFrame, rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest on labelled findings with their features: at most ``rows`` of them,
    those of smallest hash. None if there are none of either label."""
    known = findings.where("label IS NOT NULL")
    sample = materialize(known.select("label", *SHAPE, *NEIGHBOURS, F.xxhash64("doc_id", "value").alias("_h"))
                         .orderBy("_h", "label", *SHAPE, *NEIGHBOURS).limit(rows), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=5,
                                    minInstancesPerNode=2, maxMemoryInMB=64)
    return forest.fit(_assembled(sample))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per finding: doc_id, value, before, after, score, secret.

    ``findings``: labelled findings (the columns of ``candidates`` and ``label``)
    that the forest is trained on; by default those of ``docs`` that ``labelled``
    can tell. If only one label occurs, no forest can be fitted and findings
    without a label of 1 are not secrets. Equal findings of a document (value
    and neighbours) are one row; null and empty texts have none, an empty table gives an
    empty one. Whole texts are scanned, however long.
    """
    terms = materialize(word_counts(docs), "terms")
    found = materialize(features(candidates(docs).distinct(), terms), "candidates")
    known = labelled(found) if findings is None else features(findings, terms)
    model = fit_forest(known)
    if model is None:
        score = F.coalesce(F.col("label"), F.lit(0.0))
        scored = labelled(found).withColumn("score", score)
    else:
        scored = model.transform(_assembled(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "value", "before", "after", "score",
                         (F.col("score") >= threshold).alias("secret"))


def _whole(value: Column) -> Column:
    """A pattern of the value as it stands, with no letter or digit beside it."""
    quoted = F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("(?<![A-Za-z0-9])\\Q"), quoted, F.lit("\\E(?![A-Za-z0-9])"))


def mask_secrets(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret of a text replaced by ``mask`` (longest first, not within
    longer runs of letters and digits) and ``n_chars``, where there is one, counted anew. Rows, other columns (whatever they are
    called) and texts without secrets stay; rows that share a doc_id share secrets;
    rows without one have their text scanned under no id and share those."""
    secrets = materialize(scan_secrets(docs).where("secret").select("doc_id", "value").distinct(), "secrets")
    each = secrets.groupBy("doc_id").agg(F.collect_set("value").alias("found"))
    each = materialize(each.select(F.col("doc_id").alias("of"), "found"), "secrets")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    longest = F.array_sort("found", lambda a, b: F.length(b) - F.length(a))
    text = F.when(F.col("found").isNull(), F.col("doc.text")).otherwise(
        F.aggregate(longest, F.col("doc.text"), lambda acc, v: F.regexp_replace(acc, _whole(v), F.lit(mask))))
    joined = rows.join(each, F.col("doc.doc_id").eqNullSafe(F.col("of")), "left").select("doc", text.alias("masked"))
    return joined.select(*[F.length("masked").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                           else F.col("masked").alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c)
                           for c in docs.columns])
