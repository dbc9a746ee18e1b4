"""Stages of the pipeline over repeated and missing doc_ids."""

from __future__ import annotations

import random

import pytest

from corpus_pipeline import STAGES, cut_repeats, drop_near_duplicates, hide_secrets, keep_quality, run
from tests.llm.test_duplicates import frame, words


def stage(spark, f, rows):
    return sorted(((r.doc_id or 0, r.text) for r in f(spark, frame(spark, rows), "").collect()), key=str)


def test_repeated_ids_are_documents_of_their_own(spark):
    rng = random.Random(5)
    a, b, c, d = (" ".join(words(rng, 80)) for _ in range(4))
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c), (None, d), (None, b)]
    assert stage(spark, drop_near_duplicates, rows) == sorted([(1, a), (1, b), (0, c), (0, d)], key=str)
    assert stage(spark, keep_quality, [(1, a), (1, "short"), (None, b), (None, "x")]) == sorted(
        [(1, a), (0, b)], key=str)


def test_cut_texts_stay_with_their_rows(spark):
    rng = random.Random(6)
    shared, a, b, c = (" ".join(words(rng, 40)) for _ in range(4))
    rows = [(1, shared), (2, "A" + a + shared), (2, "B" + b + shared), (None, c)]
    got = stage(spark, cut_repeats, rows)
    assert len(got) == 4 and {t[:9] for _, t in got} == {t[:9] for _, t in rows}
    assert all(shared[:50] not in t for i, t in got if i == 2) and (0, c) in got


CLASHES = ("_id", "_values", "_new", "row", "doc", "cut", "_text", "h", "tag", "masked", "found")


@pytest.mark.parametrize("name,f", STAGES[:4])
def test_stages_keep_columns_of_any_name(spark, name, f):
    from pyspark.sql import functions as F

    rng = random.Random(7)
    rows = [(i, " ".join(words(rng, 90))) for i in range(6)]
    rows += [(9, rows[0][1] + " " + rows[1][1]), (10, "token = 0123456789abcdef0123456789abcdef01234567 " + rows[2][1])]
    docs = frame(spark, rows)
    for c in CLASHES:
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    got = f(spark, docs, "")
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    for r in got.collect():
        assert all(r[c] == f"{c}{r.doc_id}" for c in CLASHES) and r.n_chars == len(r.text)


@pytest.mark.parametrize("name,f", STAGES)
def test_stages_of_an_empty_table(spark, name, f):
    got = f(spark, frame(spark, []), "")
    assert got.count() == 0


def test_secrets_are_masked_and_texts_without_any_stay(spark):
    secret = "0123456789abcdef0123456789abcdef01234567"
    rows = [(1, f"the token = {secret} here"), (1, "nothing here"), (None, None), (2, ""), (None, "clean words only")]
    got = hide_secrets(spark, frame(spark, rows), "").collect()
    texts = sorted((r.text or "") for r in got)
    assert len(got) == 5 and not any(secret in t for t in texts)
    assert "nothing here" in texts and "clean words only" in texts


def test_a_run_leaves_its_result_only(spark, tmp_path):
    import os
    from urllib.parse import urlparse

    from tessera.session import checkpoint_dir

    folder = urlparse(checkpoint_dir(spark)).path.rstrip("/") + "/tables"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, 70))) for i in range(12)]
    rows += [(20, rows[0][1]), (21, rows[1][1] + " end"), (22, "short")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = run(spark, str(tmp_path))
    kept = {r.doc_id for r in out.collect()}
    assert kept == set(range(12))  # a copy, a near copy and a short text are gone
    assert len(set(os.listdir(folder)) - before) == 1


@pytest.mark.parametrize("name,f", STAGES[:3])
def test_a_stage_that_joins_leaves_its_output_only(spark, name, f):
    import os
    from urllib.parse import urlparse

    from tessera.session import checkpoint_dir

    folder = urlparse(checkpoint_dir(spark)).path.rstrip("/") + "/tables"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rng = random.Random(9)
    out = f(spark, frame(spark, [(i, " ".join(words(rng, 70))) for i in range(8)]), "")
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and out.count() == 8 and all(next(iter(left)) in x for x in out.inputFiles())


def test_quality_rules_leave_no_texts(spark):
    """What a stage leaves lies there until the last one is done: the rejected hosts only."""
    import os
    from urllib.parse import urlparse

    from tessera.session import checkpoint_dir

    folder = urlparse(checkpoint_dir(spark)).path.rstrip("/") + "/tables"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rng = random.Random(10)
    rows = [(i, " ".join(words(rng, 70))) for i in range(8)] + [(8, "short"), (None, "x"), (None, None)]
    out = keep_quality(spark, frame(spark, rows), "")
    left = set(os.listdir(folder)) - before
    assert out.count() == 8
    assert all("text" not in str(spark.read.parquet(f"{folder}/{x}").schema) for x in left)


@pytest.mark.parametrize("f", [drop_near_duplicates, cut_repeats])
def test_written_texts_are_packed_tightly(spark, f):
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    rng = random.Random(11)
    out = f(spark, frame(spark, [(i, " ".join(words(rng, 70))) for i in range(8)]), "")
    kept = [pq.ParquetFile(urlparse(x).path).metadata for x in out.inputFiles()]
    assert {m.row_group(0).column(1).compression for m in kept if m.num_rows} == {"ZSTD"}
