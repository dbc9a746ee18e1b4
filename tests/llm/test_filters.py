"""What suffix dedup counts and filters by moves in proportion to the corpus."""

from __future__ import annotations

import random
import string

import numpy as np
import pyarrow as pa

from tessera.llm import common
from tessera.llm import suffix_dedup as sd
from tests.llm.test_duplicates import frame


def test_a_filter_shuffles_each_hash_once_and_holds_it():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 64, (600_000, 30), dtype=np.uint64).min(axis=1)  # like anchors, the least of many
    bits = 1 << 24  # 256 blocks of two parts
    batches = [pa.record_batch([pa.array(hashes[k:k + 1000].view(np.int64))], ["h"]) for k in range(0, len(hashes), 1000)]
    dealt = sorted(common._dealt(batches, bits))
    assert len(dealt) == 2 and sum(len(held) for _, held in dealt) == hashes.nbytes
    fields = dict(common._united(dealt, bits))
    field = np.frombuffer(fields[0] + fields[1], np.uint8)
    assert len(field) == bits // 8 and common.may_hold_hashes(field, hashes).all()
    others = rng.integers(0, 1 << 64, (50_000, 30), dtype=np.uint64).min(axis=1)
    assert common.may_hold_hashes(field, others).mean() < 0.01


def test_a_filter_of_a_table(spark):
    hashes = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 700_000)
    field = common.hash_filter(spark.createDataFrame(pa.table({"h": hashes})), len(hashes))
    assert 8 * len(field) == 1 << 24 and common.may_hold_hashes(field, hashes).all()
    assert common.may_hold_hashes(field, hashes + 1).mean() < 0.01
    none = common.hash_filter(spark.createDataFrame([], "h long"), 0)
    assert not common.may_hold_hashes(none, hashes).any()


def test_anchors_of_several_documents_are_told_from_their_buckets():
    rng = np.random.default_rng(4)
    batches = [(rng.integers(0, 30_000, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                rng.integers(-(1 << 62), 1 << 62, n) // (1 << 60)) for n in (1, 5_000, 20_000)]
    held: dict = {}
    for h, doc in batches:
        told = sd.anchor_buckets(h, doc)
        assert len(set(told["bucket"].tolist())) == len(told["bucket"])
        for bucket, some in zip(told["bucket"].tolist(), told["held"]):
            held.setdefault(bucket, []).append(some)
    met: dict = {}
    for h, doc in batches:
        for a, b in zip(h.tolist(), doc.tolist()):
            met.setdefault(a, set()).add(b)
    got = [a for some in held.values() for a in sd.shared_anchors(some).tolist()]
    assert sorted(got) == sorted(a for a, docs in met.items() if len(docs) > 1) and got


def test_a_bucket_whose_rows_come_in_many_batches_is_counted_as_one(spark, monkeypatch):
    monkeypatch.setattr(sd, "BATCH_BYTES", 1)  # the fold is of many small batches
    passage = "A passage that two documents far from each other have in common, word by word."
    rows = [(i, f"{i} " * 40 + (passage if i in (3, 190) else "")) for i in range(200)]
    anchors = {r.h for r in sd.repeated_anchors(frame(spark, rows).repartition(5)).collect()}
    h = sd.contexts(passage.encode())[0]
    assert set(h.view(np.int64).tolist()) <= anchors


def test_short_strings_that_documents_share_are_no_anchors(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    shared = [text(18) for _ in range(10)]
    rows = [(i, "".join(text(60) + c + some + c for some in shared)) for i, c in enumerate(string.ascii_uppercase)]
    assert sd.repeated_anchors(frame(spark, rows)).count() == 0
