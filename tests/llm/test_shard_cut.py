"""The cut of groups that do not fit their first shard."""

from __future__ import annotations

from collections import Counter, defaultdict

from tessera.llm.sharding import shard_documents
from tests.llm.test_duplicates import frame


def kept(rows, got):
    of, at = dict(rows), defaultdict(Counter)
    for r in got:
        at[of[r.doc_id]][r.shard] += 1
    return {t: sorted(c.values(), reverse=True) for t, c in at.items()}


def test_a_group_larger_than_a_shard_fills_shards(spark):
    rows = [(i, "same" if i < 160 else f"t{i}") for i in range(480)]
    got = shard_documents(frame(spark, rows), 16).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [30] * 16
    assert kept(rows, got)["same"] == [30, 30, 30, 30, 30, 10]


def test_groups_that_want_the_same_shard_are_not_scattered(spark):
    rows = [(i, f"g{i % 30}") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(400)]
    got = shard_documents(frame(spark, rows), 16).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [50] * 16
    groups = [c for t, c in kept(rows, got).items() if t[0] == "g"]
    assert sum(len(c) == 1 for c in groups) >= 25
    assert sum(n * n for c in groups for n in c) >= 0.9 * sum(sum(c) ** 2 for c in groups)


def test_all_rows_linked_leave_no_room_but_swaps(spark):
    rows = [(i, f"g{i % 40}") for i in range(160)]
    got = shard_documents(frame(spark, rows), 4).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [40] * 4
    assert sum(n * n for c in kept(rows, got).values() for n in c) > 40 * 4 * 1.5
