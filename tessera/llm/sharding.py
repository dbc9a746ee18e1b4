"""Sharding by balanced label propagation (operator 2).

Linked documents should share a shard while shards stay equally full. Links
are memberships (document, group): members of a group are neighbours of one
another, so a group of any size is as many rows as it has members, never pairs.
Each round, every member proposes the shard that most of its neighbours hold, of
those that are not full; proposals between two shards are admitted best gain
first, as far as capacities allow, until no admitted move brings neighbours
together. Documents without links cost nothing to move and fill what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, number_rows

N_SHARDS = 16


def capacities(n_rows: int, n_shards: int) -> list[int]:
    """Rows per shard: equal but for one."""
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def admitted_flows(sizes: list[int], wanted: dict[tuple[int, int], int], caps: list[int]) -> dict:
    """The most of each wanted flow (from, to) such that no shard ends over its
    capacity. Starts with all flows and cuts what overfills a shard; a cut keeps
    rows where they are, so other shards are looked at again until none is over."""
    flow = dict(wanted)
    while True:
        over = None
        for s, cap in enumerate(caps):
            left = (sizes[s] + sum(n for (_, b), n in flow.items() if b == s)
                    - sum(n for (a, _), n in flow.items() if a == s))
            if left > cap and any(n for (_, b), n in flow.items() if b == s):
                over = (s, left - cap)
                break
        if over is None:
            return flow
        s, excess = over
        for key in sorted((k for k in flow if k[1] == s), key=lambda k: (flow[k], k)):
            cut = min(excess, flow[key])
            flow[key] -= cut
            excess -= cut


def _heard(state: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, shard, group) of the members and (heard_group, votes): counts per (group,
    shard), folded before the shuffle."""
    members = materialize(links.join(state, links.member == state.node)
                          .select("node", "shard", "group"), "members")
    votes = members.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    return members, materialize(votes.groupBy("group").agg(
        F.collect_list(F.struct(F.col("shard"), F.col("n"))).alias("votes"))
        .withColumnRenamed("group", "heard_group"), "votes")  # at most one entry per shard


def _kept_links(heard: DataFrame) -> int:
    """Pairs of neighbours (both ways, and each with itself) that share a shard."""
    return heard.select(F.explode("votes").alias("v")).agg(
        F.sum(F.col("v.n").cast("decimal(38,0)") * F.col("v.n").cast("decimal(38,0)"))).first()[0] or 0


def _propose(members: DataFrame, heard: DataFrame, closed: set[int]) -> DataFrame:
    """(node, shard, target, gain) of the nodes that would rather be elsewhere, but
    not in a ``closed`` shard.

    A member reads its groups' at most ``N_SHARDS`` votes. Ties go to a shard that the
    group's hash picks, so all members of a group agree and none swap for ever.
    """
    told = (members.join(heard, members.group == heard.heard_group)
            .select("node", F.col("shard").alias("at"), "group", F.explode("votes").alias("v")))
    tally = (told.groupBy("node", "at", F.col("v.shard").alias("target"))
             .agg(F.sum("v.n").alias("n"), F.min("group").alias("lead"))
             .where((F.col("target") == F.col("at")) | ~F.col("target").isin(*closed)))
    best = tally.groupBy("node", "at", ).agg(
        F.max(F.struct("n", F.xxhash64("lead", "target").alias("tie"), "target")).alias("best"),
        F.max(F.when(F.col("target") == F.col("at"), F.col("n"))).alias("here"))
    return (best.where("best.target <> at")
            .select("node", F.col("at").alias("shard"), F.col("best.target").alias("target"),
                    (F.col("best.n") - F.coalesce("here", F.lit(0))).alias("gain")))


def _regather(members: DataFrame, heard: DataFrame, open_: list[int]) -> DataFrame:
    """(node, shard, target, gain): groups scattered over full shards propose a shard
    with room that the group's hash picks, where none of them may be yet."""
    targets = F.array(*[F.lit(s) for s in open_])
    scattered = heard.where(F.size("votes") > 1)
    told = members.join(scattered, members.group == scattered.heard_group).select(
        "node", "shard", "group", targets[F.pmod(F.xxhash64("group"), F.lit(len(open_))).cast("int")].alias("target"))
    return (told.groupBy("node", "shard").agg(F.min_by("target", "group").alias("target"))
            .where("target <> shard").withColumn("gain", F.lit(0).cast("long")))


def balanced_shards(nodes: DataFrame, links: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(node, shard, slot): shard sizes at most one apart, slots gapless per shard.

    ``nodes``: one long column ``node`` without repeats. ``links``: (member,
    group), groups of two members or more. Counts, capacities and a flow matrix
    of n_shards**2 numbers are all that reach the driver. A group larger than a
    shard fills one and goes on in others. Without links rows are dealt evenly.
    An empty table gives an empty one.
    """
    caps = capacities(nodes.count(), n_shards)
    linked = links.select(F.col("member").alias("node")).distinct()
    state = number_rows(linked, [], ["node"], "at")
    state = materialize(state.select("node", (F.col("at") % n_shards).cast("int").alias("shard")), "state")
    closed: set[int] = set()  # full shards that no move could enter
    last, before, regathered = -1, state, False
    members, heard = _heard(state, links)
    while True:
        kept = _kept_links(heard)
        if kept <= last:  # the last moves brought nothing together
            state = before
            break
        sizes = [0] * n_shards
        for r in state.groupBy("shard").count().collect():
            sizes[r["shard"]] = r["count"]
        while True:
            moves = materialize(_propose(members, heard, closed), "moves")
            wanted = {(r["shard"], r["target"]): r["count"]
                      for r in moves.groupBy("shard", "target").count().collect()}
            flow = admitted_flows(sizes, wanted, caps)
            if any(flow.values()):
                break
            full = {b for _, b in wanted}
            if not full:  # nobody wants to an open shard
                break
            closed |= full
        open_ = [s for s in range(n_shards) if sizes[s] < caps[s]]
        if not any(flow.values()) and open_ and not regathered:
            regathered = True
            moves = materialize(_regather(members, heard, open_), "moves")
            wanted = {(r["shard"], r["target"]): r["count"]
                      for r in moves.groupBy("shard", "target").count().collect()}
            flow = admitted_flows(sizes, wanted, caps)
        if not any(flow.values()):
            break
        if flow != wanted:
            # best gains first: whole gain levels, then by place within the level
            ranked = number_rows(moves, ["shard", "target", "gain"], ["node"], "place")
            levels = moves.groupBy("shard", "target", "gain").agg(F.count(F.lit(1)).alias("n"))
            ahead = Window.partitionBy("shard", "target").orderBy(F.desc("gain")).rowsBetween(
                Window.unboundedPreceding, -1)
            levels = levels.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
            quota = F.create_map(*[F.lit(x) for (a, b), n in flow.items() for x in (a * n_shards + b, n)])
            moves = (ranked.join(levels, ["shard", "target", "gain"])
                     .where(F.col("place") + F.col("ahead")
                            < quota[F.col("shard") * n_shards + F.col("target")]))
        moved = moves.select(F.col("node").alias("moved"), "target")
        last, before = kept, state
        state = materialize(state.join(moved, F.col("node") == F.col("moved"), "left")
                            .select("node", F.coalesce("target", "shard").alias("shard")), "state")
        members, heard = _heard(state, links)
        for (a, b), n in flow.items():
            sizes[a], sizes[b] = sizes[a] - n, sizes[b] + n
        closed = {s for s in closed if sizes[s] >= caps[s]}
    sizes = [0] * n_shards
    for r in state.groupBy("shard").count().collect():
        sizes[r["shard"]] = r["count"]
    free = number_rows(nodes.join(state, "node", "left_anti"), [], ["node"], "at")
    place, end = F.lit(n_shards - 1), 0
    bounds = []
    for s, cap in enumerate(caps):
        end += cap - sizes[s]
        bounds.append((s, end))
    for s, stop in reversed(bounds):
        place = F.when(F.col("at") < stop, F.lit(s)).otherwise(place)
    placed = state.union(free.select("node", place.cast("int").alias("shard")))
    return number_rows(placed, ["shard"], ["node"], "slot").select(
        "node", "shard", F.col("slot").cast("long").alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """All documents over ``n_shards`` shards by the law ``rows``; equal texts are linked.

    Returns doc_id, size (UTF-8 bytes of the text, null: 0, plus 1), text_crc32,
    law, shard, slot, grown_shard (null: the law looks at rows, not keys).
    Repeated rows are separate rows; null and empty texts equal one another.
    The text is read once and leaves as hashes.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h1"),
                       F.xxhash64(F.lit(17), text).alias("h2"))
    rows = number_rows(rows, [], ["doc_id", "h1", "h2"], "node")
    rows = materialize(rows, "rows")
    groups = materialize(rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("group"))
                         .where("n > 1").drop("n"), "groups")
    links = materialize(rows.join(groups, ["h1", "h2"]).select(F.col("node").alias("member"), "group"), "links")
    placed = balanced_shards(rows.select("node"), links, n_shards)
    return rows.join(placed, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
