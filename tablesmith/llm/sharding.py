"""Consistent hashing with bounded loads: a ring of virtual nodes, keys that overflow a full shard go on clockwise.

DataFrame functions only. The ring and the loads of its arcs are small (shards x virtual nodes rows, whatever the
input); the rows themselves are ranked once along the ring and read their shard off their rank.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import OWN, ranked

#: The ring is looked up through 2 ** GRID_BITS equal cells.
GRID_BITS = 12


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """The virtual nodes as sorted (point, shard); points are signed 64-bit and depend on shard and copy only."""
    points = {}
    for shard in range(shards):
        for copy in range(virtual_nodes):
            digest = hashlib.md5(f"shard {shard} node {copy}".encode()).digest()
            points.setdefault(int.from_bytes(digest[:8], "big", signed=True), shard)
    return sorted(points.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """The most rows of each shard: (1 + slack) times the mean, rounded up; without slack the exact share."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(loads: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """Cut the arcs' rows into pieces (arc, first, end, shard); first and end count along the whole ring.

    ``loads`` are the rows of each arc clockwise, ``owners`` the shard of the node that ends it. A shard first
    takes the rows of its own arcs, in ring order, while it has room; what is left of an arc goes on clockwise
    and stops at the first node whose shard has room. So each row is in the first shard clockwise that isn't full.
    """
    room, start, pieces, over = list(room), 0, [], []
    for arc, (load, shard) in enumerate(zip(loads, owners)):
        took = min(load, room[shard])
        room[shard] -= took
        if took:
            pieces.append((arc, start, start + took, shard))
        if took < load:
            over.append((arc, start + took, start + load))
        start += load
    live = [k for k, shard in enumerate(owners) if room[shard]]
    for arc, first, end in over:
        while first < end:
            at = bisect_left(live, arc)
            shard = owners[live[at % len(live)]]
            took = min(end - first, room[shard])
            room[shard] -= took
            pieces.append((arc, first, first + took, shard))
            first += took
            if not room[shard]:
                live = [k for k in live if owners[k] != shard]
    return sorted(pieces, key=lambda p: p[1])


def shard_rows(rows: DataFrame, key: str, shards: int, virtual_nodes: int = 64, slack: float = 0.05) -> DataFrame:
    """``rows`` (narrow ones) with ``shard`` and ``slot``, the row's place in its shard, 0, 1, 2, ...

    Keys are hashed to the ring; a null key is a key like others. Rows of one key follow each other on the ring
    by a hash of all columns, so a key with more rows than a shard may hold goes on into the next shards, as
    any overflow. No shard has more than (1 + slack) times the mean; with ``slack=0`` the shards' counts are at
    most one apart. Equal rows are interchangeable, otherwise shards and slots are the same in each run. An
    empty table gives an empty one.
    """
    spark = rows.sparkSession
    at, arc, tie, rank = OWN + "at", OWN + "arc", OWN + "tie", OWN + "rank"
    nodes = ring(shards, virtual_nodes)
    points = [p for p, _ in nodes]
    shift = 64 - GRID_BITS
    cells = []
    for cell in range(-(1 << GRID_BITS - 1), 1 << GRID_BITS - 1):
        first, end = bisect_left(points, cell << shift), bisect_left(points, (cell + 1) << shift)
        cells.append((cell, points[first:end], first))
    # 2 ** GRID_BITS rows, whatever the input
    grid = F.broadcast(spark.createDataFrame(cells, f"{OWN}cell int, {OWN}points array<bigint>, {OWN}first int"))
    columns = rows.columns
    hashed = rows.select(*columns, F.xxhash64(F.col(key)).alias(at),
                         F.xxhash64(F.lit("tie"), *[F.col(c) for c in columns]).alias(tie))
    # the arc of a row ends at the first node that isn't before it; behind the last node the ring begins anew
    before = F.size(F.filter(F.col(OWN + "points"), lambda p: p < F.col(at)))
    on_ring = (hashed.withColumn(OWN + "cell", F.shiftright(at, shift).cast("int")).join(grid, OWN + "cell")
               .select(*columns, at, tie, ((F.col(OWN + "first") + before) % len(points)).alias(arc)))
    behind = F.when(F.col(at) > points[-1], 1).otherwise(0)
    on_ring = on_ring.withColumn(OWN + "turn", behind)
    order = ranked(on_ring, [OWN + "turn", at, tie, *columns], rank)
    loads = {(r[0], r[1]): r[2] for r in order.groupBy(OWN + "turn", arc).count().collect()}  # a row per arc
    total = sum(loads.values())
    # rows behind the last node rank last, but lie in the first arc: one more arc at the end, of the first's owner
    arcs = [loads.get((0, k), 0) for k in range(len(points))] + [loads.get((1, 0), 0)]
    owners = [s for _, s in nodes] + [nodes[0][1]]
    taken, plan = [0] * shards, []
    for k, first, end, shard in place(arcs, owners, capacities(total, shards, slack)):
        plan.append((k % len(points), k // len(points), first, end, shard, taken[shard]))
        taken[shard] += end - first
    by_arc: dict[tuple[int, int], list] = {}
    for k, turn, *piece in plan:
        by_arc.setdefault((k, turn), []).append(tuple(piece))
    # at most a row for each arc; an arc has another piece only where a shard became full
    pieces = F.broadcast(spark.createDataFrame(
        [(k, turn, p) for (k, turn), p in by_arc.items()],
        f"{arc} int, {OWN}turn int, {OWN}pieces array<struct<first:bigint,end:bigint,shard:int,slot:bigint>>"))
    mine = F.filter(F.col(OWN + "pieces"), lambda p: (p["first"] <= F.col(rank)) & (F.col(rank) < p["end"]))[0]
    return (order.join(pieces, [arc, OWN + "turn"]).withColumn(OWN + "piece", mine)
            .select(*columns, F.col(OWN + "piece")["shard"].alias("shard"),
                    (F.col(OWN + "piece")["slot"] + F.col(rank) - F.col(OWN + "piece")["first"]).alias("slot")))


def shard_documents(docs: DataFrame, shards: int, virtual_nodes: int = 64, slack: float = 0.05) -> DataFrame:
    """Shard documents by ``doc_id``: ``(doc_id, size, text_crc32, shard, slot)``, one row per input row.

    ``size`` is the UTF-8 length of the text plus 16, ``text_crc32`` the unsigned CRC-32 of its UTF-8 bytes; a
    null text counts as empty (16 and 0). Other columns of ``docs`` aren't read. See ``shard_rows``.
    """
    rows = docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    return shard_rows(rows, "doc_id", shards, virtual_nodes, slack)
