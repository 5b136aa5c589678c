"""Balanced label propagation: linked documents gather in few shards, all shards stay equally large.

Documents are linked with those of the same text. They start spread over the
shards; in each round those that have more of their neighbours in another shard
ask to move to the one with most. Documents of one text and one shard have the
same neighbours, so they are one cell with a count, and a text has at most as
many cells as there are shards, however many copies it has. Requests are summed
by (from, to, gain) - a table bounded by the number of shards - and quotas are
set so that no shard takes in more than its capacity allows after what surely
leaves it. Documents without a link have no edge to cut; they fill the shards
up to their exact size at the end.

All row work is DataFrame operations; the driver sees only the table of sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.shared import Scratch, whole_text
from massloom.operators.ordering import number_rows, running_total

#: Rounds at most, a part of the method: labels that would still move then stay where they are, and sizes are even
#: all the same. More rounds cut fewer edges. Rounds in which full shards may be asked for, so that documents can change places.
ROUNDS, EXCHANGES = 12, 4
#: Rows by which a shard may be larger than its share while labels move, as a part of the share and besides.
SLACK, SLACK_ROWS = 0.02, 2
#: Requests of one pair of shards and one gain fall into so many parts by hash.
PARTS = 16


@dataclass
class Quotas:
    """For each pair (from, to): requests with a key below ``cutoff`` move, of those at it ``share``."""

    cutoff: np.ndarray
    share: np.ndarray
    granted: int


def set_quotas(requests: list[tuple[int, int, int, int]], load: np.ndarray, capacity: np.ndarray) -> Quotas:
    """Quotas for requests (from, to, key, count), lower keys first, that keep every load within its capacity.

    A shard may take in its free room and what surely leaves it: only requests
    that move as a whole count as leaving, while a shared one counts in full as
    coming. Quotas only ever shrink until all shards are satisfied; the last
    resort counts on nothing that leaves.
    """
    shards = len(load)
    # For one target the order is by key; equal keys start with another source for each target.
    order = sorted(requests, key=lambda r: (r[1], r[2], (r[0] - r[1]) % shards))
    source, target, key, count = (np.array([r[k] for r in order], np.int64) for k in range(4))
    granted = count.copy()
    starts = np.searchsorted(target, np.arange(shards + 1))
    for turn in range(200):
        left = np.bincount(source[granted == count], weights=count[granted == count], minlength=shards)
        room = capacity - load + (left.astype(np.int64) if turn < 199 else 0)
        before = granted.copy()
        for shard in range(shards):
            here = slice(starts[shard], starts[shard + 1])
            came = np.cumsum(granted[here]) - granted[here]
            granted[here] = np.clip(room[shard] - came, 0, granted[here])
        if np.array_equal(granted, before):
            break
    cutoff = np.full((shards, shards), -1, np.int64)
    share = np.zeros((shards, shards))
    closed: set[tuple[int, int]] = set()
    for s, t, k, c, g in sorted(zip(source, target, key, count, granted, strict=True)):
        # In the order of keys a pair's requests are granted whole, then one in part, then none.
        if (s, t) in closed:
            continue
        if g == c:
            cutoff[s, t] = k + 1
        else:
            cutoff[s, t], share[s, t] = k, g / c
            closed.add((s, t))
    return Quotas(cutoff, share, int(granted.sum()))


def _of_pair(values: np.ndarray, source: Column, target: Column) -> Column:
    """The entry of a small square table."""
    table = F.array(*[F.lit(v) for v in values.ravel().tolist()])
    return F.element_at(table, (source * values.shape[0] + target + 1).cast("int"))


def _entry(values: np.ndarray, at: Column) -> Column:
    """The entry of a short list, counted from 0."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), (at + 1).cast("int"))


def _requests(cells: DataFrame, open_shards: list[int]) -> DataFrame:
    """Cells with the shard they ask for and the request's key, null where they stay."""
    text = Window.partitionBy("gid")
    # Of shards with equally many copies a hash of the text decides, so that no shard is favoured.
    weight = F.struct("n", F.xxhash64("gid", "shard").alias("h"), F.col("shard").alias("s"))
    best = F.max(F.when(F.col("shard").isin(open_shards), weight)).over(text)
    gain = F.floor(F.log2(F.greatest(F.col("best.n") - F.col("n"), F.lit(0)) + 1)).cast("long")
    key = (64 - gain) * PARTS + F.pmod(F.xxhash64("gid", F.lit("part")), F.lit(PARTS))
    return cells.select("*", best.alias("best"), weight.alias("own")).select(
        "gid",
        "shard",
        "n",
        F.when(F.col("best") > F.col("own"), F.col("best.s")).alias("target"),
        F.when(F.col("best") > F.col("own"), key).alias("key"),
    )


def _loads(cells: DataFrame, shards: int) -> np.ndarray:
    load = np.zeros(shards, np.int64)
    for row in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        load[row.shard] = row.n
    return load


def propagate(cells: DataFrame, capacity: np.ndarray, scratch: Scratch) -> tuple[DataFrame, np.ndarray]:
    """Moves cells (gid, shard, n) until none asks to move, none may, or the rounds are over; also the loads.

    In the first rounds full shards may be asked for, then only those with room.
    """
    shards = len(capacity)
    load = _loads(cells, shards)
    exchanges = EXCHANGES
    for turn in range(ROUNDS):
        open_shards = [s for s in range(shards) if turn < exchanges or load[s] < capacity[s]]
        if not open_shards:
            break
        asking = _requests(cells, open_shards)
        # At most shards * shards * 64 * PARTS rows, whatever the input.
        summed = asking.where("target is not null").groupBy("shard", "target", "key").agg(F.sum("n").alias("n"))
        requests = [tuple(r) for r in summed.collect()]
        quotas = set_quotas(requests, load, capacity)
        if not quotas.granted:
            if turn >= exchanges:
                break
            exchanges = 0
            continue
        source, target = F.col("shard"), F.coalesce(F.col("target"), F.col("shard"))
        cutoff, share = _of_pair(quotas.cutoff, source, target), _of_pair(quotas.share, source, target)
        moved = (
            F.when(F.col("target").isNull(), 0)
            .when(F.col("key") < cutoff, F.col("n"))
            .when(F.col("key") == cutoff, F.floor(F.col("n") * share))
            .otherwise(0)
            .cast("long")
        )
        stay = F.struct("shard", (F.col("n") - moved).alias("n"))
        go = F.struct(target.alias("shard"), moved.alias("n"))
        parts = asking.select("gid", F.explode(F.array(stay, go)).alias("part")).select("gid", "part.shard", "part.n")
        following = scratch.write(parts.where("n > 0").groupBy("gid", "shard").agg(F.sum("n").alias("n")), "cells")
        scratch.drop(cells)
        cells, load = following, _loads(following, shards)
    return cells, load


def assign_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, gid for every row of ``docs``.

    Law ``rows``: the numbers of rows in two shards differ by one at most.
    A null text counts as an empty one of no bytes; empty texts are equal and
    linked. Repeated rows are linked rows. Slots count from 0 without gaps in
    each shard. Other columns of ``docs`` are not read.
    """
    scratch = Scratch(docs.sparkSession)
    text = whole_text()
    rows = scratch.write(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("gid"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    total = rows.count()
    capacity = total // shards + (np.arange(shards) < total % shards)
    groups = scratch.write(rows.groupBy("gid").count().where("count > 1").select("gid"), "linked-texts")
    linked = rows.join(groups, "gid", "left_semi")
    spread = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("_row")]
    start = (
        number_rows(linked.select("gid", "doc_id", "_row"), [], spread, "place")
        .withColumn("shard", ((F.col("place") - 1) % shards).cast("int"))
        .groupBy("gid", "shard")
        .agg(F.count("*").alias("n"))
    )
    loose = np.floor(capacity * (1 + SLACK)).astype(np.int64) + SLACK_ROWS
    cells, load = propagate(scratch.write(start, "cells"), loose, scratch)
    # A text's cells, in order, say which of its copies go where and from which slot on.
    based = running_total(cells, ["shard"], [F.col("gid")], F.col("n"), "base")
    until = Window.partitionBy("gid").orderBy("shard")
    plan = (
        based.withColumn("until", F.sum("n").over(until))
        .groupBy("gid")
        .agg(F.sort_array(F.collect_list(F.struct("until", "shard", "base", "n"))).alias("cells"))
    )
    numbered = number_rows(linked, ["gid"], [F.col("doc_id"), F.col("_row")], "turn")
    placed = (
        numbered.join(plan, "gid")
        .withColumn("cell", F.filter("cells", lambda c: c["until"] >= F.col("turn"))[0])
        .withColumn("shard", F.col("cell.shard"))
        .withColumn("slot", F.col("cell.base") + F.col("turn") - 1 - (F.col("cell.until") - F.col("cell.n")))
    )
    # What a shard holds above its exact size, and the rows without a link, fill the others' room in order.
    above, room = np.maximum(load - capacity, 0), np.maximum(capacity - load, 0)
    over = F.col("slot") - _entry(capacity, F.col("shard"))
    excess = placed.withColumn("turn", F.when(over >= 0, over + 1 + _entry(np.cumsum(above) - above, F.col("shard"))))
    alone = number_rows(rows.join(groups, "gid", "left_anti"), [], spread, "turn").withColumn(
        "turn", F.col("turn") + int(above.sum())
    )
    full = np.cumsum(room)
    seat = F.size(F.filter(F.array(*[F.lit(int(r)) for r in full]), lambda r: r < F.col("turn")))
    slot = _entry(load - (full - room), seat) + F.col("turn") - 1
    placed = excess.withColumns(
        {
            "slot": F.when(F.col("turn").isNull(), F.col("slot")).otherwise(slot),
            "shard": F.when(F.col("turn").isNull(), F.col("shard")).otherwise(seat),
        }
    )
    filled = alone.withColumns({"slot": slot, "shard": seat})
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "gid"]
    law = {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    return placed.withColumns(law).select(columns).unionByName(filled.withColumns(law).select(columns)).withColumns(
        {"shard": F.col("shard").cast("int"), "slot": F.col("slot").cast("long")}
    )
