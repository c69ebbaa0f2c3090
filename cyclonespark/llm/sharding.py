"""Sharding [native]: balanced label propagation over linked documents.

Documents that share a link (here: an equal text) should meet in one of ``shards``
shards; every shard gets the same number of rows, at most one apart (law ``rows``).

1. Rows with equal links are pre-aggregated into weighted nodes, at most 64 a link, so a
   link that holds a third of all rows is 64 nodes and never one task or one row.
2. Nodes start on a hashed shard.  In each round a link calls its nodes to the shard that holds most
   of its weight, a link of more than a shard's quota to as many shards as it fills.  The flows between
   shards are scaled until no shard gets more than its room and what leaves it (so full shards can
   still swap), and nodes move by hash in those proportions.  Every step is a join or an
   aggregation of nodes; what the driver sees is one weight for each pair of shards.
3. Rows of a node follow it, up to the shard's exact quota; the rest and the unlinked rows,
   in the order of their links, fill what is left.

Nulls and edge cases: a null text has size 1 and text_crc32 0, and links with nothing; a null
doc_id is a row like others; repeated rows are rows of their own, linked by their text;
an empty table gives no rows; columns but doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import blocks_for, checkpoint, numbered

PIECES = 64
ROUNDS = 6
SLACK = 0.03
#: rows of a link that stay side by side
TOGETHER = 2000


def _pick(values: list, by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), by + 1)


def _shares(loads: list[int], wish: dict[tuple[int, int], int], quota: float) -> list[list[float]]:
    """Share of each wished flow between shards that may move: inflow stays within room plus outflow."""
    n = range(len(loads))
    share = [[1.0 if (a, b) in wish else 0.0 for b in n] for a in n]
    for _ in range(50):
        out = [sum(wish.get((a, b), 0) * share[a][b] for b in n) for a in n]
        for b in n:
            into = sum(wish.get((a, b), 0) * share[a][b] for a in n)
            room = max(0.0, quota - loads[b] + out[b])
            if into > room:
                for a in n:
                    share[a][b] *= room / into
    return share


def propagate(links: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """``links(link, node, weight)`` to ``(link, node, weight, total, shard)``, total: the link's weight.

    Every node belongs to one link.  Moves are accepted by hash, as a share of a flow, so no shard's
    callers are ever sorted in one task.  Shards may go over the quota by ``SLACK`` meanwhile.
    """
    at = lambda *c: F.pmod(F.xxhash64(*c), F.lit(shards)).cast("int")
    nodes = checkpoint(links.withColumn("shard", at(F.lit("start"), "link", "node")))
    for turn in range(rounds):
        weights = nodes.groupBy("link", "shard").agg(F.sum("weight").alias("w"))
        # most weight first; ties by a hash of link and shard, the same for every node of the link; one entry a shard
        held = F.reverse(F.array_sort(F.collect_list(F.struct("w", F.xxhash64("link", "shard").alias("h"), "shard"))))
        tops = weights.groupBy("link").agg(held.alias("held"), F.sum("w").alias("total"))
        filled = F.greatest(F.lit(1), F.least(F.size("held"), F.ceil(F.col("total") / quota).cast("int")))
        tops = tops.select("link", "total", F.slice(F.col("held.shard"), F.lit(1), filled).alias("tops"))
        called = nodes.drop("total").join(tops, "link")
        to = F.element_at("tops", F.pmod(F.xxhash64("link", "node", F.lit(turn)), F.size("tops")).cast("int") + 1)
        called = checkpoint(called.withColumn("to", F.when(F.array_contains("tops", F.col("shard")), F.col("shard")).otherwise(to)).drop("tops"))
        flows = called.groupBy("shard", "to").agg(F.sum("weight").alias("n")).collect()
        loads = [sum(r["n"] for r in flows if r["shard"] == s) for s in range(shards)]
        wish = {(r["shard"], r["to"]): r["n"] for r in flows if r["shard"] != r["to"]}
        nodes = called.drop("to")
        if not wish:
            break
        share = [x for row in _shares(loads, wish, quota * (1 + SLACK)) for x in row]
        draw = F.pmod(F.xxhash64(F.lit(turn), "link", "node"), F.lit(1 << 30)) / float(1 << 30)
        moves = (F.col("to") != F.col("shard")) & (draw < _pick(share, F.col("shard") * shards + F.col("to")))
        nodes = checkpoint(called.withColumn("shard", F.when(moves, F.col("to")).otherwise(F.col("shard"))).drop("to"))
    return nodes


def shard(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, link, shard, slot (gapless from 0 in a shard).

    size is the UTF-8 bytes of the text plus 1.  Shards hold ``rows // shards`` rows or one more.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        F.md5(F.col(text)).alias("link"),
    ).withColumn("node", F.pmod(F.xxhash64("doc_id", F.lit("node")), F.lit(PIECES)).cast("int"))
    rows = checkpoint(rows)
    n = rows.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    blocks = blocks_for(n)

    fine = rows.filter("link IS NOT NULL").groupBy("link", "node").agg(F.count(F.lit(1)).alias("weight"))
    linked = fine.groupBy("link").agg(F.sum("weight").alias("rows")).filter("rows > 1").select("link")
    nodes = propagate(fine.join(linked, "link"), shards, min(quotas))

    order = [F.col("spread"), F.col("link"), F.col("doc_id")]
    placed = rows.join(nodes.select("link", "node", "total", F.col("shard").alias("label")), ["link", "node"], "left").fillna(-1, ["label"])
    # rows of one link stay side by side; nodes, not whole links, of large ones are dealt to the blocks
    placed = placed.withColumn("spread", F.when(F.col("total") <= TOGETHER, F.xxhash64("link")).otherwise(F.xxhash64("link", "node")))
    placed = numbered(placed, ["label"], order, F.when(F.col("label") < 0, F.xxhash64("doc_id", "link")).otherwise(F.col("spread")), blocks, "rank")
    fits = (F.col("label") >= 0) & (F.col("rank") < _pick(quotas, F.greatest("label", F.lit(0))))
    placed = checkpoint(placed.withColumn("shard", F.when(fits, F.col("label"))).drop("rank", "label", "total"))

    held = {r["shard"]: r["n"] for r in placed.filter("shard IS NOT NULL").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    free = [quotas[s] - held.get(s, 0) for s in range(shards)]
    ends = [sum(free[: s + 1]) for s in range(shards)]
    rest = numbered(placed.filter("shard IS NULL").withColumn("all", F.lit(0)), ["all"], order, F.col("spread"), blocks, "rank")
    to = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("rank")))
    rest = rest.withColumn("shard", to).drop("rank", "all")
    whole = placed.filter("shard IS NOT NULL").unionByName(rest)
    return numbered(whole, ["shard"], order, F.xxhash64("doc_id", "link"), blocks, "slot").drop("node", "spread")


def cut_links(sharded: DataFrame) -> DataFrame:
    """Per link with more than one row: its rows and on how many shards they lie."""
    per = sharded.filter("link IS NOT NULL").groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("link").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("shards")).filter("rows > 1")
