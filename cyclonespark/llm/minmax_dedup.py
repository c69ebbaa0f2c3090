"""MinHash near-dedup: min-max hashing.

A document is the set of its word shingles.  Each permutation yields both its smallest and its
largest hash over the set, two signature values for one evaluation; with ``BANDS`` bands of
``ROWS`` values, the two pairs of a band from different permutations, a link at similarity
0.8 shares no band with a probability of about (1 - 0.8 ** 4) ** 24 = 3e-6, at 0.9 below 1e-11.

No bucket is ever expanded into its pairs:

1. equal sets are one node;
2. in each bucket every node meets the bucket's centre only: the node that meets most others over all its
   bands, such as the text that many copies were made from.  A node's centre of most shared bands, its hub, is
   confirmed first, on the full sets, then those of its other centres that are still in another component;
3. in a bucket whose nodes still lie in different components, two nodes x and y may be linked though the centre turned
   x away.  With X and Y the symmetric differences to the centre, similarity 0.8 needs |X| + |Y| - 2 |X n Y| <= (|x| + |y|) / 9,
   so X and Y share more than 4/9 of Y: such pairs are joined on the rarest elements of X and Y (a prefix
   filter with positions), which turns nearly all others away unseen.  Any two nodes of a bucket have its
   centre in common, so no link among the nodes of a bucket is lost.

Components are found by alternating large-star and small-star joins.

Nulls and edge cases: a null, empty or blank text has no shingles and is linked with nothing; a text of fewer words
than a shingle is one shingle; rows that repeat a doc_id are rows of their own (those of one
component are all ``kept`` if they carry its least id), and texts of one doc_id that are not linked lie in components
of their own; a null doc_id never is a component's id unless the component has no other (then null, and kept is false);
an empty table gives no rows;
columns but doc_id and text are ignored (``near_dups``) or kept (``dedup``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclonespark.llm.common import blocks_for, checkpoint, lean, ship
from cyclonespark.llm.hashing import U, chunks, mix, windows, words_of

BANDS, ROWS = 24, 4
PERMUTATIONS = BANDS * ROWS // 2
#: edges that a task of the component rounds takes, and the least number of such tasks
EDGES_A_TASK, EDGE_TASKS = 50_000, 8
#: similarity of a link, in percent
PERCENT = 80

_ODD = np.random.default_rng(7).integers(0, 1 << 62, PERMUTATIONS, dtype=np.uint64) << U(1) | U(1)
_SHIFT = np.random.default_rng(8).integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_sets(texts: list[bytes], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts: distinct shingle hashes text by text, and where each text's begin (one more at the end)."""
    for _, part in chunks(texts, 1 << 19):
        w = words_of([t.lower() for t in part])
        at, h = windows(w, k)
        owner = np.searchsorted(w.first, at, side="right") - 1
        short = np.flatnonzero((w.counts > 0) & (w.counts < k))
        for i in short.tolist():
            whole = words_of([b" ".join(part[i].lower().split())])
            _, x = windows(whole, int(w.counts[i]))
            owner, h = np.append(owner, i), np.append(h, x)
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        owner, h = owner[new], h[new]
        yield h, np.searchsorted(owner, np.arange(len(part) + 1))


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band keys, a row for each non-empty set: min-max values, four to a band."""
    begin = first[:-1][np.diff(first) > 0]
    if not len(begin):
        return np.zeros((0, BANDS), U)
    low = np.empty((PERMUTATIONS, len(begin)), U)
    high = np.empty_like(low)
    for i in range(PERMUTATIONS):
        x = h * _ODD[i] + _SHIFT[i]
        low[i] = np.minimum.reduceat(x, begin)
        high[i] = np.maximum.reduceat(x, begin)
    out = np.empty((len(begin), BANDS), U)
    half = PERMUTATIONS // 2
    for b in range(BANDS):
        i, j = 2 * b, (2 * b + half) % PERMUTATIONS
        key = mix(low[i], b)
        for v in (low[i + 1], high[j], high[j + 1]):
            key = mix(key ^ v, b)
        out[:, b] = key
    return out


def _bodies(batch: pd.DataFrame) -> list[bytes]:
    return [b"" if t is None else bytes(t) for t in batch["_body"]]


def _describe(k: int):
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _bodies(batch)
            n, key, bands = [], [], []
            for h, first in shingle_sets(texts, k):
                count = np.diff(first)
                sums = [np.concatenate([np.zeros(1, U), np.cumsum(mix(h, s))]) for s in (11, 13)]
                a, b = ((s[first[1:]] - s[first[:-1]]) for s in sums)
                sig = iter(signatures(h, first).view(np.int64))
                n += count.tolist()
                for c, x, y in zip(count.tolist(), a.tolist(), b.tolist(), strict=True):
                    key.append(x.to_bytes(8, "big") + y.to_bytes(8, "big") if c else None)
                    bands.append(next(sig) if c else None)
            yield pd.DataFrame({"uid": batch["uid"], "doc_id": batch["doc_id"].astype("Int64"), "n_shingles": np.asarray(n, "int64"), "node": key, "bands": bands})

    return task


def _sets(k: int):
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for h, first in shingle_sets(_bodies(batch), k):
                out += [h[a:b].view(np.int64) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pd.DataFrame({"node": batch["node"], "shingles": out})

    return task


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to (node, component): the least node reachable, by alternating star joins.

    A round links every larger neighbour of a node to the least one around it (large star), then
    every smaller one (small star), until no edge changes; a star's centre is an aggregate joined
    back, so a node with very many neighbours is no single task.  Partitions follow the counted edges:
    few edges in as many partitions as the documents would cost every round hundreds of small files.
    """

    def star(e: DataFrame, larger: bool) -> DataFrame:
        least = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = e.join(least, "u")
        if larger:
            return e.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").coalesce(parts).distinct().coalesce(parts)
        return e.select(F.col("v").alias("x"), "m").union(e.select(F.col("u").alias("x"), "m")).filter("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).coalesce(parts).distinct().coalesce(parts)

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = checkpoint(e)
    # no round has more edges than the first
    parts = max(EDGE_TASKS, blocks_for(e.count(), EDGES_A_TASK))
    e = e.coalesce(parts)
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = checkpoint(star(star(both, True), False))
        state = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before:
            break
        before = state
    whole = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return whole.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _labelled(nodes: DataFrame, found: DataFrame, name: str, out: str) -> DataFrame:
    """Add the component of column ``name`` (a node without links is its own)."""
    labels = found.select(F.col("node").alias(name), F.col("component").alias(out))
    return nodes.join(labels, name, "left").withColumn(out, F.coalesce(out, name))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` with ``linked`` (their full sets are similar enough), the sizes n and n_centre, and the symmetric difference."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("s", "t")))
    linked = F.lit(100) * F.col("both") >= F.lit(percent) * (F.size("s") + F.size("t") - F.col("both"))
    delta = F.concat(F.array_except("s", "t"), F.array_except("t", "s"))
    return both.select("a", "b", linked.alias("linked"), F.size("s").alias("n"), F.size("t").alias("n_centre"), delta.alias("delta"))


def _unsettled(stars: DataFrame, found: DataFrame, with_centre: bool) -> DataFrame:
    """Rows of ``stars(a, b)`` whose centre b has nodes of different components, itself counted or not; with the node's component."""
    members = _labelled(stars, found, "a", "component")
    ends = members.groupBy("b").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    if with_centre:
        ends = _labelled(ends, found, "b", "own").withColumn("lo", F.least("lo", "own")).withColumn("hi", F.greatest("hi", "own"))
    return members.join(ends.filter("lo <> hi").select("b"), "b", "left_semi")


def _of_one_centre(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes with one centre, in different components, the first turned away by the centre, that may be linked.

    ``members(a, b, linked, n, n_centre, delta, component)``: a node, its centre, their sizes and difference.  A pair with
    differences X, Y and s the sum of its sizes needs 2 |X n Y| >= |X| + |Y| - s (100 - percent) / (100 + percent).
    In the order of rarity, its first common element stands so early that enough of both differences follow.
    """
    items = members.select("b", "a", F.explode("delta").alias("e"))
    often = items.groupBy("b", "e").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # elements of one node's difference alone come first and meet nobody: only their number matters
    order = Window.partitionBy("b", "a").orderBy(F.desc("often"), "e")
    ranked = items.join(often, ["b", "e"]).withColumn("follow", F.row_number().over(order)).drop("often")  # itself and the rarest ones' successors
    ranked = ranked.join(members.withColumn("d", F.size("delta")).drop("delta"), ["b", "a"])
    gap = F.lit(100 - percent) / F.lit(100 + percent)
    # |y| <= |centre| + |Y|, so x shares at least half of what it is beyond the reach of its centre
    beyond = (F.col("d") - (F.col("n") + F.col("n_centre")) * gap) / 2
    # beside a node that its centre turned away, any node shares more than this part of its difference
    least = F.floor(F.col("d") * (F.lit(1) - gap) / 2) + 1
    ranked = ranked.withColumn("as_x", ~F.col("linked") & (F.col("follow") >= beyond - F.lit(1e-6))).withColumn("as_y", F.col("follow") >= least)
    ranked = checkpoint(ranked.filter("as_x OR as_y"))
    x = ranked.filter("as_x").select("b", "e", *[F.col(c).alias(f"x_{c}") for c in ("a", "n", "component", "d", "follow")])
    y = ranked.filter("as_y").select("b", "e", *[F.col(c).alias(f"y_{c}") for c in ("a", "n", "component", "d", "follow")])
    need = (F.col("x_d") + F.col("y_d") - (F.col("x_n") + F.col("y_n")) * gap) / 2
    near = x.join(y, ["b", "e"]).filter((F.col("x_component") != F.col("y_component")) & (F.least("x_follow", "y_follow") >= need - F.lit(1e-6)))
    return near.select(F.least("x_a", "y_a").alias("a"), F.greatest("x_a", "y_a").alias("b")).distinct()


def near_dups(docs: DataFrame, k: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, uid, n_shingles, component (a node of it, null without shingles), component_id, kept."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(F.col(text), "utf-8").alias("_body"))
    rows = rows.withColumn("uid", F.xxhash64("doc_id", "_body"))
    schema = "uid long, doc_id long, n_shingles long, node binary, bands array<long>"
    known = checkpoint(rows.mapInPandas(lean(_describe(k)), schema))
    # a node's sets are read from one of its rows
    nodes = checkpoint(known.filter("node IS NOT NULL").groupBy("node").agg(F.min_by(F.struct("uid", "bands"), "uid").alias("r")).select("node", "r.*"))

    banded = nodes.select("node", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = checkpoint(banded.join(sizes, "band"))
    met = shared.groupBy("node").agg(F.sum("size").alias("met"))
    centre = F.max(F.struct("met", F.xxhash64("node").alias("h"), F.col("node").alias("centre")))
    centres = shared.join(met, "node").groupBy("band").agg(centre.alias("c"))
    stars = shared.join(centres, "band").select(F.col("node").alias("a"), F.col("c.centre").alias("b")).filter("a <> b")
    stars = checkpoint(stars.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")))
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "uid")
    # rows that repeat a doc_id and its text give a node twice
    bodies = rows.join(wanted, "uid").select("node", "_body").dropDuplicates(["node"])
    sets = checkpoint(bodies.mapInPandas(lean(_sets(k)), "node binary, shingles array<long>"))

    hubs = stars.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    hubs = checkpoint(_compared(hubs, sets, percent))
    found = checkpoint(components(hubs.filter("linked").select("a", "b")))

    others = _unsettled(stars.select("a", "b"), found, True).join(hubs.select("a", "b"), ["a", "b"], "left_anti")
    met = hubs.union(checkpoint(_compared(others.select("a", "b"), sets, percent)))
    links = met.filter("linked").select("a", "b")
    found = checkpoint(components(links))

    pairs = checkpoint(_of_one_centre(_unsettled(met, found, False), percent))
    last = checkpoint(_compared(pairs, sets, percent).filter("linked").select("a", "b"))
    if not last.isEmpty():
        found = checkpoint(components(links.union(last)))

    of_rows = _labelled(known.drop("bands"), found, "node", "component")
    least = of_rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = of_rows.join(least, "component", "left")
    # a text without shingles is its own component
    out = out.withColumn("component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "uid", "n_shingles", "component", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def dedup(docs: DataFrame, k: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of its least doc_id (a null one only if there is no other), once if rows repeat it.

    Rows without shingles are linked with nothing and all stay, once if rows repeat a doc_id and its text.
    """
    found = near_dups(docs, k, percent, doc_id, text)
    # a component is known by its node: ids may be null, and may stand in several components
    alone = F.when(F.col("component").isNull(), F.col("uid")).alias("alone")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    kept = found.groupBy("component", alone).agg(first.alias("first")).select(F.col("first.uid").alias("_uid"))
    # rows without an id and without words are told apart by nothing, so none repeats another
    bare = F.col(doc_id).isNull() & ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    tagged = docs.filter(~bare).withColumn("_uid", F.xxhash64(F.col(doc_id).cast("long"), F.encode(F.col(text), "utf-8")))
    return tagged.join(kept, "_uid", "left_semi").dropDuplicates(["_uid"]).drop("_uid").unionByName(docs.filter(bare))
