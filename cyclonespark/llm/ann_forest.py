"""Approximate nearest neighbours: hash-prefix forest.

Each of ``TREES`` trees gives every distinct vector a string of ``BITS`` hash bits; a tree is the
sorted array of its strings, cut by leading bits into blocks that Spark spreads.  A query
descends in every tree: how many vectors share 0, 1, 2, ... leading bits with it.  It then
ascends in all trees together, from the longest prefixes to shorter ones, until the vectors
below it number ``SHARE`` of all entries of the trees, ``CANDIDATES`` at least; those are scored in
double precision, where they lie, and each block sends back only its best.  So the part of the vectors
that a query is scored against, and with it the recall, does not fall as the table grows.

Equal vectors are one entry with its least ids, so a vector that a third of all rows
share costs one entry; a block of many similar vectors is cut into parts of ``BLOCK``.

Directions and thresholds are fitted on at most ``SAMPLE`` vectors (least hash of the id); all vectors are indexed.
For inner products of vectors of different lengths, each gets one more component that brings it to a
common length (the sample's 99.9 % quantile), which turns the largest product into the smallest angle.

Nulls and edge cases: null, zero or non-finite vectors take no part, nor do rows without an id;
vectors of another dimension than the query's are no candidates; repeated rows (id and vector) are one; fewer than k
candidates give fewer rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclonespark.llm.common import checkpoint, ship

TREES, BITS = 12, 32
#: vectors, counted once a tree, among which a query is answered: a share of them all, and at least so many
SHARE = 0.1
CANDIDATES = 60_000
BLOCK = 4096
SAMPLE = 4096
TOP = 20


def valid(vector: Column) -> Column:
    whole = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return whole & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


class Directions:
    """Hash bits of vectors of one dimension: on which side of a sample's median they lie along random directions."""

    def __init__(self, sample: np.ndarray, trees: int, bits: int):
        rng = np.random.default_rng(sample.shape[1])
        norms = np.sqrt((sample**2).sum(1))
        self.length = float(np.quantile(norms, 0.999))
        self.lines = rng.normal(size=(sample.shape[1] + 1, trees * bits))
        self.trees, self.bits = trees, bits
        self.middle = np.median(self._lifted(sample) @ self.lines, axis=0)

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.length**2 - (x**2).sum(1)))
        return np.concatenate([x, rest[:, None]], 1)

    def keys(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """A row for each vector: its bit string in every tree, as a number."""
        if query:
            x = x * (self.length / np.sqrt((x**2).sum(1)))[:, None]
        on = (self._lifted(x) @ self.lines > self.middle).reshape(len(x), self.trees, self.bits)
        return on @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))


def _stack(vectors) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in vectors])


def _by_block(lines: dict[int, Directions], query: bool):
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.assign(dim=[len(v) for v in batch["v"]]).groupby("dim"):
                x = np.stack([np.asarray(v, float) for v in part["v"]])
                keys = lines[dim].keys(x, query)
                data = [r.tobytes() for r in x]
                for t in range(keys.shape[1]):
                    yield pd.DataFrame({"dim": np.int32(dim), "tree": np.int32(t), "key": keys[:, t], "id": part["id"].to_numpy(), "v": data})

    return task


def _levels(base: int, bits: int):
    def count(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        """How many strings of the block share each number of leading bits, from ``base`` on, with each query."""
        if not len(queries):
            return pd.DataFrame({"id": [], "n": pd.Series([], dtype=object)})
        keys = np.sort(block["key"].to_numpy())
        q = queries["key"].to_numpy()
        n = np.zeros((len(q), bits + 1), np.int64)
        for level in range(base, bits + 1):
            low = q >> (bits - level) << (bits - level)
            n[:, level] = np.searchsorted(keys, low + (1 << (bits - level))) - np.searchsorted(keys, low)
        return pd.DataFrame({"id": queries["id"], "n": list(n)})

    return count


def _best(bits: int, top: int):
    def answer(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        """Score, for each query, the strings below its prefix and keep the best ``top``."""
        if not len(queries) or not len(block):
            return pd.DataFrame({"id": [], "found": [], "score": []})
        block = block.sort_values(["key", "id"])
        keys, ids, x = block["key"].to_numpy(), block["id"].to_numpy(), _stack(block["v"])
        out = []
        for qid, key, level, v in zip(queries["id"], queries["key"], queries["level"], queries["v"], strict=True):
            low = key >> (bits - level) << (bits - level)
            a, b = np.searchsorted(keys, [low, low + (1 << (bits - level))])
            if a == b:
                continue
            score = x[a:b] @ np.frombuffer(v, np.float64)
            if b - a > top:
                # ties at the edge stay; the ranking settles them
                edge = np.partition(score, len(score) - top)[len(score) - top]
                pick = np.flatnonzero(score >= edge - 1e-9)
            else:
                pick = np.arange(b - a)
            out.append(pd.DataFrame({"id": qid, "found": ids[a + pick], "score": score[pick]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "found": [], "score": []})

    return answer


def search(vectors: DataFrame, queries: Column, k: int = TOP, vec_id: str = "vec_id", vector: str = "embedding", candidates: int = CANDIDATES, trees: int = TREES, bits: int = BITS, share: float = SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest others found for each row where ``queries`` holds.

    A query ascends until ``share`` of the entries of all trees lie below it, and no fewer than ``candidates``.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & valid(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = checkpoint(rows.withColumn("h", F.xxhash64("v")))

    # entries: distinct vectors with their k + 1 least ids
    nth = Window.partitionBy("h", "v").orderBy("id")
    least = rows.select("h", "v", "id").withColumn("nth", F.dense_rank().over(nth)).filter(F.col("nth") <= k + 1)
    entries = checkpoint(least.groupBy("h", "v").agg(F.min("id").alias("id"), F.array_sort(F.collect_set("id")).alias("ids")))
    n = entries.count()
    candidates = max(candidates, math.ceil(share * n * trees))

    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    lines: dict[int, Directions] = {}
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    lines = {d: Directions(np.asarray(x), trees, bits) for d, x in by_dim.items()}
    # a dimension that the sample lacks gets directions of its own, fitted on one of its vectors
    for r in rows.groupBy(F.size("v").alias("dim")).agg(F.min_by("v", "id").alias("v")).collect():
        if r["dim"] not in lines:
            lines[r["dim"]] = Directions(np.asarray([r["v"]]), trees, bits)

    # blocks hold about twice the candidates of a query and tree, so most queries need one a tree
    base = max(0, int(np.log2(max(1, n * trees / (2 * candidates)))))
    schema = "dim int, tree int, key long, id long, v binary"
    below = F.expr(f"shiftright(key, {bits - base})")
    points = entries.select("id", "v").mapInPandas(_by_block(lines, False), schema).withColumn("block", below)
    sizes = checkpoint(points.groupBy("dim", "tree", "block").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")))
    points = points.join(sizes.drop("n"), ["dim", "tree", "block"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")

    asked = rows.filter("asks").select("h", "v").distinct().join(entries.select("h", "v", "id"), ["h", "v"]).select("id", "v")
    asked = checkpoint(asked.mapInPandas(_by_block(lines, True), schema).withColumn("block", below))

    def at_blocks(q: DataFrame) -> DataFrame:
        return q.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "n")

    place = ["dim", "tree", "block", "part"]
    points = points.select(*place, "key", "id", "v")
    # descend: counts by level, those above the blocks from the blocks' sizes
    own = at_blocks(asked.select("dim", "tree", "block", "key", "id").join(sizes, ["dim", "tree", "block"]))
    deep = own.groupBy(*place).cogroup(points.select(*place, "key").groupBy(*place)).applyInPandas(_levels(base, bits), "id long, n array<long>")
    totals = deep.groupBy("id").agg(*[F.sum(F.get("n", F.lit(i))).alias(f"n{i}") for i in range(base, bits + 1)])
    shallow = sizes.withColumn("up", F.explode(F.sequence(F.lit(0), F.lit(base)))).withColumn("prefix", F.expr(f"shiftright(block, {base} - up)"))
    shallow = checkpoint(shallow)
    above = shallow.groupBy("dim", "tree", "up", "prefix").agg(F.sum("n").alias("n"))
    climbed = asked.select("dim", "tree", "id", F.explode(F.sequence(F.lit(0), F.lit(base))).alias("up"), "block").withColumn("prefix", F.expr(f"shiftright(block, {base} - up)"))
    climbed = climbed.join(above, ["dim", "tree", "up", "prefix"]).groupBy("id", "up").agg(F.sum("n").alias("n"))
    high = climbed.filter(F.col("n") >= candidates).groupBy("id").agg(F.max("up").alias("high"))
    found = [F.when(F.col(f"n{i}") >= candidates, i) for i in range(bits, base - 1, -1)]
    ids = asked.select("id").distinct()
    level = ids.join(totals, "id", "left").join(high, "id", "left").select("id", F.coalesce(*found, F.col("high"), F.lit(0)).cast("int").alias("level"))

    # ascend: every block below a query's prefix answers it
    reach = asked.join(level, "id").withColumn("up", F.least("level", F.lit(base))).withColumn("prefix", F.expr(f"shiftright(block, {base} - up)")).drop("block")
    reach = at_blocks(reach.join(shallow, ["dim", "tree", "up", "prefix"]))
    answers = reach.select(*place, "key", "id", "v", "level").groupBy(*place).cogroup(points.groupBy(*place)).applyInPandas(_best(bits, k + 1), "id long, found long, score double")
    answers = answers.groupBy("id", "found").agg(F.max("score").alias("score"))
    # k + 1 entries hold k + 1 ids: the query's own and k others
    top = Window.partitionBy("id").orderBy(F.desc("score"), "found")
    answers = checkpoint(answers.withColumn("nth", F.row_number().over(top)).filter(F.col("nth") <= k + 1).drop("nth"))

    who = rows.filter("asks").select(F.col("id").alias("query_id"), "h", "v").dropDuplicates(["query_id", "h"])
    who = who.join(entries.select("h", "v", "id"), ["h", "v"]).select("query_id", "id", F.col("v").alias("qv"))
    out = who.join(answers.drop("score"), "id").join(entries.select(F.col("id").alias("found"), "ids", "v"), "found")
    # the score of a pair of vectors is summed in one fixed order
    exact = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    out = out.withColumn("score", exact).select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
