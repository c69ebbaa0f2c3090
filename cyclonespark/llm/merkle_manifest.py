"""Merkle dataset manifest: levels built bottom-up, proofs by a recursive query that climbs per leaf.

Every row of a table is a leaf; the leaves of one source, by doc_id, form a tree of runs of
three, and the sources' roots, by source, form a tree of the same kind above them.

* A level is never one task.  Rows are range-partitioned by (source, doc_id), so positions
  come from counts per partition, and blocks of ``3 ** LEVELS`` neighbours are hashed up
  ``LEVELS`` levels at once, inside one row.
* What is stored is one row a node at every ``LEVELS``-th level: its id, its parent's id and
  the siblings (left, right) of each level in between.
* ``climb`` is a recursive query over these rows: it starts at each leaf with the digest to
  be proven, joins the parent link, appends the siblings and folds the digest, until the
  root; it takes one step a link, so log(n) / log(729) joins.

Nulls and edge cases: a null field hashes as ``-``; a null doc_id comes first in its source
and is never tampered with; a null source is a source of its own and comes first; equal
doc_ids are ordered by their digests, repeated rows are leaves each; an empty text differs
from a null one; an empty table has no leaves, and no root; other columns are ignored, also
where their names are those used here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclonespark.llm.common import stored

ARITY = 3
#: levels that one stored link spans
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UP = "array<struct<l:binary,r:binary>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: a row a leaf with its first link; ``nodes``: the links above, of both trees."""

    leaves: DataFrame
    nodes: DataFrame


def field(value: Column) -> Column:
    """A field as it is hashed: ``-`` or its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column | None = None) -> Column:
    """Lowercase hex sha256 of a row of documents, with another ``text`` if given."""
    return F.sha2(F.concat(*[field(F.col(c) if c != "text" or text is None else text) for c in FIELDS]), 256)


def tampered() -> Column:
    """The text without its line feeds where 2 divides crc32(doc_id), else as it is."""
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 2 == 0
    return F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))


def source_key(source: Column) -> Column:
    """A source as a string that is never null and sorts as the sources do, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the rank within ``key`` by ``order``, and ``size``, the key's rows.

    Sorted by range over all tasks; only counts per key and task meet in a window.  Rows equal
    in all of ``order`` are told apart by ``_salt``, so that they, too, are spread.
    """
    by = ["key", *order, "_salt"]
    sorted_ = rows.withColumn("_salt", F.rand(7)).repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    at = stored(sorted_.withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    runs = at.groupBy("key", "_task").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("key", "_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"))
    return at.join(runs, ["key", "_task"]).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_task", "_row", "_shift")


def _node_id(tree: str, link: int, key: Column, pos: Column) -> Column:
    """128 bits that name a node."""
    return F.unhex(F.md5(F.concat_ws("/", F.lit(tree), F.lit(str(link)), pos.cast("string"), key)))


def _linked(rows: DataFrame, tree: str, link: int, others: list[str]) -> DataFrame:
    """Hash blocks of neighbours up; a row keeps ``others`` and gets up, parent, top (the digest there), top_pos, top_size.

    A key of more than one block takes all levels in each block, the last one included; a
    key of one block stops at its single node.
    """
    width = ARITY**LEVELS
    steps = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        steps = F.when(F.col("size") <= ARITY**k, F.lit(k)).otherwise(steps)
    member = F.struct("pos", "digest", *others)
    blocks = rows.groupBy("key", F.floor(F.col("pos") / width).alias("top_pos"), "size").agg(F.sort_array(F.collect_list(member)).alias("members"))
    blocks = blocks.withColumn("steps", steps).withColumn("d0", F.expr("transform(members, m -> m.digest)"))
    for k in range(1, LEVELS + 1):
        run = f"concat(get(d{k - 1}, {ARITY} * i), " + ", ".join(f"coalesce(get(d{k - 1}, {ARITY} * i + {j}), '')" for j in range(1, ARITY)) + ")"
        step = f"transform(sequence(0, cast((size(d{k - 1}) - 1) div {ARITY} as int)), i -> sha2({run}, 256))"
        blocks = blocks.withColumn(f"d{k}", F.expr(f"if(steps >= {k}, {step}, d{k - 1})"))
    ups = []
    for k in range(LEVELS):
        at = f"(i div {ARITY**k})"
        mine = f"({at} % {ARITY})"
        near = [f"coalesce(get(d{k}, cast({at} - {mine} + {j} as int)), '')" for j in range(ARITY)]
        left = ", ".join(f"if({mine} > {j}, {near[j]}, '')" for j in range(ARITY - 1))
        right = ", ".join(f"if({mine} < {j}, {near[j]}, '')" for j in range(1, ARITY))
        ups.append(f"named_struct('l', unhex(concat({left})), 'r', unhex(concat({right})))")
    up = f"slice(array({', '.join(ups)}), 1, steps)"
    blocks = blocks.withColumn("members", F.expr(f"transform(members, (m, i) -> named_struct('m', m, 'up', {up}))"))
    flat = blocks.select("key", "top_pos", "size", F.get(f"d{LEVELS}", F.lit(0)).alias("top"), F.inline_outer("members"))  # outer: no filter that spells the levels out
    return flat.select(
        "key", "m.pos", *[f"m.{c}" for c in others], F.unhex("m.digest").alias("digest"), "up", "top", "top_pos",
        F.ceil(F.col("size") / width).alias("top_size"), _node_id(tree, link + 1, F.col("key"), F.col("top_pos")).alias("parent"),
    )


def _grown(rows: DataFrame, tree: str, others: list[str]) -> tuple[list[DataFrame], DataFrame | None]:
    """The stored links of a tree, lowest first, and its keys' top nodes (key, node, digest)."""
    links, tops, link = [], [], 0
    while True:
        made = stored(_linked(rows, tree, link, others if not link else ["node"]))
        links.append(made)
        above = made.filter(F.col("pos") % ARITY**LEVELS == 0).select("key", F.col("parent").alias("node"), F.col("top").alias("digest"), F.col("top_pos").alias("pos"), F.col("top_size").alias("size"))
        tops.append(above.filter("size = 1").select("key", "node", "digest"))
        most = made.agg(F.max("top_size").alias("n")).first()["n"]
        if most is None:
            return links, None
        if most == 1:
            break
        rows, link = above.filter("size > 1"), link + 1
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return links, top


def build(leaves: DataFrame, payload: tuple[str, ...] = ()) -> Manifest:
    """Store the tree over ``leaves(source, doc_id, digest)``; leaf rows keep ``payload`` columns."""
    keep = [f"_p{i}" for i in range(len(payload))]
    rows = leaves.select(source_key(F.col("source")).alias("key"), F.col("doc_id"), "digest", *[F.col(c).alias(k) for c, k in zip(payload, keep, strict=True)])
    links, top = _grown(_placed(rows, ["doc_id", "digest"]), "s", ["doc_id", *keep])
    first = links[0].select("doc_id", "digest", "up", "parent", *[F.col(k).alias(f"p_{c}") for c, k in zip(payload, keep, strict=True)])
    none = F.lit(None).cast("binary")
    nodes = [x.select("node", "parent", "up", none.alias("subroot"), none.alias("root")) for x in links[1:]]
    if top is not None:
        above = _placed(top.select(F.lit("").alias("key"), F.col("key").alias("name"), "node", "digest"), ["name"])
        for i, x in enumerate(_grown(above, "t", ["node"])[0]):
            root = F.when(F.col("top_size") == 1, F.unhex("top"))
            nodes.append(x.select("node", "parent", "up", (F.col("digest") if not i else none).alias("subroot"), root.alias("root")))
    spark = leaves.sparkSession
    table = spark.createDataFrame([], f"node binary, parent binary, up {_UP}, subroot binary, root binary") if not nodes else nodes[0]
    for x in nodes[1:]:
        table = table.unionByName(x)
    return Manifest(first, table)


_FOLD = "aggregate({up}, {digest}, (a, u) -> unhex(sha2(concat(lower(hex(u.l)), lower(hex(a)), lower(hex(u.r))), 256)))"
_FLAT = "aggregate({up}, X'', (a, u) -> concat(a, u.l, u.r))"


def climb(manifest: Manifest, claim: str | None = None) -> DataFrame:
    """A row a leaf: doc_id, leaf, subroot, root, proof (its siblings, level by level) as binary, and folded_root,
    folded from the payload column ``claim`` (binary), or from the leaf itself."""
    start = f"p_{claim}" if claim else "digest"
    query = f"""
WITH RECURSIVE climb(doc_id, leaf, node, subroot, root, folded, proof) AS (
  SELECT doc_id, digest, parent, CAST(NULL AS BINARY), CAST(NULL AS BINARY), {_FOLD.format(up="up", digest=start)}, {_FLAT.format(up="up")}
  FROM {{leaves}}
  UNION ALL
  SELECT c.doc_id, c.leaf, n.parent, coalesce(c.subroot, n.subroot), n.root, {_FOLD.format(up="n.up", digest="c.folded")}, concat(c.proof, {_FLAT.format(up="n.up")})
  FROM climb c JOIN {{nodes}} n ON c.node = n.node
)
SELECT * FROM climb LIMIT ALL"""
    reached = manifest.leaves.sparkSession.sql(query, leaves=manifest.leaves, nodes=manifest.nodes)
    return reached.filter("root IS NOT NULL").select("doc_id", "leaf", "subroot", "root", "proof", F.col("folded").alias("folded_root"))


def verify(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """Build the manifest of ``docs`` and check each row, with ``text`` in place of its own, against the root.

    doc_id, leaf, subroot, root, proof_sha256, folded_root (all lowercase hex), verified.
    """
    leaves = docs.select("doc_id", "source", leaf_hash().alias("digest"), F.unhex(leaf_hash(text)).alias("claim"))
    found = climb(build(leaves, ("claim",)), "claim")
    digest = lambda c: F.lower(F.hex(c)).alias(c)
    return found.select(
        "doc_id", digest("leaf"), digest("subroot"), digest("root"), F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        digest("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"),
    )
