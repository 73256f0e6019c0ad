"""Merkle manifest of a dataset, with an inclusion proof for every row, in concatenated levels.

A leaf is the hash of a row's fields. Per group the leaves stand in key order and are numbered
through, whatever the size of the group. An aligned block of ``2 ** LEVELS`` nodes is one row that
keeps each level of its subtree as one hex string: a parent is the hash of a fixed-width substring of
128 digits, the sibling of a node is the substring beside it, and the siblings on the way up form the
block's segment of a proof. The roots of the blocks are the leaves of the next round, until one block
is left per group; the groups' roots then go through the same tree. So a task holds one block, a
proof is put together by joining each block with the segment above it, and the number of rounds grows
with the logarithm of the table.

Defined results: null fields hash as ``-``. Null keys stand behind all others, rows that repeat a key
stand by their leaf, and rows that repeat everything each keep a leaf. A null group is a group of its
own and comes first. Texts are hashed whole, empty ones as ``0:``. An empty table has an empty
manifest. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import stored
from vintora.operators.skew import keyed_window

LEVELS = 10
BLOCK = 1 << LEVELS


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 length, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _numbered(leaves: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``pos`` from 0 in ``order`` within ``keys`` and the group's ``size``."""
    placed = keyed_window(leaves, keys, order, {"pos": F.lit(1)}, {"size": ("sum", F.lit(1))})
    return placed.withColumn("pos", F.col("pos") - 1)


def _parents(level: str) -> str:
    return (f"cast(array_join(transform(sequence(0, cast((octet_length({level}) + 127) div 128 as int)"
            f" - 1), i -> sha2(substring({level}, i * 128 + 1, 128), 256)), '') as binary)")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """One row per aligned block: its nodes in order and the strings of its levels.

    In a group of several blocks every block climbs all levels, a lone last node included; the only
    block of a group climbs until one node is left.
    """
    rest = ["pos", *[c for c in nodes.columns if c not in ("g", "size", "pos")]]
    steps = f"CASE WHEN size > {BLOCK} THEN {LEVELS} WHEN size > 1 THEN length(bin(size - 1)) ELSE 0 END"
    return stored(
        nodes.groupBy("g", F.shiftright("pos", LEVELS).alias("block")).agg(
            F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct(*rest))).alias("nodes"))
        .withColumn("bottom", F.expr("cast(array_join(transform(nodes, x -> x.h), '') as binary)"))
        .withColumn("levels", F.expr(
            f"aggregate(slice(sequence(0, {steps}), 2, {LEVELS}), array(bottom),"
            f" (made, i) -> concat(made, array({_parents('element_at(made, -1)')})))"))
        .withColumn("top", F.element_at("levels", -1).cast("string")).drop("bottom"), name)


def _rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of every round; a group appears until one block holds all of it."""
    rounds = [_blocks(nodes, name)]
    while rounds[-1].filter(F.col("size") > BLOCK).take(1):
        above = rounds[-1].filter(F.col("size") > BLOCK).select(
            "g", F.col("block").alias("pos"),
            F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"), F.col("top").alias("h"))
        rounds.append(_blocks(above, name))
    return rounds


def _ended(rounds: list[DataFrame]) -> DataFrame:
    """(g, top): one row per group."""
    out = [r.filter(F.col("size") <= BLOCK).select("g", "top") for r in rounds]
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0]


def _paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Every node of the first round with ``path``, its siblings from the bottom up, and the other
    columns of ``tops`` (g, path, ...). An element is the side, L or R, and the digest, or ``-``."""
    carried = [c for c in tops.columns if c not in ("g", "path")]
    sibling = "cast(substring(levels[i], cast((shiftright(x.pos & {0}, i) ^ 1) * 64 + 1 as int), 64) as string)"
    segment = (
        "transform(slice(sequence(0, size(levels) - 1), 1, size(levels) - 1), i -> CASE"
        f" WHEN {sibling.format(BLOCK - 1)} = '' THEN '-'"
        f" WHEN shiftright(x.pos & {BLOCK - 1}, i) & 1 = 1 THEN concat('L', {sibling.format(BLOCK - 1)})"
        f" ELSE concat('R', {sibling.format(BLOCK - 1)}) END)")
    above = None
    for blocks in reversed(rounds):
        # One block of each group ends here; the others have a segment from the round above.
        rows = blocks.filter(F.col("size") <= BLOCK).join(tops, "g")
        if above is not None:
            going = blocks.filter(F.col("size") > BLOCK).join(above, ["g", "block"])
            rows = rows.unionByName(going)
        inner = [f.name for f in blocks.schema["nodes"].dataType.elementType.fields]
        # Segments are cut inside the block's row, so that its strings are not copied per node.
        nodes = rows.select("g", *carried, F.expr(
            f"transform(nodes, x -> struct(x as node, concat({segment}, path) as path))").alias("n"))
        flat = nodes.select("g", *carried, F.inline("n")).select(
            "g", *carried, "path", *[F.col(f"node.{c}").alias(c) for c in inner])
        above = flat.select("g", *carried, "path", F.col("pos").alias("block"))
    return flat


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    rest = lambda e: F.substring(e, 2, 64)
    return F.aggregate(path, leaf, lambda h, e: F.sha2(
        F.when(F.left(e, F.lit(1)) == "L", F.concat(rest(e), h))
        .when(F.left(e, F.lit(1)) == "R", F.concat(h, rest(e))).otherwise(h), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda e: F.substring(e, 2, 64)), ""), 256)


def manifest(rows: DataFrame, key: str, group: str, fields: list[str],
             altered: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, altered leaf, subroot, root, path) of every row.

    ``fields`` are hashed in this order. ``altered`` gives other values of some fields: its leaf is
    kept beside the true one, which alone goes into the tree.
    """
    altered = altered or {}
    leaves = stored(rows.select(
        F.col(key).alias("k"),
        F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit(":"), F.col(group))).alias("g"),
        row_hash([F.col(c) for c in fields]).alias("h"),
        row_hash([altered.get(c, F.col(c)) for c in fields]).alias("altered"),
        F.monotonically_increasing_id().alias("at")), "leaves")
    rounds = _rounds(_numbered(leaves, ["g"], ["k", "h", "at"]).drop("at"), "levels")
    subroots = _ended(rounds).withColumnsRenamed({"g": "of", "top": "h"})
    # '-' of the null group precedes ':' of all others.
    crown = _rounds(_numbered(subroots, [], ["of"]).withColumn("g", F.lit("")), "crown")
    start = _ended(crown).select(
        "g", F.col("top").alias("root"), F.array().cast("array<string>").alias("path"))
    tops = _paths(crown, start).select(
        F.col("of").alias("g"), F.col("h").alias("subroot"), "root", "path")
    return _paths(rounds, tops).select(F.col("k").alias(key), F.col("h").alias("leaf"), "altered",
                                       "subroot", "root", "path")


def verified_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` per language, each row checked against the root after every
    seventh one (by the hash of its id) has had its ``n_chars`` raised by one."""
    raised = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
                    F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    rows = manifest(docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"],
                    {"n_chars": raised})
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
        folded(F.col("altered"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
