"""Merkle manifest of a dataset: every row's leaf, the trees above, proofs and their check.

A leaf is the hash of a row's fields.  Per group (``lang``) the leaves stand in order of id; every
``FANOUT`` consecutive nodes become their hash, until one is left, the group's subroot; the subroots
in order of group become the root in the same way.

A level is one aggregation: conditional aggregates spread the children of a parent into one column a
slot, and the columns joined are what is hashed.  Going down again, a node meets its parent's row by
the parent's place; all columns but its own slot's are its siblings, so a row of eight hashes and one
path serves eight children.  Places come from a range-partitioned numbering, so no task holds a
group, however many rows share a language or an id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.operators.keys import dense_key
from sluicework.sources.storage import Staging

# Fixed values of the contract: children of a node, the fields of a leaf in order, the tampered rows.
FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SLOTS = [f"s{j}" for j in range(FANOUT)]
_NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: a row per document with its tree and place; ``levels``: the parents' rows, bottom
    up; ``subroots``: a row per tree; ``upper``: the levels above the subroots; ``root``: the one
    hash that stands for everything, None over no rows."""

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    upper: list[DataFrame]
    root: str | None


def _field(value: Column) -> Column:
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def row_hash(row: dict[str, Column]) -> Column:
    """The leaf of a row: its fields in order, each with its length in bytes, ``-`` for null."""
    return F.sha2(F.concat(*[_field(row[name]) for name in FIELDS]), 256)


def _slot() -> Column:
    return F.col("place") % FANOUT


def _parents(nodes: DataFrame) -> DataFrame:
    """The parents of the nodes of all trees that still have several: a column per child slot."""
    children = [F.max(F.when(_slot() == j, F.col("hash"))).alias(s) for j, s in enumerate(SLOTS)]
    return (
        nodes.filter(F.col("size") > 1)
        .groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place"))
        .agg(F.ceil(F.max("size") / FANOUT).alias("size"), *children)
        .withColumn("hash", F.sha2(F.concat_ws("", *SLOTS), 256))
    )


def _climb(nodes: DataFrame, staging: Staging) -> tuple[list[DataFrame], DataFrame]:
    """The levels of parents above ``tree, place, size, hash``, and each tree's last node.

    The number of levels is known from the largest tree.
    """
    largest = nodes.agg(F.max("size").alias("n")).first()["n"] or 0
    levels: list[DataFrame] = []
    tops = nodes.filter(F.col("size") == 1).select("tree", "hash")
    while largest > 1:
        nodes = staging.table(_parents(nodes))
        levels.append(nodes)
        tops = tops.union(nodes.filter(F.col("size") == 1).select("tree", "hash"))
        largest = -(-largest // FANOUT)
    return levels, staging.table(tops)


def build(docs: DataFrame, staging: Staging) -> Manifest:
    """The manifest of ``docs``; columns beyond the fields are ignored.

    Rows with one id stand in order of their hashes, equal rows are a leaf each; null ids and the
    null language come first.  ``tampered`` is the leaf of the row after tampering where that
    happens, else null; a null id is not tampered with.
    """
    fields = {name: F.col(name) for name in FIELDS}
    lowered = fields | {"text": F.translate("text", UPPER, LOWER)}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_OF == 0
    hashed = staging.table(
        docs.select(
            "doc_id",
            "lang",
            row_hash(fields).alias("hash"),
            F.when(chosen, row_hash(lowered)).alias("tampered"),
            # Equal rows spread over ranges by this alone.
            F.monotonically_increasing_id().alias("row"),
        )
    )
    numbered = staging.table(dense_key(hashed, ["lang", "doc_id", "hash", "row"], "number", staging))
    groups = numbered.groupBy(F.col("lang").alias("group")).agg(
        F.min("number").alias("tree"), F.count("*").alias("size")
    )
    leaves = staging.table(
        numbered.join(groups, F.col("lang").eqNullSafe(F.col("group"))).select(
            "doc_id",
            "lang",
            "tree",
            (F.col("number") - F.col("tree")).alias("place"),
            "size",
            "hash",
            "tampered",
        )
    )
    levels, subroots = _climb(leaves.select("tree", "place", "size", "hash"), staging)
    # A tree is called by its first leaf's number, so trees in order are groups in order.
    placed = dense_key(subroots, ["tree"], "number", staging).select(
        F.lit(0).cast("bigint").alias("tree"),
        (F.col("number") - 1).alias("place"),
        "hash",
        F.col("tree").alias("group"),
        F.lit(subroots.count()).cast("bigint").alias("size"),
    )
    placed = staging.table(placed)
    upper, top = _climb(placed.select("tree", "place", "size", "hash"), staging)
    root = top.first()
    return Manifest(leaves, levels, placed, upper, root["hash"] if root else None)


def _above(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """``nodes`` with their parents' subroot and paths, each begun with the node's own siblings."""
    up = parents.select(
        *[F.col(c).alias(f"p_{c}") for c in ("tree", "place", *SLOTS)], "path", "subroot"
    )
    at = (F.col("tree") == F.col("p_tree")) & (F.floor(F.col("place") / FANOUT) == F.col("p_place"))
    left = F.concat_ws("", *[F.when(_slot() > j, F.col(f"p_{s}")) for j, s in enumerate(SLOTS)])
    right = F.concat_ws("", *[F.when(_slot() < j, F.col(f"p_{s}")) for j, s in enumerate(SLOTS)])
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return nodes.join(up, at).select(
        *map(F.col, nodes.columns), F.concat(step, F.col("path")).alias("path"), "subroot"
    )


def _descend(
    nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, staging: Staging
) -> DataFrame:
    """The bottom ``nodes`` with ``path`` and ``subroot``; ``tops`` has them by tree.

    A tree ends at the level where it has one node left, which differs between trees.
    """
    above = None
    for level in [*reversed(levels), nodes]:
        found = level.filter(F.col("size") == 1).join(tops, "tree").select(
            *map(F.col, level.columns), "path", "subroot"
        )
        if above is not None:
            found = found.union(_above(level.filter(F.col("size") > 1), above))
        above = staging.table(found)
    return above


def proofs(manifest: Manifest, staging: Staging) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: the siblings from the leaf up to the root, at each
    step those on the left and those on the right, joined."""
    root = F.lit(manifest.root).cast("string").alias("subroot")
    tops = manifest.subroots.select("tree", F.expr(_NO_PATH).alias("path"), root).distinct()
    subroots = _descend(manifest.subroots, manifest.upper, tops, staging)
    by_tree = subroots.select(F.col("group").alias("tree"), "path", F.col("hash").alias("subroot"))
    return _descend(manifest.leaves, manifest.levels, by_tree, staging)


def verified_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``folded_root`` is the root as recomputed from the (tampered) leaf and its siblings.  No row
    gives no result; a null field hashes as ``-``; see ``build`` for nulls and ties in ids.
    """
    staging = Staging(docs.sparkSession)
    manifest = build(docs, staging)
    path = F.col("path")
    siblings = F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"])))
    begin = F.coalesce("tampered", "hash")
    folded = F.aggregate(
        path, begin, lambda done, x: F.sha2(F.concat(x["left"], done, x["right"]), 256)
    )
    root = F.lit(manifest.root).cast("string")
    return (
        proofs(manifest, staging)
        .select(
            "doc_id",
            F.col("hash").alias("leaf"),
            "subroot",
            root.alias("root"),
            F.sha2(siblings, 256).alias("proof_sha256"),
            folded.alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
