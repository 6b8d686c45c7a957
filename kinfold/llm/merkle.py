"""Merkle dataset manifest over SHA-256 midstates.

Rows become leaves, ordered by id within their group; every run of ``FAN`` neighbours hashes to a parent until
one node of a group remains, and the groups' roots hash to the root in the same way. A parent keeps a copy of
the hash state before each of its child slots. Putting another digest into a slot then resumes that copy with
the digest and the right siblings only; what lies left of the slot is never hashed again.

A tree is worked on in blocks of ``FAN ** LEVELS`` neighbours. Going up, a block returns its one node, and the
blocks' nodes are the leaves of the next tier. Going down, a block receives its path to the root: per level the
left siblings, hashed once for all rows of the block into a state to resume, and the right siblings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Parent:
    """One inner node: its children, the hash state before each child slot, and its digest."""

    children: list[bytes]
    states: list
    digest: bytes

    @classmethod
    def of(cls, children: list[bytes]) -> Parent:
        h, states = hashlib.sha256(), []
        for c in children:
            states.append(h.copy())
            h.update(c)
        return cls(children, states, h.hexdigest().encode())

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1 :])

    def with_child(self, slot: int, digest: bytes) -> bytes:
        """The digest of this node if ``digest`` stood at ``slot``."""
        return resumed(self.states[slot], digest, self.siblings(slot)[1])


def resumed(state, digest: bytes, right: bytes) -> bytes:
    h = state.copy()
    h.update(digest)
    h.update(right)
    return h.hexdigest().encode()


def depth(n: int) -> int:
    """Levels of a block in a tree of ``n`` nodes: all of them, or as many as leave one node."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FAN), levels + 1
    return levels


def grow(digests: list[bytes], levels: int) -> list[list[Parent]]:
    """The levels above neighbouring nodes, lowest first."""
    grown = []
    for _ in range(levels):
        grown.append([Parent.of(digests[i : i + FAN]) for i in range(0, len(digests), FAN)])
        digests = [p.digest for p in grown[-1]]
    return grown


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 in hex over all fields: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    parts = []
    for c in fields:
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def _positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within its group from 0, and ``n``, the group's size.

    Rows are dealt out by ranges of (group, order) and numbered inside their part; a part's offset comes from the
    counts per group and part. No group is gathered, and rows equal in all of it are spread by a running number.
    """
    keys = [group, *order, "_at"]
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = checkpoint(dealt.drop("_at").withColumn("_seq", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_seq", 33))
    parts = placed.groupBy(group, "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    w = Window.partitionBy(group)
    before = F.sum("_rows").over(w.orderBy("_part")) - F.col("_rows")
    parts = parts.select(group, "_part", (F.col("_first") - before).alias("_shift"), F.sum("_rows").over(w).alias("n"))
    return placed.join(parts, [group, "_part"]).withColumn("pos", F.col("_seq") - F.col("_shift")).drop("_seq", "_part", "_shift")


def _block_root(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    n = int(rows["n"].iat[0])
    digests = [d.encode() for d in rows["digest"]]
    grown = grow(digests, depth(n))
    top = grown[-1][0].digest if grown else digests[0]
    return pd.DataFrame(
        {"g": [rows["g"].iat[0]], "pos": [int(rows["pos"].iat[0]) // BLOCK], "n": [-(-n // BLOCK)], "digest": [top.decode()]}
    )


def _tiers(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """``nodes (g, pos, n, digest)`` and the tiers above them; the last has one node per group."""
    tiers = [nodes]
    while largest > 1 or len(tiers) == 1:
        blocks = tiers[-1].withColumn("b", F.floor(F.col("pos") / BLOCK)).groupBy("g", "b")
        tiers.append(checkpoint(blocks.applyInPandas(_block_root, "g string, pos long, n long, digest string")))
        largest = -(-largest // BLOCK)
    return tiers


_PATH = "g string, pos long, lefts array<string>, rights array<string>, subroot string, root string"


def _paths(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The way to the root of each node of a block: siblings inside the block, then those of the block's own way."""
    nodes = nodes.sort_values("pos")
    grown = grow([d.encode() for d in nodes["digest"]], depth(int(nodes["n"].iat[0])) if len(nodes) else 0)
    up, out = above.iloc[0], []
    for i, pos in enumerate(nodes["pos"]):
        lefts, rights = [], []
        for level in grown:
            i, slot = divmod(i, FAN)
            left, right = level[i].siblings(slot)
            lefts.append(left.decode())
            rights.append(right.decode())
        out.append((up["g"], int(pos), lefts + list(up["lefts"]), rights + list(up["rights"]), up["subroot"], up["root"]))
    return pd.DataFrame(out, columns=["g", "pos", "lefts", "rights", "subroot", "root"])


def _folded(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proof and folded root of every row of a block of leaves."""
    rows = rows.sort_values("pos")
    grown = grow([d.encode() for d in rows["digest"]], depth(int(rows["n"].iat[0])) if len(rows) else 0)
    up = above.iloc[0]
    lefts, rights = [s.encode() for s in up["lefts"]], [s.encode() for s in up["rights"]]
    states = [hashlib.sha256(s) for s in lefts]
    proofs, roots = [], []
    for i, (old, new) in enumerate(zip(rows["digest"], rows["changed"])):
        digest = (new or old).encode()
        proof = hashlib.sha256()
        for level in grown:
            i, slot = divmod(i, FAN)
            for side in level[i].siblings(slot):
                proof.update(side)
            digest = level[i].with_child(slot, digest)
        for left, state, right in zip(lefts, states, rights):
            proof.update(left)
            proof.update(right)
            digest = resumed(state, digest, right)
        proofs.append(proof.hexdigest())
        roots.append(digest.decode())
    return pd.DataFrame(
        {
            "id": rows["id"].to_numpy(), "leaf": rows["digest"].to_numpy(), "subroot": up["subroot"], "root": up["root"],
            "proof_sha256": proofs, "folded_root": roots,
        }
    )


def manifest(
    rows: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
    replaced: Mapping[str, Column] | None = None, when: Column | None = None,
) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row.

    ``leaf``, ``subroot``, ``root`` and the proof (the hash of all siblings on the way up, left to right) are those of
    the rows as they are. Where ``when`` is true, ``folded_root`` starts from the leaf whose fields in ``replaced`` hold
    other values, else from the leaf itself; ``verified`` tells whether it equals the root.

    Only ``fields``, the id and the group are read, so other columns may have any name. Null fields count as null, not as
    empty. Rows of a null group form a group of their own, the first. Null ids come first in their group; rows that repeat
    an id are ordered by their leaf, and rows equal in both are interchangeable. A lone leaf is its group's root, a lone
    group's root the root. An empty table gives no rows. Texts are hashed whole by Spark; Python sees digests only.
    """
    replaced = dict(replaced or {})
    plain = [F.col(f) for f in fields]
    other = leaf_digest([replaced.get(f, F.col(f)) for f in fields])
    hit = F.coalesce(when, F.lit(False)) if when is not None and replaced else F.lit(False)
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    leaves = checkpoint(
        rows.select(F.col(id_col).alias("id"), group.alias("g"), leaf_digest(plain).alias("digest"), F.when(hit, other).alias("changed"))
    )
    placed = checkpoint(_positions(leaves, "g", ["id", "digest"]))
    tiers = _tiers(placed.select("g", "pos", "n", "digest"), placed.agg(F.max("n")).first()[0] or 0)

    # the groups' roots are leaves of one more tree
    heads = tiers[-1].select(F.lit("").alias("all"), F.col("g").alias("name"), "digest")
    heads = checkpoint(_positions(heads, "all", ["name"]))
    crown = _tiers(heads.select(F.col("all").alias("g"), "pos", "n", "digest"), heads.agg(F.max("n")).first()[0] or 0)
    nothing = F.array().cast("array<string>")
    way = crown[-1].select("g", "pos", nothing.alias("lefts"), nothing.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    way = _descend(crown, way)
    way = way.join(heads.select("pos", "name", F.col("digest").alias("top")), "pos").select(
        F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "lefts", "rights", F.col("top").alias("subroot"), "root"
    )
    way = _descend(tiers[1:], checkpoint(way))
    blocks = placed.withColumn("b", F.floor(F.col("pos") / BLOCK)).groupBy("g", "b")
    kind = leaves.schema["id"].dataType.simpleString()
    done = blocks.cogroup(way.groupBy("g", "pos")).applyInPandas(
        _folded, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return done.withColumnRenamed("id", id_col).withColumn("verified", F.col("folded_root") == F.col("root"))


def _descend(tiers: list[DataFrame], way: DataFrame) -> DataFrame:
    """From the ways of the last tier's nodes to those of the first tier's."""
    for nodes in reversed(tiers[:-1]):
        blocks = nodes.withColumn("b", F.floor(F.col("pos") / BLOCK)).groupBy("g", "b")
        way = checkpoint(blocks.cogroup(way.groupBy("g", "pos")).applyInPandas(_paths, _PATH))
    return way
