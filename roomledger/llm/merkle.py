"""Merkle manifest of a dataset, by time-forward processing of its trees.

Nodes are labelled by level and place, so a node's label comes after those of its children.
Sweeping up in label order, every node sends its digest to its parent through a priority queue;
sweeping down in the reverse order, every node sends the rest of the proof to its children. The
queue is external: messages between the nodes of a block (BAND levels above ARITY ** BAND
neighbours) wait in a heap of that block's task; messages that leave a block are rows of a
written table, which Spark's external sort brings into label order for the next band of levels.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.operators.lookup import Dimension, lookup
from roomledger.operators.numbering import number_rows
from roomledger.session import work_folder

# Children of a node. A proof level starts with the place among them, one digit.
ARITY = 8
# Levels that one sweep of a block climbs: its task holds ARITY ** BAND digests.
BAND = 4
BLOCK = ARITY**BAND
HEX = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as it is hashed: '-' if NULL, else its UTF-8 bytes after their count and a colon."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(*values: Column) -> Column:
    """The digest of a row: hex SHA-256 of its fields, one after the other."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def levels(proof: Column) -> Column:
    """The levels of a proof as strings: place among the siblings, then their digests."""
    return F.filter(F.split(proof, ","), lambda level: level != "")


def siblings(proof: Column) -> Column:
    """All digests of a proof, from the leaf's siblings up to the root's children."""
    return F.array_join(F.transform(levels(proof), lambda level: F.substr(level, F.lit(2))), "")


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""

    def parent(own: Column, level: Column) -> Column:
        before = F.substr(level, F.lit(1), F.lit(1)).cast("int") * HEX
        run = F.concat(
            F.substr(level, F.lit(2), before), own, F.substr(level, before + F.lit(2))
        )
        return F.sha2(run.cast("binary"), 256)

    return F.aggregate(levels(proof), digest, parent)


def height(count: int) -> int:
    """Levels above the leaves: 0 for a lone leaf."""
    found = 0
    while count > 1:
        count, found = -(-count // ARITY), found + 1
    return found


def climbed(nodes: list[tuple[int, str]], top: int) -> dict[tuple[int, int], list[tuple[int, str]]]:
    """Sweep up: the children of every node above a block's nodes, up to the level top.

    Labels are (level, place); the block's own nodes have level 0. The heap gives out messages
    by label, so all of a node's children are there when its turn comes.
    """
    queue = [((1, place // ARITY), place % ARITY, digest) for place, digest in nodes]
    heapq.heapify(queue)
    children: dict[tuple[int, int], list[tuple[int, str]]] = {}
    while queue:
        label = queue[0][0]
        own = children[label] = []
        while queue and queue[0][0] == label:
            own.append(heapq.heappop(queue)[1:])
        level, place = label
        if level < top:
            digest = hashlib.sha256("".join(d for _, d in own).encode()).hexdigest()
            heapq.heappush(queue, ((level + 1, place // ARITY), place % ARITY, digest))
    return children


def descended(
    children: dict[tuple[int, int], list[tuple[int, str]]], top: tuple[int, int], rest: str
) -> Iterator[tuple[int, str]]:
    """Sweep down: each node of the block with its proof, given the rest of it from the block's top."""
    queue = [(-top[0], top[1], rest)]
    while queue:
        depth, place, above = heapq.heappop(queue)
        if not depth:
            yield place, above
            continue
        run = children[(-depth, place)]
        for at, _ in run:
            level = f"{at}" + "".join(d for other, d in run if other != at)
            proof = f"{level},{above}" if above else level
            heapq.heappush(queue, (depth + 1, place * ARITY + at, proof))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after another; a partition holds whole blocks, in order."""
    held, key = [], None
    for batch in batches:
        trees, places = (batch.column(name).to_pylist() for name in ("_tree", "_place"))
        at = 0
        for own, rows in groupby((t, p // BLOCK) for t, p in zip(trees, places)):
            if own != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key, size = own, sum(1 for _ in rows)
            held.append(batch.slice(at, size))
            at += size
    if held:
        yield pa.Table.from_batches(held)


def _nodes(block: pa.Table) -> tuple[int, list[tuple[int, str]]]:
    """Size of the block's tree in its band, places and digests of the nodes."""
    places, digests = (block.column(name).to_pylist() for name in ("_place", "_digest"))
    return block.column("_size")[0].as_py(), list(zip(places, digests))


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top of every block: one row for the band above, or the root of its tree."""
    for block in _blocks(batches):
        size, nodes = _nodes(block)
        top = min(BAND, height(size))
        place = nodes[0][0] // ARITY**top
        last = climbed(nodes, top)[(top, place)]
        digest = hashlib.sha256("".join(d for _, d in last).encode()).hexdigest()
        found = {
            "_tree": [block.column("_tree")[0].as_py()],
            "_size": [-(-size // ARITY**top)],
            "_place": [place],
            "_digest": [digest],
        }
        yield pa.RecordBatch.from_pydict(found)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node with its proof. One row of a block is the message from its top."""
    for block in _blocks(batches):
        is_message = pc.is_null(block.column("_digest"))
        message = block.filter(is_message).select(["_subroot", "_root", "_proof"]).to_pylist()[0]
        own = block.filter(pc.invert(is_message))
        size, nodes = _nodes(own)
        top = min(BAND, height(size))
        label = (top, nodes[0][0] // ARITY**top)
        proofs = dict(descended(climbed(nodes, top), label, message["_proof"]))
        for name in ("_subroot", "_root"):
            filled = pa.array([message[name]] * len(nodes), pa.string())
            own = own.set_column(own.column_names.index(name), name, filled)
        at = own.column_names.index("_proof")
        own = own.set_column(at, "_proof", pa.array([proofs[p] for p, _ in nodes], pa.string()))
        yield from own.to_batches(max_chunksize=1024)


def _sorted_blocks(rows: DataFrame) -> DataFrame:
    block = F.expr(f"_place div {BLOCK}")
    return rows.repartition(F.col("_tree"), block).sortWithinPartitions("_tree", "_place")


class Forest:
    """Trees over numbered nodes, kept as one table for each band of levels.

    nodes: stored, with _tree, _size, _place, _digest and any further columns. _place counts
    from 0 in each tree of _size nodes.
    """

    def __init__(self, nodes: DataFrame, folder: str) -> None:
        self.folder, self.bands = folder, [nodes]
        while True:
            below = self.bands[-1].filter("_size > 1")
            if below.isEmpty():
                break
            path = f"{folder}/band{len(self.bands)}"
            climbing = _sorted_blocks(below.select("_tree", "_size", "_place", "_digest"))
            climbing.mapInArrow(_up, climbing.schema).write.parquet(path)
            self.bands.append(nodes.sparkSession.read.parquet(path))

    def roots(self) -> DataFrame:
        """_tree, _digest of each tree's root."""
        done = [band.filter("_size = 1").select("_tree", "_digest") for band in self.bands]
        return reduce(DataFrame.unionByName, done)

    def proofs(self, heads: DataFrame) -> DataFrame:
        """The nodes with _subroot, _root, _proof.

        heads: stored, one row for each tree, with _tree, _subroot, _root and the _proof of its root.
        """
        ends = Dimension.counted(heads.select("_tree", "_subroot", "_root", "_proof"))
        found = None
        for depth in reversed(range(len(self.bands))):
            # A root takes its proof from heads, another node from the block's top above it.
            own = lookup(self.bands[depth].filter("_size = 1"), ends, "_tree")
            found = own if found is None else found.unionByName(own)
            if depth:
                path = f"{self.folder}/proofs{depth}"
                found.write.parquet(path)
                found = self._below(heads.sparkSession.read.parquet(path), self.bands[depth - 1])
        return found

    @staticmethod
    def _below(tops: DataFrame, nodes: DataFrame) -> DataFrame:
        """A band's nodes with their proofs, from those of the tops of its blocks."""
        messages = tops.select(
            "_tree", (F.col("_place") * BLOCK).alias("_place"), "_subroot", "_root", "_proof"
        )
        rows = nodes.filter("_size > 1").unionByName(messages, allowMissingColumns=True)
        blocks = _sorted_blocks(rows)
        return blocks.mapInArrow(_down, blocks.schema)


def _numbered(rows: DataFrame, group: str, order: list[str], folder: str) -> DataFrame:
    """Stored rows with _tree, _size and _place, their place in their group from 0; stored."""
    spark = rows.sparkSession
    keyed = rows.withColumn("_tree", F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("-")))
    ranks = number_rows(keyed, [group, *order], "_rank", f"{folder}/ranks", unique=True)
    groups = ranks.groupBy("_tree").agg(
        F.count("*").alias("_size"), F.min("_rank").alias("_first")
    )
    groups.write.parquet(f"{folder}/groups")
    placed = lookup(ranks, Dimension.counted(spark.read.parquet(f"{folder}/groups")), "_tree")
    placed.withColumn("_place", F.col("_rank") - F.col("_first")).drop("_rank", "_first").write.parquet(
        f"{folder}/placed"
    )
    return spark.read.parquet(f"{folder}/placed")


def prove(rows: DataFrame, group: str = "lang", order: str = "doc_id", digest: str = "leaf") -> DataFrame:
    """The given rows with subroot, root and proof, the digests beside a row's way to the root.

    rows: one for each leaf, with its digest (hex, never NULL) and any further columns, which
    stay; none of them is named subroot, root or proof or starts with an underscore. In each
    group leaves ascend by order; the groups' roots, in order of the group, have a tree above
    them. NULL comes first in either order, equal ones ascend by digest. A proof is text: its
    levels, parted by commas, each the place among the siblings and then their digests; a lone
    leaf of a lone group has an empty one. No rows give no rows.

    A group of any size is split into blocks of BLOCK leaves, so no task holds a group. The
    number of written bands is the logarithm of the largest group to the base BLOCK.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, "merkle")
    # Rows equal in all of these are the same leaf, told apart by where they were written.
    rows.withColumn("_tie", F.monotonically_increasing_id()).write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves").withColumn("_digest", F.col(digest))
    trees = Forest(
        _numbered(leaves, group, [order, digest, "_tie"], f"{folder}/low"), f"{folder}/trees"
    )

    # The groups' roots are the leaves of one more tree. A NULL group is '-', before all '=...'.
    subroots = trees.roots().select(
        F.col("_tree").alias("_group"), "_digest", F.lit("").alias("_all")
    )
    subroots.write.parquet(f"{folder}/subroots")
    tops = _numbered(spark.read.parquet(f"{folder}/subroots"), "_all", ["_group"], f"{folder}/high")
    above = Forest(tops, f"{folder}/top")
    crown = above.roots().select(
        "_tree",
        F.lit(None).cast("string").alias("_subroot"),
        F.col("_digest").alias("_root"),
        F.lit("").alias("_proof"),
    )
    crown.write.parquet(f"{folder}/crown")
    heads = above.proofs(spark.read.parquet(f"{folder}/crown")).select(
        F.col("_group").alias("_tree"), F.col("_digest").alias("_subroot"), "_root", "_proof"
    )
    heads.write.parquet(f"{folder}/heads")
    found = trees.proofs(spark.read.parquet(f"{folder}/heads"))
    return found.select(
        *rows.columns,
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        F.col("_proof").alias("proof"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, proof of every row of documents.

    A leaf hashes FIELDS of its row: NULL and empty differ, and a text's length is part of it,
    so no two different rows share a leaf. Rows that repeat an id, or are equal throughout, are
    leaves of their own. Texts of any length are hashed whole, in the JVM. Other columns are
    not read.
    """
    return prove(docs.select("doc_id", "lang", leaf(*map(F.col, FIELDS)).alias("leaf")))


def tampered() -> Column:
    """The leaf of a row of documents after someone has lower-cased A-Z of its text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.col("text"), upper, upper.lower())
    return leaf(*[lowered if name == "text" else F.col(name) for name in FIELDS])


def tamper_check(docs: DataFrame) -> DataFrame:
    """Proofs of the whole table, held against rows of which about a third were tampered with.

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Where 3 divides the CRC-32
    of the id in decimals, the text's A-Z are lower-cased before its leaf is hashed again; a
    row without id, without text or without such letters stays as it is, and verifies.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    own = leaf(*map(F.col, FIELDS))
    rows = docs.select(
        "doc_id", "lang", own.alias("leaf"),
        F.when(chosen & F.col("text").isNotNull(), tampered()).alias("changed"),
    )
    proven = prove(rows)
    root = folded(F.coalesce("changed", "leaf"), F.col("proof"))
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
