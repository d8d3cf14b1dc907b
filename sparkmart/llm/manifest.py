"""Merkle manifest of a dataset with a proof for every row, by incremental witnesses.

Every row is a leaf, the leaves of a group (a language) a tree in order of doc_id, and the roots of
all groups a tree of their own. A tree grows by appending its nodes: complete subtrees of falling
size stay open, like the bits of a counter. Each open subtree carries the witness of every node in
it, as far as it is known; when a sibling subtree completes, both sides add the other's root.

Appending is distributed by aligned blocks of 2**BLOCK_BITS nodes. One task appends the nodes of a
block and gives partial witnesses and the block's root. The roots are appended in the same way, as
the next layer, until each group has one node. A node's witness is then its partial one followed by
its block's: one join and a concatenation a layer. So no task holds more than a block and the number
of layers is log(rows) / BLOCK_BITS.

`Forest.grown` adds later rows: only the open last block of each layer is appended to again, complete
blocks stay as they were written.

Defined results: a null doc_id comes first. Rows of equal doc_id are ordered by their digest, so
repeated rows are equal leaves next to each other. A null doc_id is never tampered with. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .work import Work

#: Nodes of a block: 1,024.
BLOCK_BITS = 10
#: A step of a witness is a side and, but for ALONE, the sibling's digest.
LEFT, RIGHT, ALONE = b"l", b"r", b"-"

#: Fixed value: the fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_digest(*values: Column) -> Column:
    """sha256 of the values, each as its UTF-8 length, a colon and itself, or a dash for null."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (v.cast("string") for v in values)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined(*digests: bytes) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class OpenSubtrees:
    """A tree that nodes are appended to: (height, root, witnesses of its nodes) of the complete
    subtrees, the largest first."""

    def __init__(self):
        self.open: list[tuple[int, bytes, list[bytearray]]] = []

    def append(self, digest: bytes) -> None:
        self.open.append((0, digest, [bytearray()]))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._pair(self.open[-1][0] + 1)

    def _pair(self, height: int) -> None:
        (_, left, of_left), (_, right, of_right) = self.open[-2:]
        for witness in of_left:
            witness += RIGHT + right
        for witness in of_right:
            witness += LEFT + left
        self.open[-2:] = [(height, joined(left, right), of_left + of_right)]

    def close(self, height: int) -> tuple[bytes, list[bytearray]]:
        """Root and witnesses at this height: the last node of a level, where it is alone, goes up."""
        while self.open[-1][0] < height:
            low, digest, witnesses = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == low:
                self._pair(low + 1)
                continue
            for witness in witnesses:
                witness += ALONE
            self.open[-1] = (low + 1, joined(digest), witnesses)
        _, digest, witnesses = self.open[0]
        return digest, witnesses


def steps(witness: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = 0
    while at < len(witness):
        side, digest = witness[at : at + 1], b"" if witness[at : at + 1] == ALONE else witness[at + 1 : at + 33]
        at += 1 + len(digest)
        yield side, digest


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for side, other in steps(witness):
        digest = joined(*((other, digest) if side == LEFT else (digest, other) if side == RIGHT else (digest,)))
    return digest


def height_of(nodes: int) -> int:
    return (nodes - 1).bit_length()


def with_ranks(work: Work, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows, which have a column grp, with rank (0, 1, ... in their grp, nulls first) and total.

    Rows are dealt by ranges of (grp, order, row number) and written, so neither a large group nor a
    repeated key meets in one task. A rank is the place in its range plus what earlier ranges hold of
    the group; there is one count for each range and group that meet.
    """
    rows = work.stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    keys = ["grp", *order, "_row"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    placed = work.stored(placed.withColumn("_part", F.shiftright("_row", 33)), "placed")
    counts = placed.groupBy(F.col("grp").alias("_grp"), F.col("_part").alias("_of")).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy("_grp")
    before = whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "total": F.sum("_n").over(whole)})
    found = placed.join(work.stored(counts, "counts"), F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("_part") == F.col("_of")))
    rank = (F.col("_before") + F.col("_row") - F.col("_first")).alias("rank")
    return found.select(*[c for c in rows.columns if c != "_row"], rank, "total")


class Forest:
    """The trees of all groups as written layers: nodes (grp, rank, total, digest and any others) with
    their partial witness and, on the first node of a block, the block's root."""

    def __init__(self, work: Work, bits: int = BLOCK_BITS):
        self.work, self.bits = work, bits

    def _block(self, rank: str | Column = "rank") -> Column:
        return F.shiftright(rank, self.bits)

    def _appended(self, nodes: DataFrame) -> DataFrame:
        bits = self.bits

        def append(table: pa.Table) -> pa.Table:
            table, tree = table.sort_by("rank"), OpenSubtrees()
            for digest in table.column("digest").to_pylist():
                tree.append(digest)
            root, found = tree.close(min(bits, height_of(table.column("total")[0].as_py())))
            table = table.append_column("partial", pa.array([bytes(w) for w in found], pa.binary()))
            return table.append_column("root", pa.array([root] + [None] * (table.num_rows - 1), pa.binary()))

        schema = StructType([*nodes.schema]).add("partial", "binary").add("root", "binary")
        names = schema.fieldNames()
        grouped = nodes.groupBy("grp", self._block().alias("_block"))
        return self.work.stored(grouped.applyInArrow(lambda table: append(table).select(names), schema), "layer")

    def _roots(self, layer: DataFrame) -> DataFrame:
        """The nodes of the next layer."""
        blocks = self._block(F.col("total") + ((1 << self.bits) - 1)).alias("total")
        return layer.where(F.col("root").isNotNull()).select("grp", self._block().alias("rank"), blocks, F.col("root").alias("digest"))

    def _is_top(self, layer: DataFrame) -> bool:
        return (layer.agg(F.max("total")).first()[0] or 0) <= 1 << self.bits

    def grow(self, nodes: DataFrame) -> list[DataFrame]:
        """All layers; in the last one every group is one block."""
        layers = [self._appended(nodes)]
        while not self._is_top(layers[-1]):
            layers.append(self._appended(self._roots(layers[-1])))
        return layers

    def grown(self, old: list[DataFrame], nodes: DataFrame) -> list[DataFrame]:
        """The layers after an append. nodes: with new totals, the later nodes and those of each growing
        group's open last block. Complete blocks stay as they are; what they lack of their witnesses
        is in the layers above, where the roots of the blocks that changed are appended in turn."""
        layers: list[DataFrame] = []
        while True:
            at = len(layers)
            changed = self._appended(nodes)
            layers.append(self.work.stored(self._replaced(old[at], changed), "layer") if at < len(old) else changed)
            if self._is_top(layers[-1]):
                return layers
            if at + 1 < len(old):
                nodes = self._roots(changed)
                nodes = nodes.unionByName(self._opened(old[at + 1], nodes))
            else:  # the trees get higher: the new layer starts with the roots of all blocks
                nodes = self._roots(layers[-1])

    def _replaced(self, old: DataFrame, changed: DataFrame) -> DataFrame:
        since = changed.groupBy(F.col("grp").alias("_grp")).agg(F.min("rank").alias("_since"), F.first("total").alias("_total"))
        kept = old.join(since, F.col("grp").eqNullSafe(F.col("_grp")), "left")
        kept = kept.where(F.col("_since").isNull() | (F.col("rank") < F.col("_since")))
        return kept.withColumn("total", F.coalesce("_total", "total")).select(old.columns).unionByName(changed)

    def _opened(self, old: DataFrame, nodes: DataFrame) -> DataFrame:
        """The unchanged nodes of blocks that the nodes are appended to."""
        since = nodes.groupBy(F.col("grp").alias("_grp")).agg(F.min("rank").alias("_since"), F.first("total").alias("_total"))
        found = old.join(since, F.col("grp").eqNullSafe(F.col("_grp")))
        found = found.where((F.col("rank") < F.col("_since")) & (self._block() == self._block("_since")))
        return found.select("grp", "rank", F.col("_total").alias("total"), "digest")

    def witnesses(self, layers: list[DataFrame]) -> DataFrame:
        """The first layer's nodes, each with its witness up to its group's root and that root."""
        top = layers[-1]
        roots = top.where(F.col("root").isNotNull()).select(F.col("grp").alias("_grp"), F.col("root").alias("subroot"))
        out = top.join(roots, F.col("grp").eqNullSafe(F.col("_grp"))).withColumn("witness", F.col("partial"))
        for layer in reversed(layers[:-1]):
            above = out.select(F.col("grp").alias("_grp"), F.col("rank").alias("_rank"), F.col("witness").alias("_above"), "subroot")
            out = layer.join(above, F.col("grp").eqNullSafe(F.col("_grp")) & (self._block() == F.col("_rank")))
            out = out.withColumn("witness", F.concat("partial", "_above"))
        return out.select(*[c for c in layers[0].columns if c not in ("partial", "root")], "witness", "subroot")


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "tampered", "subroot", "root", "witness", "above")))
        out = []
        for doc_id, digest, tampered, subroot, root, witness, above in rows:
            path = witness + above
            proof = joined(*(other for _, other in steps(path) if other))
            folded = fold(digest if tampered is None else tampered, path)
            out.append((doc_id, digest.hex(), subroot.hex(), root.hex(), proof.hex(), folded.hex(), folded == root))
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MANIFEST.split(", ")])


def leaves(docs: DataFrame) -> DataFrame:
    """grp (the language), doc_id, digest and, of the rows that are tampered with, another digest."""
    fields = {c: docs[c] for c in FIELDS}
    changed = F.crc32(fields["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = fields["n_chars"].cast("decimal(20,0)") + 1  # can't overflow
    other = leaf_digest(*[more if c == "n_chars" else v for c, v in fields.items()])
    return docs.select(
        fields["lang"].alias("grp"), fields["doc_id"].cast("long").alias("doc_id"), leaf_digest(*fields.values()).alias("digest"),
        F.when(changed & fields["n_chars"].isNotNull(), other).alias("tampered"),
    )


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row for each document: its leaf, both roots, the digest of its proof, and whether the leaf,
    after one row in seven was tampered with, still leads to the root."""
    forest = Forest(work := Work(spark))
    ranked = with_ranks(work, leaves(docs), ["doc_id", "digest"])
    rows = work.stored(forest.witnesses(forest.grow(ranked)), "witnesses")
    groups = rows.where(F.col("rank") == 0).select(F.lit("all").alias("grp"), F.col("grp").alias("member"), F.col("subroot").alias("digest"))
    above = forest.witnesses(forest.grow(with_ranks(work, groups, ["member"])))
    above = work.stored(above.select("member", F.col("witness").alias("above"), F.col("subroot").alias("root")), "groups")
    rows = rows.join(above, F.col("grp").eqNullSafe(F.col("member")))
    return rows.select("doc_id", "digest", "tampered", "subroot", "root", "witness", "above").mapInArrow(_verdicts, MANIFEST)
