"""A Merkle manifest of a table with a witness for every row, built by appending.

Rows are leaves, in the order of their ids within a group; groups have trees of their own, whose
subroots are the leaves of the tree above. A task appends the leaves of an aligned block one by one.
Two complete subtrees of the same height merge at once, and the merge extends the partial witnesses
of all leaves in both by the sibling's digest. Block roots are appended in the same way, level by
level, until a group has one block; the witnesses of block roots then extend those of their leaves.

A digest ``H`` is the lowercase hex sha256 of its inputs in a row; digests are inputs as hex text. A
node without a sibling is hashed alone. No step holds more than a block of rows, and the driver gets
the number of levels and the root.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches
from tidemark.llm.store import materialize, sent_if_small
from tidemark.operators.ranks import numbered

HEIGHT = 8  # of a block of 256 nodes
_WIDTH = 1 << HEIGHT
_SIZE = 32  # bytes of a digest
_LEFT, _RIGHT = b"\0", b"\1"  # where a sibling stands

_NODES = "grp string, position long, id long, digest binary, other binary"


def _hash(*hex_digests: bytes) -> bytes:
    return sha256(b"".join(hex_digests)).hexdigest().encode()


class Appender:
    """Open complete subtrees of an aligned run of leaves, and the witness of every leaf so far.

    A witness is a list of siblings in hex, each after a byte that tells its side.
    """

    def __init__(self):
        self.witnesses: list[list[bytes]] = []
        self.open: list[tuple[int, bytes, int]] = []  # height, root, first leaf

    def append(self, leaf: bytes) -> None:
        self.open.append((0, leaf, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge()

    def _merge(self) -> None:
        """The last two subtrees, of one height, become one; each extends the other's witnesses."""
        (height, left, first), (_, right, middle) = self.open[-2:]
        for at in range(first, middle):
            self.witnesses[at].append(_RIGHT + right)
        for at in range(middle, len(self.witnesses)):
            self.witnesses[at].append(_LEFT + left)
        self.open[-2:] = [(height + 1, _hash(left, right), first)]

    def close(self, height: int | None) -> bytes:
        """The root after the last leaf, at a height or, with None, where one node is left."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            last = self.open[-1]
            if len(self.open) > 1 and last[0] == self.open[-2][0]:
                self._merge()
            else:  # a lone node: hashed without a sibling, so no witness grows
                self.open[-1] = (last[0] + 1, _hash(last[1]), last[2])
        return self.open[0][1]


def fold(leaf: bytes, witness: list[bytes], lone: list[int] | None = None) -> bytes:
    """The root above a leaf; ``lone`` counts the hashes without a sibling before each entry."""
    node = leaf
    for at, sibling in enumerate(witness):
        for _ in range(lone[at] if lone else 0):
            node = _hash(node)
        side, digest = sibling[:1], sibling[1:]
        node = _hash(digest, node) if side == _LEFT else _hash(node, digest)
    for _ in range(lone[-1] if lone else 0):
        node = _hash(node)
    return node


def value_text(name: str) -> Column:
    """A value as the hash reads it: ``-`` if null, else its length in UTF-8 bytes, ``:``, itself."""
    own = F.col(f"`{name}`").cast("string")
    return F.coalesce(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own), F.lit("-"))


def tampered_value(name: str, id_column: str) -> tuple[Column, Column]:
    """Rows whose id's crc32 is divisible by 7, and their text of ``name`` plus 1 (nulls stay)."""
    number = F.col(f"`{name}`").cast("long")
    chosen = (batches.fold(f"`{id_column}`", 7) == 0) & number.isNotNull()
    more = (number + 1).cast("string")
    return chosen, F.concat(F.octet_length(more).cast("string"), F.lit(":"), more)


class Tree(NamedTuple):
    """Stored blocks of every level, and ``grp, subroot``."""

    levels: list[DataFrame]
    subroots: DataFrame


def _blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Nodes gathered in aligned blocks of at most 256; ``alone`` if the group has no other block."""
    block = F.expr(f"position div {_WIDTH}").alias("block")
    node = F.struct("position", "id", "digest", "other")
    gathered = nodes.groupBy("grp", block).agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    known = sizes.select(F.col("grp").alias("_grp"), (F.col("n") <= _WIDTH).alias("alone"))
    met = gathered.join(known, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    return materialize(met, "blocks")


def _appended(nodes: list[dict]) -> tuple[Appender, list[bytes]]:
    tree = Appender()
    leaves = [node["digest"].hex().encode() for node in nodes]
    for leaf in leaves:
        tree.append(leaf)
    return tree, leaves


def _roots(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The root of every block, a node of the level above."""
    for batch in rows:
        roots = []
        for nodes, alone in zip(batch.column("nodes"), batch.column("alone"), strict=True):
            tree, _ = _appended(nodes.as_py())
            roots.append(bytes.fromhex(tree.close(None if alone.as_py() else HEIGHT).decode()))
        none = pa.nulls(len(roots))
        yield pa.record_batch(
            [batch.column("grp"), batch.column("block"), none.cast(pa.int64()),
             pa.array(roots, pa.binary()), none.cast(pa.binary())],
            ["grp", "position", "id", "digest", "other"],
        )


def build(nodes: DataFrame) -> Tree:
    """The levels above ``grp, position, id, digest, other``, whose positions have no gaps."""
    sizes = materialize(nodes.groupBy("grp").agg(F.count("*").alias("n")), "sizes")
    levels = []
    while True:
        levels.append(_blocks(nodes, sizes))
        nodes = materialize(
            levels[-1].select("grp", "block", "nodes", "alone").mapInArrow(_roots, _NODES), "roots"
        )
        if not sizes.where(F.col("n") > _WIDTH).limit(1).count():
            break
        sizes = materialize(
            sizes.select("grp", F.expr(f"(n + {_WIDTH - 1}) div {_WIDTH}").alias("n")), "sizes"
        )
    return Tree(levels, nodes.select("grp", "digest"))


def _pack(witness: list[bytes]) -> bytes:
    return b"".join(x[:1] + bytes.fromhex(x[1:].decode()) for x in witness)


def _unpack(packed: bytes) -> list[bytes]:
    step = _SIZE + 1
    return [packed[i : i + 1] + packed[i + 1 : i + step].hex().encode()
            for i in range(0, len(packed), step)]


def _lone_steps(at: int, count: int, height: int | None) -> list[int]:
    """How many lone hashes stand before each sibling of leaf ``at`` of ``count``, and after all."""
    steps, lone, level = [], 0, 0
    while count > 1 or (height is not None and level < height):
        if at ^ 1 < count:
            steps.append(lone)
            lone = 0
        else:
            lone += 1
        at, count, level = at >> 1, (count + 1) >> 1, level + 1
    return [*steps, lone]


_PATHS = "grp string, position long, path binary, lone binary"


def _extended(block: list[dict], alone: bool, path: bytes, lone: bytes) -> Iterator[tuple]:
    """Every node of a block with its witness: that in the block, then that of the block's root."""
    tree, leaves = _appended(block)
    height = None if alone else HEIGHT
    tree.close(height)
    above, gaps = _unpack(path), list(lone)
    for at, leaf in enumerate(leaves):
        own = _lone_steps(at, len(leaves), height)
        joined = [*own[:-1], own[-1] + gaps[0], *gaps[1:]]
        yield block[at], leaf, tree.witnesses[at] + above, joined


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one, as a row is a whole block."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def _batch(found: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(zip(*found, strict=True), fields, strict=True)
    return pa.record_batch(
        [pa.array(values, kinds[kind]) for values, (_, kind) in columns],
        [name for name, _ in fields],
    )


def _witnesses(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for row in _rows(batch):
            found = [
                (row["grp"], node["position"], _pack(witness), bytes(gaps))
                for node, _, witness, gaps in _extended(
                    row["nodes"], row["alone"], row["path"], row["lone"]
                )
            ]
            yield _batch(found, _PATHS)


def _with_paths(blocks: DataFrame, paths: DataFrame, row_bytes: int) -> DataFrame:
    """Blocks with the witness of their root; the paths are few, one for 256 nodes."""
    above = sent_if_small(paths, row_bytes).select(
        F.col("grp").alias("_grp"), F.col("position").alias("_block"), "path", "lone"
    )
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block"))
    return blocks.join(above, same).drop("_grp", "_block")


def _descend(levels: Sequence[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest level's blocks with the witness of each block's root, from ``top`` down."""
    paths = top
    for depth, level in enumerate(reversed(levels)):
        met = _with_paths(level, paths, 200 + 34 * HEIGHT * (depth + 1))
        if depth == len(levels) - 1:
            return met
        paths = materialize(met.mapInArrow(_witnesses, _PATHS), "paths")
    raise ValueError("a tree has one level at least")


_PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def _proofs(root: bytes):
    def proofs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in _rows(batch):
                found = []
                for node, leaf, witness, gaps in _extended(
                    row["nodes"], row["alone"], row["path"], row["lone"]
                ):
                    other = node["other"]
                    folded = fold(other.hex().encode() if other else leaf, witness, gaps)
                    proof = _hash(*(sibling[1:] for sibling in witness))
                    found.append((
                        node["id"], leaf.decode(), row["subroot"].hex(), root.decode(),
                        proof.decode(), folded.decode(), folded == root,
                    ))
                yield _batch(found, _PROOFS)

    return proofs


class Manifest(NamedTuple):
    """The trees of all groups, the tree of their subroots, and the root (None without rows)."""

    groups: Tree
    above: Tree | None
    root: str | None


def build_manifest(
    df: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_column: str = "lang",
    id_column: str = "doc_id",
    tamper: str | None = None,
) -> Manifest:
    """Trees over all rows of ``df``; with ``tamper``, leaves also carry a second, tampered digest.

    A row's leaf is ``H`` of the named columns in order. Leaves of a group ascend by id, null ids
    first, equal ids by leaf; repeated rows are leaves each. Null groups are a group, before all
    others. Null and empty values differ. Other columns are ignored. An empty table has no root.
    """
    parts = [value_text(name) for name in columns]
    leaf = F.unhex(F.sha2(F.concat(*parts), 256))
    other = F.lit(None).cast("binary")
    if tamper:
        chosen, text = tampered_value(tamper, id_column)
        changed = [text if name == tamper else part for name, part in zip(columns, parts, strict=True)]
        other = F.when(chosen, F.unhex(F.sha2(F.concat(*changed), 256)))
    leaves = df.select(
        F.col(f"`{group_column}`").cast("string").alias("grp"),
        F.col(f"`{id_column}`").cast("long").alias("id"),
        leaf.alias("digest"),
        other.alias("other"),
    )
    leaves = materialize(leaves, "leaves")
    ordered = numbered(leaves, ["grp"], ["id", "digest"])
    groups = build(materialize(ordered.select("grp", "position", "id", "digest", "other"), "nodes"))

    subroots = numbered(groups.subroots, [], ["grp"])
    tops = subroots.select(
        F.lit(None).cast("string").alias("grp"), "position", F.lit(None).cast("long").alias("id"),
        "digest", F.lit(None).cast("binary").alias("other"),
    )
    above = build(materialize(tops, "tops"))
    found = above.subroots.first()
    named = materialize(subroots.select("grp", "position", "digest"), "subroots")
    return Manifest(
        groups._replace(subroots=named), above, found.digest.hex() if found else None
    )


def prove(manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every leaf.

    The witness of a leaf is that within its block, extended by its block's, its group's. Its
    siblings from left to right give ``proof_sha256``; folded with the leaf, or with the tampered
    digest where there is one, they give ``folded_root``.
    """
    groups, above, root = manifest
    spark = groups.subroots.sparkSession
    if root is None:
        return spark.createDataFrame([], _PROOFS)
    start = spark.range(1).select(
        F.lit(None).cast("string").alias("grp"), F.lit(0).cast("long").alias("position"),
        F.lit(b"").alias("path"), F.lit(b"\0").alias("lone"),
    )
    tops = _descend(above.levels, materialize(start, "start")).mapInArrow(_witnesses, _PATHS)
    tops = tops.select("position", "path", "lone")
    # A group's witness holds for its only block on its highest level.
    named = groups.subroots.withColumnRenamed("digest", "subroot").join(tops, "position")
    named = materialize(named.select("grp", "subroot", "path", "lone"), "groups")
    first = named.select("grp", F.lit(0).cast("long").alias("position"), "path", "lone")
    met = _descend(groups.levels, first)
    own = sent_if_small(named.select(F.col("grp").alias("_grp"), "subroot"), 100)
    met = met.join(own, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    return met.select("nodes", "alone", "path", "lone", "subroot").mapInArrow(
        _proofs(root.encode()), _PROOFS
    )

