"""Merkle manifest of a dataset: trees of fan-out 8 kept as aligned blocks in van Emde Boas order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.operators.numbering import number_rows
from tasteline.session import materialize

# Children of a node, as a number and in bits.
FAN = 8
_BITS = 3
# Levels of nodes above the leaves of a block; a block has at most 8**4 leaves and 4,681 nodes.
HEIGHT = 4
_DIGEST = 32


def _nodes(levels: int) -> int:
    """Nodes of a whole tree with so many levels, leaves included."""
    return (FAN**levels - 1) // (FAN - 1)


def place(levels: int, depth: np.ndarray | int, index: np.ndarray | int) -> np.ndarray | int:
    """Place in van Emde Boas order of node ``index`` of level ``depth`` (the root's is 0).

    A tree is cut at half its levels; the top tree comes first and the bottom
    trees follow from left to right, each laid out the same way. So the place
    needs one step per halving, and a path to the root crosses few stretches of
    memory whatever the size of a cache line.
    """
    at = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = _BITS * (depth - top)
        at += _nodes(top) + (index >> below) * _nodes(levels - top)
        index, depth, levels = index & ((1 << below) - 1), depth - top, levels - top
    return at


@lru_cache(maxsize=32)
def _level_places(levels: int, depth: int) -> np.ndarray:
    """Places of all nodes of a level, from left to right."""
    return place(levels, depth, np.arange(FAN**depth, dtype=np.int64)) + np.zeros(FAN**depth, dtype=np.int64)


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    height = 0
    while FAN**height < n:
        height += 1
    return height


def node_digest(children: list[bytes]) -> bytes:
    """SHA-256 of the children's digests as hex text, end to end."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """All nodes of a block in van Emde Boas order; places without a node stay zero."""
    levels = height + 1
    nodes = np.zeros((_nodes(levels), _DIGEST), dtype=np.uint8)
    row = leaves
    for depth in range(height, -1, -1):
        nodes[_level_places(levels, depth)[: len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, _DIGEST)
        if depth:
            row = [node_digest(row[i : i + FAN]) for i in range(0, len(row), FAN)]
    return nodes.tobytes()


def siblings(nodes: bytes, height: int, held: int, index: int) -> bytes:
    """Digests of the siblings on the way from leaf ``index`` of a block of ``held`` leaves to its root."""
    levels, out = height + 1, []
    for depth in range(height, 0, -1):
        first = index & ~(FAN - 1)
        places = _level_places(levels, depth)
        for other in range(first, min(first + FAN, held)):
            if other != index:
                at = int(places[other]) * _DIGEST
                out.append(nodes[at : at + _DIGEST])
        index, held = index >> _BITS, (held + FAN - 1) >> _BITS
    return b"".join(out)


def fold(digest: bytes, index: int, n: int, path: bytes) -> tuple[bytes, int]:
    """The root that a leaf at ``index`` of ``n`` and its siblings give, and the bytes of siblings used."""
    at = 0
    while n > 1:
        run = min(FAN, n - (index & ~(FAN - 1)))
        left, end = at + (index & (FAN - 1)) * _DIGEST, at + (run - 1) * _DIGEST
        digest = node_digest([path[at:left], digest, path[left:end]])
        index, n, at = index >> _BITS, (n + FAN - 1) >> _BITS, end
    return digest, at


def _field(value: Column) -> Column:
    """A value as its byte count, a colon and itself; null as a dash."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 (binary) of a document's columns, in this order."""
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]), 256))


# Letters that tampering lowers.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one, as a row holds a whole block."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, roots = [], []
        for leaves, n in zip(batch.column("leaves"), batch.column("n").to_pylist()):
            # The one block of a small tree ends at its root; any other goes up by whole blocks.
            nodes.append(build_block(leaves.as_py(), min(HEIGHT, height_of(n))))
            roots.append(nodes[-1][:_DIGEST])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("tree", "block", "n", "ids", "changed")],
             pa.array(map(len, batch.column("leaves")), pa.int32()), pa.array(nodes, pa.binary()), pa.array(roots, pa.binary())],
            names=["tree", "block", "n", "ids", "changed", "held", "nodes", "root"],
        )


_BLOCK = "tree long, block long, n long, ids array<long>, changed array<binary>, held int, nodes binary, root binary"


def build_layer(leaves: DataFrame, label: str) -> DataFrame:
    """The blocks of all trees over ``leaves`` (tree, index, n, digest, id, changed), one row each.

    A block is an aligned run of at most 8**HEIGHT leaves; that bounds every group,
    however many leaves a tree has.
    """
    leaf = F.struct("index", "digest", "id", "changed").alias("leaf")
    block = F.shiftright("index", _BITS * HEIGHT).alias("block")
    groups = leaves.select("tree", block, "n", leaf).groupBy("tree", "block").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list("leaf")).alias("l")
    )
    split = groups.select(
        "tree", "block", "n", F.col("l.digest").alias("leaves"), F.col("l.id").alias("ids"), F.col("l.changed").alias("changed")
    )
    return materialize(map_batches(split, _block_batches, _BLOCK), label)


def build_forest(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Layers of blocks of all trees, the leaves' first; the roots of a layer's blocks are the leaves of the next.

    The number of layers is a twelfth of the binary logarithm of the largest tree.
    """
    layers = [build_layer(leaves, label)]
    while True:
        up = layers[-1].where(F.col("n") > FAN**HEIGHT)
        if up.limit(1).count() == 0:
            return layers
        count = F.shiftright(F.col("n") + (FAN**HEIGHT - 1), _BITS * HEIGHT)
        row = up.select(
            "tree", F.col("block").alias("index"), count.alias("n"), F.col("root").alias("digest"),
            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("changed"),
        )
        layers.append(build_layer(row, label))


def _path_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, index, path): siblings from each leaf of a block up to the root of its tree."""
    for batch in batches:
        for row in _rows(batch):
            held, height = row["held"], min(HEIGHT, height_of(row["n"]))
            above = row["above"] or b""
            first = row["block"] << (_BITS * HEIGHT)
            paths = [siblings(row["nodes"], height, held, i) + above for i in range(held)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * held, pa.int64()), pa.array(range(first, first + held), pa.int64()), pa.array(paths, pa.binary())],
                names=["tree", "index", "path"],
            )


_PATHS = "tree long, index long, path binary"


def _with_above(layer: DataFrame, above: DataFrame | None) -> DataFrame:
    if above is None:
        return layer.withColumn("above", F.lit(None).cast("binary"))
    above = above.select("tree", F.col("index").alias("block"), F.col("path").alias("above"))
    return layer.join(above, ["tree", "block"], "left")


def block_paths(layers: list[DataFrame], label: str) -> DataFrame | None:
    """(tree, index, path) for every block of the first layer that is not its whole tree; None if there is none.

    The path goes from the block's root to the root of the tree, one layer of
    blocks after the other from the top.
    """
    above = None
    for layer in reversed(layers[1:]):
        read = _with_above(layer, above).select("tree", "block", "n", "held", "nodes", "above")
        above = materialize(map_batches(read, _path_batches, _PATHS), label)
    return above


def _proof_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf, proof and folded root of every leaf of a block."""
    for batch in batches:
        for row in _rows(batch):
            held, n, height = row["held"], row["n"], min(HEIGHT, height_of(row["n"]))
            nodes, above, over = row["nodes"], row["above"] or b"", row["over"] or b""
            first = row["block"] << (_BITS * HEIGHT)
            places = _level_places(height + 1, height)
            leaf, proof, folded = [], [], []
            for i in range(held):
                at = int(places[i]) * _DIGEST
                own = nodes[at : at + _DIGEST]
                path = siblings(nodes, height, held, i) + above + over
                changed = row["changed"][i]
                top, used = fold(own if changed is None else changed, first + i, n, path)
                top, _ = fold(top, row["tree"], row["trees"], path[used:])
                leaf.append(own.hex())
                proof.append(hashlib.sha256(path.hex().encode()).hexdigest())
                folded.append(top.hex())
            root, subroot = row["root"].hex(), row["subroot"].hex()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()), pa.array(leaf), pa.array([subroot] * held), pa.array([root] * held),
                    pa.array(proof), pa.array(folded), pa.array([f == root for f in folded], pa.bool_()),
                ],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )


_OUT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    Every row is a leaf over doc_id, source, lang, n_chars and text. The rows of a
    language, by doc_id, form a tree of fan-out 8; the trees' roots, by language,
    form the tree of the whole. Rows where ``tampered`` holds are folded from the
    digest of their text in lower case (A-Z only), all others from their own.

    Trees are kept as aligned blocks of 8**4 leaves whose nodes stand in van Emde
    Boas order; blocks are built by any task, their roots are the leaves of the
    next layer, and siblings are found by address in the block's row and in those
    of the layers above. No task sees more than a block's leaves at once.

    Null doc_ids come first, a null language is a language of its own and comes
    first. Rows that share language and doc_id are ordered by their digest, so
    repeated rows have equal leaves but places of their own. A null ``tampered``
    counts as false. Other columns are ignored; an empty frame gives an empty one.
    """
    lowered = F.translate("text", _UPPER, _LOWER)
    columns = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        "lang",
        leaf_digest(*columns, F.col("text")).alias("digest"),
        F.when(tampered, leaf_digest(*columns, lowered)).alias("changed"),
    )
    by_bytes = F.col("lang").cast("binary")
    order = [by_bytes.asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest")]
    numbered = number_rows(materialize(rows, "merkle-rows"), order, "merkle-leaves")
    langs = numbered.groupBy("lang").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    langs = materialize(number_rows(langs, [by_bytes.asc_nulls_first()], "merkle-langs", "tree"), "merkle-trees")
    same = F.col("l").eqNullSafe(F.col("lang"))
    placed = numbered.join(langs.withColumnRenamed("lang", "l"), same)
    leaves = placed.select("tree", (F.col("number") - F.col("first")).alias("index"), "n", "digest", "id", "changed")
    layers = build_forest(leaves, "merkle-blocks")

    # The only block of a tree's last layer holds its subroot.
    tops = [layer.where(F.col("n") <= FAN**HEIGHT).select("tree", "root") for layer in layers]
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.union(more)
    trees = langs.count()
    subroots = materialize(roots, "merkle-subroots")
    none = F.lit(None)
    crown = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(trees).cast("long").alias("n"),
        F.col("root").alias("digest"), none.cast("long").alias("id"), none.cast("binary").alias("changed"),
    )
    crown_layers = build_forest(crown, "merkle-crown")
    # One value: the root of the whole, or none over an empty frame.
    top = crown_layers[-1].select("root").first()
    crown_above = block_paths(crown_layers, "merkle-crown-paths")
    read = _with_above(crown_layers[0], crown_above).select("tree", "block", "n", "held", "nodes", "above")
    over = map_batches(read, _path_batches, _PATHS).select(F.col("index").alias("tree"), F.col("path").alias("over"))
    # One row per language, and one root.
    ends = materialize(over.join(subroots.withColumnRenamed("root", "subroot"), "tree"), "merkle-ends")

    above = block_paths(layers, "merkle-paths")
    whole = _with_above(layers[0].drop("root"), above).join(ends, "tree")
    root = F.lit(None if top is None else bytearray(top["root"])).cast("binary")
    whole = whole.withColumn("trees", F.lit(trees).cast("long")).withColumn("root", root)
    return map_batches(whole, _proof_batches, _OUT)


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest with every third document by the checksum of its doc_id tampered with."""
    crc = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    return manifest(docs, crc % 3 == 0)
