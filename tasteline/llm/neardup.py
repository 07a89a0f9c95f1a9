"""Near-duplicate documents by a chosen-path set similarity join over word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteline.llm.components import components
from tasteline.llm.ship import map_batches
from tasteline.llm.spans import LOWER, Block, blocks, mix64, prefix_hash, range_hash, split_words
from tasteline.llm.text import SPACE
from tasteline.session import materialize


@dataclass(frozen=True)
class JoinSpec:
    """Shingle length in words, least Jaccard similarity in percent, and shape of the search.

    Every tree sends a document to the node of one minwise token. A node of more
    than ``leaf`` documents is branched again, each document going on with
    ``branches`` further tokens, ``levels`` times at most. Two documents of
    similarity s miss each other in one tree with a chance of about 1 - s, so
    eight trees find a pair at 0.8 with a chance above 0.99999.
    """

    words: int = 5
    percent: int = 80
    trees: int = 8
    branches: int = 2
    levels: int = 3
    leaf: int = 32
    seed: int = 5

    @property
    def tokens(self) -> int:
        return self.trees * (1 + self.levels * self.branches)

    @property
    def least_equal(self) -> int:
        """Equal tokens below which two documents are six deviations away from the threshold."""
        s = self.percent / 100
        return max(0, int(self.tokens * s - 6 * (self.tokens * s * (1 - s)) ** 0.5))


def _shingles(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and where each text's begin."""
    words = split_words(block, fold=LOWER)
    n = np.diff(words.first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), count)
    start = words.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    end = start + np.minimum(n, k)[text]
    hashes = range_hash(prefix_hash(words.hash), start, end)
    order = np.argsort(hashes)
    order = order[np.argsort(text[order].astype(np.uint16 if len(n) < 1 << 16 else np.int64), kind="stable")]
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(n) + 1))


def _fingerprints(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    out = []
    for salt in (0x51, 0xA7):
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix64(hashes ^ np.uint64(salt)), out=sums[1:])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _signatures(spec: JoinSpec, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minwise tokens of each nonempty set (32 bits each), zeros of an empty one."""
    seeds = np.random.default_rng(spec.seed).integers(1, 1 << 63, (spec.tokens, 2), dtype=np.uint64)
    out = np.zeros((len(first) - 1, spec.tokens), dtype=np.int32)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    for i, (a, b) in enumerate(seeds):
        x = (hashes ^ a) * (b | np.uint64(1))
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        out[full, i] = (np.minimum.reduceat(x, first[full]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _sign_batches(spec: JoinSpec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            hashes, first = _shingles(block, spec.words)
            one, two = _fingerprints(hashes, first)
            tokens = _signatures(spec, hashes, first)
            places = pa.array(np.arange(len(tokens) + 1, dtype=np.int32) * spec.tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(block.lo, block.hi - block.lo),
                    batch.column("text_key").slice(block.lo, block.hi - block.lo),
                    pa.array(np.diff(first)),
                    pa.array(one),
                    pa.array(two),
                    pa.ListArray.from_arrays(places, pa.array(tokens.reshape(-1))),
                ],
                names=["doc_id", "text_key", "n", "fp1", "fp2", "tokens"],
            )


def _set_batches(spec: JoinSpec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole shingle sets (sorted 64-bit hashes) of the texts whose fingerprint is the one asked for."""
    for batch in batches:
        wanted = batch.column("fp1").to_numpy(zero_copy_only=False)
        for block in blocks(batch.column("text")):
            hashes, first = _shingles(block, spec.words)
            one, _ = _fingerprints(hashes, first)
            right = pa.array(one == wanted[block.lo : block.hi])
            places = pa.array((first * 8).astype(np.int32))
            sets = pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, places.buffers()[1], pa.py_buffer(hashes.tobytes())])
            ids = batch.column("id").slice(block.lo, block.hi - block.lo)
            yield pa.RecordBatch.from_arrays([ids.filter(right), sets.filter(right)], names=["id", "items"])


def _confirm_batches(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            p = np.frombuffer(x.as_buffer(), dtype=np.uint64)
            q = np.frombuffer(y.as_buffer(), dtype=np.uint64)
            if len(p) > len(q):
                p, q = q, p
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            both = int((q[at] == p).sum())
            keep.append(100 * both >= percent * (len(p) + len(q) - both))
        kept = pa.array(keep, type=pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"]
        )


def _sets(docs: DataFrame, reps: DataFrame, ids: DataFrame, spec: JoinSpec) -> DataFrame:
    """(id, items): whole shingle sets of the classes ``ids``, shingled again from the text of one row each."""
    asked = reps.select("id", "fp1", "doc_id", "text_key").join(ids, "id", "left_semi")
    asked = docs.join(asked, ["doc_id", "text_key"]).select("id", "fp1", "text")
    sets = map_batches(asked, lambda b: _set_batches(spec, b), "id long, items binary")
    return materialize(sets.dropDuplicates(["id"]), "neardup-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))


def _confirmed(sets: DataFrame, pairs: DataFrame, spec: JoinSpec) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the threshold.

    Each pair carries one set to the other's partition; a partner of very many is
    split by adaptive joins.
    """
    half = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("set_b")), "b")
    whole = half.join(sets.select(F.col("id").alias("a"), F.col("items").alias("set_a")), "a")
    percent = spec.percent
    return map_batches(
        whole.select("a", "b", "set_a", "set_b"), lambda b: _confirm_batches(percent, b), "a long, b long"
    )


def _alike(spec: JoinSpec, a: str, b: str) -> Column:
    """Sizes allow the threshold, and enough tokens are equal for it to be possible."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    equal = F.size(F.filter(F.zip_with(f"{a}.tokens", f"{b}.tokens", lambda x, y: x == y), lambda x: x))
    return (100 * small >= spec.percent * large) & (equal >= spec.least_equal)


def _leaf_pairs(spec: JoinSpec, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one node with different labels that may reach the threshold."""
    ids = rows.column("id").to_numpy()
    labels = rows.column("label").to_numpy()
    n = rows.column("n").to_numpy()
    tokens = np.asarray(rows.column("tokens").combine_chunks().flatten()).reshape(len(ids), -1)
    out_a, out_b = [], []
    for i in range(1, len(ids)):
        other = labels[:i] != labels[i]
        other &= 100 * np.minimum(n[:i], n[i]) >= spec.percent * np.maximum(n[:i], n[i])
        near = np.flatnonzero(other)
        near = near[(tokens[near] == tokens[i]).sum(axis=1) >= spec.least_equal]
        out_a.append(np.minimum(ids[near], ids[i]))
        out_b.append(np.maximum(ids[near], ids[i]))
    return np.concatenate(out_a), np.concatenate(out_b)


PairFn = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def _paired_batches(pairs_of: PairFn, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that ``pairs_of`` finds among the rows of each key; rows come sorted by key."""
    held: pa.Table | None = None

    def nodes(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = table.column("key").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        found = [pairs_of(table.slice(s, e - s)) for s, e in zip(cuts[:-1], cuts[1:]) if e - s > 1]
        if found:
            a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = table.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        held = table.slice(cut)
        if cut:
            yield from nodes(table.slice(0, cut))
    if held is not None:
        yield from nodes(held)


def _paired(rows: DataFrame, pairs_of: PairFn) -> DataFrame:
    dealt = rows.repartition("key").sortWithinPartitions("key")
    return map_batches(dealt, lambda b: _paired_batches(pairs_of, b), "a long, b long")


# Members of a node, and shingles of theirs, compared at once with as many others; columns of a product.
_CHUNK = 1024
_CHUNK_ITEMS = 1 << 20
_SLAB = 2048
# Members of a large node that every other one is compared with before the node is cut or branched.
_PIVOTS = 4


def _overlaps(items: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the sets ``left`` with the sets ``right``."""

    def flat(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(items[r]) for r in rows]), np.concatenate([items[r] for r in rows])

    sides = flat(left), flat(right)
    shared = np.intersect1d(sides[0][1], sides[1][1])
    overlap = np.zeros((len(left), len(right)), dtype=np.float32)
    for s in range(0, len(shared), _SLAB):
        some = shared[s : s + _SLAB]
        ones = []
        for (owner, values), n in zip(sides, overlap.shape):
            at = np.searchsorted(some, values)
            known = some[np.minimum(at, len(some) - 1)] == values
            side = np.zeros((n, len(some)), dtype=np.float32)
            side[owner[known], at[known]] = 1
            ones.append(side)
        overlap += ones[0] @ ones[1].T
    return overlap.astype(np.int64)


def _forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """(row, column) of links that connect whatever the links of a table connect, one less than it has ends at most."""
    rows, columns = np.ones(linked.shape[0], dtype=bool), np.ones(linked.shape[1], dtype=bool)
    for start in np.flatnonzero(linked.any(axis=1)):
        if not rows[start]:
            continue
        rows[start] = False
        todo = [(int(start), True)]
        while todo:
            at, is_row = todo.pop()
            new = np.flatnonzero(linked[at] & columns if is_row else linked[:, at] & rows)
            (columns if is_row else rows)[new] = False
            for other in new.tolist():
                yield (at, other) if is_row else (other, at)
                todo.append((other, not is_row))


def _chunk_links(percent: int, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed links between two chunks of a node (or one and itself), as many as connect what they connect.

    Whole sets are compared, by products of zeros and ones; members of one label
    are connected already.
    """
    ids, labels, n, chunk = (table.column(c).to_numpy() for c in ("id", "label", "n", "chunk"))
    if len(np.unique(labels)) == 1:
        return ids[:0], ids[:0]
    items = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("items")]
    left, right = np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk == chunk.max())
    both = _overlaps(items, left, right)
    either = n[left][:, None] + n[right][None, :] - both
    linked = (100 * both >= percent * either) & (labels[left][:, None] != labels[right][None, :])
    found = np.array(list(_forest(linked)), dtype=np.int64).reshape(-1, 2)
    a, b = ids[left[found[:, 0]]], ids[right[found[:, 1]]]
    return np.minimum(a, b), np.maximum(a, b)


def _drawn(members: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy(F.xxhash64("id"), "id")
    return members.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).drop("r")


def _node_links(members: DataFrame, sets: DataFrame, spec: JoinSpec) -> DataFrame:
    """Links (a, b) that connect all members (key, id, label) of a node which whole sets link.

    Every member is compared with every one of another label. A label of very many
    members has chunks of its own, and no two of one label meet; so a group that is
    connected but for a few costs these few times all, not the square. A pair of
    chunks is one task; what leaves it is confirmed and fewer than its members.
    """
    whole = materialize(members.join(sets.select("id", "items"), "id").withColumn("n", F.octet_length("items") / 8), "neardup-whole")
    slim = whole.select("key", "label", F.col("n").cast("long").alias("n"))
    labels = slim.groupBy("key", "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    own = (F.col("c") >= _CHUNK) | (F.col("s") >= _CHUNK_ITEMS)
    labels = materialize(labels.withColumn("part", F.when(own, F.col("label"))), "neardup-labels")
    size = F.greatest(F.sum("c") / _CHUNK, F.sum("s") / _CHUNK_ITEMS)
    parts = labels.groupBy("key", "part").agg(F.ceil(size).alias("chunks"))
    parts = materialize(parts, "neardup-parts")
    chunk = F.xxhash64("key", "part", "c").alias("chunk")
    listed = parts.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    listed = materialize(listed.select("key", "part", chunk), "neardup-chunks")
    x, y = listed.alias("x"), listed.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.chunk") <= F.col("y.chunk"))
    apart = F.col("x.part").isNull() | F.col("y.part").isNull() | (F.col("x.part") != F.col("y.part"))
    pairs = x.join(y, meet & apart).select(
        F.xxhash64("x.chunk", "y.chunk").alias("pair"), F.array_distinct(F.array("x.chunk", "y.chunk")).alias("of")
    )
    places = pairs.select("pair", F.explode("of").alias("chunk")).groupBy("chunk").agg(F.collect_list("pair").alias("pairs"))
    places = materialize(places, "neardup-places")
    named = whole.join(labels.select("key", "label", "part"), ["key", "label"])
    same = (F.col("key") == F.col("k")) & F.col("part").eqNullSafe(F.col("p"))
    named = named.join(parts.select(F.col("key").alias("k"), F.col("part").alias("p"), "chunks"), same)
    named = named.withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks"))).withColumn("chunk", F.xxhash64("key", "part", "c"))
    sides = named.join(places, "chunk").select(
        F.explode("pairs").alias("key"), "id", "label", F.col("n").cast("long").alias("n"), "chunk", "items"
    )
    percent = spec.percent
    return _paired(sides, lambda t: _chunk_links(percent, t))


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold documents of different labels, with the node's size."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("held"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    sizes = materialize(sizes.where("lo < hi").select("key", "held"), "neardup-sizes")
    return rows.join(sizes, "key")


def _connected_nodes(members: DataFrame, spec: JoinSpec) -> DataFrame:
    """(key, pivot) of large nodes of which one label has half of the members or more, but not all."""
    labels = members.groupBy("key", "pivot", "label").agg(F.count("*").alias("c"))
    nodes = labels.groupBy("key", "pivot").agg(F.sum("c").alias("held"), F.max("c").alias("most"))
    return nodes.where((F.col("held") > spec.leaf) & (2 * F.col("most") >= F.col("held")) & (F.col("most") < F.col("held")))


def _branched(members: DataFrame, reps: DataFrame, spec: JoinSpec) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) from small nodes of all trees, and the members (key, id, label) of nodes that stay large."""
    rows = materialize(_mixed(members).join(reps.select("id", "n", "tokens"), "id"), "neardup-nodes")
    found = None
    for level in range(spec.levels + 1):
        small = rows.where(F.col("held") <= spec.leaf).select("key", "id", "label", "n", "tokens")
        pairs = _paired(small, lambda t: _leaf_pairs(spec, t))
        found = pairs if found is None else found.union(pairs)
        large = rows.where(F.col("held") > spec.leaf)
        if level == spec.levels or large.limit(1).count() == 0:
            return materialize(found.distinct(), "neardup-open"), large.select("key", "id", "label")
        at = F.col("tree") * (spec.levels * spec.branches) + spec.trees + level * spec.branches + F.col("c")
        child = large.withColumn("c", F.explode(F.array(*[F.lit(c) for c in range(spec.branches)])))
        child = child.withColumn("key", F.xxhash64("key", "c", F.get("tokens", at))).drop("c", "held")
        rows = materialize(_mixed(materialize(child, "neardup-children")), "neardup-nodes")
    raise AssertionError


def text_key() -> Column:
    """What tells rows of one doc_id but different texts apart."""
    return F.xxhash64("text")


def text_components(docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """(doc_id, text_key, n, component_id) of every row of ``docs``; see ``near_duplicates``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_key())
    schema = "doc_id long, text_key long, n long, fp1 long, fp2 long, tokens array<int>"
    signed = materialize(map_batches(slim, lambda b: _sign_batches(spec, b), schema), "neardup-signed")
    usable = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # Classes of equal sets have numbers of their own, whatever ids their rows share.
    one = F.struct("doc_id", "text_key", "tokens")
    reps = usable.groupBy("fp1", "fp2", "n").agg(F.min_by(one, F.struct("doc_id", "text_key")).alias("one"))
    reps = reps.select("fp1", "fp2", "n", "one.*").withColumn("id", F.monotonically_increasing_id())
    reps = materialize(reps, "neardup-reps")

    roots = reps.select("id", F.posexplode(F.slice("tokens", 1, spec.trees)).alias("tree", "token"))
    roots = roots.select("id", "tree", F.xxhash64("tree", "token").alias("key"))
    sizes = roots.groupBy("key").agg(F.count("*").alias("held"), F.min("id").alias("pivot")).where("held > 1")
    sizes = materialize(sizes, "neardup-roots")
    members = materialize(roots.join(sizes, "key"), "neardup-members")

    slim_reps = reps.select("id", "n", "tokens")
    # Large nodes of different trees with the same least member are one here.
    large = members.where(F.col("held") > spec.leaf).select(F.col("pivot").alias("key"), "id").distinct()
    large = materialize(large, "neardup-large")
    stars = materialize(_drawn(large, _PIVOTS).select("key", F.col("id").alias("a")), "neardup-pivots")
    stars = large.join(stars, "key").select("a", F.col("id").alias("b"))
    pairs = members.select(F.col("pivot").alias("a"), F.col("id").alias("b")).union(stars)
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = (
        pairs.join(slim_reps.alias("y"), F.col("b") == F.col("y.id"))
        .join(slim_reps.alias("x"), F.col("a") == F.col("x.id"))
        .where(_alike(spec, "x", "y"))
        .select("a", "b")
    )
    near = materialize(near, "neardup-stars")
    links = _confirmed(_sets(slim, reps, _ends(near).distinct(), spec), near, spec)
    links = materialize(links, "neardup-links")
    labels = components(links)

    # Nodes that are mostly connected by now are compared as a whole, all others branched.
    label = F.coalesce("label", "id").alias("label")
    members = members.join(labels, "id", "left").select("key", "tree", "id", "pivot", label)
    members = materialize(members, "neardup-labelled")
    done = materialize(_connected_nodes(members, spec).select("key", "pivot"), "neardup-connected")
    inside = large.join(done.select(F.col("pivot").alias("key")).distinct(), "key", "left_semi").join(labels, "id", "left")
    inside = inside.select("key", "id", label)
    rest = members.join(done.select("key"), "key", "left_anti").select("key", "tree", "id", "label")
    open_pairs, unparted = _branched(rest, reps, spec)
    open_pairs = materialize(open_pairs.join(near, ["a", "b"], "left_anti"), "neardup-open")
    nodes = materialize(inside.unionByName(unparted), "neardup-whole-nodes")
    sets = _sets(slim, reps, _ends(open_pairs).union(nodes.select("id")).distinct(), spec)
    links = links.union(materialize(_confirmed(sets, open_pairs, spec), "neardup-links"))
    links = links.union(materialize(_node_links(nodes, sets, spec), "neardup-links"))
    labels = components(links)

    # Classes to components, these to their least doc_id, then rows to classes by their own sets.
    owner = reps.join(labels, "id", "left").select("fp1", "fp2", "n", "doc_id", label)
    owner = materialize(owner, "neardup-owners")
    least = materialize(owner.groupBy("label").agg(F.min("doc_id").alias("component_id")), "neardup-least")
    owner = owner.drop("doc_id").join(least, "label").drop("label")
    lone = signed.where((F.col("n") == 0) | F.col("doc_id").isNull())
    placed = usable.select("doc_id", "text_key", "n", "fp1", "fp2").join(owner, ["fp1", "fp2", "n"])
    return placed.select("doc_id", "text_key", "n", "component_id").union(
        lone.select("doc_id", "text_key", "n", F.col("doc_id").alias("component_id"))
    )


def near_duplicates(docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words by ASCII white space; a set has
    the distinct shingles of ``spec.words`` words, of fewer words the whole
    sequence. Equal sets form one class before anything is compared. First every
    class of a node is compared with the node's least one, in large nodes with a
    few more, whole sets deciding; that connects large groups of copies by a
    number of comparisons in proportion to their members. Large nodes that are
    mostly connected by then are compared as a whole, but for members that are
    connected already. The others are branched; all pairs that are still apart are
    compared inside small nodes, and in those that no branching makes small.
    ``kept`` marks the least doc_id of each component.

    Null and wordless texts have no shingles and are linked with nothing. Rows
    without doc_id are linked with nothing and kept, their component null. Rows
    that share a doc_id are compared by their own texts, each in its own
    component. Other columns are ignored; an empty frame gives an empty one.
    """
    return text_components(docs, spec).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each component, and all that are linked with nothing.

    Of a component the row with the least doc_id stays; of rows that share it, one
    by the hash of its text; of equal ones, any one. Rows without doc_id or
    without words all stay.
    """
    found = text_components(docs, spec).where("doc_id IS NOT NULL AND n > 0")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_key")).alias("one")).select("one.*")
    first = materialize(first.toDF("__id", "__key"), "neardup-kept")
    marked = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__text": text_key()})
    kept = marked.join(first, (F.col("__doc") == F.col("__id")) & (F.col("__text") == F.col("__key")), "left_semi")
    one = Window.partitionBy("__doc", "__text").orderBy(F.xxhash64(*docs.columns))
    kept = kept.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns)
    wordless = F.coalesce(F.btrim("text", F.lit(SPACE)), F.lit("")) == ""
    return kept.union(docs.where(F.col("doc_id").isNull() | wordless))
