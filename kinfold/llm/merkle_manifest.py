"""A Merkle manifest of a table: one root for all rows, and for each row the siblings that lead to it.

Rows are leaves. Those of one ``group`` are ordered by id and form a tree: two neighbours become their hash, a last one without
neighbour becomes the hash of itself alone, until one node is left. The nodes of all groups, in the order of the
groups, form one more tree in the same way; its last node is the root.

The nodes lie in an append log in the order in which they are completed (postorder). A node at ``level`` whose last leaf is
number e (from 0) stands at place ``2 e - ones(e) + level``, with the number of ones in the binary form of e: e leaves and
e - ones(e) inner nodes were completed before that leaf, and the nodes above it follow one by one. The last leaf of node j is
``min((j + 1) << level, n) - 1`` in a tree of n leaves. So every sibling is addressed without a pointer.

Builders are aligned: one takes ``1 << BITS`` neighbouring leaves, writes their nodes as they are completed, and hands
its topmost node to the builders of the next round; the number of rounds is logarithmic in the leaves with the base of a block.
Proofs are made in the same blocks from above: the block's topmost node brings its own siblings, and the siblings within the block
are found by their places in its piece of the log. Texts are hashed where they are read; only ids and digests are
shuffled, a group with a third of the rows is many blocks, and a lost task repeats one block.

Defined results: a NULL in a hashed column is ``-``; a NULL id comes first; rows with the same id are ordered by their leaf,
and equal rows are equal leaves, each with its own place; a NULL group is a group, the first; an empty table has
no leaf and no root; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import ship
from kinfold.llm.order import places
from kinfold.sources.scratch import cut_lineage

#: A block has ``1 << BITS`` leaves at most.
BITS = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every so many documents, by the hash of their id, one is changed to try the proofs.
TRIED = 7


def height(n: int) -> int:
    """Levels above the leaves of a tree."""
    return max(0, n - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes at a level of a tree of ``n`` leaves."""
    return (n + (1 << level) - 1) >> level


def place(n: int, level: int, j: int) -> int:
    """Where node ``j`` of a level stands in the log of its tree."""
    last = min((j + 1) << level, n) - 1
    return 2 * last - last.bit_count() + level


def joined(*digests: bytes) -> bytes:
    """The digest of digests, which are hashed as lowercase hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def complete(digests: Sequence[bytes], first: int, n: int, base: int, top: int) -> Iterator[tuple[int, int, bytes]]:
    """``(level, j, digest)`` of the nodes above ``digests``, as they are completed, up to level ``top``.

    ``digests`` are the nodes of level ``base`` from number ``first`` on, an aligned block of them.
    """
    waiting: dict[int, bytes] = {}
    for j, d in enumerate(digests, first):
        level = base
        yield level, j, d
        while level < top:
            if not j & 1 and j + 1 < width(n, level):
                waiting[level] = d
                break
            d = joined(waiting.pop(level), d) if j & 1 else joined(d)
            level, j = level + 1, j >> 1
            yield level, j, d


def fold(digest: bytes, j: int, n: int, siblings: Iterator[bytes]) -> bytes:
    """The last node of a tree of ``n`` leaves, from leaf ``j`` and its siblings."""
    for level in range(height(n)):
        if j ^ 1 < width(n, level):
            other = next(siblings)
            digest = joined(other, digest) if j & 1 else joined(digest, other)
        else:
            digest = joined(digest)
        j >>= 1
    return digest


def encoded(value: Column) -> Column:
    """``-`` if NULL, else the bytes of the value, counted."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns]).cast("binary"), 256))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: every row's ``_id``, digest ``_leaf``, extra columns, tree, leaf number ``_j`` and the leaves ``_n`` of its tree, and
    ``_u``, the tree's number among ``n_trees``. ``log``: ``(tree, level, j, place, digest)`` of every node. ``trees``: ``(tree, group, n, u, subroot)``.
    ``root``: digest, None without leaves."""

    leaves: DataFrame
    log: DataFrame
    trees: DataFrame
    n_trees: int
    root: bytes | None
    bits: int
    rounds: int


def _blocks(nodes: DataFrame, base: int, bits: int) -> DataFrame:
    """The log of the nodes above those of level ``base``, ``(tree, n, j, digest)``, block by block."""

    def build(t: pa.Table) -> pa.Table:
        at = np.argsort(t["j"].to_numpy(), kind="stable")
        digests = t["digest"].take(pa.array(at)).to_pylist()
        tree, n, first = t["tree"][0].as_py(), t["n"][0].as_py(), t["j"][int(at[0])].as_py()
        top = min(base + bits, height(n))
        made = [x for x in complete(digests, first, n, base, top) if not base or x[0] > base]
        level, j, digest = zip(*made, strict=True) if made else ((), (), ())
        stand = [place(n, a, b) for a, b in zip(level, j, strict=True)]
        columns = [[tree] * len(made), [n] * len(made), level, j, stand]
        return pa.table([*(pa.array(c, pa.int64()) for c in columns), pa.array(digest, pa.binary())],
                        names=["tree", "n", "level", "j", "place", "digest"])

    block = F.shiftright("j", bits)
    return nodes.groupBy(F.col("tree"), block.alias("block")).applyInArrow(
        build, "tree bigint, n bigint, level bigint, j bigint, place bigint, digest binary"
    )


def _grow(leaves: DataFrame, most: int, bits: int, name: str) -> tuple[list[DataFrame], int]:
    """The log in pieces, one for each round of builders; ``most`` is the size of the largest tree."""
    nodes, pieces, base = leaves, [], 0
    while True:
        pieces.append(cut_lineage(_blocks(nodes, base, bits), f"{name}-{base}"))
        base += bits
        if height(most) <= base:
            return pieces, len(pieces)
        nodes = pieces[-1].where((F.col("level") == base) & (F.col("n") > F.lit(1 << base))).select("tree", "n", "j", "digest")


def build(
    docs: DataFrame, id_column: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS,
    extra: Callable[[], dict[str, Column]] = dict, bits: int = BITS,
) -> Manifest:
    """Hash the rows of ``docs`` and write the log of all their trees. ``extra`` are further columns to keep with the leaves."""
    spark = docs.sparkSession
    ship(spark)
    hashed = cut_lineage(
        docs.select(
            F.col(id_column).alias("_id"), F.col(group).alias("_group"), leaf_of([F.col(c) for c in columns]).alias("_leaf"),
            *[c.alias(a) for a, c in extra().items()], F.monotonically_increasing_id().alias("_row_n"),
        ),
        "leaves",
    )
    order = [F.col(c).asc_nulls_first() for c in ("_group", "_id", "_leaf", "_row_n")]
    placed = cut_lineage(places(hashed, order, "ordered", "_at"), "placed")
    groups = cut_lineage(placed.groupBy("_group").agg(F.min("_at").alias("tree"), F.count("*").alias("n")), "groups")
    groups = cut_lineage(places(groups, [F.col("tree").asc()], "groups", "u"), "trees")
    sizes = groups.agg(F.max("n").alias("most"), F.count("*").alias("trees")).first()
    named = groups.withColumnRenamed("_group", "_named")
    leaves = (
        placed.join(named, F.col("_group").eqNullSafe(F.col("_named")))
        .withColumn("_j", F.col("_at") - F.col("tree"))
        .drop("_named", "_at", "_row_n").withColumnsRenamed({"n": "_n", "u": "_u"})
    )
    leaves = cut_lineage(leaves, "placed")
    nodes = leaves.select("tree", F.col("_n").alias("n"), F.col("_j").alias("j"), F.col("_leaf").alias("digest"))
    pieces, rounds = _grow(nodes, sizes.most or 0, bits, "log")
    log = pieces[0]
    for p in pieces[1:]:
        log = log.unionByName(p)
    # The last node of each tree stands on the lowest level that has one node only.
    tops = log.where((F.col("j") == 0) & (F.pow(F.lit(2.0), "level") >= F.col("n"))).select("tree", F.col("digest").alias("subroot"))
    trees = cut_lineage(groups.join(tops, "tree").select("tree", F.col("_group").alias("group"), "n", "u", "subroot"), "subroots")
    upper = trees.select(
        F.lit(-1).cast("bigint").alias("tree"), F.lit(sizes.trees).cast("bigint").alias("n"),
        F.col("u").alias("j"), F.col("subroot").alias("digest"),
    )
    above, _ = _grow(upper, sizes.trees, bits, "upper")
    for p in above:
        log = log.unionByName(p)
    last = above[-1].where((F.col("j") == 0) & (F.col("level") == height(sizes.trees))).select("digest").first()
    return Manifest(leaves, log, trees, sizes.trees, bytes(last.digest) if last else None, bits, rounds)


def _siblings(n: int, base: int, top: int, j: np.ndarray, stand: np.ndarray, digest: list[bytes]) -> list[list[bytes]]:
    """For nodes ``j`` of level ``base``, their siblings below level ``top``, taken from a piece of the log by place."""
    by_place = np.argsort(stand)
    ordered = stand[by_place]
    found: list[list[bytes]] = [[] for _ in j]
    for level in range(base, top):
        other = (j >> (level - base)) ^ 1
        there = np.flatnonzero(other < width(n, level))
        last = np.minimum((other[there] + 1) << level, n) - 1
        at = by_place[np.searchsorted(ordered, 2 * last - np.bitwise_count(last).astype(np.int64) + level)]
        for i, k in zip(there.tolist(), at.tolist(), strict=True):
            found[i].append(digest[k])
    return found


def _proofs(m: Manifest, nodes: DataFrame, log: DataFrame, above: DataFrame, base: int,
            finish: Callable[[pa.Table, list[bytes]], pa.Table], schema: str) -> DataFrame:
    """``finish(nodes, path)`` of every block of nodes ``(tree, _n, _j, ...)`` of level ``base``; a path is all siblings of a node up to the
    root, joined. ``above``: ``(tree, block, path)`` of each block's topmost node."""
    bits = m.bits
    level = F.col("level")
    # The last node of a tree that ends below stands on this level too, but has nothing to prove here.
    inside = log.where((level >= base) & (level < base + bits) & (F.col("n") > F.lit(1 << base if base else 0)))
    inside = inside.select("tree", F.expr(f"shiftright(j, cast({bits} - (level - {base}) as int))").alias("block"), "place", "digest")
    given = above.select("tree", "block", F.lit(-1).cast("bigint").alias("place"), F.col("path").alias("digest"))

    def extract(own: pa.Table, piece: pa.Table) -> pa.Table:
        stand, digest = piece["place"].to_numpy(), piece["digest"].to_pylist()
        rest = digest[int(np.flatnonzero(stand < 0)[0])]
        n = own["_n"][0].as_py()
        paths = _siblings(n, base, min(base + bits, height(n)), own["_j"].to_numpy(), stand, digest)
        return finish(own, [b"".join(p) + rest for p in paths])

    block = F.shiftright("_j", bits).alias("block")
    left = nodes.withColumn("block", block).groupBy("tree", "block")
    right = inside.unionByName(given).groupBy("tree", "block")
    return left.cogroup(right).applyInArrow(extract, schema)


def _path_of(own: pa.Table, paths: list[bytes]) -> pa.Table:
    return pa.table([own["tree"], own["_j"], pa.array(paths, pa.binary())], names=["tree", "block", "path"])


def _above(m: Manifest, trees: DataFrame, of: str) -> DataFrame:
    """The path of every block of leaves' topmost node: through the rounds of its tree, from the path of the tree."""
    level, n = F.col("level"), F.col("n")
    above: DataFrame | None = None
    for r in range(m.rounds - 1, -1, -1):
        base = r * m.bits
        ends = trees.where(n <= F.lit(1 << (base + m.bits)))
        if r:
            ends = ends.where(n > F.lit(1 << base))
        here = ends.select("tree", F.lit(0).cast("bigint").alias("block"), "path")
        above = here if above is None else above.unionByName(here)
        if r:
            log = m.log.where(F.col("tree") >= 0)
            nodes = log.where((level == base) & (n > F.lit(1 << base))).select("tree", n.alias("_n"), F.col("j").alias("_j"))
            above = cut_lineage(_proofs(m, nodes, log, above, base, _path_of, "tree bigint, block bigint, path binary"), f"{of}-{base}")
    return above


def proven(m: Manifest, tried: str | None = None) -> DataFrame:
    """The leaves with ``subroot``, ``siblings`` (joined digests, from the leaf to the root, left to right where two neighbours
    leave one), ``proof`` (their digest) and ``folded``: the root recomputed from the column ``tried`` where it is not NULL, else the leaf."""
    # The paths of the subroots: their tree is a tree like the others.
    upper = m.trees.select(F.lit(-1).cast("bigint").alias("tree"), F.lit(m.n_trees).cast("bigint").alias("_n"), F.col("u").alias("_j"))
    tops = _tree_paths(m, upper)
    trees = cut_lineage(
        m.trees.join(tops.withColumnsRenamed({"tree": "_t", "block": "u"}).drop("_t"), "u").select("tree", "n", "u", "subroot", "path"),
        "tree-paths",
    )
    above = _above(m, trees, "paths")
    n_trees = m.n_trees
    kept = m.leaves.drop("_group")
    fields = [f for f in kept.schema if f.name not in ("tree",)]
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def finish(own: pa.Table, paths: list[bytes]) -> pa.Table:
        asked = own[tried].to_pylist() if tried else [None] * len(own)
        leaf, j, n, u = (own[c].to_pylist() for c in ("_leaf", "_j", "_n", "_u"))
        proof, folded = [], []
        for k, path in enumerate(paths):
            parts = [path[a : a + 32] for a in range(0, len(path), 32)]
            proof.append(joined(*parts))
            walk = iter(parts)
            folded.append(fold(fold(asked[k] or leaf[k], j[k], n[k], walk), u[k], n_trees, walk))
        new = [pa.array(c, pa.binary()) for c in (paths, proof, folded)]
        return pa.table([*(own[f.name] for f in fields), own["tree"], *new], names=[*(f.name for f in fields), "tree", "siblings", "proof", "folded"])

    log = m.log.where(F.col("tree") >= 0)
    out = _proofs(m, kept, log, above, 0, finish, f"{declared}, tree bigint, siblings binary, proof binary, folded binary")
    return out.join(trees.select("tree", "subroot"), "tree")


def _tree_paths(m: Manifest, upper: DataFrame) -> DataFrame:
    """The path of every subroot to the root."""
    rounds = max(1, -(-height(m.n_trees) // m.bits))
    lone = m.trees.sparkSession.range(1 if m.n_trees else 0).select(
        F.lit(-1).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("block"), F.lit(b"").alias("path")
    )
    log, above = m.log.where("tree = -1"), lone
    for r in range(rounds - 1, -1, -1):
        base = r * m.bits
        nodes = upper if not r else log.where(F.col("level") == base).select("tree", F.col("n").alias("_n"), F.col("j").alias("_j"))
        above = _proofs(m, nodes, log, above, base, _path_of, "tree bigint, block bigint, path binary")
    return above


def verified(docs: DataFrame, id_column: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS,
             changed: str = "n_chars", bits: int = BITS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row, after one was added to the column
    ``changed`` of those documents whose id's hash ``TRIED`` divides."""

    def tried() -> dict[str, Column]:
        name = F.col(id_column).cast("string").cast("binary")
        # One more than the greatest long is no long, but has a text.
        more = (F.col(changed).cast("decimal(20,0)") + 1).cast("decimal(20,0)")
        altered = leaf_of([more if c == changed else F.col(c) for c in columns])
        return {"_tried": F.when((F.crc32(name) % TRIED == 0) & F.col(changed).isNotNull(), altered)}

    m = build(docs, id_column, group, columns, tried, bits)
    root = F.lit(m.root.hex() if m.root else None).cast("string")
    text = {c: F.lower(F.hex(c)) for c in ("_leaf", "subroot", "proof", "folded")}
    return proven(m, "_tried").select(
        F.col("_id").alias(id_column), text["_leaf"].alias("leaf"), text["subroot"].alias("subroot"), root.alias("root"),
        text["proof"].alias("proof_sha256"), text["folded"].alias("folded_root"), (text["folded"] == root).alias("verified"),
    )
