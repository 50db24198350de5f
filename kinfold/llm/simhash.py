"""Near-duplicates by SimHash: 64-bit fingerprints that differ in at most ``RADIUS`` bits are linked.

Equal fingerprints are made one first. To find the links between different ones, the 64 bits are cut
into eight bytes: two fingerprints within two bits agree on at least six of them. So each fingerprint
is put under its 28 choices of six bytes, and compared with those under the same choice only. As just
16 bits are free there, a block holds at most 65,536 fingerprints, whatever the data.

Within a block the fingerprints lie in vertical bit planes: plane b holds bit b of 64
fingerprints in each word. A query XORs its bits with the planes, and counts the differences of all of
them at once in carry-save counters, a few words for each bit of the count. A stretch of words is given
up as soon as every count in it exceeds the radius. A block yields a spanning forest of
its links, never its pairs; the forests of all blocks are joined to components in Spark.

Defined results: a NULL text has no words, like an empty one; texts without words have fingerprint zero and
are linked like any other; equal rows each get a row; a NULL id takes part but never names a component
unless all ids of it are NULL; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import map_texts
from kinfold.operators.closure import connected_components
from kinfold.sources.scratch import cut_lineage

SHINGLE = 3
RADIUS = 2
SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Words of a bit plane that are compared, or given up, together; queries compared at once.
STRETCH, QUERIES = 256, 64


def fingerprint(text: str, n: int = SHINGLE) -> int:
    """A bit is set if it is in over half of the hashes of the text's shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hash_of, join = xxhash.xxh64_intdigest, b" ".join
    shingles = zip(*(words[k:] for k in range(n)), strict=False) if len(words) >= n else [words]
    hashes = np.array([hash_of(join(s), SEED) for s in shingles], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *keep: str, n: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long."""

    def make() -> Callable:
        return lambda texts: [np.array([fingerprint(t, n) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, keep, ["fp bigint"], make)


class BitPlanes:
    """Fingerprints in vertical bit planes; padding is never reported."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype("<u8")
        n = len(values)
        self.words = -(-n // 64)
        bits = np.unpackbits(self.values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        padded = np.zeros((self.words * 64, 64), np.uint8)
        padded[:n] = bits
        self.planes = np.ascontiguousarray(np.packbits(padded.T, axis=1, bitorder="little")).view("<u8")
        # Planes on which all agree cannot add to a distance.
        self.mixed = np.flatnonzero((bits != bits[0]).any(axis=0)) if n else np.array([], int)

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """For each query a row of words: bit i is set if value i is within the radius."""
        out = np.zeros((len(queries), self.words), np.uint64)
        ask = np.where((queries[:, None] >> self.mixed.astype(np.uint64)) & np.uint64(1) == 1, _ALL, np.uint64(0))
        for a in range(0, self.words, STRETCH):
            out[:, a : a + STRETCH] = self._stretch(ask, slice(a, a + STRETCH), radius)
        return out

    def _stretch(self, ask: np.ndarray, where: slice, radius: int) -> np.ndarray:
        shape = (len(ask), self.planes[0, where].size)
        counters = [np.zeros(shape, np.uint64) for _ in range(max(1, radius.bit_length()))]
        far = np.zeros(shape, np.uint64)  # counted beyond what the counters hold
        for k, b in enumerate(self.mixed):
            carry = self.planes[b, where][None, :] ^ ask[:, k : k + 1]
            for c in range(len(counters)):
                carry, counters[c] = counters[c] & carry, counters[c] ^ carry
            far |= carry
            if k >= radius and ((far | self._above(counters, radius)) == _ALL).all():
                return np.zeros(shape, np.uint64)
        return ~(far | self._above(counters, radius))

    @staticmethod
    def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
        """Where the count is greater than the radius, comparing from the highest bit down."""
        greater, equal = np.uint64(0), _ALL
        for c in range(len(counters) - 1, -1, -1):
            if radius >> c & 1:
                equal = equal & counters[c]
            else:
                greater = greater | (equal & counters[c])
                equal = equal & ~counters[c]
        return greater | np.zeros_like(counters[0])


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Index pairs that connect all values linked directly or through others; at most n - 1."""
    n = len(values)
    if n < 2:
        return []
    planes = BitPlanes(values)
    unseen = np.zeros(planes.words, np.uint64)
    whole, rest = divmod(n, 64)
    unseen[:whole] = _ALL
    if rest:
        unseen[whole] = np.uint64((1 << rest) - 1)
    edges: list[tuple[int, int]] = []
    queue: list[int] = []  # met, but not asked yet

    def indices(mask: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))

    def take(start: int, row: np.ndarray) -> None:
        new = row & unseen
        if new.any():
            met = indices(new).tolist()
            edges.extend((start, t) for t in met)
            queue.extend(met)
            np.bitwise_and(unseen, ~new, out=unseen)

    while True:
        # Rows for the next roots are made together, but one component is finished before the next.
        roots = indices(unseen)[:QUERIES]
        if not len(roots):
            return edges
        for root, row in zip(roots.tolist(), planes.within(planes.values[roots], radius), strict=True):
            bit = np.uint64(1) << np.uint64(root & 63)
            if not unseen[root >> 6] & bit:
                continue
            unseen[root >> 6] &= ~bit
            take(root, row)
            while queue:
                asked = queue[:QUERIES]
                del queue[:QUERIES]
                for s, near in zip(asked, planes.within(planes.values[asked], radius), strict=True):
                    take(s, near)


def _choices() -> list[int]:
    """Masks of six of eight bytes, as signed longs."""
    masks = []
    for out in combinations(range(8), 2):
        mask = sum(0xFF << 8 * k for k in range(8) if k not in out)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(u, v)`` that connect exactly the fingerprints ``fp`` that links connect."""
    if radius > 2:
        raise ValueError("the choices of six bytes find links of up to two bits")
    keys = F.array(
        *[F.struct(F.lit(k).cast("tinyint").alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("m"))
          for k, m in enumerate(_choices())]
    )
    blocks = (
        distinct.select("fp", F.explode(keys).alias("key"))
        .groupBy("key.k", "key.m")
        .agg(F.collect_list("fp").alias("fps"))  # 65,536 at most
        .where(F.size("fps") > 1)
        .select("fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            u, v = [], []
            for i in range(len(column)):
                values = column[i].values.to_numpy(zero_copy_only=False)
                for a, b in forest(values.view(np.uint64), radius):
                    u.append(values[a])
                    v.append(values[b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
            )

    return blocks.mapInArrow(run, "u bigint, v bigint").distinct()


def components(docs: DataFrame, id_column: str = "doc_id", n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every document.

    Fingerprints and edges are written to the shared folder; only ids and fingerprints are shuffled.
    """
    marked = cut_lineage(fingerprints(docs, id_column, n=n), "fingerprints")
    return components_of(marked, id_column, radius).select(
        id_column, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def components_of(marked: DataFrame, id_column: str, radius: int = RADIUS) -> DataFrame:
    """``marked`` (id, fp) with ``component_id``."""
    distinct = marked.groupBy("fp").agg(F.min(id_column).alias("first_id"))
    found = connected_components(links(distinct, radius))
    named = (
        distinct.join(found.withColumnsRenamed({"node": "fp"}), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(smallest, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp")


def first_of_each(docs: DataFrame, id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One document of each component stays: the one with its smallest id; one of equal such rows.

    The rows carry a number of their own through the comparison, so equal rows and ids are told
    apart; the texts are joined once with the numbers of those that stay.
    """
    names = docs.columns
    numbered = cut_lineage(
        docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), F.col("text"))
        .withColumn("_n", F.monotonically_increasing_id()),
        "numbered",
    )
    marked = cut_lineage(fingerprints(numbered.withColumn("_id", F.col(f"_row.{id_column}")), "_n", "_id"), "fingerprints")
    placed = components_of(marked.select(F.struct(F.col("_id").isNull(), "_id", "_n").alias("at"), "fp", "_n"), "at", radius)
    stay = placed.where(F.col("component_id") == F.col("at")).select("_n")
    return numbered.join(stay, "_n", "left_semi").select("_row.*")
