"""Bytes that lie in a string of ``LENGTH`` bytes which also starts earlier in the corpus.

Strings of ``LENGTH`` bytes that are equal choose the same *anchor*: among the hashes of their parts of
``GRAM`` bytes the smallest, the first of equal ones. So no string has to be compared with one that has another
anchor. The strings with one anchor follow each other, and the text they cover is a *fragment*, a
few dozen strings in one row:

1. hashes of anchors are counted; a filter of bounded size keeps those met twice (a false hit costs
   time only);
2. fragments with such anchors are grouped by a 128-bit hash: all but the first of equal fragments
   are repeated whole;
3. different fragments with the same anchor are fetched, each from where it occurs first, and compared by a
   run-length index (``run_index``). They are ranked by where they first occur. For each bit of the rank,
   the fragments that have it set are streamed against an index of those that have not, and that agree in
   all higher bits; so each is compared with all earlier ones. A match of ``LENGTH`` or more marks a
   repeated string;
4. an anchor with more than ``CAP`` different fragments is compared string by string, by their MD5 digests, in Spark.

Fragments with one anchor never meet in one task unless they are different and at most ``CAP``. Texts are
read again for each step rather than kept, and only those with a repeated string are shuffled.

Defined results: a NULL text is empty; documents are ordered by id, a NULL id last, then by a hash of the
text; of rows equal in id and text one, it does not matter which, is the first and the others are copies
of it; texts shorter than ``LENGTH`` bytes are never touched; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.bloom_lm import Filter, _mix, make_segment
from kinfold.llm.common import portions
from kinfold.llm.run_index import RunIndex
from kinfold.sources.scratch import cut_lineage

LENGTH, GRAM = 100, 40
#: Different fragments of one anchor that are compared by an index, and fragments for an index in all.
CAP, TOGETHER = 4096, 6000
#: Bytes of the filter, at most, and keys for each of its segments.
FILTER, SEGMENT = 64 << 20, 2_000_000
#: Characters that are cut into fragments at once, so that the arrays stay in the processor's caches.
AT_ONCE = 400_000
#: Bytes of one text that are looked at together.
STRETCH = 4_000_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SECOND = 0x5DEECE66D
_KEY = ["_null", "_id", "_dg", "_dh"]
_SAME = ["h", "off", "n", "x"]


class _Powers:
    """Powers of the base of the rolling hash and of its inverse, made once for a length."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    @staticmethod
    def _of(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[:1] = 1
        return np.cumprod(factors)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (self._of(base, n) for base in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` neighbours, from each place on, by doubling."""
    n, have = len(keys), 1
    out = keys
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: n - width + 1], out[width - have : width - have + n - width + 1])


def _scattered(h: np.ndarray) -> np.ndarray:
    """Rolling hashes in an order of their own; equal ones stay equal."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    return h


class Fragments:
    """The fragments of some texts: anchor hash, text, place of the first string, number of strings."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        units = [
            (i, a, t[a : a + STRETCH + length - 1])
            for i, t in enumerate(texts)
            for a in range(0, max(1, len(t) - length + 1), STRETCH)
            if len(t) - a >= length
        ]
        self.data = b"".join(u[2] for u in units)
        n = len(self.data)
        self.hash = self.text = self.start = self.count = self.offset = self.at = np.zeros(0, np.int64)
        if not units:
            return
        b = np.frombuffer(self.data, np.uint8).astype(np.uint64) + _U(1)
        up, down = _powers(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(b * up, dtype=np.uint64)])
        hashes = _scattered((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        # The upper half of a hash decides, of equal ones the first: the same in equal strings, wherever they stand.
        keys = (hashes & _U(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_smallest(keys, length - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
        sizes = np.array([len(u[2]) for u in units])
        first = np.cumsum(sizes) - sizes
        stop = first + sizes - length + 1  # strings that start here would leave their unit
        cuts = np.unique(np.concatenate([np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, first, stop]))
        of = np.searchsorted(first, cuts, side="right") - 1
        inside = cuts < stop[of]
        self.at = cuts[inside]
        self.count = np.diff(np.append(cuts, len(anchor)))[inside]
        of = of[inside]
        a = anchor[self.at]
        self.offset = a - self.at
        self.hash = hashes[a].view(np.int64)
        self.text = np.array([u[0] for u in units])[of]
        self.start = self.at - first[of] + np.array([u[1] for u in units])[of]
        self.length = length

    def bytes_of(self, some: np.ndarray) -> list[bytes]:
        ends = self.at[some] + self.count[some] + self.length - 1
        return [self.data[x:y] for x, y in zip(self.at[some].tolist(), ends.tolist(), strict=True)]


def _keyed(docs: DataFrame, id_column: str) -> DataFrame:
    """Rows with what tells them apart where ids do not: 128 bits of the text, from two seeds."""
    return docs.select(
        F.col(id_column).isNull().alias("_null"), F.col(id_column).alias("_id"),
        F.xxhash64("text").alias("_dg"), F.xxhash64(F.lit(_SECOND), "text").alias("_dh"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def repeated_anchors(keyed: DataFrame) -> DataFrame:
    """``h`` of the anchors met twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Fragments([t.encode() for t in texts]).hash for _, texts in portions(batch.column(0), AT_ONCE)]
            h, n = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(n, pa.int64())], names=["h", "n"])

    return (
        keyed.select("text").mapInArrow(run, "h bigint, n bigint")
        .groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    )


def _place_key(h: np.ndarray, dg: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One number for an anchor and the place of its fragment; equal ones cost time only."""
    place = dg.astype(np.int64).view(np.uint64) * _U(_BASE) + start.astype(np.int64).view(np.uint64)
    return _mix(_mix(place) ^ h.view(np.uint64))


def _text_key(dg: np.ndarray) -> np.ndarray:
    """One number for a text, in the same filter."""
    return _mix(dg.astype(np.int64).view(np.uint64) ^ _U(_BASE))


def _filter(keys: DataFrame):
    """A broadcast filter of the column ``key``; ``FILTER`` bytes at most, whatever the number of rows."""
    n = min(1 + keys.count() // SEGMENT, FILTER // 4096)
    most = FILTER // n

    def build(group: pa.Table) -> pa.Table:
        held = group["key"].to_numpy().view(np.uint64)
        return pa.table({
            "segment": pa.array([int(held[0] % _U(n))], pa.int32()),
            "bits": pa.array([make_segment(held, np.ones(len(held), np.int64), most)], pa.binary()),
        })

    # The remainder of the number read as unsigned.
    unsigned = F.pmod(F.pmod(F.col("key"), F.lit(n)) + F.when(F.col("key") < 0, F.lit((1 << 64) % n)).otherwise(0), F.lit(n))
    rows = (
        keys.withColumn("segment", unsigned.cast("int")).select("segment", "key")
        .groupBy("segment").applyInArrow(build, "segment int, bits binary").collect()
    )
    held = Filter(n, {r.segment: bytes(r.bits) for r in rows})
    return keys.sparkSession.sparkContext.broadcast(held)


def _passing(keyed: DataFrame, held, with_text: bool) -> DataFrame:
    """Fragments that pass the filter, each where it occurs: by anchor, or, with their text, by anchor and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if with_text:  # texts without a wanted fragment are not cut
                batch = batch.filter(pa.array(held.value.counts(_text_key(batch.column(2).to_numpy())) > 0))
            dg = batch.column(2).to_numpy()
            for a, texts in portions(batch.column(4), AT_ONCE):
                f = Fragments([t.encode() for t in texts])
                if not len(f.hash):
                    continue
                owner = f.text + a
                key = _place_key(f.hash, dg[owner], f.start) if with_text else f.hash.view(np.uint64)
                some = np.flatnonzero(held.value.counts(key) > 0)
                data = f.bytes_of(some)
                if with_text:
                    last = pa.array(data, pa.binary())
                else:
                    last = pa.array([xxhash.xxh64_intdigest(d) for d in data], pa.uint64()).view(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).take(pa.array(owner[some])) for k in range(4)),
                        pa.array(f.start[some], pa.int64()), pa.array(f.hash[some], pa.int64()),
                        pa.array(f.offset[some], pa.int16()), pa.array(f.count[some], pa.int16()), last,
                    ],
                    names=[*_KEY, "start", "h", "off", "n", name],
                )

    name, type_ = ("frag", "binary") if with_text else ("x", "bigint")
    kind = keyed.schema["_id"].dataType.simpleString()
    found = keyed.select(*_KEY, "text").mapInArrow(
        run, f"_null boolean, _id {kind}, _dg bigint, _dh bigint, start bigint, h bigint, off smallint, n smallint, {name} {type_}"
    )
    return found.select(F.struct(*_KEY, "start").alias("at"), "h", "off", "n", name)


def _sharing(fragments: list[bytes], length: int) -> np.ndarray:
    """Which fragments have a string whose hash is met twice; the others cannot match any."""
    sizes = np.array(list(map(len, fragments)))
    data = np.frombuffer(b"".join(fragments), np.uint8).astype(np.uint64) + _U(1)
    up, down = _powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up, dtype=np.uint64)])
    hashes = (sums[length:] - sums[:-length]) * down[: len(data) - length + 1]
    strings = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), strings)
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(strings.sum())) - np.repeat(np.cumsum(strings) - strings, strings) + first[owner]
    mine = hashes[at]
    order = np.argsort(mine)
    ordered = mine[order]
    same = ordered[1:] == ordered[:-1]
    met = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    out = np.zeros(len(sizes), bool)
    out[owner[order[met]]] = True
    return out


def _compared(group: pa.Table, length: int = LENGTH) -> pa.Table:
    """The strings of different fragments that occur in an earlier one, as marked bytes."""
    group = group.filter(pa.array(_sharing(group["frag"].to_pylist(), length)))
    rank = group["rank"].to_numpy() - 1
    most = group["m"].to_numpy()
    texts = [np.frombuffer(f, np.uint8).astype(np.int64) for f in group["frag"].to_pylist()]
    repeated = [np.zeros(len(t) - length + 1, bool) for t in texts]
    level = 0
    while (1 << level) < most.max(initial=0):
        block = rank >> (level + 1)
        later = rank >> level & 1 == 1
        ask = np.flatnonzero(later)
        held = np.flatnonzero(~later & (((2 * block + 1) << level) < most))
        level += 1
        if not len(ask) or not len(held):
            continue
        # Only fragments that agree in the higher bits may match, so these are part of the symbols.
        index = RunIndex([texts[i] + (int(block[i]) << 8) for i in held])
        found = index.matching_statistics([texts[i] + (int(block[i]) << 8) for i in ask])
        for k, i in enumerate(ask.tolist()):
            repeated[i] |= found[k, : len(repeated[i])] >= length
    rows, starts, ends = [], [], []
    for i, r in enumerate(repeated):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], r.view(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            rows.append(i)
            starts.append(a)
            ends.append(b + length - 1)
    at = group["at"].combine_chunks().take(pa.array(rows, pa.int64()))
    return pa.table({"at": at, "a": pa.array(starts, pa.int64()), "b": pa.array(ends, pa.int64())})


def marks(docs: DataFrame, id_column: str = "doc_id", cap: int = CAP) -> DataFrame:
    """``(_null, _id, _dg, _dh, spans)``: for each text with repeated strings the bytes they cover; spans may
    overlap. Of rows equal in id and text nothing is said about which is the copy."""
    keyed = _keyed(docs, id_column)
    anchors = cut_lineage(repeated_anchors(keyed), "anchors")
    rows = cut_lineage(_passing(keyed, _filter(anchors.select(F.col("h").alias("key"))), False), "fragments")
    distinct = cut_lineage(
        rows.groupBy(*_SAME).agg(F.min("at").alias("at"), F.count("*").alias("times")), "distinct"
    )

    copies = distinct.where("times > 1").select(*_SAME, F.col("at").alias("first"))
    whole = (
        rows.join(copies, _SAME)
        .where(F.col("at") != F.col("first"))
        .select("at", F.lit(0).cast("bigint").alias("a"), (F.col("n") + F.lit(LENGTH - 1)).cast("bigint").alias("b"))
    )

    sizes = distinct.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    several = cut_lineage(distinct.join(sizes, "h").select("h", "off", "n", "at", "m"), "several")

    def place_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, dg, start = (batch.column(k).to_numpy() for k in range(3))
            key = np.concatenate([_place_key(h, dg, start), _text_key(np.unique(dg))]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    keys = several.select("h", "at._dg", "at.start").mapInArrow(place_keys, "key bigint")
    texts = _passing(keyed, _filter(cut_lineage(keys, "places")), True)
    # A row that stands twice in the table gives its fragments twice.
    ranked = several.join(texts, ["h", "off", "n", "at"]).dropDuplicates(["h", "off", "n", "at"])
    ranked = cut_lineage(ranked, "different")
    few, many = ranked.where(F.col("m") <= cap), ranked.where(F.col("m") > cap)
    buckets = 1 + few.count() // TOGETHER
    spread = few.withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("at", "off", "n"))).withColumn(
        "bucket", F.pmod("h", F.lit(buckets))
    )
    at_type = rows.schema["at"].dataType.simpleString()
    parts = spread.select("bucket", "at", "frag", "m", "rank").groupBy("bucket").applyInArrow(
        lambda t: _compared(t), f"at {at_type}, a bigint, b bigint"
    )

    strings = many.select(
        "at", F.explode(F.transform(
            F.sequence(F.lit(0), F.length("frag") - LENGTH),
            lambda i: F.struct(i.cast("bigint").alias("i"), F.md5(F.substring(F.col("frag"), i + 1, F.lit(LENGTH))).alias("d")),
        )).alias("s"),
    ).select(
        "at", "s.i", "s.d",
        F.struct(F.col("at._null"), F.col("at._id"), F.col("at._dg"), F.col("at._dh"), (F.col("at.start") + F.col("s.i")).alias("start")).alias("own"),
    )
    earliest = strings.groupBy("d").agg(F.min("own").alias("first"))
    single = (
        strings.join(earliest, "d").where(F.col("own") != F.col("first"))
        .select("at", F.col("i").alias("a"), (F.col("i") + LENGTH).alias("b"))
    )
    every = whole.unionByName(parts).unionByName(single)
    return every.groupBy(*[F.col(f"at.{k}").alias(k) for k in _KEY]).agg(
        F.collect_list(F.struct((F.col("at.start") + F.col("a")).alias("a"), (F.col("at.start") + F.col("b")).alias("b"))).alias("spans")
    )


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["a"], s["b"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def _result(ids: pa.Array, texts: list[bytes], runs: list[list[tuple[int, int]]], id_column: str) -> pa.RecordBatch:
    digests = []
    for data, gone in zip(texts, runs, strict=True):
        kept, at = [], 0
        for a, b in gone:
            kept.append(data[at:a])
            at = b
        digests.append(hashlib.sha256(b"".join([*kept, data[at:]])).hexdigest())
    return pa.RecordBatch.from_arrays(
        [
            ids, pa.array(list(map(len, texts)), pa.int64()),
            pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()), pa.array(list(map(len, runs)), pa.int64()),
            pa.array(digests, pa.string()), pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], _SPANS),
        ],
        names=[id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
    )


def without_repeats(docs: DataFrame, id_column: str = "doc_id", cap: int = CAP) -> DataFrame:
    """Every document with n_bytes, n_removed, n_spans, kept_sha256 and ``spans``, the maximal removed
    runs of bytes.

    A filter of the texts with spans, of bounded size, lets the others be finished where they are read.
    """
    keyed = _keyed(docs, id_column)
    found = cut_lineage(marks(docs, id_column, cap), "marks")
    twice = keyed.groupBy(*_KEY).count().where("count > 1").select(*_KEY)
    digest = F.xxhash64("_null", F.coalesce(F.col("_id").cast("string"), F.lit("")), "_dg", "_dh")
    concerned = found.select(*_KEY).unionByName(twice).select(digest.alias("key")).distinct()
    held = _filter(cut_lineage(concerned, "concerned"))
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<start:bigint,end:bigint>>"
    )

    def asked(batch: pa.RecordBatch) -> np.ndarray:
        return held.value.counts(batch.column(0).to_numpy().view(np.uint64)) > 0

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(~asked(batch)))
            for a, texts in portions(rest.column(2)):
                ids = rest.column(1).slice(a, len(texts))
                yield _result(ids, [t.encode() for t in texts], [[]] * len(texts), id_column)

    def concerning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(asked(batch)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in portions(batch.column(1)):
                some = batch.slice(a, len(texts))
                data = [t.encode() for t in texts]
                runs = [
                    [(0, len(t))] if copy > 1 and len(t) >= LENGTH else _merged(spans or [])
                    for t, copy, spans in zip(data, some.column(2).to_pylist(), some.column(3).to_pylist(), strict=True)
                ]
                yield _result(some.column(0), data, runs, id_column)

    rows = keyed.withColumn("key", digest)
    untouched = rows.select("key", "_id", "text").mapInArrow(plain, schema)
    # Keys without NULL, so that the copies are numbered and the join is made on one partitioning.
    same = ["_null", "_same", "_dg", "_dh"]
    named = F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_same")
    texts = rows.select("key", "_id", "text", "_null", named, "_dg", "_dh")
    texts = texts.mapInArrow(concerning, texts.schema)
    numbered = texts.withColumn("_copy", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))
    joined = numbered.join(found.select("_null", named, "_dg", "_dh", "spans"), same, "left")
    return untouched.unionByName(joined.select("_id", "text", "_copy", "spans").mapInArrow(cut, schema))


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
