"""Language-model scores from n-gram counts held in a log-frequency Bloom filter.

Training counts words and pairs of neighbouring words. A count c is kept as its level
``1 + floor(log2 c)``: the filter holds the events (n-gram, 1) ... (n-gram, level). To read a count,
the events of an n-gram are probed in turn until one is missing. The probability of a word after
another is its pair count, smoothed with ``PRIOR`` counts spread as the single words are.

The filter is made in segments, each by a task of its own from the counts under some of the hashes.
Segments are broadcast, at most ``MAX_BYTES`` together; a larger filter is used in several passes over
the texts, each holding some segments of single words and of pairs. A token is scored in exactly one
pass, the one that holds all it asks for, and the passes add up, so the bound changes the time only.

The base score needs exact counts. Words with at least 1 / ``FREQUENT`` of all tokens are at most
``FREQUENT``, so these are broadcast; the others, each with few rows, are joined.

Defined results: a NULL or empty text is the end token alone; equal rows each get a row and each count;
a NULL id counts as the empty text when training rows are chosen; without training rows every count is
zero; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import fold, portions, small_batches
from kinfold.sources.scratch import cut_lineage

FOLDS, HELD_OUT = 7, 2
FREQUENT = 1_000_000
MAX_BYTES = 384 << 20
PRIOR = 200.0
#: Bits of the filter for each event, and probes for each.
BITS, PROBES = 8, 4
#: Keys a segment is made for, about.
SEGMENT = 2_000_000
#: Tokens whose pairs are added up together.
TOGETHER = 5_000_000
#: Characters of text that are taken apart together.
PORTION = 2_000_000
END, START = b" ", b"  "  # no word has a space

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hash(words: Sequence[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


class Tokens:
    """The tokens of some texts in a row; each text ends with ``END``."""

    def __init__(self, texts: Sequence[str | None]):
        flat: list[bytes] = []
        sizes = []
        for t in texts:
            words = t.encode().lower().split() if t else []
            flat += words
            sizes.append(len(words))
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        self.words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())])
        at = np.cumsum(sizes, dtype=np.int64)
        self.ids = np.insert(coded.indices.to_numpy(), at, len(self.words) - 1)
        self.sizes = np.array(sizes, np.int64) + 1
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids, minlength=len(self.words))

    def hashes(self) -> np.ndarray:
        """The hashes of the distinct words and, behind them, of the start of a text."""
        return _hash([*self.words.to_pylist(), START])

    def before(self) -> np.ndarray:
        """For each token the number of the word before it."""
        ids = np.roll(self.ids, 1)
        ids[self.starts] = len(self.words)
        return ids

    def pairs(self, hashes: np.ndarray) -> np.ndarray:
        """For each token the key of itself and the word before it."""
        return _mix(hashes[self.before()] * _U(0x9E3779B97F4A7C15) + hashes[self.ids])

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(self.starts) else np.zeros(0)


def _levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log2(counts).astype(np.int64)


#: The count a level stands for: the middle, on a log scale, of the counts it holds.
_COUNT_OF = np.concatenate([[0.0], [np.sqrt(2.0 ** (q - 1) * max(1, 2.0**q - 1)) for q in range(1, 64)]])


def _event(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place of (key, level), not yet reduced to a segment, and the step to the next."""
    first = _mix(keys + _U(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    return first, _mix(first) | _U(1)


def make_segment(keys: np.ndarray, counts: np.ndarray, most: int | None = None) -> bytes:
    """The bits of a segment that holds the counts of some distinct keys, in ``most`` bytes at most."""
    levels = _levels_of(counts)
    n_bits = -(-int(levels.sum()) * BITS // 64) * 64
    if most is not None:
        n_bits = min(n_bits, max(64, most * 8))
    bits = np.zeros(n_bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        first, step = _event(keys[levels >= level], level)
        for i in range(PROBES):
            bits[((first + _U(i) * step) % _U(n_bits)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Some segments of a filter of ``n`` in all; a key belongs to segment ``key % n``."""

    def __init__(self, n: int, segments: dict[int, bytes]):
        self.n = n
        self.sizes = np.zeros(n, np.uint64)
        self.offsets = np.zeros(n, np.uint64)
        at = 0
        for s, data in segments.items():
            self.sizes[s], self.offsets[s] = len(data) * 8, at * 8
            at += len(data)
        self.bits = np.frombuffer(b"".join(segments.values()), np.uint8)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of keys whose segments are held, read level by level."""
        levels = np.zeros(len(keys), np.int64)
        segment = (keys % _U(self.n)).astype(np.int64)
        alive = np.flatnonzero(self.sizes[segment])
        level = 0
        while len(alive):
            level += 1
            size, offset = self.sizes[segment[alive]], self.offsets[segment[alive]]
            first, step = _event(keys[alive], level)
            passed = np.arange(len(alive))
            for i in range(PROBES):
                place = (first[passed] + _U(i) * step[passed]) % size[passed] + offset[passed]
                hit = self.bits[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8) & 1
                passed = passed[hit == 1]
            alive = alive[passed]
            levels[alive] = level
        return _COUNT_OF[levels]


class Vocabulary:
    """Words with their counts, looked up by hash and then compared."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        keys = _hash(words)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.int64)
        self.words = pa.array(words, pa.binary()).take(pa.array(order))

    def __call__(self, words: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are here, and their counts, zero for the others."""
        if not len(self.keys):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        here = pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False)
        return here, np.where(here, self.counts[at], 0)


def word_counts(train: DataFrame) -> DataFrame:
    """``(word, n)`` of all tokens; the end is the word ``END``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in portions(batch.column(0), PORTION):
                tokens = Tokens(texts)
                yield pa.RecordBatch.from_arrays(
                    [tokens.words, pa.array(tokens.counts())], names=["word", "n"]
                )

    return (
        train.select("text").mapInArrow(run, "word binary, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
    )


def word_segments(counts: DataFrame, n: int) -> DataFrame:
    """``(segment, bits)`` of single words, and of the start of a text with the number of texts."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, number = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            keys = _hash(words)
            for w, c in zip(words, number.tolist(), strict=True):
                if w == END:
                    keys = np.append(keys, _hash([START]))
                    number = np.append(number, c)
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys % _U(n)).astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(number)],
                names=["segment", "key", "n"],
            )

    def build(group: pa.Table) -> pa.Table:
        keys = group["key"].to_numpy().view(np.uint64)
        return _segment_row(group["segment"][0].as_py(), keys, group["n"].to_numpy())

    return (
        counts.select("word", "n").mapInArrow(keyed, "segment int, key bigint, n bigint")
        .groupBy("segment").applyInArrow(build, "segment int, bits binary")
    )


def _segment_row(segment: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    return pa.table({
        "segment": pa.array([segment], pa.int32()),
        "bits": pa.array([make_segment(keys, counts)], pa.binary()),
    })


def _together(parts: list[np.ndarray]) -> np.ndarray:
    """The parts in one array; each is let go when it is copied, and the list is empty then."""
    out = np.empty(sum(map(len, parts)), np.uint64)
    at = len(out)
    while parts:
        part = parts.pop()
        at -= len(part)
        out[at : at + len(part)] = part
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and where each begins in ``keys``, which is sorted in place."""
    keys.sort()
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return keys[first], first


def _counted_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs and their counts, about ``TOGETHER`` tokens at a time."""

    def counted() -> tuple[np.ndarray, np.ndarray]:
        pairs = _together(found)
        keys, first = _distinct(pairs)
        return keys, np.diff(first, append=len(pairs)).astype(np.uint32)

    found: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for _, texts in portions(batch.column(0), PORTION):
            tokens = Tokens(texts)
            found.append(tokens.pairs(tokens.hashes()))
            size += len(found[-1])
            if size >= TOGETHER:
                yield counted()
                size = 0
    if found:
        yield counted()


def pair_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """``(segment, keys, counts)`` of the pairs of some texts: a row has all keys of a segment, each once."""
    for keys, number in _counted_pairs(batches):
        segment = (keys % _U(n)).astype(np.int32)
        order = np.argsort(segment, kind="stable")
        keys, number, segment = keys[order], number[order], segment[order]
        del order
        held, start = np.unique(segment, return_index=True)
        cuts = np.append(start, len(keys))
        packed = pa.array([_packed(number[x:y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.binary())
        # The keys stay where they are; a row is a part of them.
        ends = [None, pa.py_buffer((cuts * 8).astype(np.int32)), pa.py_buffer(keys)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.Array.from_buffers(pa.binary(), len(held), ends), packed], names=["segment", "keys", "counts"]
        )
        del keys, number, segment, packed, ends


def pair_segment(group: pa.Table) -> pa.Table:
    """One segment of the rows of ``pair_rows``. Counts are added up row by row, to the distinct keys of all."""
    parts = [np.frombuffer(k.as_buffer(), np.uint64) for k in group["keys"]]
    keys = _distinct(_together(list(parts)))[0]
    counts = np.zeros(len(keys), np.int64)
    for part, packed in zip(parts, group["counts"], strict=True):
        counts[np.searchsorted(keys, part)] += _unpacked(packed.as_buffer())
    return _segment_row(group["segment"][0].as_py(), keys, counts)


def pair_segments(train: DataFrame, n: int) -> DataFrame:
    """``(segment, bits)`` of pairs. Each task adds its pairs up and sends, for each segment, one row
    with all keys and counts, so few rows are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pair_rows(batches, n)

    return (
        train.select("text").mapInArrow(count, "segment int, keys binary, counts binary")
        .groupBy("segment").applyInArrow(pair_segment, "segment int, bits binary")
    )


def _packed(counts: np.ndarray) -> bytes:
    """Counts in one byte each where all fit, else in four; the first byte tells."""
    small = int(counts.max(initial=0)) < 256
    return (b"\1" + counts.astype(np.uint8).tobytes()) if small else (b"\4" + counts.tobytes())


def _unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    small = data[0] in (1, b"\1")
    return np.frombuffer(data, np.uint8, offset=1) if small else np.frombuffer(memoryview(data)[1:], np.uint32)


def _groups(segments: DataFrame, most: int) -> list[list[int]]:
    """Segment numbers in groups of at most ``most`` bytes; one row for each segment is read."""
    sizes = segments.select("segment", F.length("bits").alias("n")).orderBy("segment").collect()
    groups: list[list[int]] = [[]]
    total = 0
    for r in sizes:
        if groups[-1] and total + r.n > most:
            groups.append([])
            total = 0
        groups[-1].append(r.segment)
        total += r.n
    return groups


def _load(segments: DataFrame, some: Sequence[int]) -> dict[int, bytes]:
    rows = segments.where(F.col("segment").isin(list(some))).collect()
    return {r.segment: bytes(r.bits) for r in rows}


def score(docs: DataFrame, id_column: str = "doc_id", max_bytes: int = MAX_BYTES, prior: float = PRIOR,
          frequent: int = FREQUENT) -> DataFrame:
    """Every document with held_out, n_tokens, n_known, train_tokens, base_score and score."""
    with small_batches(docs.sparkSession):
        return _score(docs, id_column, max_bytes, prior, frequent)


def _score(docs: DataFrame, id_column: str, max_bytes: int, prior: float, frequent: int) -> DataFrame:
    spark = docs.sparkSession
    train = docs.where(fold(id_column, FOLDS) != HELD_OUT)
    counts = cut_lineage(word_counts(train), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = totals.n, totals.v

    n1, n2 = 1 + v // SEGMENT, 1 + n // SEGMENT
    words = cut_lineage(word_segments(counts, n1), "word-segments")
    pairs = cut_lineage(pair_segments(train, n2), "pair-segments")
    groups1, groups2 = _groups(words, max_bytes // 4), _groups(pairs, max_bytes // 2)

    least = max(1, -(-n // frequent))
    common = counts.where(F.col("n") >= least).toArrow().combine_chunks()  # ``frequent`` rows at most
    common = spark.sparkContext.broadcast(Vocabulary(common["word"].to_pylist(), common["n"].to_numpy()))

    rows = docs.select(
        F.monotonically_increasing_id().alias("_n"), F.col(id_column).alias("_id"),
        (fold(id_column, FOLDS) == HELD_OUT).alias("held_out"), "text",
    )
    scores, base = None, None
    for a in groups1:
        for b in groups1:
            for c in groups2:
                held = spark.sparkContext.broadcast(
                    (Filter(n1, _load(words, a + b)), Filter(n2, _load(pairs, c)))
                )
                first = base is None
                part = cut_lineage(_pass(rows, held, (a, b, c), n, v, prior, common if first else None), "scores")
                if first:
                    base = part
                else:
                    scores = part if scores is None else scores.unionByName(part)
    if scores is not None:
        # Rows are told apart by what does not depend on how a pass cuts the table.
        base = _added(base, scores)
    rare = (
        base.select("_n", F.explode("rare").alias("r")).select("_n", "r.word", "r.tf")
        .join(counts, "word", "left")
        .groupBy("_n")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("tf"))).alias("known"),
            F.sum(F.col("tf") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(n + v + 1)))).alias("base"),
        )
    )
    return base.join(rare, "_n", "left").select(
        F.col("_id").alias(id_column), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"), "score",
    )


def _added(base: DataFrame, others: DataFrame) -> DataFrame:
    """``base`` with the scores of the other passes added. A score depends on the text only, so
    it is found again by a digest of the text, however a pass has cut the table."""
    per_text = others.groupBy("digest").agg((F.sum("score") / F.count("*")).alias("mean"), F.count("*").alias("k"))
    copies = base.groupBy("digest").agg(F.count("*").alias("copies"))
    more = per_text.join(copies, "digest").select("digest", (F.col("mean") * F.col("k") / F.col("copies")).alias("more"))
    return base.join(more, "digest").withColumn("score", F.col("score") + F.col("more")).drop("more")


def _pass(rows: DataFrame, held, groups, n: int, v: int, prior: float, common) -> DataFrame:
    """One pass over the texts: scores of the tokens that ask for held segments only and, where the
    frequent words are given, the exact part of the base score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles, doubles = held.value
        mine = [np.zeros(f.n, bool) for f in (singles, singles, doubles)]
        for m, g in zip(mine, groups, strict=True):
            m[g] = True
        for batch in batches:
            for a, texts in portions(batch.column(3), PORTION):
                tokens = Tokens(texts)
                size = len(texts)
                score = np.zeros(len(tokens.ids))
                hashes = tokens.hashes()
                before, pair = tokens.before(), tokens.pairs(hashes)
                home = (hashes % _U(singles.n)).astype(np.int64)
                here = mine[0][home][tokens.ids] & mine[1][home][before]
                here &= mine[2][(pair % _U(doubles.n)).astype(np.int64)]
                at = np.flatnonzero(here)
                count = singles.counts(hashes)  # once for each distinct word
                context = count[before[at]]
                together = np.minimum(doubles.counts(pair[at]), context)
                alone = (count[tokens.ids[at]] + 1) / (n + v + 1)
                score[at] = np.log10((together + prior * alone) / (context + prior))
                known = np.zeros(size, np.int64)
                base = np.zeros(size)
                rare = pa.array([None] * size, pa.list_(_RARE))
                if common is not None:
                    is_common, exact = common.value(tokens.words, hashes[:-1])
                    value = np.where(is_common, np.log10((exact + 1) / (n + v + 1)), 0.0)
                    base = tokens.per_text(value[tokens.ids])
                    known = tokens.per_text(is_common[tokens.ids].astype(np.int64))
                    rare = _rare(tokens, is_common, size)
                keep = [batch.column(k).slice(a, size) for k in range(3)]
                digests = [xxhash.xxh128_digest((t or "").encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *keep, pa.array(digests, pa.binary()), pa.array(tokens.sizes), pa.array(known),
                        pa.array(base), pa.array(tokens.per_text(score)), rare,
                    ],
                    names=["_n", "_id", "held_out", "digest", "n_tokens", "n_known", "base_score", "score", "rare"],
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"_n bigint, _id {kind}, held_out boolean, digest binary, n_tokens bigint, n_known bigint, "
        "base_score double, score double, rare array<struct<word:binary,tf:bigint>>",
    )


_RARE = pa.struct([("word", pa.binary()), ("tf", pa.int64())])


def _rare(tokens: Tokens, is_common: np.ndarray, size: int) -> pa.Array:
    """For each text its words that are not frequent, with the number of times."""
    text_of = np.repeat(np.arange(size), tokens.sizes)
    pick = ~is_common[tokens.ids]
    both = text_of[pick] * len(tokens.words) + tokens.ids[pick]
    both, times = np.unique(both, return_counts=True)
    owner, word = both // len(tokens.words), both % len(tokens.words)
    offsets = np.searchsorted(owner, np.arange(size + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays(
        [tokens.words.take(pa.array(word)), pa.array(times.astype(np.int64))], fields=list(_RARE)
    )
    return pa.ListArray.from_arrays(pa.array(offsets), values)
