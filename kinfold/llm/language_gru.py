"""Language by a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads a word, its letters in lower case between two spaces, as bytes in both directions and
gives every position a distribution over the languages. A text's probabilities are pooled from all
positions of all its words. A word's positions do not depend on its neighbours, so each
different word is read once and counted as often as it occurs; whole texts are used, whatever their length.

Training takes a bounded sample: of ``DOCS`` labelled rows for each language (in order of a hash), ``MOST_DOCS`` at most,
the distinct words, of which ``WORDS`` in all are kept (likewise). A word's target is the share of each
language in its occurrences; the loss at each position is propagated back through time.

Defined results: a NULL text or one without a letter is ``und`` with score 0, and so is every text if
nothing could be learned; ties go to the language first in the alphabet; rows with a NULL language do not
train; a NULL id counts as the empty text when training rows are chosen; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import filter_texts, fold, map_texts

FOLDS, HELD_OUT = 4, 2
DOCS, WORDS = 300, 30_000
#: Rows of the sample in all languages together.
MOST_DOCS = 30_000
HIDDEN = 12
#: Bytes of a word that are read together; a longer one is cut.
PIECE = 24
UNKNOWN = "und"
#: Words a worker remembers; beyond this many it starts anew.
REMEMBERED = 200_000
_LETTER = regex.compile(r"\p{L}")
# ASCII letters in lower case and bytes of other letters stay, all else parts words.
_TABLE = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def pieces(word: bytes) -> list[bytes]:
    cut = [word[i : i + PIECE] for i in range(0, len(word), PIECE)]
    return [b" " + c + b" " for c in cut]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Direction:
    """A gated recurrent layer; ``w`` has a row of gate inputs for each byte, ``u`` the recurrence."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.w = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.u = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)

    def forward(self, x: np.ndarray, steps: list | None = None) -> np.ndarray:
        """States after each of the bytes ``x`` (time, batch); ``steps`` keeps what backward needs."""
        k = self.hidden
        h = np.zeros((x.shape[1], k), np.float32)
        out = np.empty((*x.shape, k), np.float32)
        inputs = self.w[x]
        for t in range(len(x)):
            a, b = inputs[t], h @ self.u
            gates = _sigmoid(a[:, : 2 * k] + b[:, : 2 * k])
            z, r = gates[:, :k], gates[:, k:]
            n = np.tanh(a[:, 2 * k :] + r * b[:, 2 * k :])
            new = n + z * (h - n)
            if steps is not None:
                steps.append((h, z, r, n, b[:, 2 * k :]))
            out[t] = h = new
        return out

    def backward(self, x: np.ndarray, steps: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``w`` and ``u`` from those of the states."""
        k = self.hidden
        into = np.empty((*x.shape, 3 * k), np.float32)
        du = np.zeros_like(self.u)
        dh = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, un = steps[t]
            dh = dh + grad[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            into[t] = np.concatenate([dz, dr, dn], axis=1)
            through = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ through
            dh = dh * z + through @ self.u.T
        dw = np.zeros_like(self.w)
        np.add.at(dw, x.reshape(-1), into.reshape(-1, 3 * k))
        return dw, du


class ByteTagger:
    """Two directions and a softmax over the languages at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Direction(rng, hidden), Direction(rng, hidden)
        self.v = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.c = np.zeros(len(languages), np.float32)

    def _logits(self, x: np.ndarray, a=None, b=None) -> tuple[np.ndarray, np.ndarray]:
        both = np.concatenate([self.ahead.forward(x, a), self.back.forward(x[::-1], b)[::-1]], axis=2)
        return both, both @ self.v + self.c

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """For each word the mean over its positions of the log-probabilities of the languages."""
        total = np.zeros((len(words), len(self.languages)), np.float32)
        length = np.zeros(len(words), np.float32)
        by_length: dict[int, tuple[list[int], list[bytes]]] = {}
        for i, w in enumerate(words):
            for p in pieces(w):
                where, what = by_length.setdefault(len(p), ([], []))
                where.append(i)
                what.append(p)
        for n, (where, what) in by_length.items():
            for s in range(0, len(what), 8192):
                some = what[s : s + 8192]
                x = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), n).T
                logits = self._logits(x)[1]
                logits -= logits.max(axis=2, keepdims=True)
                logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
                at = np.array(where[s : s + 8192])
                np.add.at(total, at, logits.sum(axis=0))
                np.add.at(length, at, n)
        return total / np.maximum(length, 1)[:, None]

    def train(self, words: list[bytes], targets: np.ndarray, weights: np.ndarray, epochs: int = 6,
              batch: int = 256, rate: float = 0.01, seed: int = 2) -> None:
        """Adam over batches of words of one length; ``targets`` are shares of the languages."""
        rng = np.random.default_rng(seed)
        short = [w[:PIECE] for w in words]
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(short):
            groups.setdefault(len(w), []).append(i)
        batches = [np.array(g[i : i + batch]) for g in groups.values() for i in range(0, len(g), batch)]
        parameters = [self.ahead.w, self.ahead.u, self.back.w, self.back.u, self.v, self.c]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
        scale = weights / weights.mean()
        step, total = 0, epochs * len(batches)
        for _ in range(epochs):
            for b in rng.permutation(len(batches)):
                some = batches[b]
                x = np.frombuffer(
                    b"".join(b" " + short[i] + b" " for i in some), np.uint8
                ).reshape(len(some), -1).T
                gradients = self._gradients(x, targets[some], scale[some])
                step += 1
                now = rate * (1 - step / (total + 1))
                for p, g, (m, s) in zip(parameters, gradients, moments, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        a: list = []
        b: list = []
        both, logits = self._logits(x, a, b)
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        d = (e / e.sum(axis=2, keepdims=True) - target[None]) * (weight / (x.size))[None, :, None]
        d = d.astype(np.float32)
        k = self.ahead.hidden
        dv = both.reshape(-1, 2 * k).T @ d.reshape(-1, d.shape[2])
        dh = d @ self.v.T
        aw, au = self.ahead.backward(x, a, dh[..., :k])
        bw, bu = self.back.backward(x[::-1], b, dh[::-1, :, k:])
        return [aw, au, bw, bu, dv, d.sum(axis=(0, 1))]


def sample(docs: DataFrame, id_column: str, n_docs: int = DOCS, n_words: int = WORDS) -> DataFrame:
    """``(word, lang, n)`` from a bounded sample of the training rows; at most ``n_words`` words."""
    train = docs.where((fold(id_column, FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Rows are chosen by hashes, so that no text is shuffled for it.
    named = train.select("lang", "text", F.xxhash64(id_column).alias("_h"), F.xxhash64("text").alias("_t"))
    turn = Window.partitionBy("lang").orderBy("_h", "_t")
    chosen = (
        named.select("lang", "_h", "_t").withColumn("_k", F.row_number().over(turn)).where(F.col("_k") <= n_docs)
        .orderBy("_k", "_h", "_t", "lang").limit(MOST_DOCS)
        .select("lang", "_h", "_t").distinct()
    )
    some = named.join(F.broadcast(chosen), ["lang", "_h", "_t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words, n = np.unique(np.array(words_of(text), object), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.tolist(), pa.binary()), pa.array([lang] * len(words), pa.string()), pa.array(n)],
                    names=["word", "lang", "n"],
                )

    per_word = (
        some.select("lang", "text").mapInArrow(run, "word binary, lang string, n bigint")
        .groupBy("word", "lang").agg(F.sum("n").alias("n"))
        .groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("langs"))
    )
    return per_word.orderBy(F.xxhash64("word"), "word").limit(n_words)


def learn(docs: DataFrame, id_column: str = "doc_id", **limits: int) -> ByteTagger | None:
    """The network fitted to the sample, which is the only thing collected."""
    rows = sample(docs, id_column, **limits).collect()
    if not rows:
        return None
    languages = sorted({l.lang for r in rows for l in r.langs})
    index = {l: i for i, l in enumerate(languages)}
    counts = np.zeros((len(rows), len(languages)), np.float32)
    for i, r in enumerate(rows):
        for l in r.langs:
            counts[i, index[l.lang]] += l.n
    # Each language weighs the same, however many rows it has.
    counts /= np.maximum(counts.sum(axis=0), 1)
    share = counts / counts.sum(axis=1, keepdims=True)
    tagger = ByteTagger(languages)
    tagger.train([bytes(r.word) for r in rows], share, np.sqrt(counts.sum(axis=1)))
    return tagger


class TextJudge:
    """Pools the positions of whole texts; remembers the words it has read."""

    def __init__(self, tagger: ByteTagger | None):
        self.tagger = tagger
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((0, len(tagger.languages) if tagger else 0), np.float32)

    def _rows(self, distinct: list[bytes]) -> np.ndarray:
        """The place of each word in ``table``; words not met before are read by the network."""
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known = {}
            self.table = self.table[:0]
        new = [w for w in distinct if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.tagger.log_probabilities(new)])
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if self.tagger is None:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        flat: list[bytes] = []
        sizes = []
        for t in texts:
            words = words_of(t) if _LETTER.search(t) else []
            flat += words
            sizes.append(len(words))
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        rows = self._rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if flat else np.zeros(0, np.int64)
        n = np.array(sizes)
        ends = np.cumsum(n)
        names, scores = [], np.zeros(len(texts))
        for i, (a, b) in enumerate(zip((ends - n).tolist(), ends.tolist(), strict=True)):
            if a == b:
                names.append(UNKNOWN)
                continue
            p = pool(self.table[rows[a:b]])
            best = int(p.argmax())
            names.append(self.tagger.languages[best])
            scores[i] = min(1.0, float(p[best]))
        return names, scores


def pool(log_probabilities: np.ndarray) -> np.ndarray:
    """A text's distribution: the mean of its words' distributions, each position counting in its
    word's, so that a passage in another language counts by its length."""
    p = np.exp(log_probabilities.astype(np.float64))
    p /= p.sum(axis=1, keepdims=True)
    return p.mean(axis=0)


def identify(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` for every document."""
    tagger = docs.sparkSession.sparkContext.broadcast(learn(docs, id_column))  # a few kilobytes

    def make() -> Callable:
        return TextJudge(tagger.value)

    held_out = (fold(id_column, FOLDS) == HELD_OUT).alias("held_out")
    return map_texts(docs, [id_column, held_out], ["lang_pred string", "score double"], make)


def known_language(docs: DataFrame, id_column: str = "doc_id", min_score: float = 0.0, times_chance: float = 0.0) -> DataFrame:
    """The rows whose language is recognised with at least ``min_score``, and ``times_chance`` times the score
    of a guess among the languages learned. A single language is never in doubt."""
    learned = learn(docs, id_column)
    n = len(learned.languages) if learned else 0
    bound = max(min_score, times_chance / n if n > 1 else 0.0)
    tagger = docs.sparkSession.sparkContext.broadcast(learned)

    def make() -> Callable:
        judge = TextJudge(tagger.value)

        def passes(texts: list[str]) -> list[bool]:
            names, scores = judge(texts)
            return [n != UNKNOWN and s >= bound for n, s in zip(names, scores, strict=True)]

        return passes

    return filter_texts(docs, make)
