"""Toxic spans and document scores by a linear-chain conditional random field, in numpy.

A text's words (runs of letters) are tagged clean or toxic. The field has a weight for each word, its
beginnings and its endings (hashed into ``WEIGHTS`` places) and for each pair of neighbouring tags.
Forward and backward recursions run over stretches of ``STRETCH`` words, many stretches at a
time, and give every word its marginal probability of being toxic. A document's score is a
logistic function of how many toxic words are expected in it, how sure the surest is, and its length.

Labels are given for documents only. Words of toxic training documents are labelled toxic if they
have a feature that toxic documents have far more often than clean ones (a likelihood-ratio
test); all others are clean. The field is then fitted to these labelled words. The logistic function is
fitted on documents whose words the field, as fitted for that purpose, has not seen.

Training takes a bounded sample: of each label ``TOXIC`` and ``CLEAN`` rows, in order of a hash, with texts
of at most ``LONGEST`` characters. Scoring covers every whole text.

Defined results: a NULL or empty text, or one without a word, gets the score of a document in which
no toxic word is expected; without labels of both kinds every score is 0; rows with a NULL label do
not train; of several labels of one id the highest counts; equal rows each get a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import fold, map_texts

FOLDS, HELD_OUT = 4, 2
TOXIC, CLEAN, LONGEST = 1000, 2000, 60_000
THRESHOLD = 0.3
STRETCH = 32
WEIGHTS = 1 << 20
BEGINNINGS, ENDINGS = range(3, 11), range(3, 7)
#: A feature marks toxic documents if its likelihood ratio is at least the first, and documents of the
#: toxic kind have it at least so many times as often as others.
RATIO_TEST, TIMES = 20.0, 4.0
_WIDTH = 32
_LETTERS = bytes(b if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))
_FIND = regex.compile(r"[A-Za-z\x80-\U0010ffff]+")
_U = np.uint64


def features(words: Sequence[bytes]) -> np.ndarray:
    """For each word (in lower case) the places of its features; a missing feature has place 0."""
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ahead = np.frombuffer(b"".join([w[:_WIDTH].ljust(_WIDTH) for w in words]), np.uint8).reshape(n, _WIDTH)
    back = np.frombuffer(b"".join([w[::-1][:_WIDTH].ljust(_WIDTH) for w in words]), np.uint8).reshape(n, _WIDTH)
    out = np.zeros((n, 1 + len(BEGINNINGS) + len(ENDINGS)), np.int64)

    def place(h: np.ndarray, kind: int) -> np.ndarray:
        h = (h + _U(kind)) * _U(0x9E3779B97F4A7C15)
        return (1 + (h >> _U(33)) % _U(WEIGHTS - 1)).astype(np.int64)

    column = 0
    for matrix, lengths, first in ((ahead, BEGINNINGS, 0), (back, ENDINGS, 64)):
        h = np.full(n, 7, np.uint64)
        for k in range(_WIDTH):
            h = (h ^ matrix[:, k]) * _U(0x100000001B3)
            if k + 1 in lengths:
                out[:, column] = np.where(sizes > k, place(h, first + k + 1), 0)
                column += 1
        if first == 0:
            out[:, -1] = place(h, 128)  # the word itself
    return out


class Stretches:
    """The words of some texts, as numbers of distinct words in rows of ``STRETCH``; -1 pads."""

    def __init__(self, texts: Sequence[str]):
        flat: list[bytes] = []
        sizes = []
        for t in texts:
            words = t.encode().translate(_LETTERS).split()
            flat += words
            sizes.append(len(words))
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        self.words = [w.decode(errors="replace").lower().encode() for w in coded.dictionary.to_pylist()]
        self.sizes = np.array(sizes, np.int64)
        rows = -(-self.sizes // STRETCH)
        self.owner = np.repeat(np.arange(len(sizes)), rows)
        first = np.cumsum(rows) - rows
        start = np.cumsum(self.sizes) - self.sizes
        of = np.repeat(np.arange(len(sizes)), self.sizes)
        within = np.arange(len(flat)) - start[of]
        self.at = (first[of] + within // STRETCH, within % STRETCH)
        self.ids = np.full((int(rows.sum()), STRETCH), -1, np.int64)
        self.ids[self.at] = coded.indices.to_numpy() if flat else 0


def marginals(unary: np.ndarray, real: np.ndarray, pair: np.ndarray, want_pairs: bool = False):
    """Marginals of the toxic tag for each place of each row, by scaled forward and backward passes.

    ``unary`` is the toxic tag's log-potential (the clean one's is 0), ``real`` tells places from
    padding, ``pair[i, j]`` is the log-potential of tag i before tag j. Also returns, if wanted, the expected number
    of each pair of tags.
    """
    n, t = unary.shape
    m = np.exp(pair)
    # Potentials are scaled to at most 1, so nothing overflows.
    top = np.maximum(unary, 0)
    p1, p0 = np.where(real, np.exp(unary - top), 0), np.where(real, np.exp(-top), 1)
    f1, f0 = np.empty((t, n)), np.empty((t, n))
    a1 = p1[:, 0] / (p1[:, 0] + p0[:, 0])
    f1[0], f0[0] = a1, 1 - a1
    for k in range(1, t):
        x1 = (f0[k - 1] * m[0, 1] + f1[k - 1] * m[1, 1]) * p1[:, k]
        x0 = (f0[k - 1] * m[0, 0] + f1[k - 1] * m[1, 0]) * p0[:, k]
        s = x1 + x0
        f1[k], f0[k] = x1 / s, x0 / s
    b1, b0 = np.ones(n), np.ones(n)
    out = np.empty((t, n))
    pairs = np.zeros((2, 2))
    for k in range(t - 1, -1, -1):
        x1, x0 = f1[k] * b1, f0[k] * b0
        out[k] = x1 / (x1 + x0)
        if k:
            q1, q0 = p1[:, k] * b1, p0[:, k] * b0
            if want_pairs:
                joint = np.array([[f0[k - 1] * m[0, 0] * q0, f0[k - 1] * m[0, 1] * q1],
                                  [f1[k - 1] * m[1, 0] * q0, f1[k - 1] * m[1, 1] * q1]])
                pairs += (joint / joint.sum(axis=(0, 1)) * real[:, k]).sum(axis=2)
            # Padding stands at the end of a row and says nothing about what is before it.
            n1 = np.where(real[:, k], m[1, 0] * q0 + m[1, 1] * q1, 1)
            n0 = np.where(real[:, k], m[0, 0] * q0 + m[0, 1] * q1, 1)
            s = n1 + n0
            b1, b0 = n1 / s, n0 / s
    return out.T * real, pairs


class Field:
    """Weights of the features and of the pairs of tags."""

    def __init__(self):
        self.w = np.zeros(WEIGHTS)
        self.bias = -4.0
        self.pair = np.zeros((2, 2))

    def unary(self, words: Sequence[bytes]) -> np.ndarray:
        return self.w[features(words)].sum(axis=1) + self.bias if len(words) else np.zeros(0)

    def tag(self, s: Stretches, per_word: np.ndarray) -> np.ndarray:
        real = s.ids >= 0
        return marginals(np.where(real, per_word[s.ids], 0), real, self.pair)[0] if len(s.ids) else np.zeros((0, STRETCH))

    def fit(self, s: Stretches, toxic: np.ndarray, rounds: int = 60, rate: float = 0.15, decay: float = 3e-4) -> None:
        """Adam on the log-likelihood of the tags ``toxic`` (rows as in ``s``)."""
        found = features(s.words)
        used, compact = np.unique(found, return_inverse=True)
        compact = compact.reshape(found.shape)
        w = np.zeros(len(used))
        real = s.ids >= 0
        n = real.sum()
        ids = np.where(real, s.ids, 0)
        y = toxic & real
        seen = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                seen[i, j] = ((y[:, :-1] == i) & (y[:, 1:] == j) & real[:, 1:]).sum()
        parts = [w, np.array([self.bias]), self.pair]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
        scale = max(1, y.sum())
        for step in range(1, rounds + 1):
            per_word = w[compact].sum(axis=1) + parts[1][0]
            p, pairs = marginals(np.where(real, per_word[ids], 0), real, self.pair, True)
            missing = np.bincount(ids[real], (y - p)[real], len(s.words))
            g = np.bincount(compact.reshape(-1), np.repeat(missing, compact.shape[1]), len(used))
            g[0] = 0 if used[0] == 0 else g[0]
            gradients = [g / scale - decay * w, np.array([missing.sum() / scale]), (seen - pairs) / scale - decay * self.pair]
            for q, d, (m, v) in zip(parts, gradients, moments, strict=True):
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                q += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        self.bias = float(parts[1][0])
        self.w[used] = w
        if used[0] == 0:
            self.w[0] = 0.0


def marking(s: Stretches, labels: np.ndarray) -> np.ndarray:
    """Which distinct words have a feature that marks toxic documents."""
    found = features(s.words)
    count = np.zeros((2, WEIGHTS))
    real = s.ids >= 0
    for d in range(len(labels)):
        rows = s.owner == d
        here = np.unique(found[np.unique(s.ids[rows][real[rows]])])
        count[int(labels[d]), here] += 1
    n = np.array([(labels == 0).sum(), (labels == 1).sum()], float)
    c, t = count
    with np.errstate(divide="ignore", invalid="ignore"):
        share = (c + t) / n.sum()

        def part(k, of):
            return np.where(k > 0, k * np.log(k / of), 0)

        ratio = 2 * (
            part(t, n[1] * share) + part(c, n[0] * share)
            + part(n[1] - t, n[1] * (1 - share)) + part(n[0] - c, n[0] * (1 - share))
        )
    marks = (ratio >= RATIO_TEST) & ((t + 0.5) / (n[1] + 1) >= TIMES * (c + 0.5) / (n[0] + 1))
    marks[0] = False
    return marks[found].any(axis=1)


def summary(s: Stretches, p: np.ndarray) -> np.ndarray:
    """For each document: expected toxic words, its logarithm, the surest word, and the length."""
    n = len(s.sizes)
    total, most = np.zeros(n), np.zeros(n)
    np.add.at(total, s.owner, p.sum(axis=1))
    if len(s.owner):
        np.maximum.at(most, s.owner, p.max(axis=1))
    size = np.log1p(s.sizes)
    expected = np.log(total + 0.01) - np.log(0.01)
    return np.stack([np.ones(n), np.minimum(total, 5), expected, most, size, np.minimum(most, 1) * size], axis=1)


class Model:
    def __init__(self, field: Field, weights: np.ndarray):
        self.field, self.weights = field, weights

    def score(self, s: Stretches, p: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary(s, p) @ self.weights, -30, 30)))


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge on all but the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w += np.linalg.solve(h, x.T @ (y - p) - penalty * w)
    return w


def _field_of(texts: list[str], labels: np.ndarray) -> Field:
    s = Stretches(texts)
    marked = marking(s, labels)
    toxic = (s.ids >= 0) & marked[s.ids] & (labels[s.owner] == 1)[:, None]
    field = Field()
    field.fit(s, toxic)
    return field


def fit(texts: list[str], labels: np.ndarray) -> Model | None:
    if not 0 < labels.sum() < len(labels):
        return None
    half = np.arange(len(texts)) % 2 == 0
    x, y = [], []
    for train in (half, ~half):
        if not 0 < labels[train].sum() < train.sum():
            continue
        field = _field_of([t for t, k in zip(texts, train, strict=True) if k], labels[train])
        rest = Stretches([t for t, k in zip(texts, train, strict=True) if not k])
        x.append(summary(rest, field.tag(rest, field.unary(rest.words))))
        y.append(labels[~train])
    field = _field_of(texts, labels)
    if not x:
        s = Stretches(texts)
        x, y = [summary(s, field.tag(s, field.unary(s.words)))], [labels]
    return Model(field, _fit_logistic(np.concatenate(x), np.concatenate(y)))


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", toxic: int = TOXIC,
          clean: int = CLEAN, longest: int = LONGEST) -> Model | None:
    """The model fitted to a sample of the labelled rows outside the held-out fold."""
    known = (
        labels.where(F.col("toxic").isNotNull() & (fold(id_column, FOLDS) != HELD_OUT))
        .groupBy(id_column).agg(F.max("toxic").alias("toxic"))
    )
    # Which ids have a short text is settled before the choice, from ids and lengths only.
    short = docs.where(F.length("text") <= longest).select(id_column).distinct()
    turn = Window.partitionBy("toxic").orderBy(F.xxhash64(id_column))
    chosen = (
        known.join(short, id_column, "left_semi")
        .withColumn("_k", F.row_number().over(turn))
        .where(F.col("_k") <= F.when(F.col("toxic") == 1, toxic).otherwise(clean))
        .select(id_column, "toxic")
    )  # ``toxic + clean`` rows at most
    rows = (
        docs.where(F.length("text") <= longest).select(id_column, "text")
        .join(F.broadcast(chosen), id_column)
        .groupBy(id_column).agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
        .orderBy(F.xxhash64(id_column)).collect()
    )
    return fit([r.text for r in rows], np.array([r.toxic for r in rows]))


def _tagged(model: Model, texts: list[str]) -> tuple[Stretches, np.ndarray]:
    s = Stretches(texts)
    return s, model.field.tag(s, model.field.unary(s.words))


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted, spans)``; spans are the words that are more likely toxic
    than not, as start and end in characters."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_column))  # 8 MB

    def make() -> Callable:
        fitted = model.value

        def apply(texts: list[str]) -> list:
            if fitted is None:
                nothing = np.zeros(len(texts))
                return [nothing, nothing.astype(np.int32), pa.array([[]] * len(texts), _SPANS)]
            s, p = _tagged(fitted, texts)
            scores = fitted.score(s, p)
            spans: list[list] = [[] for _ in texts]
            place = p[s.at]  # in the order of the words
            start = np.cumsum(s.sizes) - s.sizes
            hits = np.flatnonzero(place >= 0.5)
            owner = np.searchsorted(start + s.sizes, hits, side="right")
            for d in np.unique(owner).tolist():
                wanted = set((hits[owner == d] - start[d]).tolist())
                spans[d] = [
                    {"start": m.start(), "end": m.end()}
                    for k, m in enumerate(_FIND.finditer(texts[d])) if k in wanted
                ]
            return [scores, (scores >= threshold).astype(np.int32), pa.array(spans, _SPANS)]

        return apply

    held_out = (fold(id_column, FOLDS) == HELD_OUT).alias("held_out")
    return map_texts(
        docs, [id_column, held_out], ["score double", "predicted int", "spans array<struct<start:int,end:int>>"], make,
    )


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
