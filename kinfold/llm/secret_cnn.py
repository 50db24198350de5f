"""Secrets by patterns, and further ones by a character convolutional network, in numpy.

Patterns give the base findings. Every other run of ``[A-Za-z0-9+/_.=-]`` of at least ``SHORTEST``
characters with a digit, or with an upper-case letter after a lower-case one, is a candidate, unless
base findings cover all of it; what one covers in part is scored as a whole. The
network reads the candidate with its surroundings: characters are embedded, convolved, pooled by maximum and mean, and
weighed by a logistic unit. A long candidate is read in windows, the surest of which counts.

It is trained on labelled findings: candidates that a pattern touches are secrets, the others are not. Others that
follow a name like a secret's, of which the patterns know only a few, have no label, so that such a name does not speak against one.
All of all documents are used, each different one once. In half of the examples the
surroundings are blanked, so that the characters of the secret itself are learned too. Up to about ``SHARE`` examples are learned
by one task. More are dealt to as many tasks as that takes; each goes over its own once, from the same weights, and the weights
and moments of all, weighted by their examples, are averaged before the next of ``EPOCHS`` rounds. A fifth is kept apart: on
it the scores are calibrated (a logistic function of the logit), and the threshold is set as high as
leaves ``RECALL`` of its secrets found. Candidates at or above it are added to the base findings. The driver only sees weights
and sums.

Defined results: a NULL or empty text has no findings; without examples of both labels nothing is added;
equal rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import map_texts, portions
from kinfold.llm.order import places
from kinfold.sources.scratch import cut_lineage

KINDS = ("assign", "access", "hex")
LEARNED = "learned"
SHORTEST = 12
SHARE, EPOCHS = 5_000, 8
RECALL = 0.98
BEFORE, INSIDE, AFTER = 24, 48, 8
EMBED, WIDTH, FILTERS = 8, 5, 24

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)
#: Names of secrets just before a candidate, or at its head before an equals sign.
_NAME = r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credential|(?:api|access|private)[_ -]?key)s?"
_NAMED = re.compile(_NAME + r"""["']?\x20*(?:[:=]|\x20is\b)?\x20*["']?$""", re.I | re.A)
_NAMES = re.compile(_NAME + r"=", re.I | re.A)
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]")

Span = tuple[str, int, int]


def base_findings(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each pattern, by start, then in the order of ``KINDS``."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _RUN.finditer(text) if _MIXED.search(m[0])]


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Character codes of a candidate with its surroundings, ``INSIDE`` of its characters at a
    time; 128 is added inside the candidate, 127 stands for all beyond ASCII, 0 for nothing."""
    out = []
    for a in range(start, end, INSIDE):
        b = min(a + INSIDE, end)
        row = np.zeros(BEFORE + INSIDE + AFTER, np.int64)
        parts = ((text[max(0, a - BEFORE) : a], BEFORE - min(a, BEFORE), 0), (text[a:b], BEFORE, 128),
                 (text[b : b + AFTER], BEFORE + INSIDE, 0))
        for part, at, inside in parts:
            codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
            row[at : at + len(codes)] = np.minimum(codes, 127) + inside
        out.append(row)
    return out


class CharacterNetwork:
    """Embedding, one convolution, two poolings and a logistic unit."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.4, (256, EMBED)).astype(np.float32)
        self.k = rng.normal(0, 0.25, (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.kb = np.zeros(FILTERS, np.float32)
        self.o = rng.normal(0, 0.2, 2 * FILTERS).astype(np.float32)
        self.ob = np.zeros(1, np.float32)
        self.slope, self.shift, self.threshold = 1.0, 0.0, 1.0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self._parameters()]
        self.steps = 0

    def _parameters(self) -> list[np.ndarray]:
        return [self.e, self.k, self.kb, self.o, self.ob]

    def state(self) -> np.ndarray:
        """Weights, moments and the number of steps, in a row."""
        return np.concatenate([p.ravel() for p in (*self._parameters(), *sum(self.moments, ()))] + [[self.steps]]).astype(float)

    def load(self, state: np.ndarray) -> None:
        at = 0
        for p in (*self._parameters(), *sum(self.moments, ())):
            p[...] = state[at : at + p.size].reshape(p.shape)
            at += p.size
        self.steps = round(state[at])

    def _forward(self, x: np.ndarray):
        embedded = self.e[x]
        places = x.shape[1] - WIDTH + 1
        columns = np.concatenate([embedded[:, i : i + places] for i in range(WIDTH)], axis=2)
        active = np.maximum(columns @ self.k + self.kb, 0)
        pooled = np.concatenate([active.max(axis=1), active.mean(axis=1)], axis=1)
        return columns, active, pooled, pooled @ self.o + self.ob[0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 1024])[3] for i in range(0, len(x), 1024)] or [np.zeros(0)])

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        columns, active, pooled, logit = self._forward(x)
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        dp = d[:, None] * self.o[None, :]
        da = np.repeat(dp[:, None, FILTERS:] / active.shape[1], active.shape[1], axis=1)
        best = active.argmax(axis=1)
        rows, filters = np.indices(best.shape)
        da[rows, best, filters] += dp[:, :FILTERS]
        da *= active > 0
        dk = columns.reshape(-1, columns.shape[2]).T @ da.reshape(-1, FILTERS)
        dc = da @ self.k.T
        de = np.zeros_like(self.e)
        places = dc.shape[1]
        for i in range(WIDTH):
            np.add.at(de, x[:, i : i + places].reshape(-1), dc[:, :, i * EMBED : (i + 1) * EMBED].reshape(-1, EMBED))
        return [de, dk, da.sum(axis=(0, 1)), d @ pooled, np.array([d.sum()], np.float32)]

    def train(
        self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01, seed: int | Sequence[int] = 4
    ) -> None:
        """Go on from the weights and moments there are."""
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), batch):
                some = order[a : a + batch]
                rows = x[some]
                blank = rng.random(len(rows)) < 0.5
                rows[blank] = np.where(rows[blank] >= 128, rows[blank], 0)
                self.steps += 1
                for p, g, (m, v) in zip(self._parameters(), self._gradients(rows, y[some]), self.moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)

    def fit(self, sums: Callable[[np.ndarray], Sequence[float]]) -> None:
        """Fit slope and shift by Newton's method. ``sums`` gives, for both, the sums over the examples of q x², q x, q, d x
        and d, where x is the logit, p its probability, q = p (1 - p) and d = label - p."""
        w = np.array([1.0, 0.0])
        for _ in range(25):
            qxx, qx, q, dx, d = sums(w)
            step = np.linalg.solve([[qxx + 0.1, qx], [qx, q + 0.1]], np.array([dx, d]) - 0.1 * (w - [1.0, 0.0]))
            w += step
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = float(w[0]), float(w[1])

    def calibrate(self, logit: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Fit slope and shift; set the threshold by the recall to be kept."""

        def sums(w: np.ndarray) -> list[float]:
            p = 1 / (1 + np.exp(-np.clip(w[0] * logit + w[1], -30, 30)))
            q, d = p * (1 - p), y - p
            return [(q * logit**2).sum(), (q * logit).sum(), q.sum(), (d * logit).sum(), d.sum()]

        self.fit(sums)
        secrets = np.sort(self._calibrated(logit[y == 1]))
        self.threshold = float(secrets[int((1 - recall) * len(secrets))])

    def _calibrated(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._calibrated(self.logits(x))


def _overlaps(spans: Sequence[Span], start: int, end: int) -> bool:
    return any(a < end and start < b for _, a, b in spans)


def _covered(spans: Sequence[Span], start: int, end: int) -> bool:
    """Is every character in one of the spans, which are in the order of their starts?"""
    for _, a, b in spans:
        if a <= start < b:
            start = b
    return start >= end


def named(text: str, start: int, end: int) -> bool:
    return bool(_NAMED.search(text[max(0, start - BEFORE) : start]) or _NAMES.search(text, start, end))


def examples(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(codes, label)`` of all documents, each once; ids play no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in portions(batch.column(0)):
                codes, labels = [], []
                for text in texts:
                    base = base_findings(text or "")
                    for a, b in candidates(text or ""):
                        secret = _overlaps(base, a, b)
                        if secret or not named(text, a, b):
                            codes.append(windows(text, a, b)[0].astype(np.uint8).tobytes())
                            labels.append(int(secret))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes, pa.binary()), pa.array(labels, pa.int32())], names=["codes", "label"]
                )

    return docs.select("text").mapInArrow(run, "codes binary, label int").distinct()


def _read(codes: pa.Array) -> np.ndarray:
    """The codes of some examples, one in a row."""
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), -1).astype(np.int64)


def learn(docs: DataFrame, recall: float = RECALL, share: int = SHARE) -> CharacterNetwork | None:
    found = cut_lineage(examples(docs), "examples")
    count = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    n, secrets = sum(count.values()), count.get(1, 0)
    if n < 20 or not 5 <= secrets <= n - 5:
        return None
    tasks = 1 + n // share
    by_hash = F.xxhash64("codes", "label")
    placed = places(found, [F.col("label"), by_hash, F.col("codes")], "examples", "place")
    placed = placed.select("codes", "label", (F.col("place") % 5 == 0).alias("apart"), F.pmod(by_hash, F.lit(tasks)).alias("task"))
    placed = cut_lineage(placed, "examples")
    network = CharacterNetwork()
    rounds, epochs = (1, EPOCHS) if tasks == 1 else (EPOCHS, 1)
    for k in range(rounds):
        # Examples are small and learning is not, so adaptive execution, which goes by bytes, must not put the tasks together.
        network.load(_round(placed.where("not apart").repartition(tasks, "task"), network.state(), epochs, k))
    _calibrate(network, placed.where("apart"), recall)
    return network


def _round(rows: DataFrame, state: np.ndarray, epochs: int, k: int) -> np.ndarray:
    """The mean state after each task has gone over its examples, starting from ``state``.

    States are added up as whole numbers, so the mean doesn't depend on the order in which tasks end.
    """
    scale = float(1 << 30)

    def train(group: pa.Table) -> pa.Table:
        group = group.sort_by([("codes", "ascending"), ("label", "ascending")])
        network = CharacterNetwork()
        network.load(state)
        y = group["label"].to_numpy()
        network.train(_read(group["codes"]), y, epochs, seed=[4, k, group["task"][0].as_py()])
        added = np.round(network.state() * scale * len(y)).astype(np.int64)
        return pa.table({"at": pa.array(np.arange(len(added), dtype=np.int32)), "added": added, "n": np.full(len(added), len(y))})

    per_task = rows.groupBy("task").applyInArrow(train, "at int, added bigint, n bigint")
    mean = per_task.groupBy("at").agg((F.sum("added") / F.sum("n") / F.lit(scale)).alias("mean")).orderBy("at")
    return np.array([r.mean for r in mean.select("mean").collect()])


def _calibrate(network: CharacterNetwork, rows: DataFrame, recall: float) -> None:
    """``network.calibrate`` on examples that stay where they are."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                logits = network.logits(_read(batch.column(0))).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(logits), batch.column(1)], names=["logit", "label"])

    scored = cut_lineage(rows.select("codes", "label").mapInArrow(score, "logit double, label int"), "logits")
    x = F.col("logit")

    def sums(w: np.ndarray) -> Sequence[float]:
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(w[0])) * x + F.lit(float(w[1]))))
        p = 1 / (1 + F.exp(-z))
        q, d = p * (1 - p), F.col("label") - p
        return list(scored.agg(*[F.sum(c) for c in (q * x * x, q * x, q, d * x, d)]).first())

    network.fit(sums)
    secrets = scored.where("label = 1").select("logit")
    rank = int((1 - recall) * secrets.count())
    order = F.col("logit").asc() if network.slope >= 0 else F.col("logit").desc()
    least = places(secrets, [order], "logits", "place").where(F.col("place") == rank).first().logit
    network.threshold = float(network._calibrated(np.array([least]))[0])


class Scanner:
    """All findings of a list of texts; the candidates of all texts are scored together."""

    def __init__(self, network: CharacterNetwork | None):
        self.network = network

    def __call__(self, texts: Sequence[str]) -> tuple[list[list[Span]], list[list[Span]]]:
        """For each text the base findings, and the learned ones."""
        base = [base_findings(t) for t in texts]
        learned: list[list[Span]] = [[] for _ in texts]
        if self.network is None:
            return base, learned
        places, rows = [], []
        for i, t in enumerate(texts):
            for a, b in candidates(t):
                if not _covered(base[i], a, b):
                    for row in windows(t, a, b):
                        places.append((i, a, b))
                        rows.append(row)
        if rows:
            # Equal windows are read once.
            distinct, which = np.unique(np.array(rows), axis=0, return_inverse=True)
            sure = self.network.probabilities(distinct)[which.reshape(-1)] >= self.network.threshold
            for i, a, b in sorted({places[k] for k in np.flatnonzero(sure)}):
                learned[i].append((LEARNED, a, b))
        return base, learned


def _joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans)`` for every document."""
    network = docs.sparkSession.sparkContext.broadcast(learn(docs))  # a few kilobytes

    def make() -> Callable:
        scanner = Scanner(network.value)
        order = (*KINDS, LEARNED).index

        def apply(texts: list[str]) -> list:
            base, learned = scanner(texts)
            counts = [[sum(s[0] == k for s in b) for b in base] for k in KINDS]
            both = [sorted(b + n, key=lambda s: (s[1], order(s[0]))) for b, n in zip(base, learned, strict=True)]
            return [*counts, [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], [_joined(s) for s in both]]

        return apply

    return map_texts(
        docs, [id_column],
        ["n_assign bigint", "n_access bigint", "n_hex bigint", "base_sha256 string", "spans string"], make,
    )


def redact(docs: DataFrame, id_column: str = "doc_id", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; findings that overlap are replaced
    as one. A column ``n_chars`` is set to the new length."""
    network = docs.sparkSession.sparkContext.broadcast(learn(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(network.value)
        for batch in batches:
            for a, texts in portions(batch.column(at)):
                base, learned = scanner([t or "" for t in texts])
                clean = [
                    t if not (b or n) else _without(t, b + n, mark)
                    for t, b, n in zip(texts, base, learned, strict=True)
                ]
                field = batch.schema.field(at)
                yield batch.slice(a, len(texts)).set_column(at, field, pa.array(clean, field.type))

    clean = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def _without(text: str, spans: Sequence[Span], mark: str) -> str:
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])


