"""URL rules looked up in a sorted array of 64-bit digests.

A rule is a host and the beginning of a path; it fits its host and all subdomains, and the longest
fitting rule decides. The index keeps the XXH64 digests of all rules in a sorted, memory-mapped
array. A URL is probed with every suffix of its host at a dot that is no longer than the longest host of a rule, each with the
beginnings of its path that have the length of some rule path, all probes of a batch in one binary search; the stored rule
text decides whether a digest that was met is a true match.

The index is one file, sent to the workers with ``SparkContext.addFile``. It holds ``MAX_RULES``
rules at most: 24 bytes and the text of each; a longer list is refused.

Defined results: a NULL URL or one without ``://`` has an empty host and path and gets the default
verdict; equal rows each get a row; of equal rules the last one given holds.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from kinfold.llm.common import store

MAX_RULES = 5_000_000
_URL = re.compile(r"^.*?://([^/?#]*)([^?#]*)", re.S)
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def parts_of(url: str | None) -> tuple[str, str]:
    """Host, A-Z in lower case, and path of a URL."""
    found = _URL.match(url or "")
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def digests(keys: Sequence[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k.encode()) for k in keys], np.uint64)


class DigestIndex:
    """Sorted digests beside the rules they stand for; arrays may be memory-mapped. ``lengths`` are those of rule paths,
    ``longest`` that of the longest rule host."""

    def __init__(
        self, keys: np.ndarray, order: np.ndarray, ends: np.ndarray, texts: np.ndarray, lengths: list[int], longest: int
    ):
        self.keys, self.order, self.ends, self.texts, self.lengths, self.longest = keys, order, ends, texts, lengths, longest

    @classmethod
    def build(cls, rules: Sequence[Rule]) -> DigestIndex:
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit the index")
        latest = list({(r.host, r.path): r for r in rules}.values())
        stored = [f"{r.host}{r.path}\n{r.verdict}".encode() for r in latest]
        keys = digests([r.host + r.path for r in latest])
        order = np.argsort(keys, kind="stable")
        ends = np.cumsum([len(s) for s in stored], dtype=np.int64)
        texts = np.frombuffer(b"".join(stored), np.uint8)
        longest = max((len(r.host) for r in latest), default=0)
        return cls(keys[order], order.astype(np.int64), ends, texts, sorted({len(r.path) for r in latest}), longest)

    def to_bytes(self) -> bytes:
        """All arrays one after the other, behind a line with their sizes."""
        arrays = [self.keys, self.order, self.ends, np.array([self.longest, *self.lengths], np.int64), self.texts]
        head = " ".join(str(a.size) for a in arrays).encode().ljust(128)
        return head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def load(cls, path: str) -> DigestIndex:
        with open(path, "rb") as f:
            sizes = [int(x) for x in f.read(128).split()]
        mapped = np.memmap(path, np.uint8, "r")
        at, arrays = 128, []
        for n, kind in zip(sizes, (np.uint64, np.int64, np.int64, np.int64, np.uint8), strict=True):
            end = at + n * np.dtype(kind).itemsize
            arrays.append(mapped[at:end].view(kind))
            at = end
        longest, *lengths = arrays[3].tolist()
        return cls(arrays[0], arrays[1], arrays[2], arrays[4], lengths, longest)

    def _suffixes(self, host: str) -> list[str]:
        """The host and what is behind its dots, longest first, as far as a rule can have it."""
        first = len(host) - self.longest
        found = [host] if first <= 0 else []
        dot = host.find(".", max(first - 1, 0))
        while dot >= 0:
            found.append(host[dot + 1 :])
            dot = host.find(".", dot + 1)
        return found

    def _stored(self, i: int) -> tuple[str, str]:
        k = int(self.order[i])
        start = int(self.ends[k - 1]) if k else 0
        rule, _, verdict = self.texts[start : int(self.ends[k])].tobytes().decode().rpartition("\n")
        return rule, verdict

    def look_up(self, hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[str, str] | None]:
        """For each host and path the longest fitting rule and its verdict, or None."""
        probes, owners = [], []
        for u, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            starts = [path[:n] for n in self.lengths if n <= len(path)]
            for suffix in self._suffixes(host):
                for s in starts:
                    probes.append(suffix + s)
                    owners.append(u)
        found: list[tuple[str, str] | None] = [None] * len(hosts)
        if not probes or not len(self.keys):
            return found
        wanted = digests(probes)
        first = np.searchsorted(self.keys, wanted)
        for p in np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == wanted):
            i = int(first[p])
            while i < len(self.keys) and self.keys[i] == wanted[p]:  # rules that share a digest
                rule, verdict = self._stored(i)
                best = found[owners[p]]
                if rule == probes[p] and (best is None or len(rule) > len(best[0])):
                    found[owners[p]] = (rule, verdict)
                i += 1
        return found


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_column: str = "page_id"
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every page."""
    spark = pages.sparkSession
    name = f"rules-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(store(spark, name, DigestIndex.build(rules).to_bytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex.load(SparkFiles.get(name))
        for batch in batches:
            split = [parts_of(u) for u in batch.column(1).to_pylist()]
            hosts, paths = [h for h, _ in split], [p for _, p in split]
            hits = index.look_up(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                    pa.array([h and h[0] for h in hits], pa.string()),
                    pa.array([h[1] if h else default for h in hits], pa.string()),
                ],
                names=[id_column, "host", "path", "rule", "verdict"],
            )

    kind = pages.schema[id_column].dataType.simpleString()
    return pages.select(id_column, "url").mapInArrow(
        run, f"`{id_column}` {kind}, host string, path string, rule string, verdict string"
    )
