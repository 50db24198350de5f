"""BPE encoding by an automaton over tokens that is compiled from the merges.

The automaton starts as one state with a loop for every single symbol. Each merge (u, v) -> w, in
rank order, is worked in by a gadget: all arcs that read u are led to a copy of their target
that has no arc for v, so u followed by v can no longer be spelled, and wherever u could be read an
arc w is added that leads where v led. In the end the only path that spells a word is its
encoding, and the arcs on it are the tokens.

All arcs that read one token always lead to the same state, so a gadget adds one state: the target of
u before, without v. A state is therefore kept as the state it was copied from and the token it lost,
in rank order; the arcs it still has need not be listed, as they follow from these (``_has_arc``).
Arcs that were asked for are kept in a transition table.

To encode a word, paths are followed from the start, longest arc first, until the word is spelled. A
place that led nowhere is not entered again: only one token can end there. Texts are split
into words as the tokenizer file says; its normaliser is applied to texts outside ASCII.

Defined results: a NULL or empty text has no tokens, and decodes to the empty text; strings of special
tokens in a text become those tokens. Nothing else in a row matters, and equal rows each get a row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, pre_tokenizers

from kinfold.llm.common import map_texts

#: Words and arcs remembered by a worker; beyond this many it starts anew. Longer words are spelled each time.
REMEMBERED, LONG_WORD = 200_000, 100
#: Unicode's White_Space, as the file's ``\s`` means it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NEVER = 1 << 60


class MergeAutomaton:
    """The automaton; ``merges`` are pairs of token strings, ``ids`` the id of every token."""

    def __init__(self, ids: dict[str, int], merges: Sequence[tuple[str, str]]):
        self.ids = ids
        n = max(ids.values(), default=-1) + 1
        self.rank = [-1] * n  # of the merge that made a token; -1 for a single symbol
        self.left, self.right = [-1] * n, [-1] * n
        # Per token the arcs its state lost by gadgets of its own, and when. The rest of the
        # state's history is that of the state it was copied from: of the token ``right``, as it
        # was at the token's rank.
        self.lost: list[dict[int, int] | None] = [None] * n
        self.spelled = [True] * n  # is there an arc for the token?
        for rank, (u, v) in enumerate(merges):
            self._gadget(rank, ids[u], ids[v], ids[u + v])
        self._arcs: dict[int, bool] = {}

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if not (self.spelled[u] and self.spelled[v] and self._has_arc(u, v)):
            self.spelled[w] = False  # an earlier gadget has left no place to read u, then v
            return
        if self.lost[u] is None:
            self.lost[u] = {}
        self.lost[u].setdefault(v, rank)
        self.left[w], self.right[w], self.rank[w] = u, v, rank

    def _lost_at(self, last: int, arc: int) -> int:
        """The rank at which the state after ``last`` lost ``arc``, if it did."""
        until, x = _NEVER, last
        best = _NEVER
        while x >= 0:
            own = self.lost[x]
            if own is not None:
                at = own.get(arc, _NEVER)
                if at < until and at < best:
                    best = at
            until, x = self.rank[x], self.right[x]
        return best

    def _has_arc(self, last: int, token: int) -> bool:
        """Can ``token`` follow ``last``? Its arc was made where its left part had one, and so on
        down to a single symbol; each must still have been there when the next was made."""
        if self._lost_at(last, token) < _NEVER:
            return False
        x = token
        while self.left[x] >= 0:
            if self._lost_at(last, self.left[x]) <= self.rank[x]:
                return False
            x = self.left[x]
        return True

    def follows(self, last: int, token: int) -> bool:
        key = last << 32 | token
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) >= REMEMBERED:
                self._arcs.clear()
            known = self._arcs[key] = self._has_arc(last, token)
        return known


class WordEncoder:
    """Spells words, given as strings of byte symbols, along the automaton.

    ``middle`` spells out the tokens that do not end a word, a symbol for each step, so that the arcs
    that can be read at a place are found in one walk.
    """

    def __init__(self, automaton: MergeAutomaton, suffix: str):
        self.automaton = automaton
        self.middle: dict = {}
        self.end: dict[str, int] = {}
        for token, i in automaton.ids.items():
            if not automaton.spelled[i]:
                continue
            if token.endswith(suffix):
                self.end[token.removesuffix(suffix)] = i
                continue
            node = self.middle
            for symbol in token:
                node = node.setdefault(symbol, {})
            node[""] = i
        self.longest_end = max(map(len, self.end), default=0)
        self.longest = max(map(len, automaton.ids), default=0)

    def _arcs(self, word: str, at: int) -> list[tuple[int, int]]:
        """The tokens that can be read at ``at`` and where they end, shortest first."""
        found = []
        node = self.middle
        for stop, symbol in enumerate(word[at : min(at + self.longest, len(word) - 1)], at + 1):
            node = node.get(symbol)
            if node is None:
                break
            token = node.get("")
            if token is not None:
                found.append((stop, token))
        if len(word) - at <= self.longest_end:
            token = self.end.get(word[at:])
            if token is not None:
                found.append((len(word), token))
        return found

    def encode(self, word: str) -> list[int]:
        # From the first state every arc can be taken, and no second path spells the word.
        whole = self.end.get(word)
        if whole is not None:
            return [whole]
        n, follows = len(word), self.automaton.follows
        path: list[int] = []
        open_arcs = [self._arcs(word, 0)]
        dead = set()
        starts = [0]
        while True:
            arcs = open_arcs[-1]
            while arcs:
                stop, token = arcs.pop()
                if stop not in dead and (not path or follows(path[-1], token)):
                    break
            else:
                if not path:
                    raise ValueError(f"no path spells {word!r}")
                dead.add(starts.pop())
                open_arcs.pop()
                path.pop()
                continue
            path.append(token)
            if stop == n:
                return path
            starts.append(stop)
            open_arcs.append(self._arcs(word, stop))


@cache
def _byte_symbols() -> dict[int, str]:
    """The printable symbol that stands for each byte in byte-level vocabularies: itself where it
    is printable, else the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class TextEncoder:
    """Encodes and decodes whole texts by the tokenizer file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        ids = model["vocab"]
        self.words = WordEncoder(MergeAutomaton(ids, [tuple(m) for m in model["merges"]]), suffix)
        self.labels = {i: t for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels |= {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"^\s", f"^{_SPACE}")
        self.find = regex.compile(pattern).findall
        # Classes of letters differ between versions of Unicode, so texts beyond the old Latin
        # blocks are split by the library's own.
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        self.beyond = regex.compile(r"[^\x00-\u024f]").search
        self.find_ascii = regex.compile(
            pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        ).findall
        self.cut = regex.compile("|".join(map(regex.escape, self.special))).splititer
        self.marks = regex.compile("|".join(map(regex.escape, self.special))).findall
        self.normal = Tokenizer.from_file(path).normalizer.normalize_str
        self.symbols = _byte_symbols()
        self.known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        spelled = word
        if not (word.isascii() and word.isprintable()) or " " in word:
            spelled = "".join(map(self.symbols.__getitem__, word.encode()))
        ids = np.array(self.words.encode(spelled), "<u4").tobytes()
        if len(word) <= LONG_WORD:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = ids
        return ids

    def _part(self, text: str) -> bytes:
        if text.isascii():
            found = self.find_ascii(text.lower())
        else:
            text = self.normal(text)
            if self.beyond(text):
                found = [w for w, _ in self.split.pre_tokenize_str(text)]
            else:
                found = self.find(text)
        known, word = self.known, self._word
        return b"".join([known.get(w) or word(w) for w in found])

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._part(text)
        marks = [np.array([self.special[m]], "<u4").tobytes() for m in self.marks(text)]
        parts = list(map(self._part, self.cut(text)))
        return b"".join(x for pair in zip(parts, [*marks, b""], strict=True) for x in pair)

    def decode(self, ids: Sequence[int]) -> str:
        """The labels of the arcs, apart from each other by a space, as the file has no decoder."""
        return " ".join(map(self.labels.__getitem__, ids))


@cache
def text_encoder(path: str) -> TextEncoder:
    """One for each worker process."""
    return TextEncoder(path)


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _per_text(path: str, row: Callable[[TextEncoder, str], tuple]):
    def make():
        encoder = text_encoder(path)
        return lambda texts: list(zip(*(row(encoder, t) for t in texts), strict=True))

    return make


def encode(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """``keep`` and, for every whole text, n_tokens, the token ``ids`` and the SHA-256 of the text they
    decode to."""

    def row(encoder: TextEncoder, text: str) -> tuple[int, np.ndarray, str]:
        ids = np.frombuffer(encoder.encode(text), "<u4")
        return len(ids), ids.astype(np.int32), _sha256(encoder.decode(ids.tolist()).encode())

    return map_texts(
        docs, keep, ["n_tokens bigint", "ids array<int>", "decoded_sha256 string"], _per_text(path, row)
    )


def round_trip(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """``keep``, n_tokens, and the SHA-256 of the ids and of the text decoded from them."""

    def row(encoder: TextEncoder, text: str) -> tuple[int, str, str]:
        ids = encoder.encode(text)
        decoded = encoder.decode(np.frombuffer(ids, "<u4").tolist())
        return len(ids) // 4, _sha256(ids), _sha256(decoded.encode())

    return map_texts(
        docs, keep, ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"], _per_text(path, row)
    )
