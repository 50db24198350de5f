"""The manifest, the whitening and the mix against plain Python and numpy."""

import math
import zlib
from hashlib import md5, sha256

import numpy as np
import pytest

from kinfold.llm import merkle_manifest as merkle
from kinfold.llm import source_mix, whitening

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, j int, _id int, u string"


def documents(spark, rows):
    """Rows (doc_id, text, lang, source, n_chars) beside columns with names that the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2, None) for r in rows], DOCS)


def awkward(n=60):
    rows = [(i, "" if i % 11 == 0 else None if i % 13 == 0 else f"word{i} é\n" * (i % 7 + 1), ["en", None, "", "ß", "en"][i % 5], ["a", None, "ü", ""][i % 4], i if i % 3 else None) for i in range(n)]
    return rows + rows[5:9] + [(None, "no id", "en", "a", 1), (None, "no id", "en", "a", 1), (None, None, None, None, None), (3, "other text", "ß", None, 2), (21, "long " * 50_000, "only", "a", 2**63 - 1)]


# Manifest
def encoded(v):
    b = None if v is None else str(v).encode()
    return b"-" if b is None else str(len(b)).encode() + b":" + b


def hexed(data):
    return sha256(data).hexdigest()


def climb(level):
    """The last node, and the siblings of every node from below."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, j in enumerate(at):
            if j ^ 1 < len(level):
                paths[k].append((level[j ^ 1], j & 1))
            else:
                paths[k].append(None)
        at = [j // 2 for j in at]
        level = [hexed("".join(level[j : j + 2]).encode()) for j in range(0, len(level), 2)]
    return level[0], paths


def folded(leaf, path):
    for step in path:
        leaf = hexed((leaf if step is None else step[0] + leaf if step[1] else leaf + step[0]).encode())
    return leaf


def manifest(rows):
    order = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, tops = {}, []
    for lang in order:
        own = []
        for d, text, g, source, n in (r for r in rows if r[2] == lang):
            leaf = hexed(b"".join(map(encoded, (d, source, g, n, text))))
            tried = leaf
            if d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0:
                tried = hexed(b"".join(map(encoded, (d, source, g, n + 1, text))))
            own.append((d is not None, d or 0, leaf, tried, d))
        own.sort()
        top, paths = climb([o[2] for o in own])
        trees[lang] = own, top, paths
        tops.append(top)
    root, upper = climb(tops)
    out = []
    for lang, up in zip(order, upper):
        own, top, paths = trees[lang]
        for (_, _, leaf, tried, d), path in zip(own, paths):
            got = folded(tried, path + up)
            out.append((d, leaf, top, root, hexed("".join(s[0] for s in path + up if s).encode()), got, got == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_manifest_against_plain_hashing(spark, bits):
    rows = awkward()
    got = merkle.verified(documents(spark, rows), bits=bits).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest(rows)
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_one_row_and_of_many_small_groups(spark):
    for rows in ([(7, "a", "en", "s", 1)], [(i, "t", f"l{i:02}", "s", i) for i in range(19)]):
        for bits in (1, 10):
            got = merkle.verified(documents(spark, rows), bits=bits).collect()
            assert sorted((tuple(r) for r in got), key=repr) == manifest(rows)


def test_log_is_in_postorder(spark):
    rows = [(i, "t", "en" if i % 4 else "de", "s", i) for i in range(45)]
    m = merkle.build(documents(spark, rows), bits=2)
    by_tree = {}
    for r in m.log.collect():
        by_tree.setdefault(r.tree, []).append(r)
    assert len(by_tree) == 3
    for nodes in by_tree.values():
        nodes.sort(key=lambda r: r.place)
        assert [r.place for r in nodes] == list(range(len(nodes)))
        n, stack = nodes[0].n, []
        for r in nodes:  # every node comes right after the nodes below it
            if r.level:
                below = stack[-2:] if 2 * r.j + 1 < merkle.width(n, r.level - 1) else stack[-1:]
                del stack[-len(below) :]
                assert [(b.level, b.j) for b in below] == [(r.level - 1, 2 * r.j + k) for k in range(len(below))]
                assert r.digest == merkle.joined(*[bytes(b.digest) for b in below])
            stack.append(r)
        assert len(stack) == 1 and stack[0].level == merkle.height(n)


def test_places_by_formula():
    for n in range(1, 70):
        done = [(level, j) for level, j, _ in merkle.complete([b""] * n, 0, n, 0, merkle.height(n))]
        assert [merkle.place(n, *x) for x in done] == list(range(len(done)))


# Whitening
VECTORS = "vec_id bigint, embedding array<float>, label int, n bigint, component string"


def vectors(spark, rows, kind=VECTORS):
    return spark.createDataFrame([(i, v, 0, -1, "x") for i, v in rows], kind)


def by_eigen(kept):
    x = np.floor(1024 * np.array(kept, np.float32).astype(float)).astype(np.int64) + 100_000
    n = len(x)
    s = x.sum(axis=0)
    c = (n * x - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return ((n * x - s).astype(object) ** 2).sum(axis=1), c @ v[:, :8] / np.sqrt(np.maximum(e[:8], 1e-300)), e / e.sum()


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(700, 20)) @ np.diag(np.linspace(0.02, 0.4, 20)) + 3
    good = [(i, [float(v) for v in row]) for i, row in enumerate(base)]
    good += good[:50] + [(None, good[3][1])]  # repeated rows, no id
    bad = [(9001, None), (9002, [None] * 20), (9003, [1.0] * 19 + [None]), (9004, [math.nan] * 20), (9005, [1.0] * 19 + [math.inf]),
           (9006, []), (9007, [1.0] * 3), (9008, [3e38] * 20)]
    got = whitening.whiten(vectors(spark, good + bad).repartition(5)).collect()
    deviation, white, part = by_eigen([v for _, v in good])
    assert len(got) == 8 * len(good) and {r.n for r in got} == {len(good)}
    assert got[0].identity_error < 1e-9
    for k in range(1, 9):
        mine = {r.vec_id: r for r in got if r.component == k}
        sign = np.sign(mine[0].whitened * white[0, k - 1])
        for row, (i, _) in enumerate(good):
            assert mine[i].deviation == deviation[row]
            assert abs(mine[i].whitened * sign - white[row, k - 1]) < 1e-8
            assert abs(mine[i].explained - part[k - 1]) < 1e-10


def test_whitening_without_full_rank(spark):
    rng = np.random.default_rng(2)
    flat = rng.normal(size=(300, 3)) @ rng.integers(1, 4, size=(3, 6)).astype(float)
    rows = [(i, [float(round(v * 64)) / 1024 for v in row] + [0.5]) for i, row in enumerate(flat)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    *_, part = by_eigen([v for _, v in rows])
    assert {r.component for r in got} == set(range(1, min(8, int((part > 1e-13).sum())) + 1)) and got[0].identity_error < 1e-4
    one = [(i, [0.25, 0.5]) for i in range(5)]
    assert whitening.whiten(vectors(spark, one)).collect() == []  # equal rows have no component
    two = whitening.whiten(vectors(spark, one + [(9, [0.5, 0.5])])).collect()
    assert {r.component for r in two} == {1} and len(two) == 6


def test_whitening_of_large_numbers(spark):
    kind = VECTORS.replace("float", "double")
    rows = [(i, [2.0**41 * ((i * 7) % 5 - 2), float(i)]) for i in range(9)]
    got = whitening.whiten(vectors(spark, rows, kind)).collect()
    x = [[math.floor(1024 * v) + 100_000 for v in row] for _, row in rows]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * v - t) ** 2 for v, t in zip(row, s)) for i, row in enumerate(x)}
    assert {r.vec_id: r.deviation for r in got} == {i: v if v < 2**63 else None for i, v in want.items()}
    assert got[0].identity_error < 1e-9


def test_triangular_solves_and_factors():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(50, 8)) * np.logspace(0, -7, 8)
    r = whitening.factor(a.T @ a, shifted=True)
    assert np.allclose(r, np.triu(r)) and np.allclose(whitening.solve_right(a, r) @ r, a)
    whitening.factor(np.ones((4, 4)), shifted=False)  # singular: the shift grows


# Mix
def mixed(rows):
    out, by = [], {}
    for d, text, _, source, _ in rows:
        words = len((text or "").encode().split())
        key = md5(f"{'' if d is None else d}:{md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
        by.setdefault(source, []).append((key, words, d))
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(w for _, w, _ in by[s]) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, every = set(), sum(size.values())
    while True:
        left, wide = every - sum(3 * size[s] for s in full), sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and 3 * size[s] * wide < left * weight[s]}
        if not more:
            break
        full |= more
    for s in names:
        goal = 3 * size[s] if s in full else left * weight[s] / wide
        words_left = 3 * size[s] if s in full else left * weight[s] // wide
        epochs, rest = divmod(words_left, size[s]) if size[s] else (0, 0)
        for _, w, d in sorted(by[s], key=lambda x: x[0]):
            cut = max(0, min(w, rest))
            rest -= cut
            out.append((d, w, size[s], float(goal), epochs * w + cut))
    return sorted(out, key=repr)


def test_mix_against_plain_sums(spark):
    rows = awkward()
    got = source_mix.taken_words(documents(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == mixed(rows)
    assert all(r.taken <= 3 * r.size for r in got)


@pytest.mark.parametrize("counts", [[1, 1, 400], [300, 2, 0, 5, 1, 7], [0, 0, 0], [9]])
def test_mix_with_sources_at_their_limit(spark, counts):
    rows = [(1000 * k + i, "a b c " * (i % 3 + 1) if n else "", "en", f"s{k}", 1) for k, n in enumerate(counts) for i in range(n or 1)]
    got = source_mix.taken_words(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == mixed(rows)
    taken = {}
    for r, (_, _, _, s, _) in zip(sorted(got, key=lambda r: r.doc_id), sorted(rows)):
        taken.setdefault(s, [0, r.target])[0] += r.taken
    assert all(0 <= goal - t < 1 for t, goal in taken.values())


def test_mix_of_one_hot_source_is_the_same_again(spark):
    rows = [(None if i % 3 else i, f"w{i % 50} " * (i % 9), "en", "hot" if i % 3 else f"s{i % 4}", 1) for i in range(900)]
    first, again = (sorted((tuple(r) for r in source_mix.taken_words(documents(spark, rows).repartition(p)).collect()), key=repr) for p in (2, 5))
    assert first == again == mixed(rows)


def test_mixed_texts(spark):
    rows = [(i, [" \tone two  three\nfour ", "one two  three\nfour five", "", None][i % 4], "en", "s0" if i < 4 else "s1", i) for i in range(40)]
    docs = documents(spark, rows)
    out = source_mix.mix(docs)
    assert out.columns == [*docs.columns, "_epoch"]
    words = {}
    for r in out.collect():
        whole = rows[r.doc_id][1] or ""
        assert whole.startswith(r.text or "") and r.source == rows[r.doc_id][3]
        words[r.doc_id] = words.get(r.doc_id, 0) + len((r.text or "").split())
    want = {r.doc_id: r.taken for r in source_mix.taken_words(docs).collect() if r.taken}
    assert {d: w for d, w in words.items() if w} == want
    assert any(w % len((rows[d][1] or "").split()) for d, w in want.items())  # one was cut inside


def test_words_of_a_total(spark):
    rows = [(i, "a b c d e", "en", f"s{i % 3}", 1) for i in range(30)]
    got = source_mix.taken_words(documents(spark, rows), total=60).collect()
    assert sum(r.taken for r in got) == 60
    got = source_mix.taken_words(documents(spark, rows), total=10_000).collect()  # more than the limits allow
    assert {r.taken for r in got} == {15}


def test_empty_tables_of_the_three(spark):
    none = documents(spark, []).where("false")
    assert merkle.verified(none).collect() == source_mix.taken_words(none).collect() == source_mix.mix(none).collect() == []
    assert whitening.whiten(vectors(spark, []).where("false")).collect() == []
