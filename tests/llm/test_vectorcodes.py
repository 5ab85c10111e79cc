"""Operator 12 against a plain version; its query is held against SQL in test_oracle."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from watchtally.llm import vectorcodes
from watchtally.llm.vectorcodes import CodeConfig, Tree, compress, distances

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cfg):
    """The contract with Python's integers: every part against every entry."""
    ok = [(i, v, l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, [float(np.float32(x)) for x in r[1]]))
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    if not ok:
        return []
    q = [[math.floor(cfg.scale * float(np.float32(x))) for x in v] for _, v, _ in ok]
    dim = len(q[0])
    cut = [(i * dim // cfg.parts, (i + 1) * dim // cfg.parts) for i in range(cfg.parts)]
    books = [[x[a:b] for x in q[:cfg.entries]] for a, b in cut]

    def nearest(x, book):
        return min((sum((s - t) ** 2 for s, t in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(cfg.rounds):
        for p, (a, b) in enumerate(cut):
            got = defaultdict(list)
            for x in q:
                got[nearest(x[a:b], books[p])[1]].append(x[a:b])
            books[p] = [[sum(c) // len(got[k]) for c in zip(*got[k])] if k in got else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, total = [], defaultdict(int)
    for (i, _, label), x in zip(ok, q):
        best = [nearest(x[a:b], books[p]) for p, (a, b) in enumerate(cut)]
        error = sum(d for d, _ in best)
        total[label] += error
        out.append((i, label, "".join(f"{k:02x}" for _, k in best), error))
    return sorted(((i, label, c, e, total[label], sha) for i, label, c, e in out), key=str)


def compressed(spark, rows, cfg, parts=3):
    return sorted(map(tuple, compress(spark.createDataFrame(rows, SCHEMA).repartition(parts), cfg).collect()), key=str)


def random_rows(n, dim, seed, steps=None):
    """steps: a coarse grid, so that points and distances tie."""
    rng = random.Random(seed)
    value = (lambda: rng.randrange(steps) / 256) if steps else (lambda: rng.gauss(0, 1))
    return [(rng.randrange(3 * n), [value() for _ in range(dim)], rng.choice([0, 0, 0, 1, 7, None])) for _ in range(n)]


@pytest.mark.parametrize("rows,cfg", [
    (random_rows(300, 16, 1), CodeConfig(parts=4, entries=8, block_rows=70, leaf=5)),
    (random_rows(300, 6, 2, steps=4), CodeConfig(parts=3, entries=16, block_rows=100, leaf=3)),
    (random_rows(200, 10, 3), CodeConfig(parts=4, entries=6, rounds=3, scale=1000, leaf=4)),
    (random_rows(200, 8, 4), CodeConfig(parts=4, entries=5, rounds=0)),
    (random_rows(20, 32, 5), CodeConfig()),
], ids=["gauss", "ties", "uneven", "no rounds", "few rows"])
def test_equals_plain(spark, rows, cfg):
    assert compressed(spark, rows, cfg) == plain(rows, cfg)


@pytest.mark.parametrize("steps", [None, 3])
@pytest.mark.parametrize("dim,leaf", [(4, 4), (2, 1), (8, 48)])
def test_descent_is_exact(steps, dim, leaf):
    """Owned balls and short lists give the nearest entry, lower one among equals, and the exact sums."""
    rng = np.random.default_rng(dim)
    x = rng.integers(0, steps, (700, dim)) if steps else np.floor(rng.normal(0, 40, (700, dim))).astype(np.int64)
    tree = Tree.unpacked(Tree.build(x, leaf).packed())
    assert sorted(tree.order.tolist()) == list(range(700)) and (tree.x == x[tree.order]).all()
    for book in (x[:20], x[:1], np.repeat(x[:5], 3, 0), x[:20] + 1000):
        sums, counts, entry = tree.assign(book, True)
        want = distances(tree.x, book).argmin(1)
        assert (entry == want).all() and (counts == np.bincount(want, minlength=len(book))).all()
        assert all((sums[k] == tree.x[want == k].sum(0)).all() for k in range(len(book)))
        assert (tree.assign(book, False)[0] == sums).all()


def test_balls_hold_their_points_and_are_owned():
    """Ranges, cached sums and radii are right, and far entries leave balls that are then owned whole."""
    rng = np.random.default_rng(0)
    x = np.concatenate([np.floor(rng.normal(c, 3, (200, 4))).astype(np.int64) for c in (0, 500, 1000)])
    tree = Tree.build(x, 16)
    for b in range(len(tree.start)):
        own = tree.x[tree.start[b]:tree.end[b]]
        assert len(own) and (own.sum(0) == tree.total[b]).all() and ((own - tree.pivot[b]) ** 2).sum(1).max() == tree.radius[b]
        if (c := tree.child[b]) >= 0:
            assert tree.start[c] == tree.start[b] and tree.end[c] == tree.start[c + 1] and tree.end[c + 1] == tree.end[b]
    looked = []
    tree.x = type("Watched", (np.ndarray,), {"__getitem__": lambda s, k: (looked.append(k), np.ndarray.__getitem__(s, k))[1]})(tree.x.shape, tree.x.dtype, tree.x.copy())
    tree.assign(np.array([[0] * 4, [500] * 4, [1000] * 4]), False)
    assert not looked


def test_edges(spark):
    """Null vectors, components and ids, NaN and infinity, other lengths, equal ids and rows, null labels, clashing columns, empty tables."""
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, None, 2.0, 3.0], 2), (4, [1.0, float("nan"), 2.0, 3.0], 2), (5, [float("inf")] * 4, 2), (6, [1.0, 2.0], 3)]
    rows += [(i % 9 + 7, [0.1 * i, -0.5, float(i % 3), 1.0], None if i % 2 else 5) for i in range(40)] + [(None, [9.0, 9.0, 9.0, 9.0], None)] * 2 + [(0, [1.0, 1.0, 1.0, 1.0], 5)] * 3
    cfg = CodeConfig(parts=2, entries=4, block_rows=7, leaf=2)
    assert compressed(spark, rows, cfg) == plain(rows, cfg)
    extra = spark.createDataFrame([(r[0], r[1], r[2], "x", 1, 2) for r in rows], SCHEMA + ", code string, salt int, error int")
    assert sorted(map(tuple, compress(extra, cfg).collect()), key=str) == plain(rows, cfg)
    for none in ([], rows[:2]):
        got = compress(spark.createDataFrame(none, SCHEMA), cfg)
        assert got.count() == 0 and got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_results_do_not_depend_on_blocks_or_partitions(spark):
    rows = random_rows(400, 8, 9)
    one = compressed(spark, rows, CodeConfig(parts=4, entries=16), 1)
    assert compressed(spark, rows, CodeConfig(parts=4, entries=16, block_rows=30, leaf=2, salts=3), 7) == one


def test_huge_components_are_refused(spark):
    with pytest.raises(ValueError):
        vectorcodes.whole(np.array([[1e9]]), 256)
