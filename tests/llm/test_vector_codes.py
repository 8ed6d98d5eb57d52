import random
from math import floor, inf, isfinite, nan

import numpy as np
import pytest

from pagelake.llm import vector_codes as vc


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """The contract in plain Python over (id, vector, label)."""
    kept = [(i, [floor(x * scale) for x in v], lab) for i, v, lab in rows
            if v and len(v) % parts == 0 and all(x is not None and isfinite(x) for x in v)]
    if not kept:
        return [], []
    sizes = [len(v) for _, v, _ in kept]
    dim = min(set(sizes), key=lambda d: (-sizes.count(d), d))
    kept = sorted((r for r in kept if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dim // parts
    cut = [[v[p * w:(p + 1) * w] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for x in cut[p]:
                members.setdefault(near(p, x)[1], []).append(x)
            for k, xs in members.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for n, (i, _, lab) in enumerate(kept):
        best = [near(p, cut[p][n]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    errors = {}
    for r in out:
        errors[r[1]] = errors.get(r[1], 0) + r[3]
    return [(*r, errors[r[1]]) for r in out], books


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def check(spark, rows, partitions=3, **options):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, code string")
    codes, books = vc.compress(df.repartition(partitions), **options)
    got = [tuple(r) for r in vc.with_label_error(codes).select("vec_id", "label", "code", "error", "label_error").collect()]
    want, want_books = plain(rows, **options)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert [b.tolist() for b in books] == want_books
    return got, books


def vectors(n, dim, seed, spread=0.3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dim)], rng.choice([None, 1, 2, 2, 2])) for i in range(n)]


def test_against_plain_python(spark):
    check(spark, vectors(500, 8, 1), entries=16)
    check(spark, vectors(300, 16, 2), partitions=7)  # 256 entries, negative and positive components


def test_bad_vectors_ties_and_repeats(spark):
    rows = vectors(60, 8, 3)
    rows += [(None, [0.1] * 8, None), (7, [0.25] * 8, 2), (7, [0.125] * 8, 2), (7, [0.125] * 8, 2), (-3, [0.0] * 8, 1), (-3, [0.0] * 8, 1)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.1] * 7 + [None], 1), (903, [nan] + [0.1] * 7, 1), (904, [0.1] * 7 + [inf], 1),
             (905, [0.1] * 7 + [-inf], None), (-9, [0.1] * 6, 1), (-9, [0.5] * 12, 1)]
    got, _ = check(spark, rows, entries=8)
    assert not {r[0] for r in got} & {900, 901, 902, 903, 904, 905, -9}


def test_fewer_vectors_than_entries_and_none(spark):
    check(spark, vectors(5, 4, 4))
    check(spark, [(1, [1.0, 2.0, 3.0, 4.0], None)])
    got, books = check(spark, [(1, None, 1), (2, [nan] * 4, 1)])
    assert got == [] and books == [] and vc.books_digest(books)
    empty = spark.createDataFrame([], "vec_id string, embedding array<float>, label string")
    codes, _ = vc.compress(empty)
    assert vc.with_label_error(codes).collect() == []


def test_large_components(spark):
    far = [(i, [1000.0 * (-1) ** i * (i + k) for k in range(4)], 1) for i in range(12)]  # 64-bit distances
    check(spark, far, entries=3)
    beyond = 2.0 * vc.largest_component(1) / vc.SCALE
    df = spark.createDataFrame(far + [(99, [beyond] * 4, 1)], "vec_id long, embedding array<double>, label int")
    assert 99 not in {r.vec_id for r in vc.compress(df, entries=3)[0].collect()}


def test_nearest_uses_every_block_and_breaks_ties_low():
    rng = np.random.default_rng(5)
    data = rng.integers(-50, 50, size=(3, 2_000))
    book = rng.integers(-50, 50, size=(40, 3))
    book[17] = book[3]
    found = [np.unique(d, return_inverse=True) for d in data]
    best, error = vc.nearest([v for v, _ in found], np.stack([c for _, c in found]).astype("<u2"), book)
    d = ((data.T[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (best == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all() and 17 not in best


def test_entries_are_two_hex_digits(spark):
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), entries=257)
