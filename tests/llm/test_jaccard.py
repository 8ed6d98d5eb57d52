import random

import pyarrow as pa
import pytest

from pagelake.llm import jaccard
from pagelake.llm.components import components
from pagelake.llm import shingles


def brute(rows, words=4, link=85):
    """Component by comparing word tuples of all pairs that share one."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        near = {}
        for g in s:
            for j in index.setdefault(g, []):
                near[j] = near.get(j, 0) + 1
            index[g].append(i)
        for j, both in near.items():
            if 100 * both >= link * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, node int, n_shingles int")
    out = jaccard.jaccard_components(df, **kw).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, out), key=str)


def corpus(seed, families=6, members=25, words=120):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["The", "of"] * 40
    rows, k = [], 0
    passage = [r.choice(vocab) for _ in range(60)]
    for f in range(families):
        base = [r.choice(vocab) for _ in range(r.choice([3, 30, words]))]
        for _ in range(members):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                t[r.randrange(len(t))] = r.choice(vocab)
            if r.random() < 0.3:
                base = t  # a chain: ends are linked through the middle only
            rows.append((k, r.choice([" ", "\n"]).join(t)))
            k += 1
    for _ in range(30):
        rows.append((k, " ".join([r.choice(vocab) for _ in range(r.randrange(5, 80))] + passage)))
        k += 1
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (None, "one two"),
             (5, rows[0][1]), (5, "another text under a used id with enough words in it"), (None, "alone in the world it is"),
             (906, "x " * 30_000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed, monkeypatch):
    if seed > 1:  # small blocks, salts and few buckets: the matrix has to find what the groups miss
        for k, v in {"BLOCK": 3, "QUERIES": 4, "STAR_ROWS": 3, "BANDS": 1, "ALIKE": 4 * seed, "VERY_ALIKE": 15, "HEAVY_MIN": 3, "CHUNK": 500}.items():
            monkeypatch.setattr(jaccard, k, v)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_five_words(spark):
    rows = corpus(7, families=3)
    assert run(spark, rows, words=5, link=80) == brute(rows, 5, 80)


def test_op10_matches_brute_force(spark):
    from pagelake.llm.queries import op10_token_group_join

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op10_token_group_join(spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (102, 100)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_component_rounds(spark):
    """Long chains, by ascending, descending and shuffled ids, a hub and a random graph against union-find; rounds and jumps stay few."""
    r = random.Random(9)
    shuffled = list(range(10_000, 11_000))
    r.shuffle(shuffled)
    links = [(i, i + 1) for i in range(1_000)] + [(5_000 - i, 4_999 - i) for i in range(1_000)] \
        + list(zip(shuffled, shuffled[1:])) + [(20_000, 20_001 + i) for i in range(500)] + [(29_999, 20_250)] \
        + [(r.randrange(30_000, 31_000), r.randrange(30_000, 31_000)) for _ in range(900)] \
        + [(40_000 + i, 41_000 - i) for i in range(1, 500)] + [(41_000 - i, 40_001 + i) for i in range(1, 499)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    rounds = []
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), rounds).collect()))
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert len(rounds) <= 8 and rounds[0] <= 12
    rounds.clear()
    chain = spark.createDataFrame([(i, i + 1) for i in range(1_000)], "a long, b long")
    assert components(chain, rounds).where("label = 0").count() == 1_001 and len(rounds) == 1 and rounds[0] <= 12
    assert components(chain.limit(0)).collect() == []


def test_prefix_rule():
    for n in range(1, 300):
        k = jaccard.needed(n)
        assert 100 * k >= 85 * n > 100 * (k - 1)


def test_shared_prefix_tokens():
    """Random linked sets share at least that many prefix tokens, in the same token order."""
    r = random.Random(6)
    for _ in range(3000):
        common = r.randrange(1, 120)
        a = set(range(common)) | {1000 + i for i in range(r.randrange(0, 15))}
        b = set(range(common)) | {2000 + i for i in range(r.randrange(0, 15))}
        if 100 * common < 85 * len(a | b):
            continue
        rank = {x: r.random() for x in a | b}
        prefix = [set(sorted(s, key=rank.get)[:len(s) - jaccard.needed(len(s)) + 1]) for s in (a, b)]
        assert len(prefix[0] & prefix[1]) >= jaccard.shared_at_least(len(a), len(b), 85) >= 1


def test_word_hashes(monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("abAB é\n\t\x0b x") for _ in range(r.randrange(0, 40))) for _ in range(400)] + [None, "", "x" * 300]
    column = pa.array(["pad", *texts, "pad"])[1:-1]
    for part in (1 << 22, 64, 7):
        monkeypatch.setattr(shingles, "PART", part)
        h, sizes = shingles.column_words(column)
        words = [(t or "").encode().lower().split() for t in texts]
        assert sizes.tolist() == [len(w) for w in words]
        flat = [x for w in words for x in w]
        assert len(set(zip(h.tolist(), flat))) == len(set(h.tolist())) == len(set(flat))
        for t, w in zip(texts, words):
            assert shingles.word_hashes(t).tolist() == [int(shingles.word_hashes(x.decode())[0]) for x in w]
    sets = shingles.shingle_sets(pa.array(["a b c d a b c d", "a b", None, "A  b"]), 4)
    assert list(map(len, sets)) == [4, 1, 0, 1] and sets[1] == sets[3]
