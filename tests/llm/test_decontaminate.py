import random

import numpy as np
import pytest

from pagelake.llm import decontaminate as dc
from pagelake.llm.shingles import word_hashes

VOCAB = [f"w{i}" for i in range(500)] + ["the", "of", "and"] * 60


def levenshtein_within(item, text):
    """Smallest edit distance of ``item`` to any run of ``text``."""
    best = len(item)
    prev = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(prev[j - 1] + (x != y), prev[j] + 1, row[-1] + 1))
        prev = row
    return min(best, min(prev))


def edited(r, words, k):
    w = list(words)
    for _ in range(k):
        at = r.randrange(len(w))
        kind = r.randrange(3)
        if kind == 0:
            w[at] = r.choice(VOCAB)
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, r.choice(VOCAB))
    return w


def make(seed):
    r = random.Random(seed)
    items = [(i, " ".join(r.choice(VOCAB) for _ in range(r.randrange(8, 60)))) for i in range(40)]
    docs = []
    for d in range(160):
        words = [r.choice(VOCAB) for _ in range(r.randrange(0, 150))]
        if d % 2:
            item = r.choice(items)[1].split()
            at = r.randrange(len(words) + 1)
            words[at:at] = edited(r, item, r.randrange(0, len(item) * 30 // 100 + 1))
        docs.append((d, " ".join(words).replace("the", "THE")))
    return docs, items


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = (t or "").lower().split()
        for i, x in items:
            y = (x or "").lower().split()
            if len(y) >= dc.MIN_WORDS and (n := levenshtein_within(y, w)) <= dc.edits(len(y)):
                out[d, i] = n
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_recall_and_precision(spark, seed):
    docs, items = make(seed)
    want = brute(docs, items)
    got = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in got}
    assert set(found) <= set(want) and len(found) == len(got)
    assert len(found) >= 0.98 * len(want) > 30
    light = {k for k, n in want.items() if n <= dc.edits(len(items[k[1]][1].split())) // 2}
    assert light <= set(found)
    texts, queries = dict(docs), dict(items)
    for r in got:
        run = texts[r.doc_id].lower().split()[r.start_word:r.start_word + r.n_words]
        assert dc.align(queries[r.item_id].split(), run)[0] == r.distance
        assert r.distance >= want[r.doc_id, r.item_id]


def test_align():
    assert dc.align(list("abc"), list("xxabcxx")) == (0, 2, 5)
    assert dc.align(list("abc"), list("xxacxx")) == (1, 2, 4)
    assert dc.align(list("abc"), []) == (3, 0, 0)


def test_gram_counts_lose_no_window():
    """Whatever the table finds, every window within the edits passes the counts."""
    r = random.Random(8)
    _, items = make(5)
    scanner = dc.Scanner([(i, word_hashes(t)) for i, t in items])
    assert sorted(n for c in scanner.classes for n in c) == scanner.lengths
    asked = []
    scanner._look_up = lambda h, starts, n: asked.append((n, set(starts.tolist()))) or []
    for _, t in items:
        item = t.split()
        words = [r.choice(VOCAB) for _ in range(20)] + edited(r, item, dc.edits(len(item))) + [r.choice(VOCAB) for _ in range(90)]
        h = word_hashes(" ".join(words))
        asked.clear()
        scanner.candidates(h, np.full(len(h), len(h)))
        starts = set().union(*(s for n, s in asked if n == len(item)))
        for p in range(len(words) - len(item) + 1):
            window = words[p:p + len(item)]
            prev = list(range(len(window) + 1))
            for i, x in enumerate(item, 1):
                row = [i]
                for j, y in enumerate(window, 1):
                    row.append(min(prev[j - 1] + (x != y), prev[j] + 1, row[-1] + 1))
                prev = row
            assert p in starts or prev[-1] > dc.edits(len(item))


def test_texts_and_ends_shorter_than_the_item(spark):
    """Runs with words deleted that are the whole text, or end it, are all found."""
    r = random.Random(12)
    items = [(i, " ".join(f"v{r.randrange(3000)}" for _ in range(n))) for i, n in enumerate([5, 6, 9, 10, 17, 30, 59])]
    docs, want = [], {}
    for i, t in items:
        item = t.split()
        for k in range(1, dc.edits(len(item)) + 2):
            for before in (0, 3, 40):
                words = item.copy()
                for _ in range(k):
                    del words[r.randrange(len(words))]
                words = [f"u{j}" for j in range(before)] + words
                if (n := levenshtein_within(item, words)) <= dc.edits(len(item)):
                    want[len(docs), i] = n
                docs.append((len(docs), " ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in got} == want and len(got) == len(want)
    alone = spark.createDataFrame([(1, " ".join(items[0][1].split()[:4]))], "doc_id long, text string")
    assert [(r.item_id, r.distance) for r in dc.find_leaks(alone, bench).collect()] == [(0, 1)]
    assert dc.drop_contaminated(alone, bench).count() == 0


def test_blocks_and_edge_rows(spark, monkeypatch):
    docs, items = make(3)
    docs += [(None, items[0][1]), (500, None), (501, ""), (502, items[1][1]), (502, items[1][1]), (503, "the " * 50_000 + items[2][1])]
    items += [(90, None), (91, ""), (92, "the of"), (None, items[3][1])]
    schema = "doc_id long, text string, item_id int, row string"
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], schema)
    bench = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    one = sorted(map(tuple, dc.find_leaks(frame, bench).collect()), key=str)
    monkeypatch.setattr(dc, "ITEM_BLOCK", 16)
    many = sorted(map(tuple, dc.find_leaks(frame, bench).collect()), key=str)
    assert one == many
    leaked = [(d, i) for d, i, *_ in one]
    assert (None, 0) in leaked and leaked.count((502, 1)) == 2 and (503, 2) in leaked
    assert not {i for _, i in leaked} & {90, 91, 92}
    assert {d for d, i in leaked if i is None} == {d for d, i in leaked if i == 3}
    kept = dc.drop_contaminated(frame, bench)
    assert kept.schema == frame.schema
    rows = [tuple(r) for r in kept.collect()]
    bad = {d for d, _ in leaked}
    assert sorted(rows, key=str) == sorted([(*d, 1, "x") for d in docs if d[0] not in bad], key=str)
    assert dc.find_leaks(frame.limit(0), bench).count() == 0
    assert dc.find_leaks(frame, bench.limit(0)).count() == 0
    assert dc.drop_contaminated(frame, bench.limit(0)).count() == len(docs)


def test_op9_matches_brute_force(spark):
    """Against alignment of every (document, item) that shares four words in a row; nothing else can match."""
    from pagelake.llm.queries import op9_cgk_leaks

    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {}
    for i, t in items:
        w = t.encode().lower().split()
        for j in range(len(w) - 3):
            grams.setdefault(tuple(w[j:j + 4]), set()).add(i)
    want, by_id = {}, dict(items)
    for d, t in docs:
        w = t.encode().lower().split()
        for i in set().union(*(grams.get(tuple(w[j:j + 4]), ()) for j in range(len(w) - 3)), ()):
            y = by_id[i].encode().lower().split()
            n = levenshtein_within(y, w)
            if n <= dc.edits(len(y)):
                want[d, i] = n
    got = {(r.doc_id, r.item_id): r.distance for r in op9_cgk_leaks(spark, sf).collect()}
    assert got == want and want
    assert np.mean(list(want.values())) < 3
