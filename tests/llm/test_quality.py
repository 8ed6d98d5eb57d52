import random
import re
from collections import Counter

import numpy as np

from pagelake.llm import quality


def brute(text):
    w = (text or "").encode().split()
    text = text or ""
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def sentences(r, n, symbol=""):
    words = [r.choice(["the", "of", "and"]) if r.random() < 0.4 else "".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 9)))
             for _ in range(n)]
    return "\n".join(" ".join(x + symbol for x in words[i:i + 20]) for i in range(0, n, 20))


def test_statistics_match_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", " \n\t", "of", "a b c", "a a a a", "x\x0by\x0cz\rw of", "a b c a b c a b", "é|ü <b> & é|ü <b> &", "\x1fa b c"]
    texts += ["".join(r.choice(["a", "b ", "a b c ", "\n", "#", " \t", "é "]) for _ in range(r.randrange(60))) for _ in range(200)]
    texts += ["again and again " * 20_000, " ".join(f"w{i}" for i in range(40_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in quality.text_statistics(df, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        want = brute(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want, repr(t)[:80]
        assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_outliers_go_and_clean_rows_stay(spark):
    """Junk of a third of a group doesn't move its estimate; the hot group holds most rows."""
    r = random.Random(3)
    rows = []
    for i in range(900):
        junk = i % 3 == 0
        rows.append((i, sentences(r, r.randrange(60, 400), "%%%" if junk else ""), "en", "hot" if i < 600 else f"s{i % 20}", junk))
    rows += [(None, sentences(r, 100), None, None, False), (901, None, "en", "hot", True), (902, "", None, "hot", True),
             (5, rows[5][1], "en", "hot", rows[5][4]), (903, "short", "xx", "only", True)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, source string, junk boolean, n_words int")
    got = quality.quality_rules(df, keep=("doc_id", "junk")).collect()
    assert len(got) == len(rows) and all(x.kept != x.junk for x in got)
    assert sum(x.distance2 is None for x in got) >= 3
    assert quality.quality_rules(df.limit(0)).count() == 0
    few = quality.quality_rules(df.where("doc_id < 30"), keep=("doc_id", "junk")).collect()
    assert all(x.kept and x.distance2 is None for x in few)  # fewer rows than an estimate takes


def test_cholesky_and_distance_sql(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(5, 5))
    c, m, x = a @ a.T * 1e6 + np.eye(5) * 1e6, rng.normal(size=5) * 100, rng.normal(size=5) * 2000
    row = {f"c_{p}{q}": float(c[i, j]) for i, p in enumerate(quality.X) for j, q in enumerate(quality.X) if j <= i}
    row |= {f"m_{p}": float(m[i]) for i, p in enumerate(quality.X)} | {p: float(x[i]) for i, p in enumerate(quality.X)}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} double" for k in row))
    got = quality._steps(quality._steps(df, quality.cholesky_sql()), quality.distance_sql()).first().d2
    assert np.isclose(got, (x - m) @ np.linalg.inv(c) @ (x - m))
