import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.llm import infill


def expected(doc_id, text, seed=infill.SEED, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(x in text for x in infill.MARKS) or h[2] % 100 >= fim:
        return (doc_id, n, "plain", text, None, None)
    if h[3] % 100 < spm:
        return (doc_id, n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m))
    return (doc_id, n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m))


ROWS = [(1, "a\nb\nc"), (2, None), (3, ""), (4, "x<P>\n"), (5, "\n\n\n"), (6, "é\n😀ü<"), (None, "q\n<M"), (7, "no break"), (7, "no break"),
        (8, "y" * 300_000 + "\n" + "z\n" * 50_000)] + [(i, "".join(f"l{k}\n" for k in range(i % 7))) for i in range(100, 160)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 0, "clash") for i, t in rows], "doc_id long, text string, h1 int, output string")
    return infill.restore(infill.fill_in_middle(df, **options))


def test_against_plain_python(spark):
    got = run(spark, ROWS).collect()
    key = str
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((expected(*r) for r in ROWS), key=key)
    texts = sorted(t or "" for _, t in ROWS)
    assert sorted(r.restored for r in got) == texts


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab\n<>PSM\r é", max_size=12), min_size=1, max_size=30))
def test_random_texts(spark, texts):
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in run(spark, rows).collect())
    assert [r[:6] for r in got] == [expected(*r) for r in rows]
    assert [r[6] for r in got] == texts


def test_shares_and_marks(spark):
    rows = [(i, "a\nb\n") for i in range(400)]
    got = run(spark, rows, fim_percent=30, spm_percent=0, seed=11).collect()
    assert sorted(tuple(r)[:6] for r in got) == [expected(*r, seed=11, fim=30, spm=0) for r in rows]
    assert 0.2 < sum(r.form == "psm" for r in got) / 400 < 0.4
    other = infill.restore(infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), marks=("<|pre|>", "<|suf|>", "<|mid|>")),
                           marks=("<|pre|>", "<|suf|>", "<|mid|>"))
    assert other.where("restored = 'a\nb\n'").count() == 400
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "S", "<M>"), ("<P<>", "<S>", "<M>")):
        with pytest.raises(ValueError):
            infill.fill_in_middle(other, marks=bad)


def test_empty_table_and_string_ids(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert infill.restore(infill.fill_in_middle(none)).collect() == []
    named = spark.createDataFrame([("k", "a\nb")], "doc_id string, text string")
    assert tuple(run(spark, [(1, "a\nb")]).drop("doc_id").first())[-1] == "a\nb"
    assert tuple(infill.fill_in_middle(named).first()) == expected("k", "a\nb")


def test_plan_has_no_shuffle(spark):
    plan = infill.fill_in_middle(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
