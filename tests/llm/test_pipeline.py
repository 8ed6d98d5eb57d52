import zlib

import numpy as np
import pytest
from test_decontaminate import levenshtein_within
from test_jaccard import brute as components
from test_packing_tokens import whole

import corpus_pipeline as cp
from pagelake.llm import decontaminate as dc
from pagelake.llm import packing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def test_stage_names():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    """Inputs and outputs of the stages over the small table, each written and read."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from pagelake.session import fresh_dir

    out = [docs]
    for name, f in cp.STAGES:
        path = fresh_dir(spark, "t-" + name)
        f(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_quality_stage(stages):
    kept = quality.quality_rules(stages[0]).where("kept")
    assert stages[1].columns == stages[0].columns and ids(stages[1]) == ids(kept)


def test_near_duplicate_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = sorted({c for _, _, c in components(rows, cp.NEAR_WORDS, cp.NEAR_PERCENT)})
    assert ids(stages[2]) == want and len(want) < len(rows)
    assert stages[2].columns == stages[0].columns


def test_decontamination_stage(spark, stages):
    items = [r.text.encode().lower().split() for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    grams = [{tuple(w[i:i + 4]) for i in range(len(w) - 3)} for w in items]
    clean = []
    for r in stages[2].collect():
        w = r.text.encode().lower().split()
        mine = {tuple(w[i:i + 4]) for i in range(len(w) - 3)}
        near = [x for x, g in zip(items, grams) if g & mine]  # a leak shares four words in a row
        if all(levenshtein_within(x, w) > dc.edits(len(x)) for x in near):
            clean.append(r.doc_id)
    assert ids(stages[3]) == sorted(clean) and len(clean) < stages[2].count()
    assert stages[3].columns == stages[0].columns


def test_packing_stage(stages):
    want = []
    for r in stages[3].collect():
        x = np.asarray(whole("bytes", r.text, 1), "<u4")
        want += [(r.doc_id, s, k, zlib.crc32(x[s:s + k].tobytes())) for s, k in packing.binary_pieces(len(x))]
    got = [(r.doc_id, r.start, r.length, r.ids_crc32) for r in stages[4].collect()]
    assert sorted(got) == sorted(want)


def test_edge_rows(spark):
    sf = "/root/testdata/sf0.001"
    text = " ".join(f"word{i}" for i in range(80))
    near = text.replace("word40", "other")
    rows = [(1, text, "en", "s", 1, "a"), (1, text, "en", "s", 1, "a"), (2, near, "en", "s", 1, "b"), (None, text, None, None, None, "c"),
            (1, "a different text under the same id " + " ".join(f"x{i}" for i in range(70)), "en", "s", 1, "d"),
            (3, None, "en", "s", 1, "e"), (4, "", "en", None, 1, "f"), (5, "short", "en", "s", 1, "g")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = cp.quality_stage(spark, docs, sf)
    assert kept.schema == docs.schema
    assert sorted(r.extra for r in kept.collect()) == ["a", "a", "b", "c", "d"]
    one = cp.near_duplicate_stage(spark, kept, sf)
    assert sorted(r.extra for r in one.collect()) == ["c", "d"]  # a null id comes first
    one = cp.near_duplicate_stage(spark, kept.where("doc_id IS NOT NULL"), sf)
    assert sorted(r.extra for r in one.collect()) == ["a", "d"]
    for _, f in cp.STAGES:
        assert f(spark, docs.limit(0), sf).count() == 0


def test_clashing_columns(spark):
    """Columns named like the stages' own helpers come through with their values."""
    sf = "/root/testdata/sf0.001"
    names = ["first", "copies", "_row", "_first", "_copies", "kept", "node", "label", "_group", "component_id"]
    text = " ".join(f"word{i}" for i in range(80))
    texts = [text, text, text.replace("word40", "other"), " ".join(f"x{i}" for i in range(70)), None]
    rows = [(i, t, "en", "s", *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    want = {0: rows[0], 3: rows[3]}
    for name, f in cp.STAGES[:3]:
        docs = f(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", *names]
        if name != "quality_rules":
            assert {r.doc_id: tuple(r) for r in docs.collect()} == want
    assert sorted({r.doc_id for r in cp.packing_stage(spark, docs, sf).collect()}) == [0, 3]
