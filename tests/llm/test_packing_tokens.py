import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagelake.llm import packing, token_files
from pagelake.llm.tokens import FileEncoder
from pagelake.session import fresh_dir

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TOKENIZERS = {"bytes": Tokenizer.from_file(BYTE), "words": Tokenizer.from_file(WORD)}
PATHS = {"bytes": BYTE, "words": WORD}
ODD = ["", " ", "\n", "  a", "a  ", "a \n b", "a\n\nb", "a\n\n b", "a \t  b", "x<|endoftext|>y", "it's 12 o'clock!!",
       "\x1c a", "é́ ñ", "ΣΑΣ ΟΔΟΣ", "a\r\nb", "don't   stop\n\n\n", "a b", "́a ́b", "12,345.6", ":\U0003d000", "日本語 テスト。", "Привет, мир! Ёж", "Ελληνικά Ά", "“quoted” – dash… €5", "한국어 글", "a\u0378b"]


def whole(kind, text, end):
    return TOKENIZERS[kind].encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_ids_equal_the_librarys(kind):
    enc = FileEncoder(PATHS[kind])
    assert enc.prepare is not None

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.one_of(st.text(alphabet="ab'sT1é \n\t\r .<|>!\x1c ", max_size=30), st.text(max_size=20),
                              st.sampled_from(ODD)), max_size=3))
    def check(texts):
        for t in texts:
            assert np.frombuffer(enc.encode(t), "<u4").tolist() == whole(kind, t, 0)[:-1], repr(t)

    check()


@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_every_latin_character(kind):
    enc = FileEncoder(PATHS[kind])
    for c in map(chr, range(256)):
        for t in (c, f"a{c}b", f"1{c}{c}'{c}s", f" {c} 's{c}", f"{c}'T!{c}É2²"):
            assert np.frombuffer(enc.encode(t), "<u4").tolist() == whole(kind, t, 0)[:-1], repr(t)


def test_binary_pieces():
    for n in [1, 2, 3, 7, 2047, 2048, 2049, 4096, 6143]:
        pieces = packing.binary_pieces(n)
        assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))]
        assert sum(k for _, k in pieces) == n
        assert all(k & (k - 1) == 0 and k <= 2048 for _, k in pieces)


ROWS = [(1, "the same text"), (1, "the same text"), (2, None), (None, "null id"), (3, ""), (4, "word " * 5000),
        (5, "\n".join(ODD)), (0, "first\n\nline")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, 7, 8, "x") for i, t in rows],
                                 "doc_id long, text string, start long, ids long, source string")


def test_pack_round_trip(spark):
    rows = packing.pack(frame(spark), BYTE).collect()
    docs = {}
    for r in sorted(rows, key=lambda r: r.sequence_id):
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length == 1 << r.bucket and r.offset == 0
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids.tolist()))
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, t in ROWS:
        ids = whole("bytes", t, 1)
        pieces = docs[i, len(ids)]
        copies = sum((i, t) == x for x in ROWS)
        assert sorted(pieces) == sorted(copies * [(s, ids[s:s + k]) for s, k in packing.binary_pieces(len(ids))])


def test_op1_digests_match_brute_force(spark):
    from pagelake.llm.queries import op1_pack_power_of_two

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(r.doc_id, r.start): r for r in op1_pack_power_of_two(spark, sf).collect()}
    want = {}
    for i, t in texts.items():
        ids = np.asarray(whole("bytes", t, 1), "<u4")
        for s, k in packing.binary_pieces(len(ids)):
            want[i, s] = (k, zlib.crc32(ids[s:s + k].tobytes()), len(ids))
    assert {k: (r.length, r.ids_crc32, r.doc_tokens) for k, r in got.items()} == want


def test_pack_empty_table_and_bad_length(spark):
    assert packing.pack(frame(spark, []), BYTE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame(spark), BYTE, seq_len=100)


def expected(rows, kind, end):
    out, at = [], 0
    for i, t in rows:
        ids = np.asarray(whole(kind, t, end), "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_round_trip(spark):
    path = token_files.write_token_files(frame(spark), fresh_dir(spark, "t"), WORD)
    got = token_files.with_crc(token_files.read_token_files(spark, path)).select(
        "doc_id", "start", "n_tokens", "ids_crc32").collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(order, "words", 2)
    ids = {r.start: r.ids for r in token_files.read_token_files(spark, path).collect()}
    assert ids[0] == whole("words", "null id", 2)


def test_token_files_layout(spark):
    import glob

    import pyarrow.parquet as pq

    path = token_files.write_token_files(frame(spark), fresh_dir(spark, "t"), WORD)
    files = [pq.ParquetFile(f) for f in glob.glob(path.removeprefix("file:") + "/part-*.parquet")]
    rows = [f for f in files if f.metadata.num_rows]
    assert rows
    for f in rows:
        group = f.metadata.row_group(0)
        cols = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        ids = next(c for n, c in cols.items() if n.startswith("ids"))
        assert any("DICTIONARY" in e for e in ids.encodings)
        assert "DELTA_BINARY_PACKED" in cols["n_tokens"].encodings
        assert all(c.has_column_index and c.has_offset_index for c in cols.values())
    plan = token_files.read_token_files(spark, path, ("n_tokens",))._jdf.queryExecution().toString()
    assert "ids" not in plan.split("Physical Plan")[1]


def test_token_files_empty(spark):
    path = token_files.write_token_files(frame(spark, []), fresh_dir(spark, "t"), WORD)
    assert token_files.read_token_files(spark, path).count() == 0


def test_op6_matches_brute_force(spark):
    from pagelake.llm.queries import op6_token_files

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = op6_token_files(spark, sf).orderBy(F.col("start")).collect()
    assert [tuple(r) for r in got] == expected(rows, "words", 2)
