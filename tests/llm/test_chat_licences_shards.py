import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagelake.llm import chat, licences, sharding


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<\\|>ab\n%0A25imend_", max_size=40))
def test_escape_round_trip(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text
    role = chat.escape_role(text)
    assert chat.unescape_role(role) == text and "\n" not in role and "<|" not in role


TURNS = [(1, 0, "system", "be <|im_start|> kind"), (1, 1, "user", None), (1, 2, "assistant", "a<\\|b"),
         (1, 2, "assistant", "a<\\|b"), (1, None, "user", "first"), (None, 0, None, "x"), (2, 0, "ro\nle%0A", "")]


def test_read_back(spark):
    df = spark.createDataFrame([(*t, "clash") for t in TURNS],
                               "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_messages(chat.text_parts(df))
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert set(got) == {1, None, 2}
    order = [("user", "first"), ("system", "be <|im_start|> kind"), ("user", ""), ("assistant", "a<\\|b"), ("assistant", "a<\\|b")]
    assert got[1].n_turns == 5 and got[1].loss_chars == 10
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in order).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"a<\\|ba<\\|b").hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"ro\nle%0A\n\n").hexdigest()
    assert got[None].n_turns == 1
    assert chat.format_messages(chat.text_parts(df.limit(0))).count() == 0


def test_typed_parts(spark):
    rows = [(1, 0, "user", [("text", "see <", None, None, None, None, None), ("text", "|this|>", None, None, None, None, None),
                            ("image", None, "img://a", 600, 500, None, None), ("audio", None, "aud://b", None, None, 1.5, None),
                            ("document", None, "doc://c", None, None, None, 3), ("text", "end", None, None, None, None, None)]),
            (1, 1, "assistant", [("text", "yes", None, None, None, None, None), ("image", None, None, None, None, None, None),
                                 ("text", " no", None, None, None, None, None)]),
            (1, 2, "assistant", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>")
    r = chat.format_messages(df).first()
    assert r.formatted == ("<|im_start|>user\nsee <\\|this|><|image:0|><|audio:1|><|document:2|>end<|im_end|>\n"
                           "<|im_start|>assistant\nyes<|image:3|> no<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert [(a.number, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, "image", "img://a", 340), (1, "audio", "aud://b", 38), (2, "document", "doc://c", 1500), (3, "image", None, 170)]
    assert r.extra_tokens == 340 + 38 + 1500 + 170
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans] == ["yes", " no"]
    assert chat.parse(r.formatted)[0][1] == "see <|this|><|image:0|><|audio:1|><|document:2|>end"
    bad = spark.createDataFrame([(1, 0, "user", [("video", None, None, None, None, None, None)])], df.schema)
    with pytest.raises(Exception, match="unknown content part"):
        chat.format_messages(bad).collect()


def test_licences(spark):
    mit = next(t for i, t in licences.KNOWN if i == "MIT" and len(t) > 500)
    changed = "Copyright (c) 2021 Someone\n" + mit.upper().replace("SUBLICENSE", "SUBLICENCE").replace(",", ";") + "\n(c) x\n"
    rows = [(1, changed, 1), (2, "code\n# Licensed under CC BY-NC 4.0\nmore\nLicenced under the Apache Licence, version 2.0", 1),
            (3, None, 1), (4, "", 1), (5, "... !!", 1), (6, "Licensed under CC BY-NC 4.0. And more words", 1),
            (2, "code\n# Licensed under CC BY-NC 4.0\nmore\nLicenced under the Apache Licence, version 2.0", 1),
            (None, "Released under the MIT License.", 1), (7, "Released under the MIT License.\n" * 2000 + "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    got = licences.scan_licences(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].licence == "MIT"
    assert by[2].licence is None and by[2].notices == "Apache-2.0|CC-BY-NC-4.0" and by[2].n_notices == 2
    assert all(by[k].licence is None and by[k].notices == "" for k in (3, 4, 5, 6))
    assert by[None].licence == "MIT" and by[None].n_notices == 1
    assert by[7].n_notices == 2000 and by[7].licence is None
    assert licences.scan_licences(df.limit(0)).count() == 0


def test_wrapping_does_not_matter(spark):
    """Known texts on one line, and their paragraphs wrapped anywhere, are known."""
    import re
    import textwrap

    rows, want = [], {}
    for licence, text in licences.KNOWN:
        paragraphs = re.split(r"\n\s*\n", text)
        forms = [text, " ".join(text.split())]
        # lines of its own copyright stay lines, other paragraphs are wrapped
        for width in (30, 45, 60, 72, 100, 10**6):
            forms.append("Copyright 2020 Some One\n\n" + "\n\n".join(
                t if re.search(r"copyright (\(c\)|\[)|all rights reserved", t.lower()) else textwrap.fill(
                    " ".join(t.split()), width, break_long_words=False, break_on_hyphens=False) for t in paragraphs))
        for f in forms:
            want[len(rows)] = licence
            rows.append((len(rows), f))
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, want[r.doc_id], rows[r.doc_id][1][:300]) for r in got if r.licence != want[r.doc_id]] == []
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"} <= set(want.values())


def test_copyright_lines(spark):
    line = "Released under the MIT License."
    dropped = ["Copyright (c) 2021 Someone", "copyright 1999-2004, X", "# Copyright by X", "Copyright © X", "© X", "(c) 2020 X",
               "(C) x", "Copyright Someone, 2020", "Copyright The Go Authors.", "// All rights reserved.", "Copyright [yyyy] [name]",
               "Copyright Facebook, Inc. and its affiliates."]
    kept = ["copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM",
            "(c) You must retain, in the Source form of any Derivative Works", "all rights reserved to the licensor by law"]
    rows = [(i, f"{t}\n{line}") for i, t in enumerate(dropped + kept)]
    got = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got if r.licence == "MIT") == list(range(len(dropped)))


def test_shards(spark):
    rows = [(i, None if i % 7 == 0 else f"s{min(i % 9, 3)}", None if i == 5 else "t" * (i % 13), 1) for i in range(500)]
    rows += [(None, "s1", "x", 1), (3, "s3", "ttt", 1), (3, "s3", "ttt", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int")
    got = sharding.shard_documents(df, shards=8).collect()
    assert len(got) == len(rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    sizes = [len(v) for v in shards.values()]
    assert max(sizes) - min(sizes) <= 1 and sorted(shards) == list(range(8))
    for v in shards.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
        for s in {r.source for r in got}:
            share = sum(r.source == s for r in got) / 8
            assert abs(sum(r.source == s for r in v) - share) <= 2
    again = sharding.shard_documents(df.repartition(5), shards=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sharding.shard_documents(df.limit(0)).count() == 0
    few = sharding.shard_documents(df.limit(3), shards=8).collect()
    assert len({(r.shard, r.slot) for r in few}) == 3 and all(r.slot == 0 for r in few)


def test_licence_lines_looked_up_by_anchor(spark):
    """Leaving out lines without an anchor word changes nothing; holders of any length make a copyright line."""
    mit = next(t for i, t in licences.KNOWN if i == "MIT" and len(t) > 500)
    rows = [(k, t) for k, t in enumerate([
        "LICENCED UNDER CC-BY-NC 4.0.\nplain line\nwithout a match\nlicense", " ".join(mit.split()), "no such word\nhere", "", None,
        f"Copyright {'Very Long Holder Name ' * 20} 2011\n{mit}", f"(c) {'Very Long Holder Name ' * 20}, 2011.\n{mit}"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = licences.known_digests(spark)
    assert known.where("anchor IS NULL").isEmpty()
    got = sorted(map(tuple, licences.scan_licences(df, known).collect()))
    assert got == sorted(map(tuple, licences.scan_licences(df, known.drop("anchor")).collect()))
    assert [(r[0], r[2], r[3]) for r in got] == [(0, None, "CC-BY-NC-4.0"), (1, "MIT", "MIT"), (2, None, ""), (3, None, ""),
                                                 (4, None, ""), (5, "MIT", ""), (6, "MIT", "")]
    strange = licences.known_digests(spark, [("X", "üä ö"), ("Y", "Some Words")])
    assert [r.notices for r in licences.scan_licences(spark.createDataFrame([(1, "üä, ö\nsome words")], df.schema),
                                                      strange).collect()] == ["X|Y"]
