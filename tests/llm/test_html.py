import itertools
import random

import numpy as np
import pytest

from pagelake.llm import extract_html as eh
from pagelake.llm.crf import LinearChain
from pagelake.llm.dom import blocks

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return eh.train(pages)


def article_text(page):
    """The article by an ordinary HTML parser, for pages whose markup is plain."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        depth, parts, out = 0, [], []

        def cut(self):
            if text := " ".join("".join(self.parts).split()):
                self.out.append(text)
            self.parts = []

        def handle_starttag(self, tag, attrs):
            if tag == "article":
                self.depth += 1
            if tag in ("p", "h1", "article"):
                self.cut()
            if tag == "br":
                self.parts.append(" ")

        def handle_endtag(self, tag):
            if tag in ("p", "h1", "article"):
                self.cut()
            if tag == "article":
                self.depth -= 1

        def handle_data(self, data):
            if self.depth:
                self.parts.append(data)

    p = P(convert_charrefs=True)
    p.parts, p.out = [], []
    p.feed(page)
    return "\n\n".join(p.out)


def test_op8_equals_articles(spark):
    from pagelake.llm.queries import op8_crf_main_text

    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op8_crf_main_text(spark, SF).collect()
    assert len(got) == len(html)
    for r in got:
        assert r.text == article_text(html[r.page_id]) and r.n_chars == len(r.text)


def test_held_out_accuracy(pages, model):
    r = random.Random(99)
    extractor = eh.Extractor(model)
    right = total = 0
    for row in pages.orderBy("page_id").collect():
        found = blocks(row.html)
        main = [b.text for b in found if eh.marked_label(b.path) == 1]
        page, labels = eh.compose(r, main[:6], [w for b in found for w in b.text.split()])
        kept = {b.text for b in extractor.main_blocks(page)}
        right += sum((b.text in kept) == bool(y) for b, y in zip(page, labels))
        total += len(page)
    assert right / total > 0.99


def test_blocks():
    got = blocks("<body><DIV class='A b-c'>x &amp; y&nbsp;z<br>w<p>one <b>two</b>three<p>four <a href=\"a>b\">link</a>"
                 "</div><!-- no --><script>var a='<p>no</p>';</script>5 < 6 &lt;p&gt; <ul><li>a<li>b</ul><p>open")
    assert [b.text for b in got] == ["x & y z w", "one twothree", "four link", "5 < 6 <p>", "a", "b", "open"]
    assert got[1].path[-2:] == (("div", ("a", "b", "c")), ("p", ())) and got[2].linked == 4
    assert got[4].path[-2:] == got[5].path[-2:] == (("ul", ()), ("li", ()))
    assert blocks(None) == blocks("") == blocks(" <p> </p>") == []
    assert [b.text for b in blocks("<p>a<!-- never closed <p>b")] == ["a"]
    assert [b.text for b in blocks("<p title='x>a</p><p>b")] == ["a", "b"]
    assert len(blocks("<div>" * 3000 + "deep" + "<" * 50_000)) == 1


def test_open_and_self_closed_elements_lose_nothing():
    def texts(page):
        return [b.text for b in blocks(page)]

    page = "<meta charset=utf-8><title>t</title><script>x<p></script>{}<article><p>one</p><p>two</p></article>"
    for end in ("</head>", "</head><body>", "<body>", "\n", "<link rel=x>"):
        assert texts("<!doctype html><html><head>" + page.format(end)) == ["one", "two"]
    assert texts("<head><title>t</title>loose<p>one") == ["loose", "one"]
    assert texts("<p>a<head><p>b") == ["a", "b"]
    for void in ("<svg/>", "<svg viewBox='0 0 1 1' />", '<svg class="a"/>', "<math/>", "<object data='x' />", "<svg hidden/>"):
        assert texts(f"<article><p>a {void} b</p><p>c</p></article><svg><text>no</text></svg><p>d") == ["a b", "c", "d"]
    assert texts("<p>a<svg><title>no</title><style/><text>no</text><svg>no</svg>no</svg>b") == ["ab"]
    assert texts("<p>a<svg><path d='x'><p>b</p><svg>no</svg><p>c") == ["a", "b", "c"]
    assert texts("<article><svg class=a/ ><text>no</article><p>b") == ["b"]
    assert texts("<p>a<svg><foreignObject><p>no</p><div>no</div></foreignObject>no</svg>b") == ["ab"]
    assert texts("<div><object><div>no</div><p>no</object>a</div>b") == ["a", "b"]
    assert texts("<div><object><p>no</div>b<object>no</object>") == ["b"]
    for raw in ("script", "style", "noscript", "template", "title", "textarea", "iframe", "object"):
        assert texts(f"<p>a<{raw} x>b<p>c") == ["ab", "c"]
        assert texts(f"<p>a<{raw}><p>no</{raw.upper()} >b<p>c") == ["ab", "c"]
        assert len(blocks(f"<{raw}>" * 20_000 + "a")) == 1
    assert blocks("<object>" * 3000 + "</object>") == blocks("<svg>" * 3000 + "no") == []


def test_crf_against_enumeration():
    r = random.Random(3)
    sequences = [[[r.choice("ab"), r.choice("cd")] for _ in range(r.randrange(1, 6))] for _ in range(40)]
    labels = [[int("a" in b) if r.random() < 0.9 else 0 for b in s] for s in sequences]
    model = LinearChain().fit(sequences, labels, rounds=60)
    for s in sequences:
        scores = [tuple(model.emit[model.rows(b)].sum(0)) for b in s]

        def value(ys):
            return model.first[ys[0]] + sum(scores[i][y] for i, y in enumerate(ys)) + sum(
                model.step[x, y] for x, y in zip(ys, ys[1:]))

        best = max(itertools.product((0, 1), repeat=len(s)), key=value)
        assert np.isclose(value(best), value(model.decode(scores)))
    assert LinearChain().fit([], []).decode([]) == []


def test_edge_rows(spark, model):
    rows = [(1, "u", "<article><p>Some words of text here.</p></article>", "x"), (1, "u", "<article><p>Some words of text here.</p></article>", "x"),
            (None, None, None, "x"), (2, None, "", "x"), (3, "v", "<nav><a>Home</a></nav>", "x"),
            (4, "w", "<article>" + "<p>Long page with words.</p>" * 20_000 + "</article>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, eh.extract_main_text(df, model).collect()), key=str)
    text = "Some words of text here."
    assert got[:2] == [(1, "u", text, 1)] * 2
    assert {g[0]: g[2] for g in got if g[0] in (None, 2, 3)} == {None: "", 2: "", 3: ""}
    assert next(g for g in got if g[0] == 4)[3] == 20_000
    assert eh.extract_main_text(df.limit(0)).count() == 0
    assert eh.extract_main_text(df.where("page_id = 3")).count() == 1
