"""Main-text extraction: a linear-chain CRF over DOM leaf blocks.

Each leaf block is described by its ancestors' tags and class/id/role words
and by its text; the chain's labels (main text or not) are decoded by Viterbi.

The CRF is trained on labelled pages: a bounded sample of ``SAMPLE`` rows,
labelled where the markup itself says what a block is (``article`` against
``nav``, ``footer``, adverts, ...), and for each of them ``VARIANTS`` pages
composed from its paragraphs with known labels: the same text under other
containers, with headers, menus, sidebars, notices, adverts, forms, comments
and footers named in the many ways pages name them.
"""

from __future__ import annotations

import html as html_lib
import random
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.crf import LinearChain
from pagelake.llm.dom import Block, blocks

SAMPLE = 150
VARIANTS = 4
SEED = 20_240_613
# Words in class, id and role names.
BOILER = frozenset("""ad ads advert advertisement advertising adsense aside banner bar bottom breadcrumb breadcrumbs button
byline caption category comment comments consent contact cookie cookies copyright crumbs date disclaimer discussion
disqus dropdown feedback foot footer form gdpr head header hidden link links login logo masthead menu meta modal
nav navbar navigation newsletter notice notification outbrain overlay pager pagination paywall popup post-meta privacy
promo promoted promotion rail rating recommend recommended register related reply replies respond review reviews rss
search share sharing sidebar sidebars signup sitemap skip social sponsor sponsored subscribe subscription tag tags
taboola teaser toolbar tools top topbar trending tweet user widget widgets""".split())
CONTENT = frozenset("""article articlebody body content copy entry hentry main maincontent page paragraph post prose read
single story storybody text""".split())
MARKED = {"article": 1, "main": 1, "nav": 0, "footer": 0, "header": 0, "aside": 0, "form": 0}


def marked_label(path) -> int | None:
    """What the markup says of a block: by its innermost telling ancestor."""
    for tag, names in reversed(path):
        if any(n in BOILER for n in names):
            return 0
        if tag in MARKED:
            return MARKED[tag]
    return None


def path_features(path) -> list[str]:
    out = [f"inner:{marked_label(path)}"]
    for depth, (tag, names) in enumerate(reversed(path)):
        if tag in ("html", "body"):
            continue
        place = "own" if depth == 0 else "up"
        out.append(f"{place}:{tag}")
        out += [f"name:{n}" for n in names]
        if any(n in BOILER for n in names):
            out += ["boiler", f"boiler:{min(depth, 3)}"]
        elif any(n in CONTENT for n in names):
            out += ["content", f"content:{min(depth, 3)}"]
    return out


def text_features(b: Block) -> list[str]:
    n = b.text.count(" ") + 1
    out = ["bias", f"words:{n.bit_length()}", f"links:{min(4, 4 * b.linked // len(b.text))}"]
    if b.text[-1] in ".!?…\"'”»":
        out.append("stop")
    if "©" in b.text:
        out.append("copyright")
    if "|" in b.text or "·" in b.text:
        out.append("bars")
    return out


def features(b: Block) -> list[str]:
    return path_features(b.path) + text_features(b)


def compose(r: random.Random, paragraphs: list[str], words: list[str]) -> list[tuple[list[Block], list[int]]]:
    """A page with known labels.  Every block is written by ``put``, which
    keeps its label; the page is then parsed like any other."""
    label_of: dict[str, int] = {}
    out: list[str] = []

    def put(tag: str, text: str, label: int, link: bool = False) -> None:
        text = f"{text} {len(label_of)}"  # made distinct, so that its label is found again
        label_of[text] = label
        inner = html_lib.escape(text)
        out.append(f"<{tag}>" + (f'<a href="#">{inner}</a>' if link else inner) + f"</{tag}>")

    def some(lo: int, hi: int) -> str:
        return " ".join(r.choice(words) for _ in range(r.randint(lo, hi)))

    def inside(tags: list[str], fill) -> None:
        tag = r.choice(tags)
        out.append(f"<{tag}>")
        fill()
        out.append(f"</{tag.split()[0]}>")

    def named(tag: str, *names: str) -> list[str]:
        return [f'{tag} {r.choice(["class", "class", "id"])}="{r.choice(["", "", "site-", "page-", "main-", "c-"])}{n}"'
                for n in names]

    def menu() -> None:
        inside(["nav", *named("div", "menu", "nav", "navbar", "navigation", "breadcrumbs", "topbar")], lambda: inside(
            ["ul", "ol"], lambda: [put("li", some(1, 3), 0, r.random() < 0.9) for _ in range(r.randint(2, 7))]))

    def header() -> None:
        def fill():
            put(r.choice(["h1", "div", "p"]), some(1, 4), 0, r.random() < 0.5)
            if r.random() < 0.5:
                put("p", some(3, 10), 0)
        inside(["header", *named("div", "header", "masthead", "banner", "logo")], fill)

    def short(tags: list[str]):
        return lambda: inside(tags, lambda: [put(r.choice(["p", "div", "li"]), some(3, 30), 0, r.random() < 0.2)
                                             for _ in range(r.randint(1, 3))])

    advert = short(named("div", "ad", "ads", "advert", "advertisement", "promo", "sponsored", "banner-ad"))
    notice = short(named("div", "notice", "cookie-notice", "cookie-banner", "consent", "gdpr", "notification", "disclaimer"))
    side = short(["aside", "aside", *named("div", "sidebar", "related", "widget", "rail", "trending", "recommended", "share")])

    def form() -> None:
        inside(["form", *named("form", "search", "newsletter", "login", "subscribe")], lambda: [
            put(r.choice(["label", "p", "div", "button"]), some(1, 8), 0) for _ in range(r.randint(1, 4))])

    def comments() -> None:
        def each():
            for _ in range(r.randint(1, 5)):
                inside(named("div", "comment", "reply", "comment-body", "review") + ["li class=\"comment\"", "li"], lambda: [
                    put("p", some(5, 60) + r.choice(["", "."]), 0) for _ in range(r.randint(1, 2))])
        inside(named("div", "comments", "comment-list", "discussion", "responses", "disqus") +
               named("section", "comments", "replies", "reviews") + ["ol class=\"comments\""], each)

    def footer() -> None:
        inside(["footer", *named("div", "footer", "copyright", "bottom")], lambda: put("p", r.choice(["© ", ""]) + some(3, 25), 0))

    def article() -> None:
        put(r.choice(["h1", "h2", "div"]), some(3, 12), 1)
        for text in paragraphs:
            if r.random() < 0.06:
                r.choice([advert, advert, side, notice, form])()
            if r.random() < 0.08:
                put(r.choice(["h2", "h3"]), some(1, 6), 1)
            if r.random() < 0.08:
                inside(["ul", "ol"], lambda: [put("li", some(1, 20), 1) for _ in range(r.randint(2, 4))])
            put("blockquote" if r.random() < 0.05 else "div" if r.random() < 0.05 else "p", text, 1)

    def body() -> None:
        kinds = ["article", "main", *named("div", "article", "content", "post", "entry", "story", "main", "text"),
                 *named("section", "content", "article"), "article class=\"post\"", "section", "div"]
        inside(kinds, article)

    def bits(fns, share):
        for f in r.sample(fns, len(fns)):
            if r.random() < share:
                f()

    bits([menu, header, notice, advert, form], 0.5)
    wrap = ["div", *named("div", "wrapper", "container", "page", "layout"), "main"]
    inside(wrap, lambda: (bits([menu, side, advert], 0.25), body(), bits([comments, side, advert, form], 0.45)))
    bits([side, comments, advert, notice, form], 0.3)
    if r.random() < 0.9:
        footer()
    page = blocks("<html><body>" + "".join(out) + "</body></html>")
    return page, [label_of[b.text] for b in page]


def labelled(pages: list[str]) -> tuple[list[list[Block]], list[list[int]]]:
    """Labelled pages from the sampled ones."""
    r = random.Random(SEED)
    sequences, labels = [], []
    for page in pages:
        found = blocks(page)
        marks = [marked_label(b.path) for b in found]
        if found and None not in marks:
            sequences.append(found)
            labels.append(marks)
        main = [b.text for b, y in zip(found, marks) if y == 1]
        words = [w for b in found for w in b.text.split()]
        if not main or not words:
            continue
        for _ in range(VARIANTS):
            few = [" ".join(t.split()[:80]) for t in r.sample(main, min(len(main), r.randint(1, 8)))]
            page_blocks, ys = compose(r, few, words)
            sequences.append(page_blocks)
            labels.append(ys)
    return sequences, labels


def train(pages: DataFrame) -> LinearChain:
    """The CRF of a table of pages: the ``SAMPLE`` distinct pages with the
    smallest hashes (bounded, whatever the table's size) are labelled.  Only
    hashes travel to find them; copies of a page are one."""
    hashed = pages.select(F.col("html").cast("string").alias("html")).where("html <> ''") \
        .withColumn("h", F.xxhash64("html"))
    chosen = [row["h"] for row in hashed.select("h").distinct().orderBy("h").limit(SAMPLE).collect()]
    sample = hashed.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect()
    sequences, labels = labelled([row["html"] for row in sample])
    return LinearChain().fit([[features(b) for b in s] for s in sequences], labels)


class Extractor:
    """Labels a page's blocks; path scores are remembered."""

    def __init__(self, model: LinearChain):
        self.model = model
        self.emit = model.emit.tolist()
        self.paths: dict = {}

    def _sum(self, names: list[str]) -> tuple[float, float]:
        rows = [self.emit[i] for i in self.model.rows(sorted(set(names)))]
        return sum(x for x, _ in rows), sum(y for _, y in rows)

    def main_blocks(self, found: list[Block]) -> list[Block]:
        scores = []
        for b in found:
            if (p := self.paths.get(b.path)) is None:
                if len(self.paths) > 20_000:
                    self.paths.clear()
                p = self.paths[b.path] = self._sum(path_features(b.path))
            q = self._sum(text_features(b))
            scores.append((p[0] + q[0], p[1] + q[1]))
        return [b for b, y in zip(found, self.model.decode(scores)) if y]

    def text(self, page: str | None) -> str:
        return "\n\n".join(b.text for b in self.main_blocks(blocks(page)))


def extract_main_text(pages: DataFrame, model: LinearChain | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_blocks`` (main blocks) for every row
    of ``pages``; ``model`` defaults to one trained on the table itself.

    Null, empty and blank html give an empty text; broken markup is read as
    far as it goes; whole pages are parsed.  Repeated rows and null ids or
    urls keep rows of their own.  Other columns are ignored; an empty table
    gives no rows.  One pass, no shuffle; a page is the unit of memory.
    """
    if model is None:
        model = train(pages)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    source = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_blocks long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pagelake.llm.tokens import slices

        extractor = Extractor(shared.value)
        for b in slices(batches, column=2):
            main = [extractor.main_blocks(blocks(h)) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(["\n\n".join(x.text for x in m) for m in main], pa.string()),
                 pa.array([len(m) for m in main], pa.int64())], names=["page_id", "url", "text", "n_blocks"])

    return source.withColumn("url", F.col("url").cast("string")).select("page_id", "url", "html").mapInArrow(run, schema)
