"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document leaks an item when some run of its words is within ``EDIT_PERCENT``
percent of the item's words in edit distance (word insertions, deletions and
substitutions; words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased).

The CGK embedding walks a string once: at step ``j`` it writes the symbol
under the pointer and advances by a random bit that depends on ``j`` and the
symbol, so strings at a small edit distance fall into step and differ in few
of the written places.  Each of ``TABLES`` tables has a walk of its own and
samples ``SAMPLES`` places; windows of the item's length whose samples equal
the item's are candidates.  Candidates are then verified by exact alignment.

Only windows that can match are embedded: an edit breaks at most two of the
item's ``n - 1`` word pairs and three of its ``n - 2`` triples, so a window
within ``k`` edits keeps ``n - 1 - 2k`` and ``n - 2 - 3k`` of them.  Both
counts are running sums over the whole text, refined by the items' lengths,
and lose nothing.  Runs too near the end of their text for a window of the
item's length (texts shorter than the item are all end) are not embedded: the
items that share enough word pairs with the end are aligned with it.

Texts are read where they lie; nothing is shuffled.  Items are broadcast in
blocks of ``ITEM_BLOCK`` items and ``BLOCK_WORDS`` words at most, one scan per
block, so their number is not limited.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.shingles import column_words, gram_hashes, mix, word_hashes

EDIT_PERCENT = 20
MIN_WORDS = 5             # shorter items identify nothing and are not searched
SAMPLES = 3
TABLES = 48
GRAM_BITS = 20            # of the tables of the items' pairs and triples: which lengths have them
ITEM_BLOCK = 20_000
BLOCK_WORDS = 2_000_000
EMBEDDED = 500            # windows embedded at a time
SEED = 20_240_611
_PAD = np.uint64(0)


def edits(n: int) -> int:
    return n * EDIT_PERCENT // 100


def align(item: list, text: list) -> tuple[int, int, int]:
    """(distance, start, end) of the run of ``text`` nearest to ``item``: the
    smallest distance, then the first end, then the shortest run."""
    prev = [(0, -j) for j in range(len(text) + 1)]  # (cost, -start): ties prefer the later start
    for i, x in enumerate(item, 1):
        row = [(i, 0)]
        for j, y in enumerate(text, 1):
            row.append(min((prev[j - 1][0] + (x != y), prev[j - 1][1]), (prev[j][0] + 1, prev[j][1]),
                           (row[j - 1][0] + 1, row[j - 1][1])))
        prev = row
    cost, end = min((c, j) for j, (c, _) in enumerate(prev))
    return cost, -prev[end][1], end


class Scanner:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple]):
        """``items``: (id, word hashes as an array)."""
        rng = np.random.default_rng(SEED)
        self.items = items
        by_length: dict[int, list[int]] = {}
        for k, (_, h) in enumerate(items):
            by_length.setdefault(len(h), []).append(k)
        self.lengths = sorted(by_length)
        self.grams = {g: np.zeros(1 << GRAM_BITS, np.uint64) for g in (2, 3)}
        for _, h in items:
            for g, marks in self.grams.items():
                marks[self._slots(h, g)] |= self._mark(len(h))
        self.walks = rng.integers(1, 1 << 63, size=TABLES, dtype=np.uint64)
        self.places = {n: np.sort(rng.integers(0, 2 * n, size=(TABLES, SAMPLES)), axis=1) for n in self.lengths}
        self.tables: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.pairs: dict[int, dict[int, list[int]]] = {}
        for n, ks in by_length.items():
            table = self.tables[n] = {}
            pairs = self.pairs[n] = {}
            for k in ks:
                for x in set(gram_hashes(items[k][1], 2).tolist()):
                    pairs.setdefault(x, []).append(k)
            for lo in range(0, len(ks), EMBEDDED):
                part = ks[lo:lo + EMBEDDED]
                keys = self.keys(np.stack([items[k][1] for k in part]))
                for r in range(TABLES):
                    for k, key in zip(part, keys[r].tolist()):
                        table.setdefault((r, key), []).append(k)
        # lengths in classes of up to 5/4, each counted with its smallest window and largest number of edits
        self.classes: list[list[int]] = []
        for n in self.lengths:
            if self.classes and 4 * n <= 5 * self.classes[-1][0]:
                self.classes[-1].append(n)
            else:
                self.classes.append([n])

    def _mark(self, n: int) -> np.uint64:
        return np.uint64(1 << (self.lengths.index(n) % 64))

    @staticmethod
    def _slots(h: np.ndarray, g: int) -> np.ndarray:
        return (gram_hashes(h, g) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """Sampled CGK embedding of each window, in every table."""
        count, n = windows.shape
        padded = np.concatenate([windows, np.full((count, 1), _PAD)], axis=1).ravel()
        base = np.arange(count) * (n + 1)
        at = np.broadcast_to(base, (TABLES, count)).copy()
        end = base + n
        steps = [mix(padded + self.walks[:, None] + np.uint64(s)) for s in range((2 * n + 63) // 64)]
        flat = [s.ravel() for s in steps]
        row = np.arange(TABLES)[:, None] * len(padded)
        key = np.zeros((TABLES, count), np.uint64)
        taken = [np.flatnonzero((self.places[n] == j).any(axis=1)) for j in range(2 * n)]
        for j in range(2 * n):
            if len(taken[j]):
                key[taken[j]] = mix(key[taken[j]] ^ padded[at[taken[j]]]) + np.uint64(j)
            bits = (flat[j // 64][row + at] >> np.uint64(j % 64)) & np.uint64(1)
            at = np.minimum(at + bits.astype(np.int64), end)
        return key

    def candidates(self, h: np.ndarray, bound: np.ndarray) -> list[tuple[int, int]]:
        """(start, item) for the texts whose words ``h`` are laid end to end;
        ``bound`` is each word's end of text."""
        if not self.lengths or len(h) < self.lengths[0] - edits(self.lengths[0]):
            return []
        marks, sums = {}, {}
        for g, table in self.grams.items():
            marks[g] = np.where(bound[g - 1:] == bound[:1 - g], table[self._slots(h, g)], np.uint64(0))
            sums[g] = np.concatenate([[0], np.cumsum(marks[g] != 0)])
        found = self._ends(h, bound, sums)
        for lengths in self.classes:
            lo, k = lengths[0], edits(lengths[-1])
            if len(h) < lo:
                continue
            near = np.flatnonzero(np.logical_and.reduce([
                s[lo - g + 1:] - s[:len(s) - lo + g - 1] >= lo - g + 1 - g * k for g, s in sums.items()]))
            for n in lengths:
                mine = near[near + n <= bound[near]]
                for g, s in sums.items():
                    least = n - g + 1 - g * edits(n)
                    mine = mine[s[mine + n - g + 1] - s[mine] >= least]
                    own = [((marks[g][part[:, None] + np.arange(n - g + 1)] & self._mark(n)) != 0).sum(axis=1)
                           for part in np.array_split(mine, len(mine) // 5_000 + 1)]
                    mine = mine[np.concatenate(own) >= least]
                found += self._look_up(h, mine, n)
        return sorted(found, key=lambda x: (x[1], x[0]))

    def _ends(self, h: np.ndarray, bound: np.ndarray, sums: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        """(start, item) for the ends of texts, one word shorter than the item
        at most, that keep as many of its pairs and triples as ``edits`` leave."""
        stops = np.unique(bound)
        starts = np.concatenate([[0], stops[:-1]])
        found = []
        for n in self.lengths:
            lo = np.maximum(starts, stops - n + 1)
            long = stops - lo >= n - edits(n)
            lo, hi = lo[long], stops[long]
            for g, s in sums.items():
                near = s[hi - g + 1] - s[lo] >= n - g + 1 - g * edits(n)
                lo, hi = lo[near], hi[near]
            for a, b in zip(lo.tolist(), hi.tolist()):
                shared = Counter(k for x in gram_hashes(h[a:b], 2).tolist() for k in self.pairs[n].get(x, ()))
                found += [(a, k) for k, c in shared.items() if c >= n - 1 - 2 * edits(n)]
        return found

    def _look_up(self, h: np.ndarray, starts: np.ndarray, n: int) -> list[tuple[int, int]]:
        """(start, item) of the windows of ``n`` words that share a table key
        with an item; equal windows are embedded once."""
        if not len(starts):
            return []
        sums = np.zeros(len(starts), np.uint64)
        for j in range(n):
            sums = mix(sums + h[starts + j])
        _, first, same = np.unique(sums, return_index=True, return_inverse=True)
        items: list[set[int]] = [set() for _ in first]
        table = self.tables[n]
        for lo in range(0, len(first), EMBEDDED):
            keys = self.keys(h[starts[first[lo:lo + EMBEDDED], None] + np.arange(n)])
            for r in range(TABLES):
                for k, key in enumerate(keys[r].tolist(), lo):
                    items[k].update(table.get((r, key), ()))
        return [(p, item) for p, k in zip(starts.tolist(), same.tolist()) for item in items[k]]

    def scan(self, column) -> list[list[tuple]]:
        """For each row of an Arrow text column its leaks (item id, start
        word, words, distance): the nearest place of each item."""
        h, sizes = column_words(column)
        size = np.concatenate([[0], np.cumsum(sizes)])
        bound = np.repeat(size[1:], sizes)
        regions: dict[tuple[int, int], list[list[int]]] = {}
        for p, item in self.candidates(h, bound):
            n, text = len(self.items[item][1]), int(np.searchsorted(size, p, side="right")) - 1
            lo, hi = max(int(size[text]), p - edits(n)), min(int(size[text + 1]), p + n + edits(n))
            spans = regions.setdefault((text, item), [])
            if spans and lo <= spans[-1][1] and hi - spans[-1][0] <= 4 * n:
                spans[-1][1] = max(hi, spans[-1][1])
            else:
                spans.append([lo, hi])
        out: list[list[tuple]] = [[] for _ in sizes]
        for (text, item), spans in regions.items():
            name, words = self.items[item]
            best = None
            for lo, hi in spans:
                d, a, b = align(words.tolist(), h[lo:hi].tolist())
                if d <= edits(len(words)) and (best is None or d < best[0]):
                    best = (d, lo - int(size[text]) + a, b - a)
                if best and best[0] == 0:
                    break
            if best:
                out[text].append((name, best[1], best[2], best[0]))
        return out


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items with enough words, in blocks of bounded size: (id, text)."""
    n = F.size(F.split(F.col("text"), r"[\x20\x09-\x0D]+"))
    sized = items.select("item_id", F.col("text").cast("string").alias("text"), n.alias("n")).where("n > 0")
    total = sized.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("words"),
                      F.coalesce(F.max("n"), F.lit(0)).alias("longest")).first()
    blocks = max(1, -(-total["items"] // (ITEM_BLOCK // 2)), -(-total["words"] // (BLOCK_WORDS // 2)))
    for k in range(blocks):  # a block holds half its bounds on average
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).select("item_id", "text").collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def _scanner(shared, held: dict) -> Scanner:
    """The block's scanner, built once per task."""
    if "s" not in held:
        hashed = [(i, word_hashes(t)) for i, t in shared.value]
        held["s"] = Scanner([x for x in hashed if len(x[1]) >= MIN_WORDS])
    return held["s"]


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Leaks: ``doc_id``, ``item_id``, ``start_word``, ``n_words``,
    ``distance``; one row per document and item, at the nearest place.

    Null and empty texts leak nothing and are never leaked; items of fewer
    than ``MIN_WORDS`` words are not searched.  Repeated documents and items
    give repeated rows.  Null ids stay null.  Other columns are ignored; an
    empty table on either side gives no rows.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("start_word", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("distance", T.LongType())])
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def search(shared):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            from pagelake.llm.tokens import slices

            held: dict = {}
            for b in slices(batches):
                rows = [(i, *leak) for i, leaks in enumerate(_scanner(shared, held).scan(b.column(1)))
                        for leak in leaks]
                if not rows:
                    continue
                row, item, start, n, d = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(item, items_type), pa.array(start, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(d, pa.int64())], names=[f.name for f in schema.fields])

        return run

    from pyspark.sql.pandas.types import to_arrow_type

    items_type = to_arrow_type(schema["item_id"].dataType)
    sc = docs.sparkSession.sparkContext
    parts = [source.mapInArrow(search(sc.broadcast(block)), schema) for block in item_blocks(items)]
    return reduce(DataFrame.union, parts)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that leak no item, with all their columns unchanged."""
    def clean(shared, at):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            from pagelake.llm.tokens import slices

            held: dict = {}
            for b in slices(batches, column=at):
                leaks = _scanner(shared, held).scan(b.column(at))
                yield b.filter(pa.array([not x for x in leaks], pa.bool_()))

        return run

    sc = docs.sparkSession.sparkContext
    for block in item_blocks(items):
        docs = docs.mapInArrow(clean(sc.broadcast(block), docs.columns.index("text")), docs.schema)
    return docs
