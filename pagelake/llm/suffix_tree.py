"""Language-model scoring with a probabilistic suffix tree.

Symbols are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end per
text; a text begins after a begin mark, which is a context but never a symbol.

* Root: absolute discounting over all training words; the freed mass is the
  probability of one unknown symbol.
* Candidate contexts are all words and word pairs that occur twice at least.  A
  context's next-symbol distribution keeps the symbols that follow it twice at
  least, discounted; what is left is shared in proportion to its suffix's
  distribution.  ``P_MIN`` and ``GAMMA_MIN`` are relative frequencies below
  which contexts and kept symbols are left out; they are 0, so none is.
* Divergence test: a context is retained if its count times the
  Kullback-Leibler divergence from its suffix's distribution (over the kept
  symbols and the rest) reaches ``DIVERGENCE``; the suffix of a retained pair
  is retained too.
* A symbol is scored in the state of the longest retained suffix of the text
  before it.

Every count covers all training texts, and contexts and kept symbols are
tables, joined by hash.  Counting is map-side combined (a task sorts the hashes
of a few million symbols and emits the distinct ones, one array for each range
of hashes; the arrays of a range are added up together).  Words and pairs are
counted in one pass; a longer n-gram is counted only if its first and its last n - 1
words may occur twice, which a bit table tells, with errors to the safe side
only.  Tables of finished steps are deleted.

The log10 probability of a symbol is a sum of values of the n-grams that end
with it: its own at the root; for a word or pair that is a retained context,
the log10 of the factor on its suffix's distribution; and for a kept symbol
after a retained context, what corrects that.  So a text's score is a sum over
its n-grams.  The values of the ``HEAD`` most frequent n-grams are broadcast;
other n-grams that may have a value (bit tables of values and of retained
contexts) are joined to the values, one length after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import Scratch, cut, scratch
from pagelake.llm.shingles import column_words

P_MIN = 0.0
GAMMA_MIN = 0.0
DIVERGENCE = 12.0
DISCOUNT = 0.75
DEPTH = 2                  # words of the longest contexts
CHUNK = 2_000_000          # symbols counted together in a task
RANGES = 8                 # ranges of hashes for each shuffle partition
HEAD = 2_000_000           # values of n-grams that are broadcast
BITS = 27                  # log2 of the slots of the largest bit table (16 MB)
END = np.uint64(0x9D39247E33776D41)
BEGIN = np.uint64(0x5A1F0C7E9B24D683)
NONE = np.uint64(0x3C6EF372FE94F82B)  # in counts, the context of a word by itself
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


class Index:
    """Position of 64-bit hashes in a sorted array of distinct ones, or -1."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(1, min(22, int(len(keys)).bit_length() + 1))
        slots = np.arange(1 << self.bits, dtype=np.uint64)
        self.start = np.searchsorted(keys, slots << np.uint64(64 - self.bits))
        self.start = np.append(self.start, len(keys)).astype(np.int32 if len(keys) < 1 << 31 else np.int64)
        self.most = int(np.diff(self.start).max()) if len(keys) else 0

    def __reduce__(self):
        return Index, (self.keys,)  # the rest is made again where it is used

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys) or not len(h):
            return out
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.start[slot], self.start[slot + 1]
        left = np.flatnonzero(at < stop)
        for k in range(self.most):
            p = at[left] + k
            hit = self.keys[p] == h[left]
            out[left[hit]] = p[hit]
            left = left[~hit & (p + 1 < stop[left])]
            if not len(left):
                break
        return out


@dataclass
class Bits:
    """One bit for each value of the first ``size`` bits of a code."""
    size: int
    table: np.ndarray

    def may_have(self, code: np.ndarray) -> np.ndarray:
        slot = code >> np.uint64(64 - self.size)
        return (self.table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


@dataclass
class Model:
    total: int                   # N
    vocabulary: int              # V
    discount: float
    unknown: float = 0.0         # log10 probability of an unknown symbol at the root
    head: Index | None = None    # frequent n-grams of all lengths, by code
    score: np.ndarray | None = None
    count: np.ndarray | None = None  # of a word; 0 for others
    valued: Bits | None = None   # what has a value
    contexts: Bits | None = None


def _turned(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def join(ctx: np.ndarray, suf: np.ndarray) -> np.ndarray:
    """64-bit codes of n-grams from those of their first and of their last
    n - 1 words: Spark's ``xxhash64`` of the two, as in ``_code``."""
    h = (np.uint64(42 + 8) + _P5) ^ (_turned((_turned(ctx, 1) ^ suf) * _P2, 31) * _P1)
    h = _turned(h, 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _code(ctx: str = "ctx", suf: str = "suf") -> Column:
    turned = F.shiftleft(ctx, 1).bitwiseOR(F.shiftrightunsigned(ctx, 63))
    return F.xxhash64(turned.bitwiseXOR(F.col(suf)))


def _signed(code: np.uint64) -> int:
    return int(np.array([code]).view(np.int64)[0])


def sequence(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all symbols of an Arrow text column, laid end to end, and the
    number of symbols of each row (its end included)."""
    h, sizes = column_words(column)
    h = np.where((h == END) | (h == BEGIN) | (h == NONE), h + np.uint64(1), h)
    return np.insert(h, np.cumsum(sizes), END), sizes + 1


def ngrams(column, longest: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Codes of the n-grams that end at each place of the texts, which are laid
    end to end with their begin marks, for n = 1 to ``longest``; the sizes of
    the texts (both marks included); and the place of each symbol in its text.
    An n-gram is one where its place is n - 1 at least."""
    h, sizes = sequence(column)
    codes = [np.insert(h, np.cumsum(sizes) - sizes, BEGIN)]
    sizes = sizes + 1
    place = np.arange(len(codes[0])) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for _ in range(longest - 1):
        codes.append(join(np.concatenate([[np.uint64(0)], codes[-1][:-1]]), codes[-1]))
    return codes, sizes, place


def _bits(codes: DataFrame) -> Bits:
    """Bit table of the ``code`` column, 16 slots or more a row up to the
    largest size, which does not depend on the rows."""
    size = min(BITS, max(6, (16 * codes.count()).bit_length()))
    slot = F.shiftrightunsigned("code", 64 - size)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    found = codes.select(F.shiftright(slot, 6).alias("block"), bit.alias("bit")).groupBy("block") \
        .agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(1 << (size - 6), np.uint64)
    table[found["block"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
    return Bits(size, table)


def _distinct(ctx: np.ndarray, suf: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct pairs, the sum of their ``times`` and their codes, in order of these."""
    key = join(ctx, suf)
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(start, len(key))) if times is None else np.add.reduceat(times[order], start)
    return ctx[order[start]], suf[order[start]], n, key[start]


def _count(texts: DataFrame, codes, least: float, words: bool = False) -> DataFrame:
    """How often each pair ``ctx``, ``suf`` of the codes that ``codes(column)``
    gives per slice occurs in all texts (``n``, ``least`` or more); with
    ``words``, also each ``suf`` by itself, as that of ``NONE``, of any ``n``."""
    ranges = RANGES * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pagelake.llm.tokens import slices

        held, size = [], 0

        def combined():
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            ctx, suf, n, key = _distinct(*columns)
            del columns
            yield from listed(ctx, suf, n, key)
            if words:
                yield from listed(*_distinct(np.full(len(suf), NONE), suf, n))

        def listed(ctx, suf, n, key):
            part = ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            offsets = pa.array(np.append(start, len(part)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in
                     (ctx.view(np.int64), suf.view(np.int64), n.astype(np.int32))]
            found = pa.RecordBatch.from_arrays([pa.array(part[start].astype(np.int32)), *lists],
                                               names=["part", "ctx", "suf", "n"])
            step = max(1, 200_000 * len(start) // len(part))
            for lo in range(0, len(start), step):
                yield found.slice(lo, step)

        for b in slices(batches, column=0):
            held.append(codes(b.column(0)))
            size += len(held[-1][0])
            if size >= CHUNK:
                yield from combined()
                size = 0
        if size:
            yield from combined()

    def added(rows):
        import pyarrow as pa
        import pyarrow.compute as pc

        ctx, suf, n = (pc.list_flatten(rows[c]).to_numpy() for c in ("ctx", "suf", "n"))
        ctx, suf, n, _ = _distinct(ctx.view(np.uint64), suf.view(np.uint64), n.astype(np.int64))
        kept = (n >= least) | (ctx == NONE)
        return pa.table({"ctx": ctx[kept].view(np.int64), "suf": suf[kept].view(np.int64), "n": n[kept]})

    return texts.select("text").mapInArrow(run, "part int, ctx array<long>, suf array<long>, n array<int>") \
        .groupBy("part").applyInArrow(added, "ctx long, suf long, n long")


def _words_and_pairs(texts: DataFrame) -> DataFrame:
    """Counts of all words and of the pairs that occur twice."""
    def codes(column):
        (word,), _, place = ngrams(column, 1)
        at = np.flatnonzero(place)
        return word[at - 1], word[at]

    return _count(texts, codes, 2, words=True)


def _longer(texts: DataFrame, n: int, shared, least: float) -> DataFrame:
    """Counts of the ``n``-grams that occur ``least`` times; ``ctx`` and
    ``suf`` of all of them are in the broadcast bit table."""
    def codes(column):
        found, _, place = ngrams(column, n - 1)
        may = shared.value.may_have(found[-1])
        ok = np.flatnonzero((place[1:] >= n - 1) & may[:-1] & may[1:])
        return found[-1][ok], found[-1][ok + 1]

    return _count(texts, codes, least)


@contextmanager
def _cleaned(spark):
    """Shuffle files of the actions inside are removed when each ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)


def _contexts(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """``code``, ``n``, ``beta`` (log10 of the factor on the suffix's
    probability) and ``kept`` (the divergence test) of the contexts that have
    kept symbols and are in ``totals`` (``code``, ``n``); one without kept
    symbols differs in nothing from its suffix."""
    times, n = F.col("n") - DISCOUNT, F.col("n")
    sums = edges.groupBy(F.col("ctx").alias("code")).agg(
        F.sum(times).alias("own"), F.sum("parent").alias("parent"),
        F.sum(times * F.ln(times / F.col("parent"))).alias("gain"))
    own = F.col("own") / n
    rest = 1.0 - own
    ratio = rest / F.greatest(1.0 - F.col("parent"), F.lit(1e-12))
    gain = F.col("gain") - F.col("own") * F.ln(n) + n * rest * F.ln(ratio)
    return sums.join(totals.select("code", "n"), "code").select("code", "n", F.log10(ratio).alias("beta"),
                                                                (gain >= DIVERGENCE).alias("kept"))


def _own() -> Column:
    return (F.col("n") - DISCOUNT) / F.col("total")


def _retained(steps: Scratch, levels: list[tuple[DataFrame, DataFrame]]) -> list[DataFrame]:
    """The retained contexts of each level, the suffixes of retained ones among them."""
    out = []
    for k, (edges, contexts) in reversed([*enumerate(levels)]):
        if out:
            need = out[0].join(edges.select(_code().alias("code"), "suf"), "code").select(F.col("suf").alias("code")).distinct()
            contexts = contexts.join(need.withColumn("needed", F.lit(True)), "code", "left") \
                .where(F.col("kept") | F.col("needed").isNotNull())
        else:
            contexts = contexts.where("kept")
        out.insert(0, steps.cut(contexts.select("code", "n", "beta"), f"retained{k}"))
    return out


def _values(words: DataFrame, edges: list[DataFrame], retained: list[DataFrame], unknown: float) -> list[DataFrame]:
    """For n-grams of each length, a table of ``code``, ``n``, ``score``,
    ``word``: what an occurrence adds to the sums of a text.  A code's rows, two
    at most, add up."""
    out = [words.select("code", "n", (F.log10("p") - unknown).alias("score"), F.lit(True).alias("word"))]
    for rows, contexts in zip(edges, retained, strict=True):
        out[-1] = out[-1].union(contexts.select("code", "n", "beta", F.lit(False)))
        out.append(rows.join(contexts.select(F.col("code").alias("ctx"), F.col("n").alias("total"), "beta"), "ctx").select(
            _code().alias("code"), "n", (F.log10(_own() / F.col("parent")) - F.col("beta")).alias("score"),
            F.lit(False).alias("word")))
    return out


def _least(values: DataFrame) -> int:
    """The count from which on the values are broadcast, ``HEAD`` rows at most."""
    # one row per different count, of which there are fewer than the root of twice the symbols
    sizes = values.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).toArrow()
    n, rows = sizes["n"].to_numpy(), sizes["rows"].to_numpy()
    order = np.argsort(-n)
    fits = np.cumsum(rows[order]) <= HEAD
    return int(n[order][fits][-1]) if fits.any() else int(n.max(initial=0)) + 1


def train(texts: DataFrame, steps: Scratch) -> tuple[Model, list[DataFrame]]:
    """The model of all ``texts`` (column ``text``) and the tables of the values
    of its n-grams that are not in the head, by length (none without symbols)."""
    spark = texts.sparkSession
    single = F.col("ctx") == _signed(NONE)
    counts = steps.cut(_words_and_pairs(texts), "counts1")
    words = steps.cut(counts.where(single).select(F.col("suf").alias("code"), "n"), "words")
    row = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("types"),
                    F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
                    F.max(F.when(F.col("code") == _signed(END), F.col("n"))).alias("ends")).first()
    discount = row["once"] / (row["once"] + 2 * row["twice"]) if row["once"] else 0.5
    model = Model(int(row["total"]), int(row["types"]), min(max(discount, 0.1), 0.9))
    if not model.total:
        return model, []
    model.unknown = math.log10(model.discount * model.vocabulary / model.total)
    least, kept = max(2.0, P_MIN * model.total), max(2.0, GAMMA_MIN * model.total)
    words = words.withColumn("p", (F.col("n") - model.discount) / model.total)
    ends = spark.createDataFrame([(_signed(BEGIN), row["ends"])], "code long, n long")
    shorter, levels = words.unionByName(ends, allowMissingColumns=True), []
    for k in range(1, DEPTH + 1):
        found = counts.where(~single)
        if k > 1:
            shared = spark.sparkContext.broadcast(_bits(shorter.where(F.col("n") >= kept)))
            found = steps.cut(_longer(texts, k + 1, shared, kept), f"counts{k}")
            shared.destroy()
        totals = shorter.where(F.col("n") >= least)
        edges = found.where(F.col("n") >= kept).join(
            shorter.where(F.col("n") >= kept).select(F.col("code").alias("suf"), F.col("p").alias("parent")), "suf")
        if k < DEPTH:
            edges = edges.join(totals.select(F.col("code").alias("ctx"), F.col("n").alias("total")), "ctx")
        edges = steps.cut(edges, f"edges{k}")
        steps.drop(f"counts{k}")
        levels.append((edges, steps.cut(_contexts(edges, totals), f"contexts{k}")))
        if k < DEPTH:
            shorter = edges.select(_code().alias("code"), "n", _own().alias("p"))
    retained = _retained(steps, levels)
    values = _values(words, [edges.select("ctx", "suf", "n", "parent") for edges, _ in levels], retained, model.unknown)
    values = [steps.cut(rows, f"values{k}") for k, rows in enumerate(values)]
    model.contexts = _bits(reduce(DataFrame.union, [x.select("code") for x in retained]))
    steps.drop(*(x for x in steps.paths if not x.startswith("values")))
    every = reduce(DataFrame.union, values)
    first = _least(every)
    model.valued = _bits(every.where(F.col("n") < first))
    head = every.where(F.col("n") >= first).toArrow()
    code, at = np.unique(head["code"].to_numpy().view(np.uint64), return_inverse=True)
    model.head = Index(code)
    model.score = np.bincount(at, head["score"].to_numpy(), len(code))
    model.count = np.bincount(at, np.where(head["word"].to_numpy(), head["n"].to_numpy(), 0), len(code))
    return model, [rows.where(F.col("n") < first) for rows in values]


def held_out_fold(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram), ``score`` (suffix tree) for every row of
    ``docs``, learnt from the rows that are not held out.

    Null text counts as empty: one end.  Rows with equal ids are rows of their
    own; null ids are trained on.  Without training rows nothing is known and
    an unknown symbol has probability 1.  Other columns are ignored; an empty
    table gives no rows.  Words are told apart by 64-bit hashes.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    with _cleaned(docs.sparkSession), scratch(docs.sparkSession) as steps:
        return cut(_scores(rows, steps), "scores")


def _scores(rows: DataFrame, steps: Scratch) -> DataFrame:
    model, values = train(rows.where(~F.col("held_out")), steps)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    lists = [f"rare{k}" for k in range(len(values))]
    schema = (f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, score double"
              + "".join(f", {x} array<struct<code:long,n:long>>" for x in lists))
    size = model.total + 1 * (model.vocabulary + 1)

    def listed(owner: np.ndarray, code: np.ndarray, texts: int):
        """For each text its distinct codes and how often it has them."""
        import pyarrow as pa

        order = np.lexsort((code, owner))
        owner, code = owner[order], code[order]
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]) if len(code) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        n = np.diff(np.append(starts, len(code)))
        offsets = np.searchsorted(owner[starts], np.arange(texts + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
            [pa.array(code[starts].view(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pagelake.llm.tokens import slices

        m = shared.value
        for b in slices(batches):
            codes, sizes, place = ngrams(b.column(1), DEPTH + 1)
            first = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(sizes)), sizes)
            base = np.where(place > 0, -math.log10(size), 0.0)
            score = np.where(place > 0, m.unknown, 0.0)
            known = np.zeros(len(place), np.int64)
            rare = []
            for n, code in enumerate(codes if m.head else []):
                at = np.flatnonzero(place >= n)
                found = m.head.find(code[at])
                hit = found >= 0
                score[at[hit]] += m.score[found[hit]]
                if not n:
                    base[at[hit]] += np.log10(m.count[found[hit]] + 1)
                    known[at[hit]] += m.count[found[hit]] > 0
                at = at[~hit]
                at = at[m.valued.may_have(code[at])]
                if n:  # a retained context itself, or a kept symbol after one
                    at = at[m.contexts.may_have(code[at]) | m.contexts.may_have(codes[n - 1][at - 1])]
                rare.append(listed(owner[at], code[at], len(sizes)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(sizes - 1), pa.array(np.add.reduceat(known, first)),
                 pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(score, first)), *rare],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", *lists])

    scored = steps.cut(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    shared.destroy()
    out = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
           F.col("base").alias("base_score"), "score"]
    if not values:
        return scored.select(*out)
    n, shifted = F.col("times"), F.log10(F.col("n") + 1)
    sums = [steps.cut(scored.select("row", F.inline(x).alias("code", "times")).join(table, "code").groupBy("row").agg(
        F.sum(F.when(F.col("word"), n)).alias("k"), F.sum(F.when(F.col("word"), n * shifted)).alias("b"),
        F.sum(n * F.col("score")).alias("s")), f"sums_{x}") for x, table in zip(lists, values, strict=True)]
    rare = reduce(DataFrame.union, sums).groupBy("row").agg(*(F.sum(c).alias(c) for c in "kbs"))
    more = {"n_known": (F.col("n_known") + F.coalesce("k", F.lit(0))).cast("long"),
            "base": F.col("base") + F.coalesce("b", F.lit(0.0)), "score": F.col("score") + F.coalesce("s", F.lit(0.0))}
    return scored.drop(*lists).join(rare, "row", "left").withColumns(more).select(*out)
