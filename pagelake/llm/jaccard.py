"""N-gram Jaccard join with a token-group matrix.

Documents are sets of hashed word shingles.  Equal sets are one class.  The
join finds the connected components of all links (Jaccard at least ``LINK``
percent) in these steps:

1. Similar classes are partitioned into groups: a class joins the class with
   the most copies of one of its ``BANDS`` min-hash buckets, if they look alike
   by a longer signature.  Those very alike are compared at once, which links
   most near copies to one class of their family.
2. Token-group matrix: for every group the union of its members' prefix
   tokens.  Under one global token order (frequent tokens last) two linked
   sets share tokens among their first ``size - ceil(t * size) + 1``; how many
   at least follows from their sizes, and the places of a shared token bound
   the overlap.  Only groups that pass both bounds can hold a link.
3. The smaller group of such a pair queries the blocks of the larger one, and
   in a group of several the members that step 1 did not link query the
   group's own blocks.  A query opens a block only if its overlap with the
   block's token union reaches ``ceil(t * size)``; members are then compared
   exactly.  A task keeps the links that connect, not all pairs.
4. Components over the links of steps 1 and 3.

Signatures only form groups: any partition gives the same components, since
links between groups and inside them are all looked for.  A family of
thousands of similar texts is a few groups, whether they are linked or not, so
it adds one matrix row per token and no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import checkpointed, cut
from pagelake.llm.components import components

WORDS = 4
LINK = 85                   # percent
BANDS = 4                   # min-hashes that make buckets
SIGNATURE = 16              # min-hashes that are compared
ALIKE = 5                   # of SIGNATURE, to join the bucket's centre
VERY_ALIKE = 10             # of SIGNATURE, to be compared with it at once
HEAVY_MIN = 8               # seen so often inside tasks, a token is frequent
HEAVY_TOKENS = 1 << 20      # frequent tokens that are broadcast; the rest keep the hash order (order only, no result)
FILTER_BITS = 1 << 22       # bitmap of the documents to open
STAR_ROWS = 500             # members compared with one copy of a centre
BLOCK = 256                 # members of a group opened together
QUERIES = 2_000             # queries run against one copy of a block
CHUNK = 2_000_000           # tokens counted together in a task


def needed(n: int, link: int = LINK) -> int:
    """Smallest overlap that a set of ``n`` needs for a link."""
    return -(-n * link // 100)


def _signs(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: a document's class (``node`` digest, size,
    signature), and tokens seen more than once in a task, with their count."""
    schema = (f"kind int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, n long, "
              "signature array<long>")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        from pagelake.llm.shingles import mix, shingle_sets
        from pagelake.llm.tokens import slices

        seeds = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
        names = ["kind", "doc_id", "node", "n", "signature"]
        id_type = None
        held: list = []
        size = 0

        def frequent():
            tokens, count = np.unique(np.concatenate(held), return_counts=True)
            tokens, count = tokens[count > 1].view(np.int64), count[count > 1]
            for lo in range(0, len(tokens), 100_000):
                t, c = tokens[lo:lo + 100_000], count[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(t), np.int32)), pa.nulls(len(t), id_type), pa.array(t),
                     pa.array(c.astype(np.int64)), pa.nulls(len(t), pa.list_(pa.int64()))], names=names)

        for b in slices(batches):
            id_type = b.column(0).type
            node, n, signature = [], [], []
            for s in shingle_sets(b.column(1), words):
                n.append(len(s))
                if len(s):
                    node.append(xxhash.xxh3_64_intdigest(s.tobytes()) >> 1)
                    signature.append([int((s * k >> np.uint64(1)).min()) for k in seeds])
                    held.append(s)
                    size += len(s)
                else:
                    node.append(None)
                    signature.append(None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(n), np.int32)), b.column(0), pa.array(node, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(signature, pa.list_(pa.int64()))], names=names)
            if size >= CHUNK:
                yield from frequent()
                held, size = [], 0
        if held:
            yield from frequent()

    return docs.mapInArrow(run, schema)


def _prefixes(docs: DataFrame, words: int, link: int, heavy) -> DataFrame:
    """(``node``, ``n``, ``tokens``): size and prefix of each document's set; a
    task gives a class's prefix once."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        from pagelake.llm.shingles import shingle_sets
        from pagelake.llm.tokens import slices

        token, rank = heavy.value
        seen: set[int] = set()
        for b in slices(batches):
            nodes, sizes, prefixes = [], [], []
            for s in shingle_sets(b.column(1), words):
                if not len(s):
                    continue
                node = xxhash.xxh3_64_intdigest(s.tobytes()) >> 1
                if node in seen:
                    continue
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add(node)
                k = len(s) - needed(len(s), link) + 1
                if len(token):
                    at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                    often = token[at] == s
                    if often.any():
                        late = s[often]
                        s = np.concatenate([s[~often], late[np.lexsort((late, rank[at[often]]))]])
                nodes.append(node)
                sizes.append(len(s))
                prefixes.append(s[:k].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "n", "tokens"])

    return docs.mapInArrow(run, "node long, n int, tokens array<long>")


def shared_at_least(n, m, link: int):
    """How many prefix tokens two linked sets of sizes ``n`` and ``m`` share
    at least: with an overlap of ``o`` tokens the ``t``-th common one is among
    the first ``t + n - o``.  (Arrays or numbers.)"""
    import numpy as np

    o = -(-link * (n + m) // (100 + link))
    prefix = lambda k: k + 1 + (-k * link // 100)  # noqa: E731  k - ceil(link k / 100) + 1
    return np.maximum(1, np.minimum(prefix(n) - (n - o), prefix(m) - (m - o)))


def _group_pairs(matrix: DataFrame, link: int) -> DataFrame:
    """Pairs (``a`` < ``b``) of groups that may hold a link, from ``matrix``
    (``token``, ``g``, ``n``, ``at``).

    With a token at places i and j of sets of sizes m and n, at most
    ``min(i, j) + min(m - i, n - j)`` tokens are common: that must be enough
    for a link.  Tokens that leave room are counted per pair of groups, and
    the count must reach what the sizes demand.  Rows arrive sorted by token,
    and a task holds one token's rows at a time."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rest = [np.zeros(0, np.int64)] * 4
        pairs: dict[tuple[int, int], list[int]] = {}

        def find(token, g, n, at):
            if not len(token):
                return
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            ends = np.append(starts[1:], len(token))
            many = g[starts] != g[ends - 1]  # sorted by group: more than one
            for i, j in zip(starts[many].tolist(), ends[many].tolist()):
                rows = np.unique(np.stack([g[i:j], n[i:j], at[i:j]], axis=1), axis=0) if j - i > 2 else \
                    np.stack([g[i:j], n[i:j], at[i:j]], axis=1)
                here: dict[tuple[int, int], int] = {}
                for lo in range(0, len(rows), 500):
                    x, y = rows[lo:lo + 500, None], rows[None, lo:]
                    most = np.minimum(x[..., 2], y[..., 2]) + np.minimum(x[..., 1] - x[..., 2], y[..., 1] - y[..., 2])
                    p, q = np.nonzero((x[..., 0] < y[..., 0]) & (100 * most >= link * (x[..., 1] + y[..., 1] - most)))
                    least = shared_at_least(rows[lo + p, 1], rows[lo + q, 1], link).tolist()
                    for a, b, k in zip(rows[lo + p, 0].tolist(), rows[lo + q, 0].tolist(), least):
                        here[a, b] = min(k, here.get((a, b), k))
                for key, k in here.items():
                    if (old := pairs.get(key)) is None:
                        pairs[key] = [1, k]
                    else:
                        old[0] += 1
                        old[1] = min(old[1], k)
                if len(pairs) > 200_000:
                    yield flush()

        def flush():
            cols = [*zip(*pairs)] if pairs else [(), ()]
            cols += [*zip(*pairs.values())] if pairs else [(), ()]
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n", "least"])

        for b in batches:
            cols = [np.concatenate([r, b.column(i).to_numpy(zero_copy_only=False)]) for i, r in enumerate(rest)]
            if not len(cols[0]):
                continue
            last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last token may go on in the next batch
            yield from find(*(c[:last] for c in cols))
            rest = [c[last:] for c in cols]
        yield from find(*rest)
        yield flush()

    rows = matrix.select("token", "g", "n", "at")
    found = rows.repartition("token").sortWithinPartitions("token", "g").mapInArrow(
        run, "a long, b long, n long, least long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("least").alias("least")) \
        .where("n >= least").select("a", "b")


def _open(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` rows (``doc_id``, ...) with their document's ``text``.  A
    bitmap of fixed size drops most other texts before the join's shuffle; the
    join itself is exact."""
    import numpy as np

    spark = docs.sparkSession
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    slots = wanted.select(slot.alias("slot")).distinct().toPandas()["slot"].to_numpy()  # FILTER_BITS at most
    bits = np.zeros(FILTER_BITS, bool)
    bits[slots] = True
    bitmap = spark.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keep = np.unpackbits(bitmap.value).astype(bool)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["doc_id", "text"]).filter(
                pa.array(keep[b.column(2).to_numpy(zero_copy_only=False)]))

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string"
    texts = docs.select("doc_id", "text", slot.alias("slot")).mapInArrow(run, schema)
    ids = wanted.withColumnRenamed("doc_id", "_id")
    return texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")


def _verify(opened: DataFrame, words: int, link: int) -> DataFrame:
    """Links (``a``, ``b``) between queries (``role`` 1) and the members
    (``role`` 0) of the same ``block`` and ``salt``: those that connect what
    earlier ones didn't.

    Members come first and are held as token -> member arrays, whose tokens
    are the block's union; queries pass one at a time."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        from pagelake.llm.shingles import shingle_sets
        from pagelake.llm.tokens import slices

        key = None
        sets: list = []
        ids: list[int] = []
        index = None
        joined: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                joined[x] = x = joined.get(up, up)
            return x

        for b in slices(batches, column=4):
            a_out, b_out = [], []
            cols = [b.column(i).to_pylist() for i in range(4)]
            for block, salt, role, node, q in zip(*cols, shingle_sets(b.column(4), words)):
                if (block, salt) != key:
                    key, sets, ids, index = (block, salt), [], [], None
                    joined.clear()
                if xxhash.xxh3_64_intdigest(q.tobytes()) >> 1 != node:
                    continue  # another document with the same id
                if role == 0:
                    if node not in ids:
                        ids.append(node)
                        sets.append(q)
                    continue
                if not ids:
                    continue
                if index is None:
                    tokens = np.concatenate(sets)
                    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                    order = np.argsort(tokens, kind="stable")
                    index = tokens[order], owner[order], np.asarray([len(s) for s in sets])
                tokens, owner, size = index
                lo, hi = np.searchsorted(tokens, q), np.searchsorted(tokens, q, side="right")
                hit = hi > lo
                if hit.sum() < needed(len(q), link):
                    continue  # the group's union holds too little of the query
                lo, n = lo[hit], (hi - lo)[hit]
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(size))
                linked = np.flatnonzero(100 * both >= link * (size + len(q) - both))
                for k in linked.tolist():
                    if (x := root(node)) != (y := root(ids[k])):
                        joined[x] = y
                        a_out.append(node)
                        b_out.append(ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())],
                                             names=["a", "b"])

    rows = opened.select("block", "salt", "role", "node", "text")
    return rows.repartition("block", "salt").sortWithinPartitions("block", "salt", "role") \
        .mapInArrow(run, "a long, b long")


def _centres(classes: DataFrame) -> DataFrame:
    """(``node``, ``doc_id``, ``centre``, ``centre_doc``, ``alike``): each class
    with the centres of its buckets that it is like."""
    from functools import reduce

    found = []
    for k in range(BANDS):
        bucket = classes.select("node", "doc_id", "signature", "copies", F.col("signature")[k].alias("m"))
        centre = bucket.groupBy("m").agg(F.max(F.struct("copies", "node", "doc_id", "signature")).alias("c"),
                                         F.count(F.lit(1)).alias("s")).where("s > 1")
        both = bucket.join(centre, "m").where(F.col("node") != F.col("c.node"))
        same = F.aggregate(F.zip_with("signature", "c.signature", lambda x, y: (x == y).cast("int")),
                           F.lit(0), lambda x, y: x + y)
        found.append(both.select("node", "doc_id", F.col("c.node").alias("centre"), F.col("c.doc_id").alias("centre_doc"),
                                 F.col("c.copies").alias("copies"), same.alias("alike")).where(F.col("alike") >= ALIKE))
    return checkpointed(reduce(DataFrame.union, found).distinct())


def _stars(centres: DataFrame) -> DataFrame:
    """Very alike classes and their centres, to compare: ``doc_id``, ``block``
    (the centre), ``salt``, ``role``, ``node``."""
    pairs = centres.where(F.col("alike") >= VERY_ALIKE).select("node", "doc_id", F.col("centre").alias("block"), "centre_doc")
    sizes = pairs.groupBy("block", "centre_doc").agg(F.ceil(F.count(F.lit(1)) / STAR_ROWS).cast("int").alias("salts"))
    members = pairs.join(sizes.select("block", "salts"), "block").select(
        "doc_id", "block", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"),
        "node")
    starred = sizes.select(F.col("centre_doc").alias("doc_id"), "block",
                           F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"),
                           F.col("block").alias("node"))
    return members.union(starred)


def _groups(classes: DataFrame, centres: DataFrame, labels: DataFrame) -> DataFrame:
    """(``node``, ``doc_id``, ``g``, ``label``): the group of every class, and
    its component so far.  A class joins the centre with the most copies, then
    the greatest; a centre that joined another one's group keeps its own."""
    best = centres.groupBy("node").agg(F.max(F.struct("copies", "centre")).alias("c")).select(
        "node", F.col("c.centre").alias("centre"))
    named = classes.select("node", "doc_id").join(best, "node", "left").join(labels, "node", "left")
    return checkpointed(named.select("node", "doc_id", F.coalesce("centre", "node").alias("g"),
                                     F.coalesce("label", "node").alias("label")))


def _queries(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows to open for pairs of groups: the smaller group's members query all
    blocks of the larger one; in a group of several, the members outside its
    largest component so far query the group's own blocks."""
    sizes = groups.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    a = sizes.select(F.col("g").alias("a"), F.col("size").alias("sa"))
    b = sizes.select(F.col("g").alias("b"), F.col("size").alias("sb"))
    swap = F.col("sa") > F.col("sb")
    between = pairs.join(a, "a").join(b, "b").select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("query"),
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("target"),
        F.ceil(F.greatest("sa", "sb") / BLOCK).cast("int").alias("blocks"), F.least("sa", "sb").alias("n_query"))
    parts = groups.groupBy("g", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("g").agg(
        F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("size"))
    inside = parts.where(F.col("most.n") < F.col("size")).select(
        F.col("g").alias("target"), F.col("most.label").alias("main"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), (F.col("size") - F.col("most.n")).alias("n_query"))
    directed = checkpointed(between.withColumn("main", F.lit(None).cast("long")).unionByName(
        inside.withColumn("query", F.col("target"))))
    salts = directed.groupBy("target", "blocks").agg(
        F.ceil(F.sum("n_query") / QUERIES).cast("int").alias("salts"))
    block = F.concat_ws("/", F.col("target").cast("string"), F.col("block").cast("string")).alias("block")
    members = groups.join(salts, groups["g"] == salts["target"]).select(
        "doc_id", "node", "target", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    asked = directed.join(salts, ["target", "blocks"]).join(groups, F.col("query") == F.col("g")) \
        .where("main IS NULL OR label <> main").select(
        "doc_id", "node", "target", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"))
    return members.select("doc_id", block, "salt", F.lit(0).alias("role"), "node").union(
        asked.select("doc_id", block, "salt", F.lit(1).alias("role"), "node"))


def jaccard_components(docs: DataFrame, words: int = WORDS, link: int = LINK) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by
    links, itself included), ``class_copies`` (rows with the same set) for
    every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Null, empty and
    blank texts have no shingles and no links; a text of fewer than ``words``
    words is one shingle.  Rows with equal ids are documents of their own, and
    the component id is an id.  Null ids are never the smallest unless all
    are null.  Other columns are ignored; an empty table gives no rows.
    ``link`` is a percentage, compared in whole numbers.  Sets are told apart
    by 64-bit digests, shingles by 64-bit hashes.
    """
    import numpy as np

    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    signs = cut(_signs(docs, words), "jaccard-signs")
    rows = signs.where("kind = 0").select("doc_id", "node", "n")
    top = signs.where("kind = 1").groupBy("node").agg(F.sum("n").alias("seen")).where(F.col("seen") >= HEAVY_MIN) \
        .orderBy(F.desc("seen"), "node").limit(HEAVY_TOKENS).toPandas()
    token = top["node"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    heavy = spark.sparkContext.broadcast((token[order], top["seen"].to_numpy(np.int64)[order]))

    classes = checkpointed(signs.where("kind = 0 AND n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature")))
    centres = _centres(classes)
    inside = checkpointed(_verify(_open(docs, _stars(centres)), words, link))
    groups = _groups(classes, centres, components(inside))

    matrix = _prefixes(docs, words, link, heavy).join(groups.where("g <> node").select("node", "g"), "node", "left") \
        .select(F.posexplode("tokens").alias("at", "token"), "n", F.coalesce("g", "node").alias("g"))
    pairs = checkpointed(_group_pairs(matrix, link))
    between = checkpointed(_verify(_open(docs, _queries(pairs, groups)), words, link))

    whole = components(inside.union(between))
    named = classes.join(whole, "node", "left").select("node", "doc_id", "copies",
                                                       F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    result = checkpointed(named.join(smallest, "label").select("node", "component_id", "copies"))
    return rows.join(result, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("class_copies"))
