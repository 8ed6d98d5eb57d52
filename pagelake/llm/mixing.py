"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose share of the budget is its target.  Its documents
stand in a seeded order, repeated while its target asks for more than it has,
and each gets a virtual finish time: the source's words up to and including
it, divided by the target.  All documents sorted by finish time are the mix,
in an order that serves the sources in proportion everywhere; the running sum
of words cuts it at the budget.

A document that spans the end of its source's target counts as two packets,
before and behind that end, so the cut comes at the targets whatever the
length of the documents.

All running sums are range partitions with carried-in sums: a source that
holds a third of all rows is spread over many tasks.  Only keys and sizes
travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.common import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 20_240_613
# Fixed value: a word is a run of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"


def running_sums(rows: DataFrame, order: Sequence[str], value: str, name: str, within: Sequence[str] = (),
                 stage: str = "running") -> DataFrame:
    """Add ``name``, the sum of ``value`` over the rows before this one in
    ``order``, among rows equal in ``within`` (null is a value).

    Range partitions in order are written with their numbers, so a lost
    executor can't change them between the two uses; a window inside each adds
    up, and sums of the earlier partitions (one row per partition and key) are
    carried in.  Rows equal in ``within`` and ``order`` must be interchangeable.
    """
    ranged = rows.repartitionByRange(*within, *order).sortWithinPartitions(*within, *order)
    kept = cut(ranged.withColumns({"_rs_part": F.spark_partition_id(), "_rs_row": F.monotonically_increasing_id()}), stage)
    inside = Window.partitionBy("_rs_part", *within).orderBy("_rs_row").rowsBetween(Window.unboundedPreceding, -1)
    totals = kept.groupBy("_rs_part", *within).agg(F.sum(value).alias("_rs_sum"))
    earlier = Window.partitionBy(*within).orderBy("_rs_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col("_rs_part").alias("_rs_p"), *[F.col(k).alias(f"_rs_k{i}") for i, k in enumerate(within)],
                          F.coalesce(F.sum("_rs_sum").over(earlier), F.lit(0)).alias("_rs_carry"))
    same = F.col("_rs_part") == F.col("_rs_p")
    for i, k in enumerate(within):
        same &= F.col(k).eqNullSafe(F.col(f"_rs_k{i}"))
    local = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return kept.withColumn("_rs_local", local).join(carry, same) \
        .withColumn(name, F.col("_rs_carry") + F.col("_rs_local")).select(*rows.columns, name)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> tuple[DataFrame, int, int]:
    """(sources, budget, number of sources) from ``source``, ``source_size``:
    adds ``rank`` (from 0, by code point, null last) and ``target`` (double).

    The budget is ``share`` of all sizes; each source gets its weight's part,
    but at most ``repeats`` times its size; what is above that goes to the
    others by weight until none is above.  The fixed point is found by order:
    sources sorted by cap over weight are full as long as the level of those
    that follow reaches their cap.
    """
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    budget = share * total.t
    keyed = sizes.withColumns({"_wf_null": F.col("source").isNull(), "_wf_one": F.lit(1).cast("long")})
    ranked = running_sums(keyed, ["_wf_null", "source"], "_wf_one", "rank", stage="mix-rank")
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size") * repeats) \
        .withColumn("fill", F.col("cap").cast("double") / F.col("weight").cast("double"))
    all_weights = weighed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    by_fill = running_sums(weighed, ["fill", "rank"], "cap", "cap_before", stage="mix-caps")
    by_fill = running_sums(by_fill, ["fill", "rank"], "weight", "weight_before", stage="mix-weights")
    level = (F.lit(float(budget)) - F.col("cap_before")) / (F.lit(float(all_weights)) - F.col("weight_before"))
    judged = cut(by_fill.withColumn("full", F.col("fill") <= level), "mix-sources")
    rest = judged.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)).alias("caps"),
                      F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)).alias("weights")).first()
    open_target = F.col("weight").cast("double") * F.lit(float(budget - rest.caps)) / F.lit(float(rest.weights or 1))
    out = judged.select("source", "source_size", "rank",
                        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(open_target).alias("target"))
    return out, int(min(budget, repeats * total.t)), int(total.n)


def fair_queue(rows: DataFrame, sources: DataFrame, budget: int, n_sources: int, order: Sequence[str],
               repeats: int = REPEATS) -> DataFrame:
    """The mix as packets: the columns of ``rows`` and of ``sources`` plus
    ``turn`` (0 for a document's first use), ``words``, ``finish`` (virtual
    time), ``position`` (words before it) and ``taken`` (words inside the
    budget).

    ``rows`` has ``source``, ``size`` and the columns of ``order``, the
    shuffle.  Every document has a packet of its first turn; packets of later
    turns that the budget can't reach are left out: once all targets are
    served less than one word a source is left.
    """
    queued = running_sums(rows, order, "size", "_wf_before", within=["source"], stage="mix-queues")
    known = sources.select(F.col("source").alias("_wf_source"), "source_size", "rank", "target")
    flows = queued.join(known, F.col("source").eqNullSafe(F.col("_wf_source"))).drop("_wf_source")
    quota = "CAST(floor(target) AS BIGINT)"
    packets = flows.withColumn("_wf_packet", F.expr(f"""explode(flatten(transform(sequence(0, {repeats - 1}), t -> CASE
        WHEN t * source_size + _wf_before < {quota} AND t * source_size + _wf_before + size > {quota} THEN array(
          struct(t AS turn, {quota} - t * source_size - _wf_before AS words, {quota} AS end),
          struct(t AS turn, t * source_size + _wf_before + size - {quota} AS words, t * source_size + _wf_before + size AS end))
        WHEN t = 0 OR t * source_size + _wf_before < {quota} + {n_sources} THEN array(
          struct(t AS turn, size AS words, t * source_size + _wf_before + size AS end))
        ELSE array() END)))"""))
    finish = F.when(F.col("target") > 0, F.col("_wf_packet.end") / F.col("target")).otherwise(F.lit(float("inf")))
    timed = packets.select(*rows.columns, "source_size", "rank", "target", F.col("_wf_packet.turn").alias("turn"),
                           F.col("_wf_packet.words").alias("words"), F.col("_wf_packet.end").alias("_wf_end"),
                           finish.alias("finish"))
    # equal (finish, rank, end) are empty packets beside at most one with words
    mix = running_sums(timed, ["finish", "rank", "_wf_end", "words"], "words", "position", stage="mix-order")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), F.lit(budget) - F.col("position")))
    return mix.withColumn("taken", taken).drop("_wf_end")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
                  seed: int = SEED, size: Column | None = None) -> DataFrame:
    """The mix of ``docs`` (``doc_id``, ``source``, ``text``) as packets (see
    ``fair_queue``) with ``doc_id``, ``size`` and ``row``, a number of the
    input row (reruns may number rows anew; all else agrees).

    ``size`` defaults to the words of the text (null text: none).  A null
    source is a source of its own, last in order.  Documents without words have
    an empty packet.  Rows with equal ids are documents of their own, ordered
    by text digest and size; a null id is shuffled like any other.  Other columns
    are ignored, whatever their names; an empty table gives no rows.
    """
    if not weights or any(w < 1 for w in weights) or share < 0 or repeats < 1:
        raise ValueError("weights and repeats must be positive, the share not negative")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                           (word_count(F.col("text")) if size is None else size.cast("long")).alias("size"),
                           key.alias("key"), digest.alias("digest"), F.monotonically_increasing_id().alias("row")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources, budget, n = source_targets(sizes, weights, share, repeats)
    return fair_queue(rows, sources, budget, n, ["key", "doc_id", "digest", "size"], repeats).drop("key", "digest")


def taken_per_document(mix: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``,
    ``source_size``, ``target``, ``taken`` (words the mix takes, repeats
    counted)."""
    keys = ["row", "doc_id", "source", "size", "source_size", "target"]
    return mix.groupBy(*keys).agg(F.sum("taken").alias("taken")).drop("row")
