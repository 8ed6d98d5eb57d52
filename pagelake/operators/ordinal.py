"""Global order, positions and work shares.

``add_ordinal`` gives a contiguous 0-based position in a global order without
a window that has no partition key (that would pull every row into one task):

1. a range-partitioned sort (``orderBy``) splits the data into ordered,
   non-overlapping ranges;
2. inside each range, ``monotonically_increasing_id`` minus the partition's
   base is the local position (both are computed in the sort's own stage);
3. the frame is checkpointed to the shared checkpoint folder, so a lost
   executor cannot re-run the range sampling and change the ranges between
   the two passes below;
4. per-partition counts (one row per partition) give prefix offsets;
   that table has exactly one row per partition, so broadcasting it is
   bounded by the partition count, not by the data.

The slices of a list of length ``L`` are pure arithmetic on the position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.session import work_dir

# The original slice sizes and shares.
SLICE_LEN = 244078
SUB_SLICES = 50
SHARES = 32
UPPER_SHARES_FROM = 16
UPPER_SKIP = 0.15


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def add_ordinal(df: DataFrame, order: Sequence[Column | str], name: str = "ordinal",
                partitions: int | None = None, length: str | None = None) -> DataFrame:
    """Add a contiguous 0-based ``name`` column in ``order`` (which must be
    total: add a unique last key).  ``length`` also attaches the total row
    count, taken from the same per-partition counts."""
    spark = df.sparkSession
    work_dir(spark)
    cols = _cols(order)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)
    indexed = ranged.select("*", pid.alias("_pid"), local.alias("_local")).checkpoint(eager=True)
    counts = indexed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.sum("_n").over(everything).alias("_total"))
    out = indexed.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, F.col("_off") + F.col("_local"))
    if length:
        out = out.withColumn(length, F.col("_total"))
    return out.drop("_pid", "_local", "_off", "_total")


def sort_ids(df: DataFrame, column: str = "id", name: str = "ordinal") -> DataFrame:
    """Ascending *text* order of ids (``"10" < "9"``), with position."""
    return add_ordinal(df.withColumn(column, F.col(column).cast("string")), [F.col(column)], name)


def rank_slice(df: DataFrame, by: str, lo: int, hi: int, ordinal: str = "ordinal",
               name: str = "rank") -> DataFrame:
    """Rows at positions ``lo <= r < hi`` after a stable ascending sort by
    ``by`` (ties keep list order via ``ordinal``)."""
    ranked = add_ordinal(df, [F.col(by), F.col(ordinal)], name)
    return ranked.where((F.col(name) >= lo) & (F.col(name) < hi))


def share_of(i: Column, length: Column, n: int = SHARES) -> Column:
    """Share ``k`` of position ``i`` when a list of ``length`` is cut at
    ``int(length * k / n)``: ``ceil((i+1)·n / length) - 1`` in integers."""
    return (F.floor(((i + 1) * n + length - 1) / length) - 1).cast("int")


def share_bounds(k: Column, length: Column, n: int = SHARES) -> tuple[Column, Column]:
    lo = F.floor(length * k / n).cast("long")
    hi = F.floor(length * (k + 1) / n).cast("long")
    return lo, hi


def fraction_slice(df: DataFrame, n: int = SHARES, ordinal: str = "ordinal", length: str = "_len",
                   k: int | None = None) -> DataFrame:
    """Label every row with its share (``share``) of ``n`` exact shares; with
    ``k`` keep only that share.  ``df`` needs ``ordinal`` and ``length``."""
    out = df.withColumn("share", share_of(F.col(ordinal), F.col(length), n))
    return out if k is None else out.where(F.col("share") == k)


def skip_fraction(df: DataFrame, n: int = SHARES, from_share: int = UPPER_SHARES_FROM,
                  skip: float = UPPER_SKIP, ordinal: str = "ordinal", length: str = "_len") -> DataFrame:
    """Shares ``>= from_share`` drop their first ``int(len(share) * skip)``
    rows.  Needs ``share`` (``fraction_slice``); the share length is
    arithmetic, no count pass."""
    lo, hi = share_bounds(F.col("share"), F.col(length), n)
    pos_in = F.col(ordinal) - lo
    first_kept = ((hi - lo).cast("double") * F.lit(skip)).cast("long")
    return df.where((F.col("share") < from_share) | (pos_in >= first_kept))


def fixed_slice(df: DataFrame, ordinal: str = "ordinal", slice_len: int = SLICE_LEN,
                sub_slices: int = SUB_SLICES, slice_no: int | None = None,
                sub: int | None = None) -> DataFrame:
    """Label each position with ``slice`` (``i // slice_len``), ``sub``
    (sub-slice of ``int(slice_len / sub_slices)`` positions) and ``covered``
    (false for the tail positions no sub-slice reaches).  With
    ``slice_no``/``sub`` keep that one sub-slice."""
    sub_len = int(slice_len / sub_slices)
    i = F.col(ordinal)
    sl = F.floor(i / slice_len).cast("long")
    sb = F.floor((i - sl * slice_len) / sub_len).cast("long")
    out = df.withColumn("slice", sl).withColumn("sub", sb).withColumn("covered", sb < sub_slices)
    if slice_no is not None:
        out = out.where(F.col("slice") == slice_no)
    if sub is not None:
        out = out.where(F.col("sub") == sub)
    return out


def order_requests(requests: DataFrame, priority: str = "priority",
                   tie: Sequence[str] = ("request_url",)) -> DataFrame:
    """Higher priority first (missing priority is 0), with a position."""
    pr = F.coalesce(F.col(priority), F.lit(0))
    return add_ordinal(requests, [pr.desc(), *[F.col(t) for t in tie]], "queue_pos")


def keyed_running_count(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                        flag: Column | None = None, name: str = "running", inclusive: bool = True) -> DataFrame:
    """Per key, in ``order``: how many rows so far have ``flag`` (all rows when
    ``flag`` is None; ``inclusive`` counts the current row).

    A window partitioned by the key would put a key holding a third of all
    rows into one task.  Instead: a range-partitioned sort on (key, order)
    splits such a key over many partitions; a window over (partition, key)
    counts inside each piece; a small table of per-(partition, key) totals
    gives each piece the count carried in from the earlier pieces of its key.
    The sorted frame is checkpointed, so partition ids cannot change between
    the two uses.  Without a ``flag`` no window is needed: a row's place in its
    piece is its place in the sorted partition less that of the piece's first row.
    """
    work_dir(df.sparkSession)
    okeys = [F.col(k) for k in keys] + _cols(order)
    ranged = df.repartitionByRange(*okeys).sortWithinPartitions(*okeys)
    pid = F.spark_partition_id()
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if flag is None:
        local = F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)
        marked = ranged.select("*", pid.alias("_pid"), local.alias("_local")).checkpoint(eager=True)
        pieces = marked.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_t"), F.min("_local").alias("_first"))
        carry = pieces.select("_pid", *keys, (F.coalesce(F.sum("_t").over(earlier), F.lit(0)) - F.col("_first")).alias("_carry"))
        value = F.col("_carry") + F.col("_local") + F.lit(1 if inclusive else 0)
        return marked.join(carry, ["_pid", *keys], "inner").withColumn(name, value.cast("long")) \
            .drop("_pid", "_local", "_carry")
    marked = ranged.select("*", pid.alias("_pid"), F.coalesce(flag, F.lit(False)).cast("long").alias("_x")) \
        .checkpoint(eager=True)
    w = Window.partitionBy("_pid", *keys).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding,
                                                                          Window.currentRow)
    local = marked.withColumn("_local", F.sum("_x").over(w))
    totals = marked.groupBy("_pid", *keys).agg(F.sum("_x").alias("_t"))
    carry = totals.select("_pid", *keys, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_carry"))
    out = local.join(carry, ["_pid", *keys], "inner")
    value = F.col("_carry") + F.col("_local") - (F.lit(0) if inclusive else F.col("_x"))
    return out.withColumn(name, value.cast("long")).drop("_pid", "_x", "_local", "_carry")


def keyed_running_max(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column,
                      name: str = "running_max") -> DataFrame:
    """Per key, in ``order``: the greatest ``value`` so far (NULL until there
    is one).  Built like ``keyed_running_count``, so a key with a third of all
    rows is spread over many tasks; only keys, order columns and the value are
    checkpointed, so pass a narrow ``df``."""
    work_dir(df.sparkSession)
    okeys = [F.col(k) for k in keys] + _cols(order)
    ranged = df.withColumn("_x", value).repartitionByRange(*okeys).sortWithinPartitions(*okeys)
    marked = ranged.select("*", F.spark_partition_id().alias("_pid")).checkpoint(eager=True)
    w = Window.partitionBy("_pid", *keys).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding,
                                                                          Window.currentRow)
    local = marked.withColumn("_local", F.max("_x").over(w))
    tops = marked.groupBy("_pid", *keys).agg(F.max("_x").alias("_t"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = tops.select(F.col("_pid").alias("_p"), *[F.col(k).alias(f"_key_{k}") for k in keys],
                        F.max("_t").over(earlier).alias("_carry"))
    same = F.col("_pid") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    out = local.join(carry, same, "inner")
    return out.withColumn(name, F.greatest("_carry", "_local")) \
        .drop("_x", "_pid", "_p", "_local", "_carry", *[f"_key_{k}" for k in keys])
