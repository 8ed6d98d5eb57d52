"""Streaming operators over a landing folder of pages.

* ``stream_extract``: the batch extractors unchanged (explode and project:
  stateless, append mode).
* ``stream_new_commenters``: exact de-duplication of commenter ids
  (``dropDuplicates``; state is one key per distinct commenter), or bounded
  state with a watermark (``dropDuplicatesWithinWatermark``), which emits an
  id again when it returns after the watermark has passed.
* ``stream_take_until``: the ordered prefix across an account's pages as a
  per-account state machine (``transformWithState``).  Pages may land
  out of order, more than once, late or never: pages that arrive ahead of
  their turn wait in a map state, one entry per landing, so a batch costs its
  own pages and those it releases, whatever is held; an event-time timer gives
  up a gap.  Every landing of a page counts; one that comes after its turn is
  cut at the first stop so far.  What has been written is not taken back when
  a late page stops earlier.
* ``stream_error_streak``: runs of profile failures per slice; emits an alert
  row when a run reaches ``n``.  Fetches wait in a list state until the
  watermark has passed them and are then taken in time order, so files may
  land in any order within the watermark's delay.
* ``stream_max_id``: highest id per group in update mode, upserted by key into
  a versioned table (``sinks.versions``).

Every query keeps its checkpoint in the given (shared) folder, so a restarted
driver or lost executor resumes from the last committed batch.  The stateful
ones keep their state in RocksDB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import groupby, islice

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pagelake.operators import extract as ex
from pagelake.operators.audit import STREAK_LIMIT, profile_outcomes
from pagelake.operators.filters import require_cursor
from pagelake.sinks.versions import upsert_sink
from pagelake.sources.pages import read_pages


def run_to_end(writer, checkpoint: str, timeout_s: float | None = None) -> StreamingQuery:
    """Start a writer with ``availableNow`` and wait until all input is done.
    With ``timeout_s`` a run that takes longer is stopped and raises: its sink
    is not complete."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream was stopped after {timeout_s} s; its sink is not complete")
    if q.exception() is not None:
        raise q.exception()
    return q


def _source(spark: SparkSession, landing: str, max_files: int | None, fmt: str) -> DataFrame:
    return read_pages(spark, landing, streaming=True, fmt=fmt, max_files_per_trigger=max_files)


def stream_extract(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                   extractor: Callable[[DataFrame], DataFrame] = ex.extract_statuses,
                   max_files: int | None = None, fmt: str = "parquet") -> StreamingQuery:
    out = extractor(_source(spark, landing, max_files, fmt))
    return run_to_end(out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


def stream_new_commenters(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                          max_files: int | None = None, fmt: str = "parquet",
                          watermark: str | None = None) -> StreamingQuery:
    pages = _source(spark, landing, max_files, fmt)
    if watermark:
        pages = pages.withWatermark("fetched_at", watermark)
        items = require_cursor(ex.comment_items(pages).where(F.col("reject_reason").isNull()))
        ids = items.select(F.col("comment_people_id").alias("user_id"), "fetched_at") \
            .where(F.col("user_id").isNotNull()).dropDuplicatesWithinWatermark(["user_id"]).select("user_id")
    else:
        ids = ex.extract_comments(pages).select(F.col("comment_people_id").alias("user_id")) \
            .where(F.col("user_id").isNotNull()).dropDuplicates(["user_id"])
    return run_to_end(ids.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


# --------------------------------------------------------------------------- time and state

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK = 10_000    # rows of a key taken together
CLOCK = "(clock)"  # ``page_key`` of rows that only move the watermark


@contextmanager
def _rocksdb(spark: SparkSession):
    """Stream queries started inside keep their state in RocksDB (a query
    takes the setting when it starts)."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)


def _clocks(spark: SparkSession, checkpoint: str) -> str:
    """Folder of clock rows beside the checkpoint."""
    folder = checkpoint.rstrip("/") + "-clocks"
    spark.createDataFrame([], "fetched_at timestamp").write.mode("append").parquet(folder)
    return folder


def _with_clock(pages: DataFrame, folder: str, kind: str | None, delay: str) -> DataFrame:
    """Pages of ``kind`` (None: all) and clock rows with a watermark on the
    fetch time."""
    clock = pages.sparkSession.readStream.schema("fetched_at timestamp").parquet(folder).withColumns(
        {"kind": F.lit(kind or CLOCK), "page_key": F.lit(CLOCK)})
    pages = pages if kind is None else pages.where(F.col("kind") == kind)
    return pages.unionByName(clock, allowMissingColumns=True).withWatermark("fetched_at", delay)


def _run_and_close(run: Callable[[], StreamingQuery], final: bool, spark: SparkSession, landing: str, fmt: str, folder: str,
                   *waits: str) -> StreamingQuery:
    """Run to the end of what has landed.  With ``final`` a clock row is then
    landed, later than every page by twice the ``waits``, and a second short
    run lets the timers fire: it has to come behind all pages, which one run
    can't promise."""
    with _rocksdb(spark):
        q = run()
        if final:
            last = read_pages(spark, landing, fmt=fmt).agg(F.max("fetched_at").alias("t"))
            after = F.coalesce(F.col("t"), F.timestamp_seconds(F.lit(0))) + F.expr("INTERVAL 1 SECOND")
            for wait in waits:
                after = after + F.expr(f"INTERVAL {wait}") * 2
            last.select(after.alias("fetched_at")).write.mode("append").parquet(folder)
            q = run()
    return q


# --------------------------------------------------------------------------- take_until as state

POST_FIELDS = ["edit_at", "created_ts", "text", "reposts_count", "comments_count", "attitudes_count", "status_id", "origin_url"]
HELD = ("array<struct<pos: bigint, edit_at: string, created_ts: timestamp, text: string, reposts_count: bigint, "
        "comments_count: bigint, attitudes_count: bigint, status_id: string, origin_url: string>>")
TAKE_OUT = T.StructType([T.StructField("seed_key", T.StringType()), T.StructField("posts", T.StringType()),
                         T.StructField("stop_pos", T.LongType())])
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class TakeUntil(StatefulProcessor):
    """Releases an account's pages in the order of their numbers.

    State: the next page number, the first stop (page and position) and when
    to give up the gap being waited for; and, by (page number, landing), the
    posts of pages that are ahead.
    """

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", "next_page long, stop_page long, stop_pos long, give_up long")
        self.held = handle.getMapState("held", "page long, landing long", "posts string, stop_pos long, deadline long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._load()
        out: list[tuple] = []
        watermark = timerValues.getCurrentWatermarkInMs()
        while chunk := sorted(islice(rows, CHUNK), key=lambda r: r.page_no):
            for page, landed in groupby(chunk, key=lambda r: r.page_no):
                landed = list(landed)
                landings = [(r.posts, r.stop_pos) for r in landed]
                if page > self.next_page:
                    if self.stop is None:  # nothing after the first stop is wanted
                        at = [r.fetched_ms for r in landed if r.fetched_ms is not None]
                        self._hold(page, landings, (max(at) if at else watermark) + self.patience_ms)
                    continue
                self._release(page, landings, out)
                if page == self.next_page:
                    self._go_on(page + 1, out)
        yield from self._finish(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        out: list[tuple] = []
        waiting = sorted((k[0], v[2]) for k, v in self.held.iterator())
        for page, deadline in waiting:
            if page < self.next_page:  # released with the run before it
                continue
            if deadline > timerValues.getCurrentWatermarkInMs() or self.stop is not None:
                break
            self._go_on(page, out)
        self.give_up = min((d for p, d in waiting if p >= self.next_page), default=None) if self.stop is None else None
        if self.give_up is not None:
            self.handle.registerTimer(self.give_up)
        yield from self._finish(key, out)

    def close(self) -> None:
        pass

    def _load(self) -> None:
        next_page, stop_page, stop_pos, give_up = self.progress.get() or (0, None, None, None)
        self.next_page, self.give_up = next_page, give_up
        self.stop = None if stop_page is None else (stop_page, stop_pos)

    def _hold(self, page: int, landings: list[tuple], deadline: int) -> None:
        k = 0
        while self.held.containsKey((page, k)):
            k += 1
        for posts, stop in landings:
            self.held.updateValue((page, k), (posts, stop, deadline))
            k += 1
        if self.give_up is None:
            self.give_up = deadline
            self.handle.registerTimer(deadline)

    def _release(self, page: int, landings: list[tuple], out: list[tuple]) -> None:
        stops = [(page, s) for _, s in landings if s is not None]
        if stops:
            self.stop = min([*stops, *([self.stop] if self.stop else [])])
        if self.stop is None or page <= self.stop[0]:
            cut = self.stop[1] if self.stop and self.stop[0] == page else None
            out += [(posts, cut) for posts, _ in landings]

    def _go_on(self, page: int, out: list[tuple]) -> None:
        """Release held pages from ``page`` on until one is missing.  Without a
        time to give up, no page is held."""
        while self.stop is None and self.give_up is not None and self.held.containsKey((page, 0)):
            landings, k = [], 0
            while self.held.containsKey((page, k)):
                landings.append(self.held.getValue((page, k))[:2])
                self.held.removeKey((page, k))
                k += 1
            self._release(page, landings, out)
            page += 1
        self.next_page = max(self.next_page, page)
        if self.stop is not None and self.give_up is not None:
            self.held.clear()
            self.give_up = None

    def _finish(self, key, out: list[tuple]) -> Iterator[Row]:
        self.progress.update((self.next_page, *(self.stop or (None, None)), self.give_up))
        for posts, stop in out:
            yield Row(seed_key=key[0], posts=posts, stop_pos=stop)


def take_until_input(pages: DataFrame, min_year: int) -> DataFrame:
    """One row per landing of a post-list page: its good posts up to its own
    first stop, as JSON, and where that stop is.  A page without a number is
    before the numbered ones."""
    cut = ex.prefix_pages(pages, lambda f: f["year"] < F.lit(min_year))
    good = F.transform(F.filter("posts", lambda x: x["reject_reason"].isNull()),
                       lambda x: F.struct(x["pos"].alias("pos"), *[x[f].alias(f) for f in POST_FIELDS]))
    return cut.select("seed_key", F.coalesce("page_no", F.lit(-1)).alias("page_no"),
                      F.unix_millis("fetched_at").alias("fetched_ms"), "stop_pos", F.to_json(good, EXACT).alias("posts"))


def take_until_stateful(pages: DataFrame, min_year: int, patience: str) -> DataFrame:
    """``pages`` has a watermark.  Only the timers use it: the fetch time goes
    on as a number, so no page is dropped as late."""
    patience_ms = int(pd.Timedelta(patience) / pd.Timedelta(milliseconds=1))
    out = take_until_input(pages, min_year).groupBy("seed_key").transformWithState(
        TakeUntil(patience_ms), TAKE_OUT, "Append", "EventTime")
    posts = out.select("seed_key", "stop_pos", F.inline(F.from_json("posts", HELD, EXACT)))
    posts = posts.where("stop_pos IS NULL OR pos < stop_pos").withColumn("user_id", F.col("seed_key").try_cast("bigint"))
    return posts.select(*ex.STATUS_OUT)


def stream_take_until(spark: SparkSession, landing: str, sink: str, checkpoint: str, min_year: int,
                      max_files: int | None = None, fmt: str = "parquet", final: bool = True,
                      delay: str = "1 hour", patience: str = "1 day") -> StreamingQuery:
    """The stream up to the pages that have landed.

    A gap in an account's page numbers is given up when the watermark (the
    latest fetch less ``delay``) is ``patience`` behind the pages that wait
    for it: they are then released by the batch rule.  With ``final`` all gaps
    are given up at the end: a clock row is landed that moves the watermark
    past every page; without it pages wait in the state for the next run.
    """
    folder = _clocks(spark, checkpoint)

    def run() -> StreamingQuery:
        pages = _with_clock(_source(spark, landing, max_files, fmt), folder, "status_list", delay)
        out = take_until_stateful(pages, min_year, patience)
        return run_to_end(out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)

    return _run_and_close(run, final, spark, landing, fmt, folder, delay, patience)


# --------------------------------------------------------------------------- error streaks as state

STREAK_OUT = T.StructType([
    T.StructField("slice", T.StringType()), T.StructField("run", T.LongType()),
    T.StructField("first_us", T.LongType()), T.StructField("alert_us", T.LongType()),
])


class ErrorStreak(StatefulProcessor):
    """Counts a slice's failures in a row.

    State: successes so far, length and start of the present run; and the
    fetches that the watermark has not passed, which a timer takes out in time
    order.
    """

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "run long, length long, first_us long, timer long")
        self.pending = handle.getListState("pending", "t_us long, page_key string, failed boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        run, length, first, timer = self.run.get() or (0, 0, None, None)
        earliest = None
        fetches = ((r.t_us, r.page_key, r.failed) for r in rows if r.page_key != CLOCK)
        while chunk := list(islice(fetches, CHUNK)):
            self.pending.appendList(chunk)
            first_us = min(t for t, _, _ in chunk)
            earliest = first_us if earliest is None else min(earliest, first_us)
        if earliest is not None:
            at = max(earliest // 1000, 0)
            if timer is None or at < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                timer = at
                self.handle.registerTimer(at)
            self.run.update((run, length, first, timer))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        run, length, first, _ = self.run.get()
        passed = timerValues.getCurrentWatermarkInMs()
        due, later = [], []
        for row in self.pending.get():
            (due if row[0] // 1000 <= passed else later).append(tuple(row))
        alerts = []
        for t, _page, failed in sorted(due):
            if not failed:
                run, length, first = run + 1, 0, None
                continue
            first = t if length == 0 else first
            length += 1
            if length == self.n:
                alerts.append((key[0], run, first, t))
        timer = min((r[0] for r in later), default=None)
        if later:
            timer = max(timer // 1000, 0)
            self.pending.put(later)
            self.handle.registerTimer(timer)
        else:
            self.pending.clear()
        self.run.update((run, length, first, timer))
        for alert in alerts:
            yield Row(**dict(zip(STREAK_OUT.fieldNames(), alert)))

    def close(self) -> None:
        pass


def error_streak_stateful(outcomes: DataFrame, n: int = STREAK_LIMIT) -> DataFrame:
    """``outcomes``: ``slice`` (text), ``page_key``, ``fetched_at`` with a
    watermark, ``failed``.  A fetch without a time counts as the first."""
    rows = outcomes.select("slice", F.coalesce("page_key", F.lit("")).alias("page_key"),
                           F.coalesce(F.unix_micros("fetched_at"), F.lit(-1)).alias("t_us"),
                           F.coalesce("failed", F.lit(False)).alias("failed"))
    out = rows.groupBy("slice").transformWithState(ErrorStreak(n), STREAK_OUT, "Append", "EventTime")
    return out.select("slice", "run", F.timestamp_micros("first_us").alias("first_at"),
                      F.timestamp_micros("alert_us").alias("alert_at"))


def fetch_outcomes(pages: DataFrame) -> DataFrame:
    """A fetch fails when its HTTP status is not 200."""
    return pages.select("seed_key", "page_key", "fetched_at", (F.col("http_status") != 200).alias("failed"))


def stream_error_streak(spark: SparkSession, landing: str, sink: str, checkpoint: str, n: int = STREAK_LIMIT,
                        max_files: int | None = None, fmt: str = "parquet", final: bool = True, delay: str = "1 day",
                        slices: DataFrame | None = None, kind: str | None = None,
                        outcomes: Callable[[DataFrame], DataFrame] = fetch_outcomes) -> StreamingQuery:
    """An alert per run of ``n`` failures in a row.

    ``slices`` maps accounts (``seed_key``) to their ``slice`` of the work
    list; without it an account is its own slice.  ``outcomes`` tells failed
    pages of ``kind``.  Files may land in any order within ``delay``; a fetch
    that lands later still counts, where it arrives.  ``final`` moves the clock past every page at the end, so
    all fetches are counted; without it the last ``delay`` waits.
    """
    folder = _clocks(spark, checkpoint)

    def run() -> StreamingQuery:
        found = outcomes(_with_clock(_source(spark, landing, max_files, fmt), folder, kind, delay))
        if slices is None:
            found = found.withColumn("slice", F.col("seed_key"))
        else:
            known = slices.select(F.col("seed_key").alias("_account"), F.col("slice").cast("string").alias("slice"))
            found = found.join(known, F.col("seed_key") == F.col("_account"), "left")
        return run_to_end(error_streak_stateful(found, n).writeStream.format("parquet").option("path", sink)
                          .outputMode("append"), checkpoint)

    return _run_and_close(run, final, spark, landing, fmt, folder, delay)


def stream_profile_error_streak(spark: SparkSession, landing: str, sink: str, checkpoint: str, slices: DataFrame,
                                **options) -> StreamingQuery:
    """``stream_error_streak`` per slice over profile pages alone: a page fails
    when it gives no profile or no post-list container."""
    return stream_error_streak(spark, landing, sink, checkpoint, slices=slices, kind="profile", outcomes=profile_outcomes, **options)


# --------------------------------------------------------------------------- running max

def stream_max_id(spark: SparkSession, landing: str, table: str, checkpoint: str,
                  by: tuple[str, ...] = ("slice",), slices: DataFrame | None = None, month: int | None = None,
                  max_files: int | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Highest account id per group so far, upserted into the versioned table
    at ``table`` (``sinks.versions.read_current``).  ``slices`` as in
    ``stream_error_streak``; only groups that a batch touches are sent on."""
    cards = ex.status_cards(_source(spark, landing, max_files, fmt))
    posts = cards.where(~F.col("is_promo") & F.col("reject_reason").isNull())
    if month is not None:
        posts = posts.where(F.col("month") == month)
    if slices is not None:
        known = slices.select(F.col("seed_key").alias("_account"), "slice")
        posts = posts.join(known, F.col("seed_key") == F.col("_account"), "left")
    agg = posts.groupBy(*by).agg(F.max("user_id").alias("max_id"))
    return run_to_end(agg.writeStream.outputMode("update").foreachBatch(upsert_sink(table, by)), checkpoint)
