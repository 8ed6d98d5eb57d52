"""Silver posts, clustered so that a cutoff reads only files that can hold kept posts.

The folder holds, per load (a named batch of landed pages):

* ``posts``: the good posts, in folders by load, year and account range, by
  month inside a file;
* ``firsts``: for every account and month the first place (page and position)
  where a post of that month stands, bad posts included.  Any cutoff year or
  month window finds an account's first stop here, whatever its rule, without
  a look at posts;
* ``bounds``: the account ranges, fixed by the first load.

A query takes the stops from ``firsts``.  A folder of posts can hold a kept
one only if some account of its range meets a wanted month of its year before
its stop; these folders are written as a small list that prunes the scan of ``posts``
(dynamic partition pruning), and each remaining post is compared with its
account's stop.

A load becomes visible when its ``firsts`` are written, which comes last; a
load that died is not seen, and one that is repeated under its name replaces
itself.  Loads of one store must not run at the same time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import extract as ex
from pagelake.operators.filters import PAGE_CARDS, month_stop
from pagelake.session import fresh_dir

RANGES = 16         # account ranges: with ten years, 160 folders a load
FOLDERS = ["load", "post_year", "folder"]
POST_COLS = ["post_month", "seed_key", "page_key", "page_no", "pos", "place", *ex.STATUS_OUT]
FIRSTS = "load string, account_range int, seed_key string, year int, month int, first long"


def _folder() -> Column:
    """Name of the folder of a post.  It names load, range and year together,
    since Spark prunes by each join column for itself."""
    return F.concat_ws(".", "load", "account_range", "year")


def _place() -> Column:
    """A post's place in its account's feed; pages without a number come first."""
    return F.coalesce(F.col("page_no").cast("long"), F.lit(-1)) * F.lit(PAGE_CARDS).cast("long") + F.col("pos")


class CardStore:
    """The store under ``path`` (shared by all machines)."""

    def __init__(self, spark: SparkSession, path: str, ranges: int = RANGES):
        self.spark, self.path, self.ranges = spark, path.rstrip("/"), ranges

    # ------------------------------------------------------------------ load

    def load(self, pages: DataFrame, name: str) -> None:
        """Add the posts of landed ``status_list`` pages; each page is parsed
        once.  A hot account's posts are split over tasks by their place."""
        if "/" in name or "=" in name:
            raise ValueError("a load is a plain name")
        staged = fresh_dir(self.spark, "silver-posts")
        cards = ex.status_cards(pages).where(~F.col("is_promo")) \
            .withColumns({"place": _place(), "post_month": F.coalesce("month", F.lit(0))}) \
            .select(*POST_COLS, "year", "month", "reject_reason")
        cards.write.parquet(staged)
        cards = self.spark.read.schema(cards.schema).parquet(staged)
        firsts = cards.where(F.col("year").isNotNull()).groupBy("seed_key", "year", "month") \
            .agg(F.min("place").alias("first"))
        account = self._range(self._bounds(firsts))
        placed = cards.where(F.col("reject_reason").isNull()) \
            .withColumns({"load": F.lit(name), "account_range": account}).select(
            "load", F.col("year").alias("post_year"), _folder().alias("folder"), *POST_COLS)
        self._drop(f"{self.path}/firsts/load={name}")     # a repeated load is not seen while it is rewritten
        self._drop(f"{self.path}/posts/load={name}")
        # by month inside a folder, so that a month window reads few row groups of a file
        order = [*FOLDERS[1:], "post_month", "seed_key", "place"]
        placed.repartitionByRange(*order).sortWithinPartitions(*order) \
            .write.mode("append").partitionBy(*FOLDERS).parquet(f"{self.path}/posts")
        firsts.select(F.lit(name).alias("load"), account.alias("account_range"), "seed_key", "year", "month", "first") \
            .write.mode("append").partitionBy("load").parquet(f"{self.path}/firsts")

    def _bounds(self, firsts: DataFrame) -> list[int]:
        """Upper ends of the account ranges but the last: equal numbers of the
        first load's accounts.  ``ranges`` bounds their number."""
        path = f"{self.path}/bounds"
        if not self._exists(f"{path}/_SUCCESS"):
            accounts = firsts.select(F.col("seed_key").try_cast("bigint").alias("_id")).distinct()
            cuts = [k / self.ranges for k in range(1, self.ranges)]
            ends = F.percentile_approx("_id", cuts, 10_000) if cuts else F.lit(None).cast("array<bigint>")
            accounts.agg(ends.alias("ends")).coalesce(1).write.mode("overwrite").parquet(path)
        row = self.spark.read.schema("ends array<bigint>").parquet(path).first()
        return sorted(set(row["ends"] or []))

    @staticmethod
    def _range(ends: list[int]) -> Column:
        """Number of the account's range; ids that are no numbers are in range 0."""
        ident = F.col("seed_key").try_cast("bigint")
        passed = F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends]), lambda e: e < ident) if ends else F.array()
        return F.size(passed).cast("int")

    # ------------------------------------------------------------------ read

    def firsts(self) -> DataFrame:
        if not self._exists(f"{self.path}/firsts"):
            return self.spark.createDataFrame([], FIRSTS)
        return self.spark.read.schema(FIRSTS).parquet(f"{self.path}/firsts")

    def posts(self) -> DataFrame:
        """All good posts of all loads (those without ``firsts`` included)."""
        types = {f.name: f.dataType.simpleString() for f in self._post_types()}
        schema = ", ".join(f"{c} {types[c]}" for c in POST_COLS)
        schema += ", load string, post_year int, folder string"
        if not self._exists(f"{self.path}/posts"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/posts")

    def _post_types(self):
        from pagelake.schemas import RAW_PAGES

        empty = self.spark.createDataFrame([], RAW_PAGES)
        return ex.status_cards(empty).withColumns({"place": _place(), "post_month": F.lit(0)}).select(*POST_COLS).schema.fields

    def until_year(self, min_year: int, accounts: DataFrame | None = None) -> DataFrame:
        """``year_cutoff`` of everything loaded: each account's good posts
        before its first post written before ``min_year``.  ``accounts``:
        distinct ids (``id``, text) to look at; default all."""
        return self._until(F.col("year") < F.lit(min_year), F.col("post_year") >= F.lit(min_year), accounts)

    def month_window(self, min_year: int = 2023, month: int = 4, accounts: DataFrame | None = None) -> DataFrame:
        """``month_window`` of everything loaded."""
        stop = month_stop(min_year, month)({"year": F.col("year"), "month": F.col("month")})
        return self._until(stop, (F.col("post_year") >= F.lit(min_year)) & (F.col("post_month") == F.lit(month)), accounts)

    def _until(self, stop: Column, wanted: Column, accounts: DataFrame | None) -> DataFrame:
        firsts, stops = self._stops(stop, accounts)
        live = self._live(firsts, stops).where(wanted).select("folder")
        posts = self.posts().where(wanted)
        if accounts is not None:
            posts = posts.join(accounts.select(F.col("id").alias("seed_key")), "seed_key", "left_semi")
        posts = posts.join(live, "folder", "left_semi")
        joined = posts.join(stops, F.col("seed_key").eqNullSafe(F.col("_key")), "left")
        return joined.where(F.col("_stop").isNull() | (F.col("place") < F.col("_stop"))).drop("_key", "_stop")

    def _stops(self, stop: Column, accounts: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        firsts = self.firsts()
        if accounts is not None:
            firsts = firsts.join(accounts.select(F.col("id").alias("seed_key")), "seed_key", "left_semi")
        return firsts, firsts.where(stop).groupBy(F.col("seed_key").alias("_key")).agg(F.min("first").alias("_stop"))

    def _live(self, firsts: DataFrame, stops: DataFrame) -> DataFrame:
        """Folders and months in which some account stands before its stop: a
        row each at most, written, so that its size is known."""
        near = firsts.join(stops, F.col("seed_key").eqNullSafe(F.col("_key")), "left") \
            .where(F.col("_stop").isNull() | (F.col("first") < F.col("_stop")))
        live = near.select(_folder().alias("folder"), F.col("year").alias("post_year"),
                           F.coalesce("month", F.lit(0)).alias("post_month")).distinct()
        path = fresh_dir(self.spark, "silver-folders")
        live.write.parquet(path)
        return self.spark.read.schema("folder string, post_year int, post_month int").parquet(path)

    # ----------------------------------------------------------------- files

    def _exists(self, path: str) -> bool:
        target, fs = self._hadoop(path)
        return fs.exists(target)

    def _drop(self, path: str) -> None:
        target, fs = self._hadoop(path)
        fs.delete(target, True)

    def _hadoop(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
