"""A set of ids that lives across runs: ``insert`` answers which ids are new.

The folder holds

* ``ids``: the set, append-only, bucketed by id.  It is declared as a table in
  the session's catalog (a bucketed folder can be declared again by any later
  session), so a join on the id reads it bucket by bucket without a shuffle;
* ``bits``: a Bloom filter as bitmaps of 32,768 bits, one row per insert and
  bitmap it touches.  An id sets one bit per hash.  Only ids whose bits are all
  set, which may be in the set, are looked up in ``ids``;
* ``answers``: the new ids of each insert, written before the set grows, so an
  insert that is run again under its name gives the same answer;
* ``counts``: one row per insert with its date, how many ids were given and
  how many were new, and a mergeable sketch of the ids given: totals by date
  need no look at old ids.

A run that dies leaves bits without ids at worst (a few needless lookups),
never ids without bits.  Inserts of one set must not run at the same time.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import fresh_dir

BUCKETS = 64
BITS = 1 << 30      # of the filter: 128 MB at most, in rows of 4 kB as they are touched
HASHES = 2
SKETCH_K = 14       # the sketch's 2^14 registers: a relative error of 1 % or so


class SeedStore:
    """The set under ``path`` (shared by all machines)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bits: int = BITS):
        self.spark, self.path, self.buckets, self.bits = spark, path.rstrip("/"), buckets, bits
        self.table = "seed_set_" + hashlib.md5(self.path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (id STRING) USING parquet "
                  f"CLUSTERED BY (id) INTO {int(buckets)} BUCKETS LOCATION '{self.path}/ids'")
        for name, schema in (("bits", "slot long, bits binary"),
                             ("counts", "name string, added_on date, n_given long, n_new long, sketch binary")):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def ids(self) -> DataFrame:
        return self.spark.table(self.table)

    def _slots(self, ids: DataFrame) -> DataFrame:
        """(``id``, ``slot``, ``position``): the bitmap and bit of every hash."""
        hashes = F.array(*[F.pmod(F.xxhash64(F.lit(k), F.col("id")), F.lit(self.bits)) for k in range(HASHES)])
        hashed = ids.select("id", F.explode(hashes).alias("_h"))
        return hashed.select("id", F.floor(F.col("_h") / 32_768).alias("slot"), (F.col("_h") % 32_768).cast("int").alias("position"))

    def maybe_known(self, ids: DataFrame) -> DataFrame:
        """Those of distinct ``ids`` that may be in the set: all their bits are
        set.  Ids that are in it are always among them."""
        bits = self.spark.read.schema("slot long, bits binary").parquet(f"{self.path}/bits") \
            .select(F.col("slot").alias("_slot"), "bits")
        byte = F.conv(F.hex(F.expr("substring(bits, position div 8 + 1, 1)")), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.expr("shiftleft(1, position % 8)")) != 0
        found = self._slots(ids).join(bits, (F.col("slot") == F.col("_slot")) & is_set, "left_semi")
        return found.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == HASHES).select("id")

    def known(self, ids: DataFrame) -> DataFrame:
        """Those of distinct ``ids`` that are in the set.  Candidates are
        written first, so that they and not the set are dealt out anew: the set
        is read bucket by bucket and not shuffled."""
        path = fresh_dir(self.spark, "seed-lookups")
        self.maybe_known(ids).write.parquet(path)
        return self.spark.read.schema("id string").parquet(path).join(self.ids().hint("merge"), "id", "left_semi")

    def insert(self, ids: DataFrame, column: str = "id", name: str | None = None, added_on: str | None = None) -> DataFrame:
        """Add the non-null values of ``column`` (as text) and return the new
        ones (``id``), each once.  ``name`` makes a repeated insert give its
        first answer again; ``added_on`` is its date (default: today)."""
        name = name or uuid.uuid4().hex
        given = ids.select(F.col(column).cast("string").alias("id")).where(F.col("id").isNotNull())
        answer = f"{self.path}/answers/{name}"
        tallied = None

        def tally() -> DataFrame:
            """The given ids, each once with how often it was given: written, so that what gives them runs once."""
            nonlocal tallied
            if tallied is None:
                path = fresh_dir(self.spark, "seed-given")
                given.groupBy("id").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
                tallied = self.spark.read.schema("id string, n long").parquet(path)
            return tallied

        if not self._exists(f"{answer}/_SUCCESS"):
            batch = tally().select("id")
            fresh = batch.join(self.known(batch), "id", "left_anti")
            fresh.write.mode("overwrite").parquet(answer)
        fresh = self.spark.read.schema("id string").parquet(answer)
        counts = self.spark.read.parquet(f"{self.path}/counts")
        if counts.where(F.col("name") == name).isEmpty():
            # bits before ids; the counts come last and mark the insert as done
            self._slots(fresh).groupBy("slot").agg(F.bitmap_construct_agg("position").alias("bits")) \
                .write.mode("append").parquet(f"{self.path}/bits")
            fresh.repartition(self.buckets, "id").write.mode("append").format("parquet").option("path", f"{self.path}/ids") \
                .bucketBy(self.buckets, "id").saveAsTable(self.table)
            day = F.lit(added_on).cast("date") if added_on else F.current_date()
            new = fresh.agg(F.count(F.lit(1)).alias("n_new"))
            row = tally().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_given"), F.hll_sketch_agg("id", SKETCH_K).alias("sketch")).join(new)
            row.select(F.lit(name).alias("name"), day.alias("added_on"), "n_given", "n_new", "sketch") \
                .coalesce(1).write.mode("append").parquet(f"{self.path}/counts")
        return fresh

    def totals(self) -> DataFrame:
        """Per date: ids given and new on it, and the set's size at its end.
        Reads one row per insert."""
        days = self.spark.read.parquet(f"{self.path}/counts").groupBy("added_on").agg(
            F.sum("n_given").alias("n_given"), F.sum("n_new").alias("n_new"))
        upto = days.select(F.col("added_on").alias("_day"), F.col("n_new").alias("_n"))
        return days.join(upto, F.col("_day") <= F.col("added_on")).groupBy("added_on", "n_given", "n_new") \
            .agg(F.sum("_n").alias("n_ids"))

    def sketches(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/counts").select("added_on", "sketch")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def estimated_union(*stores: SeedStore) -> float:
    """Distinct ids given to any of the stores, from their sketches alone (a
    relative error of about 1 %; 3 % is rare)."""
    every = reduce(DataFrame.unionByName, [s.sketches() for s in stores])
    size = every.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n")).first()["n"]
    return float(size or 0)
