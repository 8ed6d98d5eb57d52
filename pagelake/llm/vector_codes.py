"""Compression of vectors to codes of their parts (product quantisation).

Components become integers; every vector is cut into equal parts and each part
is coded by the nearest entry of its position's codebook.  The codebooks are
refined by rounds of assignment and componentwise means, in integers, so a
result does not depend on the order of the rows.

Distances come from per-dimension value dictionaries.  The vectors are written
once as chunks: for every dimension the distinct integers of the chunk and,
per vector, their dictionary codes.  An assignment tabulates, per dimension,
the squared differences of every distinct integer to all entries; the distance
of a part is then gathered from these tables by code and added up.

A chunk holds at most ``CHUNK_ROWS`` vectors, so a task's memory is bounded.
A round moves one row per task and used entry (count and sums), whatever the
size of the table; what the driver collects and sends out is the codebooks,
whose size is set by the parameters.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import cut

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
CHUNK_ROWS = 8_192  # codes of a chunk's dictionaries fit 16 bits
CHUNK_VALUES = 1 << 21
BLOCK_ROWS = 512  # rows whose distances are added up together


def largest_component(width: int) -> int:
    """Greatest size of an integer component whose squared distances, summed
    over a part, surely fit a signed 64-bit integer."""
    return int((2 ** 62 / max(width, 1)) ** 0.5) // 2


def _kept(column, parts: int, scale: float):
    """(row numbers, integer matrix) for each length of vector in an Arrow
    list column; unusable rows are left out."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).cast(pa.float64())
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    with np.errstate(invalid="ignore", over="ignore"):
        integers = np.floor(values * scale)
    for length in np.unique(lengths[(lengths > 0) & (lengths % parts == 0)]).tolist():
        rows = np.flatnonzero(lengths == length)
        block = integers[(ends[rows] - length)[:, None] + np.arange(length)]
        usable = (np.abs(block) <= largest_component(length // parts)).all(axis=1)  # false for nan and infinity
        if usable.any():
            yield rows[usable], block[usable].astype(np.int64)


def chunks(vectors: DataFrame, parts: int = PARTS, scale: float = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """The usable vectors as chunks of equal length: ``dim``, ``n``, ``ids``,
    ``labels``, ``values`` (distinct integers, dimension by dimension),
    ``sizes`` (how many a dimension has) and ``codes`` (unsigned 16-bit, all
    vectors of the first dimension first)."""
    id_type, label_type = vectors.schema[id_col].dataType, vectors.schema[label_col].dataType
    schema = T.StructType([
        T.StructField("dim", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)),
        T.StructField("values", T.ArrayType(T.LongType(), False)), T.StructField("sizes", T.ArrayType(T.IntegerType(), False)),
        T.StructField("codes", T.BinaryType())])

    def encode(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def one(x):  # an array as the only row of a list column
            return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)

        for b in batches:
            longest = pc.max(pc.list_value_length(b.column(1))).as_py() or 1
            step = max(1, min(CHUNK_ROWS, CHUNK_VALUES // max(longest, 1)))
            for lo in range(0, b.num_rows, step):
                piece = b.slice(lo, step)
                for rows, block in _kept(piece.column(1), parts, scale):
                    found = [np.unique(block[:, j], return_inverse=True) for j in range(block.shape[1])]
                    codes = np.stack([c.ravel() for _, c in found]).astype("<u2")
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.shape[1]], pa.int32()), pa.array([len(rows)], pa.int32()),
                         one(pc.take(piece.column(0), take)), one(pc.take(piece.column(2), take)),
                         one(pa.array(np.concatenate([v for v, _ in found]))),
                         one(pa.array([len(v) for v, _ in found], pa.int32())), pa.array([codes.tobytes()], pa.binary())],
                        names=[f.name for f in schema.fields])

    return vectors.select(F.col(id_col), F.col(vec_col), F.col(label_col)).mapInArrow(encode, schema)


def _dictionaries(batch, row: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct integers of each dimension, codes by dimension and vector)."""
    sizes = batch.column("sizes")[row].values.to_numpy()
    values = batch.column("values")[row].values.to_numpy()
    codes = np.frombuffer(batch.column("codes")[row].as_buffer(), dtype="<u2").reshape(len(sizes), -1)
    return np.split(values, np.cumsum(sizes)[:-1]), codes


def nearest(values: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of every vector's part; ties go to
    the lower entry.  ``book``: entries x width."""
    reach = max(int(np.abs(book).max()), max(int(np.abs(v).max()) for v in values))
    kind = np.int32 if len(values) * (2 * reach) ** 2 < 2 ** 31 else np.int64
    tables = [((v[:, None] - book[None, :, j]) ** 2).astype(kind) for j, v in enumerate(values)]
    n = codes.shape[1]
    best, error = np.empty(n, np.int64), np.empty(n, np.int64)
    for lo in range(0, n, BLOCK_ROWS):
        at = codes[:, lo:lo + BLOCK_ROWS].astype(np.intp)
        total = tables[0].take(at[0], axis=0)
        row = np.empty_like(total)
        for j in range(1, len(tables)):
            total += np.take(tables[j], at[j], axis=0, out=row, mode="clip")
        pick = total.argmin(axis=1)
        best[lo:lo + BLOCK_ROWS] = pick
        error[lo:lo + BLOCK_ROWS] = total[np.arange(len(pick)), pick]
    return best, error


def first_entries(made: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """Integer vectors of the smallest ids (null ids last, equal ids by their
    components), at most ``entries``."""
    field = made.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("id", field), T.StructField("vec", T.ArrayType(T.LongType(), False))])

    def smallest(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            for row in range(b.num_rows):
                ids = b.column("ids")[row].values
                values, codes = _dictionaries(b, row)
                whole = np.stack([v[c] for v, c in zip(values, codes, strict=True)])
                rank = pc.rank(ids, null_placement="at_end", tiebreaker="dense").to_numpy()
                order = np.lexsort((*whole[::-1], rank))[:entries]
                vec = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1) * len(whole), pa.int32()),
                                               pa.array(whole[:, order].T.ravel()))
                yield pa.RecordBatch.from_arrays([pc.take(ids, pa.array(order)), vec], names=["id", "vec"])

    rows = made.mapInArrow(smallest, schema).orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    return np.array([r.vec for r in rows], dtype=np.int64)


def _refine(made: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: assign all parts, then move every used entry to the floor of
    its parts' mean."""
    width = books[0].shape[1]
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType(), False))])

    def totals(batches):
        import pyarrow as pa

        shape = (len(books), len(books[0]))
        count, sums = np.zeros(shape, np.int64), np.zeros((*shape, width), np.int64)
        for b in batches:
            for row in range(b.num_rows):
                values, codes = _dictionaries(b, row)
                for p, book in enumerate(books):
                    lo = p * width
                    best, _ = nearest(values[lo:lo + width], codes[lo:lo + width], book)
                    count[p] += np.bincount(best, minlength=len(book))
                    order = np.argsort(best, kind="stable")
                    used, first = np.unique(best[order], return_index=True)
                    for j in range(width):
                        sums[p, used, j] += np.add.reduceat(values[lo + j][codes[lo + j]][order], first)
        part, entry = np.nonzero(count)
        flat = sums[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(flat.ravel()))],
            names=[f.name for f in schema.fields])

    added = made.mapInArrow(totals, schema).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums"))
    moved = [b.copy() for b in books]
    for r in added.collect():  # one row per part and entry at most
        moved[r.part][r.entry] = np.array(r.sums, dtype=np.int64) // r.n
    return moved


def _assigned(made: DataFrame, books: list[np.ndarray]) -> DataFrame:
    width = books[0].shape[1]
    schema = T.StructType([
        T.StructField("vec_id", made.schema["ids"].dataType.elementType),
        T.StructField("label", made.schema["labels"].dataType.elementType),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def assign(batches):
        import pyarrow as pa

        for b in batches:
            for row in range(b.num_rows):
                values, codes = _dictionaries(b, row)
                found = [nearest(values[p * width:(p + 1) * width], codes[p * width:(p + 1) * width], book)
                         for p, book in enumerate(books)]
                digits = np.stack([best for best, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                step = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[row].values, b.column("labels")[row].values,
                     pa.array([digits[i:i + step] for i in range(0, len(digits), step)], pa.string()),
                     pa.array(sum(error for _, error in found))], names=[f.name for f in schema.fields])

    return made.mapInArrow(assign, schema)


def books_digest(books: list[np.ndarray]) -> str:
    """Hex SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks).  Codes: ``vec_id``, ``label``, ``code`` (an entry
    per part, two hex digits each), ``error`` (squared distances summed over
    the parts).  Codebooks: one integer array of entries x width per part.

    Each component ``x`` becomes ``floor(scale * x)``.  Left out are vectors
    that are null or empty or hold null or non-finite components; so are those
    with an integer above ``largest_component`` (2^28 for parts of 16), whose
    distances don't fit a long, and those whose length differs from the
    commonest usable one that ``parts`` divides (ties: the shorter).  Codebooks
    start as the vectors of the smallest ids, fewer than ``entries`` if there
    are fewer.  Null ids come last; repeated rows are vectors of their own.
    Other columns are ignored, whatever their names.  No usable vector: no
    rows and no codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name 1 to 256 entries")
    made = cut(chunks(vectors, parts, scale, id_col, vec_col, label_col), "vector-chunks")
    common = made.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").first()
    books: list[np.ndarray] = []
    if common is None:
        return made.select(F.explode("ids").alias("vec_id"), F.col("labels")[0].alias("label"),
                           F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    made = made.where(F.col("dim") == common.dim)
    books = [b.copy() for b in np.split(first_entries(made, entries), parts, axis=1)]
    for _ in range(rounds):
        books = _refine(made, books)
    return _assigned(made, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``, the errors added up over equal labels (null is a
    label).  ``codes`` is written and read twice; a label that holds a third of
    the rows is one row per task before the shuffle."""
    codes = cut(codes, "vector-codes")
    sums = codes.groupBy(F.col("label").alias("_vc_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_vc_label")), "left").drop("_vc_label")
