"""Fill-in-the-middle training texts.

A document is cut into units (lines); two of its unit borders, drawn from a
hash of its id, split it into prefix, middle and suffix, which are written in
the order of its form behind their marks.

Every batch goes through ``pyarrow.compute`` alone: texts become list arrays
of units, the lists are flattened with their parents' indices, each unit gets
its ordinal inside its parent, units are filtered by role, the lists of a role
are rebuilt from the counts and ``binary_join`` makes its text.  Nothing is
shuffled; batches are cut to a bounded amount of text, so memory follows the
longest text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.tokens import slices

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle


def _check(marks: Sequence[str]) -> tuple[str, str, str]:
    """Marks of the form ``<...>`` without further angle brackets: none can
    arise where two pieces meet, so a text without marks is always restored."""
    if len(set(marks)) != 3 or any(len(m) < 3 or m[0] != "<" or m[-1] != ">" or set(m[1:-1]) & set("<>") for m in marks):
        raise ValueError("marks must be three different texts of the form <...>")
    return tuple(marks)


def _units(text):
    """Units of each text, flat: (units, parent row, ordinal in the row,
    number of units of each row)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    pieces = pc.split_pattern(text, "\n")
    breaks = pc.subtract(pc.list_value_length(pieces), 1)
    open_end = pc.invert(pc.or_(pc.equal(text, ""), pc.ends_with(text, "\n")))  # a last unit without a line break
    n = pc.add(breaks, open_end.cast(breaks.type)).cast(pa.int64())
    flat, parent = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(pieces.offsets[:-1], parent).cast(pa.int64()))
    closed = pc.less(ordinal, pc.take(breaks, parent).cast(pa.int64()))
    ends = pc.if_else(closed, pa.scalar("\n", text.type), pa.scalar("", text.type))
    units = pc.binary_join_element_wise(flat, ends, pa.scalar("", text.type))
    return units, parent, ordinal, n


def _rebuild(units, mask, counts):
    """Texts of one role: its units by row, joined."""
    import pyarrow as pa
    import pyarrow.compute as pc

    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])
    lists = pa.ListArray.from_arrays(offsets, pc.filter(units, mask))
    return pc.binary_join(lists, pa.scalar("", units.type))


def _modulo(x, n):
    import pyarrow.compute as pc

    return pc.subtract(x, pc.multiply(pc.divide(x, n), n))


def fill_in_middle(docs: DataFrame, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED,
                   marks: Sequence[str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n`` (units), ``form``
    (``plain``, ``psm`` or ``spm``), ``output``, ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain).

    A unit is a line with its line break, or what follows the last one.  The
    first four 8-digit groups of the SHA-256 of ``seed:id`` give the two
    borders (modulo ``n + 1``), the share of texts left plain and the share of
    ``spm``.  Null text counts as empty; empty texts and texts that hold a mark
    stay plain.  A null id hashes as nothing after the colon.  Rows with equal
    ids are documents of their own; other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    P, S, M = _check(marks)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    source = docs.select(F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *draws)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("output", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())])

    def transform(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        wide = pa.large_string()
        one, P_, S_, M_, none = (pa.scalar(x, wide) for x in ("", P, S, M, None))
        for b in slices(batches):
            text = b.column(1).cast(wide)
            units, parent, ordinal, n = _units(text)
            borders = pc.add(n, 1)
            a, z = _modulo(b.column(2), borders), _modulo(b.column(3), borders)
            lo, hi = pc.min_element_wise(a, z), pc.max_element_wise(a, z)
            lo_u, hi_u, n_u = (pc.take(x, parent) for x in (lo, hi, n))
            prefix = _rebuild(units, pc.less(ordinal, lo_u), lo)
            middle = _rebuild(units, pc.and_(pc.greater_equal(ordinal, lo_u), pc.less(ordinal, hi_u)), pc.subtract(hi, lo))
            suffix = _rebuild(units, pc.and_(pc.greater_equal(ordinal, hi_u), pc.less(ordinal, n_u)), pc.subtract(n, hi))
            plain = pc.or_(pc.equal(text, ""), pc.greater_equal(_modulo(b.column(4), 100), fim_percent))
            for mark in (P, S, M):
                plain = pc.or_(plain, pc.match_substring(text, mark))
            spm = pc.less(_modulo(b.column(5), 100), spm_percent)
            output = pc.if_else(
                plain, text, pc.if_else(spm, pc.binary_join_element_wise(S_, suffix, P_, prefix, M_, middle, one),
                                        pc.binary_join_element_wise(P_, prefix, S_, suffix, M_, middle, one)))
            form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
            chars = [pc.utf8_length(pc.if_else(plain, none, x)).cast(pa.int64()) for x in (prefix, middle)]
            yield pa.RecordBatch.from_arrays([b.column(0), n, form, output.cast(pa.string()), *chars],
                                             names=[f.name for f in schema.fields])

    return source.mapInArrow(transform, schema)


def _between(x, first, second, third):
    """The three pieces of texts ``first a second b third c``."""
    import pyarrow.compute as pc

    rest = pc.utf8_slice_codeunits(x, len(first))
    halves = pc.split_pattern(rest, second, max_splits=1)
    tail = pc.split_pattern(pc.list_element(halves, 1), third, max_splits=1)
    return pc.list_element(halves, 0), pc.list_element(tail, 0), pc.list_element(tail, 1)


def restore(rows: DataFrame, marks: Sequence[str] = MARKS, restored: str = "restored") -> DataFrame:
    """Add the exact text, rebuilt from ``output`` and ``form`` alone.  Other
    columns are kept; ``restored`` names the new one.  Null outputs stay null."""
    P, S, M = _check(marks)
    keep = rows.schema.fields
    at = {f.name: i for i, f in enumerate(keep)}
    schema = T.StructType([*keep, T.StructField(restored, T.StringType())])

    def rebuild(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        wide = pa.large_string()
        one = pa.scalar("", wide)
        for b in slices(batches, column=at["output"]):
            output, form = b.column(at["output"]).cast(wide), b.column(at["form"])
            text = output
            for name, marks_ in (("psm", (P, S, M)), ("spm", (S, P, M))):
                mine = pc.equal(form, name)
                x, y, middle = _between(pc.if_else(mine, output, pa.scalar("".join(marks_), wide)), *marks_)
                prefix, suffix = (x, y) if name == "psm" else (y, x)
                text = pc.if_else(mine, pc.binary_join_element_wise(prefix, middle, suffix, one), text)
            yield pa.RecordBatch.from_arrays([*b.columns, text.cast(pa.string())], names=[f.name for f in schema.fields])

    return rows.mapInArrow(rebuild, schema)
