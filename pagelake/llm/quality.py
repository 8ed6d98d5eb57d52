"""Quality rules with robust multivariate outliers.

Text statistics of each document are transformed to a vector; per language and
source a minimum-covariance-determinant (MCD) estimate gives a centre and a
scatter that junk does not move, and documents far from the centre in
Mahalanobis distance are rejected, beside two fixed base rules.

Statistics are computed inside each row by built-in functions.  An MCD
concentration step is one aggregate: rows are binned by distance per group,
each bin keeps its count, sums and products, a running sum over a group's bins
finds the smallest ball with at least ``H`` of its rows, and that ball's sums
are the next centre and scatter.  A group of any size is thus partially
aggregated to at most a few hundred bins per task, and no row is moved.
Vectors are whole numbers (ten-thousandths), so sums don't depend on order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.common import checkpointed, cut

MIN_WORDS = 50               # base rule
MAX_REPEAT_PERCENT = 50      # base rule
MIN_ROWS = 50                # smaller (language, source) groups are pooled by language, then over all
H = 0.6                      # share of a group in the concentrated subset
STEPS = 3                    # concentration steps
# Chi-square with 5 degrees of freedom. Share / P(chi2_7 <= q_share), quantiles 0.975 and 0.99999.
H_FACTOR = 1.6848
WEIGHT_FACTOR = 1.0556
WEIGHT_CUT = 12.8325
CUTOFF = 30.8562
# Transformed statistics, in ten-thousandths, each with the standard deviation below which differences carry no
# weight (clean texts have no symbols at all, so an estimate alone would be singular).
UNIT = 10_000
VECTOR = {
    "x1": ("ln(n_words)", 1.5),
    "x2": ("ln(word_chars / n_words)", 0.06),
    "x3": ("n_symbols / n_words", 0.04),
    "x4": ("10 * n_dup_lines / n_words", 0.15),
    "x5": ("n_repeat_words / n_words", 0.08),
}
X = list(VECTOR)
PAIRS = [(a, b) for i, a in enumerate(X) for b in X[:i + 1]]
BIN = "CAST(floor(32 * ln(1 + {0})) AS BIGINT)"

_BLANK = r"\x20\x09-\x0D"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row plus its statistics (see the query's
    contract) and ``base_failed``.  Each text is read once, inside its row;
    repeated word triples are found by sorting their 64-bit hashes, so the
    work is n log n in the words of a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(*[F.col(c).alias(c) for c in keep], text.alias("_text"))
    blanks = r"' \t\n\u000b\u000c\r'"
    words = (f"CASE WHEN btrim(_text, {blanks}) = '' THEN CAST(array() AS array<string>) "
             f"ELSE split(btrim(_text, {blanks}), r'[{_BLANK}]+') END")
    lines = f"filter(split(_text, '\\n'), x -> rlike(x, r'[^{_BLANK}]'))"
    triples = ("CASE WHEN size(w) < 3 THEN CAST(array() AS array<struct<h:bigint,p:int>>) ELSE "
               "sort_array(transform(sequence(0, size(w) - 3), "
               "i -> struct(xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)) AS h, i AS p))) END")
    twice = ("sort_array(transform(filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) "
             "OR coalesce(get(s, i + 1).h = x.h, false)), x -> x.p))")
    cover = "aggregate(transform(q, (p, i) -> least(3, coalesce(get(q, i + 1) - p, 3))), 0, (a, x) -> a + x)"
    # lambda variables hold the arrays: as projected columns they could be inlined and evaluated per element
    counts = _let(words, "w", f"struct(size(w) AS n, {_let(triples, 's', _let(twice, 'q', cover))} AS r)")
    counted = base.select(*keep, "_text", F.expr(counts).alias("_w")).select(
        *keep, F.col("_w.n").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.expr(_let(lines, "l", "size(l) - size(array_distinct(l))")).cast("long").alias("n_dup_lines"),
        F.col("_w.r").cast("long").alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def vector_sql() -> dict[str, str]:
    return {x: f"CAST(round({UNIT} * ({e})) AS DOUBLE)"
            for x, (e, _) in VECTOR.items()}


def scatter_sql(n: str, total: Callable[[str], str], factor: float) -> dict[str, str]:
    """Centre ``m_*`` and scatter ``c_*`` from a count and sums."""
    out = {f"m_{a}": f"{total(a)} / {n}" for a in X}
    for a, b in PAIRS:
        c = f"({total(a + b)} / {n} - ({total(a)} / {n}) * ({total(b)} / {n})) * {factor}"
        out[f"c_{a}{b}"] = c if a != b else f"greatest({c}, 0.0) + {(VECTOR[a][1] * UNIT) ** 2}"
    return out


def cholesky_sql() -> list[dict[str, str]]:
    """Lower triangle ``l_*`` of the scatter, in steps that use earlier ones."""
    out = []
    for j, b in enumerate(X):
        diag = " - ".join([f"c_{b}{b}", *(f"l_{b}{k} * l_{b}{k}" for k in X[:j])])
        out.append({f"l_{b}{b}": f"sqrt(greatest({diag}, 1.0))"})
        out.append({f"l_{a}{b}": "(" + " - ".join([f"c_{a}{b}", *(f"l_{a}{k} * l_{b}{k}" for k in X[:j])]) + f") / l_{b}{b}"
                    for a in X[j + 1:]})
    return [s for s in out if s]


def distance_sql() -> list[dict[str, str]]:
    """Squared Mahalanobis distance ``d2`` by forward substitution."""
    out = [{f"y_{a}": "(" + " - ".join([f"{a} - m_{a}", *(f"l_{a}{k} * y_{k}" for k in X[:i])]) + f") / l_{a}{a}"}
           for i, a in enumerate(X)]
    return [*out, {"d2": " + ".join(f"y_{a} * y_{a}" for a in X)}]


def _steps(df: DataFrame, steps: list[dict[str, str]]) -> DataFrame:
    for s in steps:
        df = df.select("*", *[F.expr(e).alias(n) for n, e in s.items()])
    return df


def _params(sums: DataFrame, factor: float) -> DataFrame:
    """Group parameters from one row of sums per group."""
    scatter = sums.select("_group", *[F.expr(e).alias(n) for n, e in scatter_sql("n", lambda s: f"s_{s}", factor).items()])
    names = ["_group", *[f"m_{a}" for a in X], *[f"l_{a}{b}" for a, b in PAIRS]]
    return checkpointed(_steps(scatter, cholesky_sql()).select(*names))


def _sums(use=None) -> list:
    """Count, sums and products of the rows (of those that ``use`` marks)."""
    only = (lambda c: c) if use is None else (lambda c: F.when(use, c))
    return [F.count(only(F.lit(1))).alias("n"), *[F.sum(only(F.col(a))).alias(f"s_{a}") for a in X],
            *[F.sum(only(F.col(a) * F.col(b))).alias(f"s_{a}{b}") for a, b in PAIRS]]


def _concentrate(binned: DataFrame) -> DataFrame:
    """Sums over each group's smallest ball of whole distance bins that holds
    at least ``H`` of its rows."""
    bins = binned.groupBy("_group", "_bin").agg(*_sums())
    upto = Window.partitionBy("_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_group")
    run = bins.select("_group", "_bin", F.sum("n").over(whole).alias("_total"),
                      *[F.sum(c).over(upto).alias(c) for c in bins.columns if c not in ("_group", "_bin")])
    first = Window.partitionBy("_group").orderBy("_bin")
    return run.where(F.col("n") >= F.ceil(F.col("_total") * H)).withColumn("_k", F.row_number().over(first)) \
        .where("_k = 1").drop("_k", "_bin", "_total")


def _start(rows: DataFrame) -> DataFrame:
    """Centre and scale to begin with: medians and quartile ranges of each
    coordinate, from counts per hundredth."""
    long = rows.select("_group", F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.floor(F.col(a) / 100).alias("v")) for a in X])).alias("_x")) \
        .groupBy("_group", "_x.a", "_x.v").agg(F.count(F.lit(1)).alias("n"))
    key = Window.partitionBy("_group", "a")
    upto = key.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = long.select("_group", "a", "v", F.sum("n").over(upto).alias("r"), F.sum("n").over(key).alias("t"))
    at = lambda share: F.min(F.when(F.col("r") >= F.ceil(F.col("t") * share), F.col("v")))
    q = run.groupBy("_group", "a").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    cols = []
    for a in X:
        mine = lambda e, a=a: F.max(F.when(F.col("a") == a, e))
        cols.append(mine(F.col("q2") * 100 + 50).cast("double").alias(f"m_{a}"))
        cols.append(mine(F.greatest((F.col("q3") - F.col("q1")) * 100 / 1.349, F.lit(VECTOR[a][1] * UNIT)))
                    .cast("double").alias(f"l_{a}{a}"))
    return checkpointed(q.groupBy("_group").agg(*cols).select(
        "*", *[F.lit(0.0).alias(f"l_{a}{b}") for a, b in PAIRS if a != b]))


def _distances(rows: DataFrame, params: DataFrame) -> DataFrame:
    return _steps(rows.join(params, "_group"), distance_sql())


def grouped(stats: DataFrame) -> DataFrame:
    """Give each row its ``_group``: language and source if they have
    ``MIN_ROWS`` rows that pass the base rules, else the language's pool of
    small sources, else the pool of all the rest.  Null is a value."""
    name = F.concat_ws("\x1f", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("null")),
                       F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    pool = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("null"))
    named = stats.withColumns({"_fine": name, "_pool": pool})
    counts = named.where(~F.col("base_failed")).groupBy("_fine", "_pool").agg(F.count(F.lit(1)).alias("_n"))
    small = counts.where(F.col("_n") < MIN_ROWS)
    pools = small.groupBy("_pool").agg(F.sum("_n").alias("_m")).where(F.col("_m") >= MIN_ROWS)
    names = counts.join(pools, "_pool", "left").select("_fine", F.when(F.col("_n") >= MIN_ROWS, F.col("_fine")).when(
        F.col("_m").isNotNull(), F.col("_pool")).otherwise(F.lit("")).alias("_group"))
    return named.join(checkpointed(names), "_fine", "left").drop("_fine", "_pool")


def judge(stats: DataFrame) -> DataFrame:
    """``stats`` (``text_statistics`` with ``lang`` and ``source``) plus
    ``distance2`` (null if not measured) and ``kept``.

    Rows that fail a base rule are not kept and take no part.  A last pool of
    fewer than ``MIN_ROWS`` rows has no estimate: its rows are kept.
    """
    vectors = stats.select("*", *[F.expr(f"CASE WHEN NOT base_failed THEN {e} END").alias(x)
                                  for x, e in vector_sql().items()])
    rows = cut(grouped(cut(vectors, "quality-statistics")), "quality-groups")
    measured = rows.where(~F.col("base_failed")).select("_group", *X)
    params = _start(measured)
    for _ in range(STEPS):
        binned = _distances(measured, params).withColumn("_bin", F.expr(BIN.format("d2")))
        params = _params(_concentrate(binned), H_FACTOR)
    # conditional sums: a filter on the distance would be pushed below the steps that compute it
    near = _distances(measured, params).groupBy("_group").agg(*_sums(F.col("d2") <= WEIGHT_CUT))
    final = _params(near, WEIGHT_FACTOR)
    sizes = measured.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"))
    final = checkpointed(final.join(sizes, "_group").where(F.col("_rows") >= MIN_ROWS).drop("_rows"))
    out = _steps(rows.join(final, "_group", "left"), distance_sql())
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    return out.select(*stats.columns, d2.alias("distance2"),
                      (~F.col("base_failed") & F.coalesce(d2 <= CUTOFF, F.lit(True))).alias("kept"))


def quality_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Statistics and verdict of every row of ``docs``: ``keep`` columns,
    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``distance2``, ``kept``.

    Null text has no words and fails the base rules, like an empty one.  Null
    language or source is a value of its own.  Rows are judged one by one, so
    repeated rows and null or equal ids get equal verdicts.  Only ``keep``,
    ``text``, ``lang`` and ``source`` are read; an empty table gives no rows.
    """
    held = {f"_k{i}": c for i, c in enumerate(keep)}
    source = docs.select("text", F.col("lang").cast("string").alias("lang"),
                         F.col("source").cast("string").alias("source"), *[F.col(c).alias(k) for k, c in held.items()])
    out = judge(text_statistics(source, ["lang", "source", *held]))
    return out.select(*[F.col(k).alias(c) for k, c in held.items()], "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "distance2", "kept")
