"""DuckDB texts for the queries that SQL can express."""

from __future__ import annotations

from pagelake.llm import infill, licences, mixing, quality, sharding, vector_codes
from pagelake.llm.common import LOWER, UPPER


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(x: str) -> str:
    out = f"translate({x}, '{UPPER}', '{LOWER}')"
    out = (f"regexp_replace({out}, {_q('(?:^|' + chr(92) + 'n)' + licences.LEAD + licences.COPYRIGHT)} || "
           f"'[^\\n]*', chr(10), 'g')")
    out = f"' ' || regexp_replace({out}, {_q(licences.PUNCTUATION)}, '  ', 'g') || ' '"
    for other, usual in licences.SPELLINGS:
        out = f"replace({out}, {_q(' ' + other.replace(' ', '  ') + ' ')}, {_q(' ' + usual.replace(' ', '  ') + ' ')})"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'), ' ')"


LICENCES = f"""
WITH known AS (
  SELECT sha256({_canonical('t')}) AS digest, min(id) AS licence
  FROM (VALUES {", ".join(f"({_q(i)}, {_q(t)})" for i, t in licences.KNOWN)}) AS v(id, t)
  WHERE {_canonical('t')} <> '' GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
hits AS (
  SELECT r, string_agg(DISTINCT licence, '|' ORDER BY licence) AS notices, count(*) AS n
  FROM lines JOIN known ON sha256({_canonical('line')}) = digest GROUP BY r)
SELECT doc_id, sha256({_canonical('text')}) AS digest, licence, coalesce(notices, '') AS notices,
       CAST(coalesce(n, 0) AS BIGINT) AS n_notices
FROM docs LEFT JOIN known ON sha256({_canonical('text')}) = known.digest LEFT JOIN hits USING (r)
"""

_ESC = r"regexp_replace({0}, '<(\\*)\|', '<\1\\|', 'g')"
CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
d AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<|im_start|>') + length({_ESC.format("replace(replace(role, '%', '%25'), chr(10), '%0A')")}) + 1
        + length({_ESC.format('text')}) + length('<|im_end|>') + 1) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM d
"""

# CRC-32 has no DuckDB function; it is computed bit by bit per byte elsewhere, so text_crc32 uses a table of
# the 256 byte remainders made by the polynomial's rule.
SHARDS = f"""
WITH RECURSIVE step AS (
  SELECT i AS b, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) AS t(i)
  UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END, k + 1
  FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS tab FROM step WHERE k = 8),
docs AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    xor(CAST(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), [CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length(h) // 2)]),
      lambda a, x : xor(a >> 8, tab[(xor(a, x) & 255) + 1])) AS BIGINT), 4294967295) AS text_crc32
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents), crc),
keyed AS (
  SELECT *, coalesce('=' || source, 'null') AS s,
    md5('{sharding.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS m FROM docs),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY m, doc_id NULLS FIRST, text_crc32, size) AS r,
    count(*) OVER (PARTITION BY s) AS n FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY CAST(2 * r - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), s, m,
    doc_id NULLS FIRST, text_crc32, size) - 1 AS p, count(*) OVER () AS t FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(p * {sharding.SHARDS} // t AS INTEGER) AS shard,
  CAST(p - ((p * {sharding.SHARDS} // t) * t + {sharding.SHARDS - 1}) // {sharding.SHARDS} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, source
FROM placed
"""


def _quality() -> str:
    """The MCD rounds written out: one CTE per step."""
    X, PAIRS = quality.X, quality.PAIRS
    share = f"CAST({quality.H} AS DOUBLE)"
    columns = [f"m_{a}" for a in X] + [f"l_{a}{b}" for a, b in PAIRS]
    sums = ["n", *[f"s_{a}" for a in X], *[f"s_{a}{b}" for a, b in PAIRS]]
    made = ", ".join(["count(*) AS n", *[f"sum({a}) AS s_{a}" for a in X], *[f"sum({a} * {b}) AS s_{a}{b}" for a, b in PAIRS]])

    def steps(source: str, parts: list[dict[str, str]]) -> str:
        for part in parts:
            source = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in part.items())} FROM {source})"
        return source

    def params(source: str, factor: float) -> str:
        scatter = quality.scatter_sql("n", lambda x: f"s_{x}", factor)
        return f"SELECT grp, {', '.join(columns)} FROM " + steps(source, [scatter, *quality.cholesky_sql()])

    def distances(table: str, base: str = "m0", join: str = "JOIN") -> str:
        return steps(f"(SELECT * FROM {base} {join} {table} USING (grp))", quality.distance_sql())

    quart = ", ".join(f"min(CASE WHEN r >= ceil(t * CAST({q} AS DOUBLE)) THEN v END) AS q{k}"
                      for k, q in ((1, 0.25), (2, 0.5), (3, 0.75)))
    start = ", ".join([f"max(CASE WHEN a = '{a}' THEN CAST(q2 * 100 + 50 AS DOUBLE) END) AS m_{a}" for a in X] + [
        f"max(CASE WHEN a = '{a}' THEN greatest((q3 - q1) * 100 / CAST(1.349 AS DOUBLE), {quality.VECTOR[a][1] * quality.UNIT}) END) "
        f"AS l_{a}{a}" if a == b else f"CAST(0 AS DOUBLE) AS l_{a}{b}" for a, b in PAIRS])
    ctes = [r"""docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents)""",
            r"""texts AS (SELECT r, doc_id, lang, source, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x : regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs)""",
            r"""grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts))""",
            "twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams)",
            "cover AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS z(k) WHERE c >= 2 GROUP BY r)",
            f"""stats AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words
  AS base_failed FROM (SELECT r, doc_id, coalesce('=' || lang, 'null') AS pool,
  coalesce('=' || lang, 'null') || chr(31) || coalesce('=' || source, 'null') AS fine, CAST(len(w) AS BIGINT) AS n_words,
  CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN cover USING (r)))""",
            "fines AS (SELECT fine, pool, count(*) AS n FROM stats WHERE NOT base_failed GROUP BY ALL)",
            f"pools AS (SELECT pool, sum(n) AS m FROM fines WHERE n < {quality.MIN_ROWS} GROUP BY 1 HAVING sum(n) >= {quality.MIN_ROWS})",
            f"""names AS (SELECT fine, CASE WHEN n >= {quality.MIN_ROWS} THEN fine WHEN m IS NOT NULL THEN pool ELSE '' END AS grp
  FROM fines LEFT JOIN pools USING (pool))""",
            f"""m0 AS (SELECT r, grp, {', '.join(f'{e} AS {x}' for x, e in quality.vector_sql().items())}
  FROM stats JOIN names USING (fine) WHERE NOT base_failed)""",
            "bins AS (" + " UNION ALL ".join(
                f"SELECT grp, '{a}' AS a, floor({a} / 100) AS v, count(*) AS n FROM m0 GROUP BY ALL" for a in X) + ")",
            """ranked AS (SELECT grp, a, v, sum(n) OVER (PARTITION BY grp, a ORDER BY v) AS r,
  sum(n) OVER (PARTITION BY grp, a) AS t FROM bins)""",
            f"quart AS (SELECT grp, a, {quart} FROM ranked GROUP BY ALL)",
            f"p0 AS (SELECT grp, {start} FROM quart GROUP BY grp)"]
    for k in range(quality.STEPS):
        ctes += [f"b{k} AS (SELECT grp, bin, {made} FROM (SELECT *, {quality.BIN.format('d2')} AS bin FROM {distances(f'p{k}')}) "
                 "GROUP BY ALL)",
                 f"c{k} AS (SELECT grp, bin, sum(n) OVER (PARTITION BY grp) AS total, " + ", ".join(
                     f"sum({c}) OVER (PARTITION BY grp ORDER BY bin) AS {c}" for c in sums) + f" FROM b{k})",
                 f"f{k} AS (SELECT * FROM c{k} WHERE n >= ceil(total * {share}) QUALIFY row_number() OVER "
                 "(PARTITION BY grp ORDER BY bin) = 1)",
                 f"p{k + 1} AS ({params(f'f{k}', quality.H_FACTOR)})"]
    ctes += [f"near AS (SELECT grp, {made} FROM {distances(f'p{quality.STEPS}')} WHERE d2 <= {quality.WEIGHT_CUT} GROUP BY grp)",
             f"large AS (SELECT grp FROM m0 GROUP BY grp HAVING count(*) >= {quality.MIN_ROWS})",
             f"final AS (SELECT * FROM ({params('near', quality.WEIGHT_FACTOR)}) WHERE grp IN (SELECT grp FROM large))",
             f"judged AS (SELECT r, d2 FROM {distances('final')})"]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(d2 <= {quality.CUTOFF}, true) AS kept
FROM stats LEFT JOIN judged USING (r)"""


def _infill() -> str:
    P, S, M = (_q(m) for m in infill.MARKS)
    draw = " ".join(f", CAST('0x' || substr(key, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{infill.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
units AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u {draw} FROM docs),
cuts AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi,
    CASE WHEN text = '' OR contains(text, {P}) OR contains(text, {S}) OR contains(text, {M}) OR h3 % 100 >= {infill.FIM_PERCENT}
      THEN 'plain' WHEN h4 % 100 < {infill.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM units),
pieces AS (
  SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle,
    array_to_string(u[hi + 1:], '') AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN {P} || prefix || {S} || suffix || {M} || middle
    ELSE {S} || suffix || {P} || prefix || {M} || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM pieces"""


def _vector_codes() -> str:
    """The rounds written out: one assignment and one set of means each."""
    parts, scale = vector_codes.PARTS, vector_codes.SCALE
    ctes = [f"""given AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(len(embedding) AS BIGINT) AS dim,
  [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(embedding) % {parts} = 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
            "kept AS (SELECT * FROM given WHERE dim = (SELECT dim FROM given GROUP BY dim ORDER BY count(*) DESC, dim LIMIT 1))",
            f"""p AS MATERIALIZED (SELECT r, vec_id, v, k AS part, v[k * dim // {parts} + 1:(k + 1) * dim // {parts}] AS x
  FROM kept, range({parts}) AS t(k))""",
            f"""b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, v) - 1 AS entry, x
  FROM p QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, v) <= {vector_codes.ENTRIES})"""]
    for k in range(vector_codes.ROUNDS + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (SELECT r, part, min({{'d': d, 'e': entry}}) AS best FROM (SELECT p.r, p.part, b.entry,
  CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.x, b.x)]) AS BIGINT) AS d
  FROM p JOIN b{k} AS b USING (part)) GROUP BY ALL)""")
        if k < vector_codes.ROUNDS:
            ctes.append(f"""b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b{k}.x) AS x FROM b{k} LEFT JOIN (
  SELECT part, entry, list(y ORDER BY j) AS x FROM (
    SELECT part, best.e AS entry, j, CAST(floor(CAST(sum(y) AS DOUBLE) / count(*)) AS BIGINT) AS y
    FROM (SELECT part, best, unnest(x) AS y, unnest(range(len(x))) AS j FROM p JOIN a{k} USING (r, part)) GROUP BY ALL)
  GROUP BY ALL) AS m USING (part, entry))""")
    last = vector_codes.ROUNDS
    ctes += [f"""codes AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{last} GROUP BY r)""",
             "rows_ AS (SELECT vec_id, label, code, error FROM kept JOIN codes USING (r))",
             f"""digest AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, j)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS y, unnest(range(len(x))) AS j FROM b{last}))"""]
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows_, digest"""


def _mix() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    last = mixing.REPEATS - 1
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS BIGINT) AS size,
    md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key, md5(coalesce(text, '')) AS digest FROM documents),
sized AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE rank % {len(mixing.WEIGHTS)} {weights} END AS weight, source_size * {mixing.REPEATS} AS cap FROM sized),
whole AS (SELECT {mixing.SHARE} * CAST(sum(source_size) AS DOUBLE) AS budget, sum(weight) AS weights, count(*) AS n FROM weighed),
filled AS (
  SELECT *, CAST(cap AS DOUBLE) / weight <=
    (budget - CAST(coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank {before}), 0) AS DOUBLE))
    / CAST(weights - coalesce(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank {before}), 0) AS DOUBLE) AS is_full
  FROM weighed, whole),
rest AS (
  SELECT coalesce(sum(cap) FILTER (is_full), 0) AS caps, coalesce(sum(weight) FILTER (NOT is_full), 1) AS open FROM filled),
targets AS (
  SELECT source, source_size, rank, n, CAST(floor(least(budget, {mixing.REPEATS} * budget / {mixing.SHARE})) AS BIGINT) AS budget,
    CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE CAST(weight AS DOUBLE) * (budget - CAST(caps AS DOUBLE)) / CAST(open AS DOUBLE) END
    AS target FROM filled, rest),
queued AS (
  SELECT docs.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, digest, size, r {before}), 0) AS b
  FROM docs),
uses AS (
  SELECT q.r, q.doc_id, q.size, t.source_size, t.rank, t.target, t.budget, CAST(floor(target) AS BIGINT) AS quota,
    CAST(u * source_size + b AS BIGINT) AS start
  FROM queued AS q JOIN targets AS t ON q.source IS NOT DISTINCT FROM t.source, range({last + 1}) AS z(u)
  WHERE u = 0 OR u * source_size + b < floor(target) + n),
packets AS (
  SELECT *, start AS lo, CASE WHEN start < quota AND start + size > quota THEN quota ELSE start + size END AS hi FROM uses
  UNION ALL
  SELECT *, quota AS lo, start + size AS hi FROM uses WHERE start < quota AND start + size > quota),
mix AS (
  SELECT *, coalesce(sum(hi - lo) OVER (ORDER BY CASE WHEN target > 0 THEN hi / target ELSE CAST('inf' AS DOUBLE) END,
    rank, hi, hi - lo {before}), 0) AS position FROM packets)
SELECT doc_id, size, source_size, target,
  CAST(sum(greatest(0, least(hi - lo, budget - position))) AS BIGINT) AS taken
FROM mix GROUP BY r, doc_id, size, source_size, target"""


ORACLE = {
    "op11_fill_in_middle": _infill(),
    "op12_vector_codes": _vector_codes(),
    "op13_fair_mix": _mix(),
    "op5_mcd_quality": _quality(),
    "op3_licence_digests": LICENCES,
    "op4_chat_parts": CHAT,
    "op7_proportional_shards": SHARDS,
}
