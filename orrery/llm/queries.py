"""Each operator applied to its whole table, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.llm import align as A, decontaminate as D, license_scan as L, mixing as M, quality_rules as R, secret_scan as S
from orrery.llm import token_counts as C
from orrery.llm.lm_score import lm_scores
from orrery.llm.spelling import spelling_variants
from orrery.llm.substring_dedup import repeated_passages
from orrery.llm.token_files import token_round_trip
from orrery.llm.warc import round_trip
from orrery.llm.near_dedup import near_duplicates
from orrery.plans.registry import Tables, query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
SPACED = r"[^\x20\x09-\x0D]+"  # words between white space

def near_sql(documents: str = "documents") -> str:
    """Near-duplicates among a table or subquery by brute force."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{SPACED}') AS ws FROM {documents}),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
    THEN list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' '))
    ELSE [array_to_string(ws, ' ')] END) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM {documents} UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, m AS component_id, m = doc_id AS kept
FROM {documents} JOIN c ON c.a = doc_id LEFT JOIN n USING (doc_id)
"""


@query(near_sql())
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(Tables(spark, sf_dir).documents)


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # words of letters, digits and other scripts


def _license_sql() -> str:
    rows = ", ".join(
        f"({i}, '{label}', {exact}, {place}, '{gram}', {grams}, {length})"
        for i, label, exact, place, gram, grams, length in L.template_rows(L.templates())
    )
    return rf"""
WITH t(template, label, exact, place, gram, grams, length) AS (VALUES {rows}),
w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS ws FROM documents),
g AS (
  SELECT doc_id, i - 1 AS pos, array_to_string(ws[i:i + {L.K - 1}], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {L.K - 1})) AS i FROM w)),
h AS (SELECT doc_id, pos, pos - place AS diagonal, t.* FROM g JOIN t USING (gram)),
p AS (
  SELECT doc_id, label, exact, grams, min(pos) AS first, count(DISTINCT place) AS votes FROM h
  WHERE exact GROUP BY doc_id, template, label, exact, grams, diagonal
  UNION ALL SELECT a.doc_id, a.label, a.exact, a.grams, a.pos, count(DISTINCT b.place) FROM h a JOIN h b
    ON a.doc_id = b.doc_id AND a.template = b.template AND b.pos >= a.pos AND b.pos + 3 - a.pos <= 1.5 * a.length
  WHERE NOT a.exact GROUP BY a.doc_id, a.template, a.label, a.exact, a.grams, a.pos),
f AS (SELECT *, votes >= CASE WHEN exact THEN 1 ELSE 0.7 END * grams AS found FROM p)
SELECT w.doc_id, len(any_value(ws)) AS n_words, count(*) FILTER (found AND exact) AS n_base,
  min(first) FILTER (found AND exact) AS first_word, max(first) FILTER (found AND exact) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found AND exact), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found), '') AS labels,
  coalesce(max(votes / grams), 0.0) AS score
FROM w LEFT JOIN f ON w.doc_id = f.doc_id GROUP BY w.doc_id
"""


@query(_license_sql())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.license_labels(Tables(spark, sf_dir).documents)


def quality_sql(documents: str = "documents") -> str:
    """Counts and verdicts of the quality rules over a table or subquery."""
    symbols, marks = "[^#*$%&|<>]+", r"[^\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"
    tests = [(r, c) for r in R.RULES for c in r.cutoffs]
    value = {r.name: f"coalesce({r.part} / nullif({r.whole}, 0), 0.0)" for r in R.RULES}
    ks = ", ".join(f"({r.name!r}, {c}, count(*) FILTER ({value[r.name]} > {c}))" for r, c in tests)
    share = R.ALPHA / len(R.RULES)
    over = " OR ".join(f"coalesce({value[r.name]} > cut_{r.name}, false)" for r in R.RULES)
    cuts = ", ".join(f"min(cutoff) FILTER (rule = {r.name!r}) AS cut_{r.name}" for r in R.RULES)
    return rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM {documents}),
w AS (
  SELECT *, regexp_extract_all(t, '{SPACED}') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
c AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), (VALUES (0), (1), (2)) v(o)
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '{symbols}', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
    length(regexp_replace(t, '{marks}', '', 'g')) AS n_marks, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper,
    coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (
  SELECT lang, count(*) AS n, unnest([{ks}]) AS test FROM b
  WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY lang),
p AS (
  SELECT lang, test[1] AS rule, test[2] AS cutoff,
    CASE WHEN test[3] > n * {share!r} THEN 1.0 ELSE list_sum(list_transform(range(0, test[3]::BIGINT + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r})))) END AS p
  FROM h),
s AS (
  SELECT lang, {cuts} FROM p WHERE p <= {R.DELTA} / ((SELECT count(DISTINCT coalesce(lang, '-')) FROM p) * {len(tests)}) GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({over}) AS kept
FROM b LEFT JOIN s ON b.lang IS NOT DISTINCT FROM s.lang
"""


@query(quality_sql())
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return R.quality_verdicts(t.documents, t.labels).drop("text_hash")


def mixing_sql(documents: str = "documents") -> str:
    """The mix of a table or subquery."""
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS size,
    md5('{M.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS draw FROM {documents}),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, sum({M.EPOCHS} * source_size) OVER o - {M.EPOCHS} * source_size AS caps, sum(weight) OVER o - weight AS weights,
    sum(source_size) OVER () AS t, sum(weight) OVER () AS w
  FROM s WINDOW o AS (ORDER BY {M.EPOCHS} * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT max((t - caps)::DOUBLE / (w - weights)::DOUBLE) AS level FROM f),
g AS (SELECT source, source_size, least(({M.EPOCHS} * source_size)::DOUBLE, level * weight) AS target FROM s, l),
h AS (
  SELECT *, CASE WHEN target >= {M.EPOCHS} * source_size THEN {M.EPOCHS} ELSE floor(target / source_size) END AS whole FROM g),
u AS (
  SELECT d.*, source_size, target, whole,
    sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
r AS (
  SELECT *, (whole + CASE WHEN whole < {M.EPOCHS} AND 2 * upto - size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END)::BIGINT
    AS repeats FROM u)
SELECT doc_id, size, source_size, target, repeats, repeats * size AS taken FROM r
"""


@query(mixing_sql())
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mix(Tables(spark, sf_dir).documents).drop("text_hash")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def secret_spans_sql(documents: str = "documents") -> str:
    """CTEs that end in `c (doc_id, source, kind, name, start, stop, value)`, one row per match, and `v` with the verdicts."""
    either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    assign = S.ASSIGN.replace("password|passwd|secret|token|api_?key", either).replace("[a-z0-9+/_.=-]", "[A-Za-z0-9+/_.=-]")
    kinds = [("assign", assign, 2, "length(value) >= 12"), ("access", S.ACCESS, 0, "length(value) >= 18"), ("hex", S.HEX, 0, "true")]
    mixed = " AND ".join(f"regexp_matches(value, '{p}')" for p in S.MIXED_NEEDS)
    kinds += [(k, p, 1 if k == "address" else 0, mixed if k == "mixed" else "true") for k, p in S.MORE.items()]
    parts = " UNION ALL ".join(
        f"""SELECT * FROM (
  SELECT doc_id, source, {i} AS kind, '{name}' AS name, list_sum(list_transform(p[1:i], lambda x: length(x))) +
    coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start, start + length(m[i]) AS stop, g[i] AS value
  FROM (
    SELECT *, unnest(generate_series(1, len(m))) AS i FROM (
      SELECT doc_id, source, string_split_regex(t, {_quoted(pattern)}) AS p, regexp_extract_all(t, {_quoted(pattern)}) AS m,
        regexp_extract_all(t, {_quoted(pattern)}, {group}) AS g FROM t))) WHERE {extra}"""
        for i, (name, pattern, group, extra) in enumerate(kinds)
    )
    marked = " OR ".join(f"contains(translate(value, '{UPPER}', '{LOWER}'), '{w}')" for w in S.PLACEHOLDERS)
    return rf"""
t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM {documents}),
c AS ({parts}),
o AS (SELECT value, count(*) AS owners FROM (SELECT DISTINCT value, source FROM c) GROUP BY value),
v AS (
  SELECT c.*, kind < {len(S.BASE_KINDS)} AS base, base OR (owners < {S.OWNERS} AND NOT ({marked})
    AND list_aggregate(string_split(value, ''), 'entropy') >= {S.ENTROPY}) AS chosen FROM c JOIN o USING (value))"""


def _secret_sql() -> str:
    listed = "string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    counts = ", ".join(f"count(*) FILTER (name = '{k}') AS n_{k}" for k in S.BASE_KINDS)
    return rf"""
WITH {secret_spans_sql()}
SELECT t.doc_id, {counts}, sha256(coalesce({listed} FILTER (base), '')) AS base_sha256, coalesce({listed} FILTER (chosen), '') AS spans
FROM t LEFT JOIN v ON v.doc_id = t.doc_id GROUP BY t.doc_id
"""


@query(_secret_sql())
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.secret_report(Tables(spark, sf_dir).documents)


def contained_sql(documents: str = "documents") -> str:
    """CTEs that end in `h (doc_id, item_id, n_item, n_shared)`."""
    shingled = "unnest(CASE WHEN len(ws) >= 5 THEN list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' ')) ELSE [array_to_string(ws, ' ')] END)"
    return rf"""
b AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({LOWERED}, '{SPACED}') AS ws FROM benchmark),
bs AS (SELECT DISTINCT item, item_id, least(len(ws), 5) AS k, {shingled} AS g FROM b WHERE len(ws) > 0),
bn AS (SELECT item, item_id, count(*) AS n_item FROM bs GROUP BY ALL),
dw AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{SPACED}') AS ws FROM {documents}),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM dw, (SELECT DISTINCT k FROM bs))),
h AS (
  SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM ds JOIN bs USING (g) JOIN bn USING (item, item_id)
  GROUP BY doc_id, item, item_id, n_item HAVING 100 * count(*) >= 75 * n_item)"""


@query(f"WITH {contained_sql()} SELECT *, n_shared / n_item AS containment FROM h")
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return D.contained_items(t.documents, t.benchmark).drop("text_hash")


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(x, {i * 5 + 1}, 5))::BIGINT >> {s} & 31) + 1, 1)"
    for i in range(8) for s in (15, 10, 5, 0)
)
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, {_BASE32} AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM r
"""


@query(WARC_SQL)
def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(Tables(spark, sf_dir).pages)


TOKENIZERS = "orrery.tokenizers"  # setting: the folder of the vocabulary files


def vocabulary(spark: SparkSession, name: str) -> str:
    """The path of a public tokenizer's file, in the folder of the setting or where the installed package has it."""
    folder = spark.conf.get(TOKENIZERS, None)
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(Tables(spark, sf_dir).documents)


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.context_table(C.length_histogram(Tables(spark, sf_dir).documents, vocabulary(spark, "byte_bpe_50k.tiktoken")))


@query()
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(Tables(spark, sf_dir).documents)


@query()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(Tables(spark, sf_dir).documents, vocabulary(spark, "byte_bpe_50k.json"))


# The checksum byte by byte; a run of these letters has one byte a code point below 128 and two otherwise.
SPELLING_SQL = rf"""
WITH RECURSIVE k AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all({LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
g AS (SELECT d, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY ALL),
b AS (
  SELECT run, n, flatten(list_transform(string_split(d || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
    ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS bytes FROM g),
h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, k),
s AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
i AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
o AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM i),
e AS (
  SELECT x.word AS a, y.word AS b FROM o x JOIN o y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT o.word, v.word FROM o JOIN v ON v.word = o.a || o.z
  UNION SELECT v.word, o.word FROM o JOIN v ON v.word = o.a || o.z),
f AS (SELECT e.a AS word, count(*) AS n_near, min((-v.n, v.word)) AS best FROM e JOIN v ON v.word = e.b GROUP BY e.a),
w AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * v.n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * v.n THEN -best[1] END AS form_n
  FROM v LEFT JOIN f USING (word)),
c AS (SELECT word, word AS root, form FROM w UNION ALL SELECT c.word, w.word, w.form FROM c JOIN w ON w.word = c.form)
SELECT word, w.form, root, n, n_near, form_n FROM w JOIN c USING (word) WHERE c.form IS NULL
"""


@query(SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(Tables(spark, sf_dir).documents, spoil=97)


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.aligned_tokens(Tables(spark, sf_dir).documents, vocabulary(spark, "byte_bpe_50k.json"), vocabulary(spark, "piece_bpe_32k.model"))
