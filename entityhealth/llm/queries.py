"""The operators as queries over the given tables, and the SQL that must agree where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from entityhealth.llm import bpe, codes, hostrules, mixing, multiindex, packing, pagetext, quality, secrets, simhash, stripes, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_simhash")
def op1_simhash(spark, sf):
    """Fingerprint and component of near copies of every document."""
    return simhash.near_duplicates(table(spark, sf, "documents"))


def _match_sql(rule: secrets.Rule, rank: int) -> str:
    """The counted matches of a rule in `text` as a list of {start, kind, name, stop}."""
    pattern = rule.pattern.replace("'", "''")
    hits, gaps = f"regexp_extract_all(text, '{pattern}')", f"regexp_split_to_array(text, '{pattern}')"
    held = f"regexp_extract_all(text, '{pattern}', {rule.group})"
    return f"""SELECT doc_id, unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
          'start': CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                   + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS INTEGER),
          'size': length(hits[i]), 'counts': length(held[i]) >= {rule.least}}})) AS m, {rank} AS kind, '{rule.kind}' AS name
        FROM (SELECT doc_id, {hits} AS hits, {gaps} AS gaps, {held} AS held FROM texts
              WHERE regexp_matches(text, '{pattern}'))"""


_MATCHES = " UNION ALL ".join(_match_sql(r, k) for k, r in enumerate(secrets.RULES))


@query(
    "op3_secrets",
    f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    matches AS ({_MATCHES}),
    found AS (
      SELECT doc_id, kind, m.start AS start, name || ':' || m.start || ':' || (m.start + m.size) AS said
      FROM matches WHERE m.counts
    ), listed AS (
      SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex, string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg(said, ',' ORDER BY start, kind) AS spans
      FROM found GROUP BY doc_id
    ) SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
      FROM texts t LEFT JOIN listed l ON t.doc_id = l.doc_id""",
)
def op3_secrets(spark, sf):
    """Secrets of every document."""
    return secrets.scan(table(spark, sf, "documents"))


WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


@query(
    "op8_quality_rules",
    rf"""WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS_SQL} AS w FROM documents),
    windows AS (
      SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g
      FROM texts WHERE len(w) >= 8
    ), twice AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
    places AS (SELECT x.doc_id, x.i, lead(x.i) OVER (PARTITION BY x.doc_id ORDER BY x.i) AS j
               FROM windows x JOIN twice y ON x.doc_id = y.doc_id AND x.g = y.g),
    repeats AS (SELECT doc_id, CAST(sum(least(8, coalesce(j - i, 8))) AS BIGINT) AS n FROM places GROUP BY doc_id),
    lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM texts),
    m AS (
      SELECT t.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines
      FROM texts t JOIN lines USING (doc_id) LEFT JOIN repeats r USING (doc_id)
    ), rated AS (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words
        OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines AS failed
      FROM m
    ), hosts AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS bad FROM rated GROUP BY source),
    total AS (SELECT sum(bad) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts FROM hosts),
    spread AS (
      SELECT any_value(mean) AS mean,
        sum(h.n * (bad / h.n - mean) ** 2) / any_value(t.n) - any_value(mean * (1 - mean) * hosts / t.n) AS s
      FROM hosts h, total t
    ), prior AS (
      SELECT mean, CASE WHEN s > 0 THEN least(1000, greatest(2, mean * (1 - mean) / s - 1)) ELSE 1000 END AS weight FROM spread
    ), verdicts AS (
      SELECT source, (bad + mean * weight) / (n + weight) > 0.5 AS bad_host FROM hosts, prior
    ) SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT (bad_host AND failed) AS kept, bad_host
      FROM rated r JOIN verdicts v ON r.source IS NOT DISTINCT FROM v.source""",
)
def op8_quality_rules(spark, sf):
    """Rule measures and the verdict on every document."""
    return hostrules.judge(table(spark, sf, "documents"))


@query(
    "op10_mixing",
    rf"""WITH sized AS (
      SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) || ':mix') AS key FROM documents
    ), named AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sized GROUP BY source
    ), ranked AS (
      SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
        row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS r FROM named
    ), filled AS (
      SELECT *, CAST(cap AS DOUBLE) * (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))
        <= CAST(weight AS DOUBLE) * (total - coalesce(sum(cap) OVER before, 0)) AS is_full
      FROM ranked WINDOW before AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), goal AS (
      SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
          CAST(weight * (total - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) AS DOUBLE)
          / sum(weight) FILTER (NOT is_full) OVER () END AS target FROM filled
    ), rounds AS (
      SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS n FROM goal
    ), keys AS (SELECT source, key, sum(size) AS size FROM sized GROUP BY source, key),
    placed AS (
      SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM keys
    ), cut AS (
      SELECT p.source, max(key) AS cut FROM placed p JOIN rounds g ON p.source IS NOT DISTINCT FROM g.source
      WHERE before + p.size / 2 <= target - n * source_size AND p.size > 0 GROUP BY p.source
    ) SELECT s.doc_id, s.size, s.source, source_size, target,
        CAST(s.size * (n + CASE WHEN s.key <= cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
      FROM sized s JOIN rounds g ON s.source IS NOT DISTINCT FROM g.source
      LEFT JOIN cut c ON s.source IS NOT DISTINCT FROM c.source""",
)
def op10_mixing(spark, sf):
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, sf, "documents"))


@query("op6_packing")
def op6_packing(spark, sf):
    """The batch and place of every sequence of the documents."""
    return packing.pack(table(spark, sf, "documents"))


@query("op9_token_counts")
def op9_token_counts(spark, sf):
    """Token counts of every document by the 32k piece model."""
    return bpe.count(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op2_page_text")
def op2_page_text(spark, sf):
    """The main text of every page."""
    return pagetext.extract(table(spark, sf, "pages"))


@query("op4_quality")
def op4_quality(spark, sf):
    """The quality of every document."""
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op5_toxicity")
def op5_toxicity(spark, sf):
    """The toxicity of every document."""
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_nearest")
def op7_nearest(spark, sf):
    """The nearest vectors of every fiftieth one."""
    rows = table(spark, sf, "embeddings")
    return multiindex.search(rows, rows["vec_id"] % 50 == 0)


_SHARE = "1 + CAST(1000000000 AS HUGEINT) * ({0} + 5) // ({1} + 5 * v)"


@query(
    "op11_divergence",
    rf"""WITH texts AS (
      SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    ), tokens AS (
      SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
    ), kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
    counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
    groups AS (SELECT DISTINCT lang, source FROM texts),
    grid AS (
      SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {_SHARE.format("coalesce(n, 0)", "coalesce(total, 0)")} AS p
      FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source, term)
      LEFT JOIN totals t USING (lang, source)
    ), whole AS (
      SELECT lang, term, {_SHARE.format("sum(n)", "sum(sum(n)) OVER (PARTITION BY lang)")} AS q
      FROM counts JOIN sizes USING (lang) GROUP BY lang, term, v
    ), pairs AS (
      SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
      ) s ON a.lang = s.lang AND a.source = s.source AND b.source = s.item
    ), terms AS (
      SELECT lang, source, term AS item, p - q AS value FROM grid JOIN whole USING (lang, term) WHERE n > 0 AND p > q
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (
        SELECT *, 'pair' AS part FROM pairs UNION ALL BY NAME SELECT *, 'term' AS part FROM terms)
    ) SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
      FROM ranked WHERE part = 'pair' OR rank <= 50""",
)
def op11_divergence(spark, sf):
    """How far the sources of every language differ, and by which terms."""
    return stripes.audit(table(spark, sf, "documents"))


def _cut_sql(books: str, rows: str) -> str:
    """The nearest entry of every part of `rows`, lower index on ties, and the distance."""
    gaps = " + ".join(f"(r.x[{i}] - b.x[{i}]) * (r.x[{i}] - b.x[{i}])" for i in range(1, 5))
    return f"""SELECT id, part, label, x, entry, far FROM (
      SELECT r.id, r.part, r.label, r.x, b.entry, {gaps} AS far,
        row_number() OVER (PARTITION BY r.id, r.part ORDER BY {gaps}, b.entry) AS place
      FROM {rows} r JOIN {books} b USING (part)) WHERE place = 1"""


def _move_sql(books: str, assigned: str) -> str:
    """The entries at the floor of the mean of their parts, unused ones where they were."""
    mean = ", ".join(f"CAST(floor(sum(x[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
    return f"""SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
      SELECT part, entry, [{mean}] AS x FROM {assigned} GROUP BY part, entry) m USING (part, entry)"""


@query(
    "op12_codes",
    f"""WITH rows AS MATERIALIZED (
      SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS id,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
      SELECT id, label, p AS part, v[4 * p + 1:4 * p + 4] AS x FROM rows, range(16) t(p)
    ), books0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x FROM parts WHERE id <= 64),
    first AS MATERIALIZED ({_cut_sql("books0", "parts")}), books1 AS MATERIALIZED ({_move_sql("books0", "first")}),
    second AS MATERIALIZED ({_cut_sql("books1", "parts")}), books2 AS MATERIALIZED ({_move_sql("books1", "second")}),
    last AS MATERIALIZED ({_cut_sql("books2", "parts")}),
    print AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2),
    coded AS (
      SELECT id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error, any_value(label) AS label
      FROM last GROUP BY id
    ) SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY c.label) AS BIGINT) AS label_error, codebooks_sha256
      FROM coded c JOIN rows USING (id), print""",
)
def op12_codes(spark, sf):
    """The code of every vector, and how far its entries are."""
    return codes.compress(table(spark, sf, "embeddings"))


@query(
    "op13_inner_products",
    """WITH rows AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ) SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
      FROM scored QUALIFY rank <= 5""",
)
def op13_inner_products(spark, sf):
    """The largest inner products of every fiftieth vector."""
    rows = table(spark, sf, "embeddings")
    return topk.search(rows, rows["vec_id"] % 50 == 0)
