"""One query per operator over whole tables, and DuckDB SQL for those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.llm import (combination_join, decontaminate, fp_search, html_extract, hyperminhash, imatch, langid,
                           pareto_mix, quality, suffix_dedup, token_counts, turn_repair, url_rules)
from formweave.llm.blocks import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
TOKENIZER = "piece_bpe_32k.model"


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)))


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.mix(table(spark, sf_dir, "documents")).drop("copies")


@query
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


@query
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, RULES))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.verdicts(found)


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return imatch.fingerprint(docs, imatch.lexicon(docs))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(turn_repair.damage(table(spark, sf_dir, "conversations")))


@query
def op12_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combination_join.similarity_join(table(spark, sf_dir, "documents"), width=5, percent=80)


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.search_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Links between word shingle sets and their components, by comparing all sets that share a shingle.
_COMPONENTS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + WIDTH - 1), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - WIDTH + 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (
  SELECT c.a, c.b FROM c JOIN n x ON c.a = x.doc_id JOIN n y ON c.b = y.doc_id
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(doc_id, other) AS (SELECT a, a FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
m AS (SELECT doc_id, min(other) AS least FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.least, d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id"""

ORACLE: dict[str, str] = {
    "op3_near_duplicates": "SELECT *, doc_id = component_id AS kept FROM (" + _COMPONENTS.replace("WIDTH", "2") + ")",
    "op12_similarity_join": _COMPONENTS.replace("WIDTH", "5"),
    "op13_ranked_search": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count_if(len(w) > 0)::BIGINT AS documents, sum(len(w))::BIGINT AS length FROM d),
q AS (
  SELECT item_id, item, term, count(*)::BIGINT AS qtf
  FROM (SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(translate(text,
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, item, term),
v AS (SELECT DISTINCT term FROM q),
t AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM d) JOIN v USING (term)
  GROUP BY row, term),
w AS (
  SELECT term, floor(1000 * ln((2 * s.documents + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term), s),
m AS (SELECT doc_id, row, 100 - 75 + ((75 * len(w)::BIGINT * s.documents) // s.length) AS m FROM d, s WHERE len(w) > 0),
r AS (
  SELECT q.item_id, q.item, m.doc_id,
         sum(q.qtf * w.weight * ((1000000000 * t.tf) // (1000 * t.tf + 8 * m.m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY q.item_id, q.item, m.doc_id, row)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
WHERE rank <= 10""",
    "op11_conversation_repair": r"""
WITH RECURSIVE k AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS t),
r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
           lambda c, b: xor(c >> 8, k.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS lot
  FROM conversations, k),
d AS (
  SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE lot WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM r),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1, 's') AS last, left(role, 1) AS initial
  FROM d),
q AS (
  SELECT *, last = '' AS blank, last <> '' AND seen AS duplicate,
         last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') AS truncated,
         coalesce(before || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM o)),
n AS (
  SELECT conv_id, count(*) AS rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
         count_if(illegal) AS illegal
  FROM q GROUP BY conv_id),
w(conv_id, pos, f) AS (
  SELECT conv_id, 0::BIGINT, [{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}, {'c': 1000000000, 'a': '', 't': []},
                              {'c': 1000000000, 'a': '', 't': []}, {'c': 1000000000, 'a': '', 't': []}]
  FROM n
  UNION ALL
  SELECT conv_id, pos, CASE WHEN gone THEN list_transform(g, lambda x: {'c': x.c + 4, 'a': x.a || 'D', 't': x.t}) ELSE [
      {'c': g[1].c + 4, 'a': g[1].a || 'D', 't': g[1].t},
      list_min([{'c': g[2].c + 4, 'a': g[2].a || 'D', 't': g[2].t},
                CASE WHEN initial = 's' THEN {'c': g[1].c + p, 'a': g[1].a || 'K', 't': list_append(g[1].t, role || ':' || text)} END]),
      list_min([{'c': g[3].c + 4, 'a': g[3].a || 'D', 't': g[3].t},
                {'c': m.c + p + 3, 'a': m.a || 'R', 't': list_append(m.t, 'user:' || text)},
                CASE WHEN initial = 'u' THEN {'c': m.c + p, 'a': m.a || 'K', 't': list_append(m.t, role || ':' || text)} END]),
      list_min([{'c': g[4].c + 4, 'a': g[4].a || 'D', 't': g[4].t},
                {'c': g[3].c + p + 3, 'a': g[3].a || 'R', 't': list_append(g[3].t, 'assistant:' || text)},
                CASE WHEN initial = 'a' THEN {'c': g[3].c + p, 'a': g[3].a || 'K', 't': list_append(g[3].t, role || ':' || text)} END])
    ] END
  FROM (
    SELECT *, list_min([g[1], g[2], g[4]]) AS m
    FROM (
      SELECT *, [f[1], f[2], two, list_min([f[4], {'c': two.c + 3, 'a': two.a || 'I', 't': list_append(two.t, 'assistant:')}])] AS g
      FROM (
        SELECT w.conv_id, w.pos + 1 AS pos, w.f, q.blank OR q.duplicate AS gone, CASE WHEN q.truncated THEN 3 ELSE 0 END AS p,
               q.initial, q.role, q.text,
               list_min([w.f[3], {'c': e.c + 3, 'a': e.a || 'I', 't': list_append(e.t, 'user:')}]) AS two
        FROM (SELECT *, list_min([f[1], f[2], f[4]]) AS e FROM w) w
        JOIN q ON w.conv_id IS NOT DISTINCT FROM q.conv_id AND q.pos = w.pos + 1)))),
z AS (
  SELECT conv_id, list_min([f[1], f[4], {'c': two.c + 3, 'a': two.a || 'I', 't': list_append(two.t, 'assistant:')}]) AS b
  FROM (
    SELECT w.conv_id, w.f, list_min([w.f[3], {'c': e.c + 3, 'a': e.a || 'I', 't': list_append(e.t, 'user:')}]) AS two
    FROM (SELECT *, list_min([f[1], f[2], f[4]]) AS e FROM w) w
    JOIN n ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.pos = n.rows))
SELECT c.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank,
       coalesce(n.duplicate, 0)::BIGINT AS duplicate, coalesce(n.truncated, 0)::BIGINT AS truncated,
       coalesce(n.illegal, 0)::BIGINT AS illegal, coalesce(z.b.c, 0)::BIGINT AS cost, coalesce(z.b.a, '') AS audit,
       sha256(coalesce(array_to_string(z.b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN n ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN z ON c.conv_id IS NOT DISTINCT FROM z.conv_id""",
    "op4_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
f AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS filled FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM f WINDOW before AS (ORDER BY filled, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         coalesce(least(cap, weight * (SELECT arg_min(level, (filled, -level)) FROM l WHERE level <= filled)), cap)
           AS target
  FROM l),
k AS (
  SELECT source, pow(2.0, floor((length(bin(size)) - 1) / 2)) AS weight, sum(size)::BIGINT AS words
  FROM d WHERE size > 0 GROUP BY ALL),
v AS (
  SELECT k.*, t.target, (t.target - coalesce(sum(k.words) OVER heavier, 0) * 2.0::DOUBLE)
         / (sum(k.words * k.weight) OVER (PARTITION BY k.source) - coalesce(sum(k.words * k.weight) OVER heavier, 0))
           AS level
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
  WINDOW heavier AS (PARTITION BY k.source ORDER BY k.weight DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT source, arg_max(level, weight) AS level FROM v WHERE level * weight <= 2 GROUP BY source),
e AS (
  SELECT v.source, v.weight, v.words, v.target, coalesce(least(2.0::DOUBLE, o.level * v.weight), 2.0::DOUBLE) AS expected
  FROM v LEFT JOIN o ON v.source IS NOT DISTINCT FROM o.source),
m AS (
  SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS chance,
         target - sum(floor(expected)::BIGINT * words) OVER (PARTITION BY source)::BIGINT AS missing
  FROM e),
u AS (
  SELECT d.doc_id, d.source, d.size, coalesce(m.whole, 0) AS whole, m.missing, m.chance,
         (('0x' || substr(md5(d.doc_id::VARCHAR || ':mix'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE
           AS random
  FROM d LEFT JOIN m ON d.source IS NOT DISTINCT FROM m.source AND d.size > 0
    AND m.weight = pow(2.0, floor((length(bin(d.size)) - 1) / 2))),
r AS (
  SELECT *, random / (1 - random) / (chance / (1 - chance)) AS rank FROM u WHERE missing > 0 AND chance > 0),
c AS (
  SELECT *, sum(size) OVER in_order AS so_far, row_number() OVER in_order AS nth FROM r
  WINDOW in_order AS (PARTITION BY source ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, count(*) FILTER (so_far <= missing) OVER (PARTITION BY source) AS cut FROM c),
n AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY nth) - 1 AS bit
  FROM (SELECT * FROM g
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(nth - cut - 0.5), nth) <= 9)),
b AS (
  SELECT n.source, i.way, abs(min(n.missing) - min(n.so_far - n.size) - sum(n.size * (i.way // (3 ** n.bit)::BIGINT % 3))) AS off
  FROM n, (SELECT unnest(range(19683)) AS way) i
  GROUP BY n.source, i.way
  HAVING i.way < (3 ** count(*))::BIGINT AND max(i.way // (3 ** n.bit)::BIGINT % 3 - (2 - n.whole)) <= 0),
x AS (SELECT source, arg_min(way, (off, way)) AS way FROM b GROUP BY source),
y AS (
  SELECT n.doc_id, n.source, n.nth, x.way // (3 ** n.bit)::BIGINT % 3 AS more
  FROM n JOIN x ON n.source IS NOT DISTINCT FROM x.source),
z AS (SELECT source, min(nth) AS first FROM y GROUP BY source),
w AS (
  SELECT g.doc_id, g.source, CASE WHEN g.nth < z.first THEN 1 ELSE coalesce(y.more, 0) END AS more
  FROM g JOIN z ON g.source IS NOT DISTINCT FROM z.source
  LEFT JOIN y ON g.source IS NOT DISTINCT FROM y.source AND g.nth = y.nth)
SELECT u.doc_id, u.size, t.source_size, t.target, (u.size * (u.whole + coalesce(w.more, 0)))::BIGINT AS taken
FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source
LEFT JOIN w ON u.doc_id = w.doc_id AND u.source IS NOT DISTINCT FROM w.source""",
    "op6_url_rules": r"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
j AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM j""",
    "op8_decontaminate": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
n AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 11, 2))) AS p FROM i WHERE len(w) > 0)),
k AS (SELECT DISTINCT k FROM n),
v AS (
  SELECT doc_id, w, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS s
  FROM (SELECT d.doc_id, d.w, k.k, unnest(range(1, len(d.w) - k.k + 2)) AS p FROM d, k WHERE len(d.w) >= k.k)),
h AS (SELECT v.doc_id, v.p, v.k, n.item_id FROM v JOIN n ON v.s = n.s AND v.k = n.k),
a AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM h) GROUP BY doc_id),
b AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(a.n_hit, 0)::BIGINT AS n_hit,
       coalesce(b.n_items, 0)::BIGINT AS n_items, sha256(coalesce(b.items, '')) AS items_sha256,
       coalesce(a.n_hit, 0) > 0 AND 20 * coalesce(a.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN a ON d.doc_id = a.doc_id LEFT JOIN b ON d.doc_id = b.doc_id""",
}
