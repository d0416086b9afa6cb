"""DuckDB SQL with the same results as the registered queries, where SQL can express them."""

from trolley.llm import licenses

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {}

SQL["op4_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, k, array_to_string(w[p : p + k - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS k,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT doc_id, p, k, item FROM dw JOIN iw USING (k, s)),
pos AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM h))
  GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

SQL["op10_minhash_dedup"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS p FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS joint
        FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * joint >= 85 * (na.n + nb.n - joint)),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT b, c FROM reach JOIN pairs ON a = doc_id)
SELECT doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id,
       doc_id = min(c) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

SQL["op2_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT h, max(page_id) AS winner FROM p GROUP BY h)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((CAST('0x' || substr(h, CAST(x // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (x % 4) AS INT)) & 31) + 1, 1)
         FOR x IN range(32)], '') AS payload_digest,
       CASE WHEN page_id < winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < winner THEN winner END AS refers_to
FROM p JOIN w USING (h)
"""

SQL["op12_source_divergence"] = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
  FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, k.term, coalesce(t.n, 0) AS n, k.n AS lang_n, sum(coalesce(t.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
p AS MATERIALIZED (
  SELECT c.lang, source, term, n,
         CAST(1 + (1000000000 * (CAST(n AS HUGEINT) + 5)) // CAST(c.total + 5 * v AS HUGEINT) AS BIGINT) AS p,
         CAST(1 + (1000000000 * (CAST(lang_n AS HUGEINT) + 5)) // CAST(v.total + 5 * v AS HUGEINT) AS BIGINT) AS q
  FROM c JOIN v ON v.lang = c.lang),
s AS (
  SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 50
"""


def _licences() -> str:
    """Sentences and rules as tables; a rule holds if each of its sentences is found after the one
    before, taking the first place possible."""
    known = ", ".join(f"('{i}', '{s}')" for i, s in licenses.SENTENCES.items())
    names = sorted({name for name, _ in licenses.RULES})

    def holds(rule: list[str]) -> str:
        # The place of each sentence, or nothing.
        place = "0"
        for sentence in rule:
            after = f"ids[CAST({place} AS BIGINT) + 1 :]"
            place = f"({place} + nullif(list_position({after}, '{sentence}'), 0))"
        return f"coalesce({place} > 0, false)"

    tests = {n: " OR ".join(holds(r) for name, r in licenses.RULES if name == n) for n in names}
    for small, large in licenses.CONTAINED.items():
        tests[small] = f"({tests[small]}) AND NOT ({tests[large]})"
    found = ", ".join(f"CASE WHEN {tests[n]} THEN '{n}' END" for n in names)
    folded = "trim(regexp_replace(translate({}, '" + licenses.UPPER + "', '" + licenses.LOWER + "'), '[^a-z0-9]+', ' ', 'g'))"
    return rf"""
WITH known(id, sentence) AS (VALUES {known}),
c AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS n, unnest(parts) AS c
  FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '{licenses.ENDS}') AS parts FROM documents)),
s AS (SELECT doc_id, n, c, id FROM c LEFT JOIN known ON sentence = {folded.format("c")}
      WHERE regexp_matches(c, '[A-Za-z0-9]')),
l AS (
  SELECT doc_id, n, m, id
  FROM (SELECT doc_id, n, generate_subscripts(lines, 1) AS m, unnest(lines) AS line
        FROM (SELECT doc_id, n, string_split(c, chr(10)) AS lines FROM s WHERE id IS NULL AND contains(c, chr(10))))
  JOIN known ON sentence = {folded.format("line")}),
f AS (SELECT doc_id, n, 0 AS m, id FROM s WHERE id IS NOT NULL UNION ALL SELECT * FROM l),
i AS (SELECT doc_id, list(id ORDER BY n, m) AS ids FROM f GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_sentences FROM s GROUP BY doc_id),
r AS (
  SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(ids, []) AS ids
  FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN i USING (doc_id)),
h AS (SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS found FROM r)
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, CAST(len(ids) AS BIGINT) AS n_licence_sentences,
       array_to_string(ids, ' ') AS sequence, array_to_string(found, ',') AS licences,
       CAST(len(found) AS BIGINT) AS n_licences
FROM h
"""


SQL["op3_licence_scan"] = _licences()
