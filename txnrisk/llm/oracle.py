"""The expected results as DuckDB SQL, where SQL can express the operator."""

MIXING = """
WITH doc AS (
  SELECT doc_id, CASE WHEN n IS NULL THEN 'other' ELSE ['web', 'books', 'news', 'forum'][n % 4 + 1] END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source, n_tokens, text_md5
  FROM (
    SELECT *, TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS INTEGER) AS n,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
           md5(coalesce(text, '')) AS text_md5
    FROM documents
  )
),
leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, 4 * sum(n_tokens)::BIGINT AS capacity
  FROM doc WHERE n_tokens > 0 GROUP BY ALL
),
domain_node AS (
  SELECT domain, sum(capacity)::DOUBLE AS c, (SELECT sum(supply)::DOUBLE FROM leaf) AS b,
         CASE domain WHEN 'web' THEN 4.0 WHEN 'books' THEN 3.0 WHEN 'news' THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM leaf GROUP BY domain
),
domain_full AS (
  SELECT *, c * sum(w) OVER (ORDER BY c / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (b - coalesce(sum(c) OVER (ORDER BY c / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS f
  FROM domain_node
),
domain_budget AS (
  SELECT domain, CASE WHEN f THEN c ELSE floor((b - sum(CASE WHEN f THEN c ELSE 0 END) OVER ()) * w
                      / sum(CASE WHEN f THEN 0 ELSE w END) OVER ()) END AS budget
  FROM domain_full
),
lang_node AS (
  SELECT domain, lang, sum(capacity)::DOUBLE AS c, any_value(budget) AS b,
         CASE lang WHEN 'en' THEN 6.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM leaf JOIN domain_budget USING (domain) GROUP BY domain, lang
),
lang_full AS (
  SELECT *, c * sum(w) OVER (PARTITION BY domain ORDER BY c / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (b - coalesce(sum(c) OVER (PARTITION BY domain ORDER BY c / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS f
  FROM lang_node
),
lang_budget AS (
  SELECT domain, lang, CASE WHEN f THEN c ELSE floor((b - sum(CASE WHEN f THEN c ELSE 0 END) OVER p) * w
                      / sum(CASE WHEN f THEN 0 ELSE w END) OVER p) END AS budget
  FROM lang_full WINDOW p AS (PARTITION BY domain)
),
source_full AS (
  SELECT *, c * sum(w) OVER (PARTITION BY domain, lang ORDER BY c / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (b - coalesce(sum(c) OVER (PARTITION BY domain, lang ORDER BY c / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS f
  FROM (SELECT domain, lang, source, supply, capacity::DOUBLE AS c, budget AS b, 1.0::DOUBLE AS w
        FROM leaf JOIN lang_budget USING (domain, lang))
),
leaf_budget AS (
  SELECT *, budget // supply AS epochs, budget % supply AS rest
  FROM (
    SELECT domain, lang, source, supply,
           (CASE WHEN f THEN c ELSE floor((b - sum(CASE WHEN f THEN c ELSE 0 END) OVER p) * w
                      / sum(CASE WHEN f THEN 0 ELSE w END) OVER p) END)::BIGINT AS budget
    FROM source_full WINDOW p AS (PARTITION BY domain, lang)
  )
),
last_epoch AS (
  SELECT doc_id, domain, lang, source, epochs, rest, n_tokens,
         coalesce(sum(n_tokens) OVER (
           PARTITION BY domain, lang, source
           ORDER BY md5('7:' || epochs || ':' || doc_id) || text_md5
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM doc JOIN leaf_budget USING (domain, lang, source) WHERE n_tokens > 0
)
SELECT doc_id, domain, lang, source, unnest(range(epochs)) AS epoch, n_tokens, n_tokens AS take_tokens FROM last_epoch
UNION ALL
SELECT doc_id, domain, lang, source, epochs, n_tokens, least(n_tokens, rest - before) FROM last_epoch WHERE before < rest
"""

DIVERGENCE = """
WITH doc AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
seen AS (SELECT doc, lang, source, unnest(terms) AS term FROM doc),
kept AS (SELECT lang, term FROM seen GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
lang_size AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
term_count AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM seen JOIN kept USING (lang, term) GROUP BY lang, source, term
),
lang_count AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM term_count GROUP BY lang, term),
lang_total AS (SELECT lang, sum(n)::HUGEINT AS total FROM lang_count GROUP BY lang),
member AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN term_count USING (lang, source) GROUP BY lang, source
),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.total + 2 * s.v) AS p
  FROM member g JOIN kept k USING (lang) JOIN lang_size s USING (lang)
  LEFT JOIN term_count c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM p x JOIN p y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM member a JOIN member b ON a.lang = b.lang AND a.source <> b.source
),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM (
    SELECT p.lang, p.source, p.term, p.p, 1 + (1000000000 * (l.n + 2)) // (t.total + 2 * s.v) AS q
    FROM p JOIN lang_count l USING (lang, term) JOIN lang_total t USING (lang) JOIN lang_size s USING (lang) WHERE p.n > 0
  ) WHERE p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) QUALIFY part = 'pair' OR rank <= 10
"""

WARC = """
WITH payload AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
first_page AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM payload
),
record AS (SELECT *, first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM first_page)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM record
"""

SQL = {"op2_mixing": MIXING, "op12_source_divergence": DIVERGENCE, "op13_warc": WARC}
