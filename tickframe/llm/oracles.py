"""DuckDB SQL of the corpus queries that SQL can express."""

COLLOCATIONS = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
     pieces AS (SELECT lang, doc, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
     listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
     runs AS (SELECT lang, words, len(words) AS m FROM listed WHERE len(words) > 0),
     totals AS (SELECT lang, sum(m) AS n FROM runs GROUP BY lang),
     places AS (SELECT lang, words, m, unnest(range(1, m + 1)) AS i FROM runs),
     grams AS (SELECT lang, words[i:i + k - 1] AS words, k FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= m),
     often AS (SELECT lang, words, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
     cuts AS (SELECT c.lang, c.words, c.f AS a, l.f AS l, r.f AS r, t.n, cut,
                CAST((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
              FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1) c
              JOIN often l ON l.lang = c.lang AND l.words = c.words[1:cut]
              JOIN often r ON r.lang = c.lang AND r.words = c.words[cut + 1:c.k]
              JOIN totals t ON t.lang = c.lang),
     scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
     spans AS (SELECT lang, f, k, words, unnest(range(2, k)) AS m FROM often WHERE k > 2),
     starts AS (SELECT *, unnest(range(1, k - m + 2)) AS i FROM spans),
     inside AS (SELECT lang, words[i:i + m - 1] AS words, max(f) AS longer FROM starts GROUP BY ALL),
     kept AS (SELECT s.*, array_to_string(s.words, ' ') AS phrase FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.words = s.words
              WHERE i.longer IS NULL OR 100 * i.longer < 100 * a),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
"""

WARC = """
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM (SELECT *, strlen(html) >= 1000 AND page_id < first AS again
      FROM (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM pages))
"""

LEXICAL = r"""
WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
     sizes AS (SELECT doc, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
     totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM sizes),
     asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     counts AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY ALL),
     weights AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, totals GROUP BY term, nd),
     scores AS (SELECT item_id, doc, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nt)))) AS BIGINT) AS score
                FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc), totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN sizes USING (doc) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
