"""SQL forms of the queries that SQL can express over whole tables."""

OP2_URL_FILTER = r"""
WITH rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
parsed AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
),
fitting AS (
    SELECT p.n, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict),
                        length(r.host || r.path)) AS best
    FROM parsed p JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.n
)
SELECT p.page_id, p.host, p.path, f.best.rule AS rule, coalesce(f.best.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN fitting f ON p.n = f.n
"""

OP11_COLLOCATIONS = r"""
WITH words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
),
started AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM started, range(1, 6) AS sizes(size) WHERE i + size - 1 <= len(w)
),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (
    SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f FROM counted WHERE size >= 2 AND f >= 100
),
inside AS (
    SELECT lang, array_to_string(w[i:i + inner_size - 1], ' ') AS phrase, max(f) AS longest
    FROM (SELECT lang, w, size, f, unnest(range(2, size)) AS inner_size FROM candidates),
         range(1, 5) AS starts(i)
    WHERE i + inner_size - 1 <= size
    GROUP BY ALL
),
kept AS (
    SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
    WHERE i.longest IS NULL OR 100 * i.longest < 100 * c.f
),
cut AS (
    SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n,
           (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
    FROM cut c JOIN totals t ON c.lang = t.lang
    JOIN counted l ON c.lang = l.lang AND c.first = l.phrase
    JOIN counted r ON c.lang = r.lang AND c.rest = r.phrase
),
lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

OP12_RESAMPLING = r"""
WITH crc_table AS (
    SELECT list(entry ORDER BY i) AS entries
    FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
                                lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
          FROM range(256) AS t(i))
),
texts AS (
    SELECT 'source' AS side, row_number() OVER () AS id, doc_id, text FROM documents
    UNION ALL SELECT 'target', row_number() OVER (), NULL, text FROM benchmark
),
words AS (
    SELECT side, id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
),
features AS (
    SELECT side, id, feature, count(*) AS n
    FROM (SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature
          FROM words)
    GROUP BY ALL
),
hashed AS (
    SELECT feature, xor(list_reduce(
               list_prepend(4294967295, list_transform(range(0, octet_length(encode(feature))),
                                                       lambda i: ('0x' || hex(encode(feature))[2 * i + 1:2 * i + 2])::BIGINT)),
               lambda c, b: xor(c >> 8, entries[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM features), crc_table
),
counted AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'source'), 0) AS s, coalesce(sum(n) FILTER (side = 'target'), 0) AS t
    FROM features JOIN hashed USING (feature) GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
               / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted
),
summed AS (
    SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
    FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'source' GROUP BY id
),
weighed AS (
    SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features,
           CASE WHEN total IS NULL THEN 0
                ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
           ('0x' || left(sha256('7:' || coalesce(w.doc_id::VARCHAR, '')), 8))::BIGINT AS h
    FROM words w LEFT JOIN summed USING (id) WHERE side = 'source'
),
scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed
),
ranked AS (
    SELECT *, CASE WHEN n_words >= 20
                   THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT 25 * count(*) // 100 FROM scored WHERE n_words >= 20) THEN place END AS rank
FROM ranked
"""


def oracle_sql():
    return {
        "op2_url_filter": OP2_URL_FILTER,
        "op11_collocations": OP11_COLLOCATIONS,
        "op12_resampling": OP12_RESAMPLING,
    }
