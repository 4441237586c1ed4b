"""DuckDB counterparts of the queries that SQL can express on whole tables."""

ORACLE = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
        FROM d""",
    "op7_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                       lambda x: x <> '') AS ws
            FROM documents),
        windows AS (
            SELECT doc_id, k, md5(array_to_string(ws[k:k + 49], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS k FROM d WHERE len(ws) >= 50)),
        firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS k
            FROM windows JOIN firsts USING (h) WHERE least < doc_id),
        words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS k FROM d),
        kept AS (
            SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.k) AS text, count(*) AS n
            FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.k = g.k GROUP BY w.doc_id)
        SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece,
                   list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS ws
            FROM (SELECT lang, unnest(regexp_split_to_array(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
        words AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS k FROM pieces),
        counts AS (
            SELECT lang, m, array_to_string(ws[k:k + m - 1], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, ws, k, unnest(range(1, 6)) AS m FROM words)
            WHERE k + m - 1 <= len(ws) GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE m = 1 GROUP BY lang),
        found AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE m > 1 AND f >= 100),
        cuts AS (SELECT *, unnest(range(1, m)) AS k FROM found),
        scores AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
                   (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')
            JOIN totals t ON t.lang = c.lang),
        best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_phrases AS (
            SELECT lang, a AS longer, array_to_string(ws[s:s + j - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, m - j + 2)) AS s
                  FROM (SELECT *, unnest(range(2, m)) AS j FROM found WHERE m > 2))),
        covered AS (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL),
        kept AS (
            SELECT b.* FROM best b LEFT JOIN covered c ON b.lang = c.lang AND b.phrase = c.phrase
            WHERE c.longer IS NULL OR 100 * c.longer < 100 * b.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
        FROM kept QUALIFY rank <= 2000""",
    "op12_resampling": r"""
        WITH bits AS (
            SELECT list_transform(range(0, 256), lambda b: list_reduce(
                list_prepend(b, range(0, 8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
        d AS (SELECT doc_id, words(text) AS ws FROM documents),
        aim AS (SELECT unnest(words(text)) AS w FROM benchmark),
        every AS (SELECT doc_id, unnest(ws) AS w FROM d),
        names AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM every UNION SELECT w FROM aim)),
        buckets AS (
            SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2),
                       lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                       lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM names, bits),
        source AS (SELECT bucket, count(*) AS s FROM every JOIN buckets USING (w) GROUP BY bucket),
        target AS (SELECT bucket, count(*) AS t FROM aim JOIN buckets USING (w) GROUP BY bucket),
        sums AS (SELECT (SELECT count(*) FROM every) AS n, (SELECT count(*) FROM aim) AS m),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (n + 10000)
                                           / ((s + 1)::DOUBLE * (m + 10000))))::BIGINT AS gain
            FROM source LEFT JOIN target USING (bucket), sums),
        weights AS (
            SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM every JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
                                                              + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
            FROM d LEFT JOIN weights USING (doc_id)),
        places AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER () * 10 // 100 AS wanted
            FROM scored WHERE n_features >= 20)
        SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
        FROM scored s LEFT JOIN places USING (doc_id)""",
    "op13_ngram_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS k FROM d WHERE len(ws) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m
            FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
            WHERE 100 * m >= 80 * (s.n + t.n - m)),
        reached AS (
            SELECT doc_id AS x, doc_id AS y FROM d
            UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
        SELECT x AS doc_id, coalesce(max(n), 0) AS n_shingles, min(y) AS component_id
        FROM reached LEFT JOIN sizes ON doc_id = x GROUP BY x""",
}

# The words of a text, written out where a query says words(text).
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE["op12_resampling"] = ORACLE["op12_resampling"].replace("words(text)", _WORDS)
