"""The queries' results in SQL, where SQL can say them over whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE = {
    "op3_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
        win AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
        ),
        first AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
        gone AS (
            SELECT DISTINCT doc_id, p FROM (
                SELECT win.doc_id, unnest(range(i, i + 50)) AS p
                FROM win JOIN first USING (h) WHERE first.m < win.doc_id
            )
        ),
        word AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
            FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op7_near_dedup": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        sh AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ),
        link AS (
            SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
            WHERE 100 * c >= 85 * (nx.n + ny.n - c)
        ),
        both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
        reach AS (
            SELECT doc_id, doc_id AS r FROM d
            UNION SELECT reach.doc_id, b.y FROM reach JOIN both_ways b ON b.x = reach.r
        ),
        least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
            d.doc_id = component_id AS kept
        FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
    "op10_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{TOKEN}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({LOWER}, '{TOKEN}') AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ),
        k AS (SELECT DISTINCT k FROM bw),
        dw AS (
            SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)
        ),
        m AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, s)),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id
        ),
        it AS (
            SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
    """,
    # texts as hex digits, two a byte
    "op8_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        win AS (
            SELECT doc_id, i, md5(x[2 * i + 1:2 * i + 800]) AS h
            FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 399)) AS i FROM d WHERE length(x) >= 800)
        ),
        dup AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
        hit AS (
            SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM win JOIN dup USING (h)
        ),
        run AS (
            SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id ORDER BY i) AS r
            FROM hit
        ),
        span AS (SELECT doc_id, r, min(i) AS a, max(i) + 400 AS b FROM run GROUP BY doc_id, r),
        gap AS (
            SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM span
            UNION ALL
            SELECT doc_id, coalesce(max(b), 0), max(length(x) // 2) FROM d LEFT JOIN span USING (doc_id) GROUP BY doc_id
        ),
        kept AS (
            SELECT doc_id, string_agg(x[2 * f + 1:2 * t], '' ORDER BY f) AS y
            FROM gap JOIN d USING (doc_id) WHERE t > f GROUP BY doc_id
        ),
        n AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
        SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
            CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(y, ''))) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op11_ranked_search": rf"""
        WITH d AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM documents),
        len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
        size AS (SELECT count(*) AS c, CAST(sum(n) AS BIGINT) AS l FROM len),
        b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM b) GROUP BY ALL),
        weight AS (
            SELECT term, CAST(floor(1000 * ln((2 * c + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size
        ),
        m AS (SELECT doc_id, 10 + (90 * n * c) // l AS m FROM len, size),
        s AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM b JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (doc_id) GROUP BY ALL
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
        ) WHERE rank <= 10
    """,
    "op12_collocations": rf"""
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents
        ),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        gram AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, unnest([1, 2, 3, 4]) t(k) WHERE len(w) >= k)
        ),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 30),
        cut AS (
            SELECT lang, phrase, a, c, array_to_string(w[:c], ' ') AS x, array_to_string(w[c + 1:], ' ') AS y
            FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1)
        ),
        scored AS (
            SELECT cut.lang, cut.phrase, cut.a, c, fx.a AS l, fy.a AS r,
                CAST((2000000 * CAST(cut.a AS HUGEINT)) // (fx.a + fy.a) AS BIGINT) AS score
            FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = y
        ),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
        ),
        part AS (
            SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
            FROM (
                SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i
                FROM (SELECT lang, a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 2), unnest([2, 3]) t(m) WHERE m < k
            )
        ),
        held AS (SELECT lang, phrase, max(a) AS longer FROM part GROUP BY ALL)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank
            FROM lowest LEFT JOIN held USING (lang, phrase)
            WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
        ) JOIN total USING (lang) WHERE rank <= 2000
    """,
    "op13_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        ) WHERE rank <= 10
    """,
}
