"""SQL that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORDS = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATION = f"""WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_NORMAL}) AS w FROM benchmark),
test AS (
    SELECT DISTINCT item, array_to_string(w[i:i+9], ' ') AS win, least(len(w), 10) AS n
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_NORMAL}) AS w FROM documents),
place AS (
    SELECT doc_id, i, n, array_to_string(w[i:i+n-1], ' ') AS win
    FROM doc, (SELECT DISTINCT n FROM test), unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT DISTINCT doc_id, i, n, item FROM place JOIN test USING (win, n)),
words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY 1),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated
FROM doc d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

SUBSTRINGS = f"""WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
place AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS win
    FROM doc, unnest(range(1, len(w) - 48)) AS t(i)),
first AS (SELECT win, min(doc_id) AS low FROM place GROUP BY 1),
gone AS (
    SELECT DISTINCT doc_id, p FROM place JOIN first USING (win), unnest(range(i, i + 50)) AS t(p)
    WHERE low < doc_id),
word AS (SELECT doc_id, k, w[k] AS word FROM doc, unnest(range(1, len(w) + 1)) AS t(k)),
kept AS (
    SELECT word.doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
    FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.k
    WHERE gone.p IS NULL GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""

NEAR_DUPLICATES = f"""WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS s
    FROM doc, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b
    ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM doc
    UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, component_id,
    doc.doc_id = component_id AS kept
FROM doc LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""

ARCHIVES = """WITH page AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
known AS (
    SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM page),
owner AS (SELECT digest, min(page_id) AS owner FROM known WHERE n >= 100 GROUP BY 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, known.digest AS payload_digest,
    CASE WHEN owner < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN owner < page_id THEN owner END AS refers_to
FROM known LEFT JOIN owner ON owner.digest = known.digest AND n >= 100"""


FILL_IN_MIDDLE = """WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (
    SELECT doc_id, text, u, len(u) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
        CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM doc),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
part AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a+1:b], '') AS m,
        array_to_string(u[b+1:n], '') AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM part"""


def _round(k: int, book: str) -> str:
    """Codes by a codebook, and the codebook that they lead to."""
    return f"""code{k} AS (
    SELECT r, p, any_value(x) AS x, min(d * 64 + e) // 64 AS d, min(d * 64 + e) % 64 AS e FROM (
        SELECT r, part.p, part.x, e, list_sum(list_transform(range(1, len(part.x) + 1),
            lambda i: (part.x[i] - b.x[i]) * (part.x[i] - b.x[i]))) AS d
        FROM part JOIN {book} b ON part.p = b.p) GROUP BY r, p),
sum{k} AS (
    SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM code{k}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL),
mean{k} AS (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM sum{k} GROUP BY p, e),
book{k} AS (
    SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)"""


CODE_COMPRESSION = f"""WITH usable AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (
    SELECT r, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x FROM usable, unnest(range(16)) AS t(p)),
start AS (SELECT p, r AS e, x FROM part WHERE r < 64),
{_round(1, "start")},
{_round(2, "book1")},
{_round(3, "book2")},
book AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2),
found AS (
    SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, sum(d) AS error
    FROM code3 GROUP BY r)
SELECT vec_id, code, CAST(error AS BIGINT) AS error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM usable JOIN found USING (r), book"""


def statements() -> dict[str, str]:
    return {
        "op3_substring_dedup": SUBSTRINGS,
        "op5_near_duplicates": NEAR_DUPLICATES,
        "op7_decontamination": DECONTAMINATION,
        "op9_warc": ARCHIVES,
        "op11_fill_in_middle": FILL_IN_MIDDLE,
        "op12_code_compression": CODE_COMPRESSION,
    }
