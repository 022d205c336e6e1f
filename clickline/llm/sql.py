"""DuckDB SQL for the queries that it can express."""

from __future__ import annotations

from clickline.llm import chat, jaccard, mixing, vectors

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '\\', '\\b'), '##', '#\\#'), '</turn', '<\\/turn')"


def chat_formatting() -> str:
    marks = len(chat.HEAD) + len(chat.COLON) + len(chat.END)
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
        sum({marks} + length(replace({_escaped("role")}, ':', '\\c')) + length({_escaped("text")})) AS chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM whole"""


def source_mixing(weight_cycle: int = 3) -> str:
    passes = mixing.MAX_PASSES
    return f"""
WITH sizes AS (
    SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
        md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key
    FROM documents
), ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, rank % {weight_cycle} + 1 AS weight
    FROM sizes GROUP BY source
), levels AS (
    SELECT *, {passes} * source_size AS whole, sum(source_size) OVER () AS budget,
        budget - coalesce(sum({passes} * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
        row_number() OVER f AS nth
    FROM ranked WINDOW f AS (ORDER BY source_size / weight, rank)
), fits AS (
    SELECT *, whole * weights <= rest * weight AS fits, min(nth) FILTER (NOT whole * weights <= rest * weight) OVER () AS edge
    FROM levels
), targets AS (
    SELECT f.source, f.rank, f.weight, f.source_size, f.budget::BIGINT AS budget,
        CASE WHEN f.fits OR e.nth IS NULL THEN f.whole::DOUBLE
            ELSE (f.weight * e.rest)::DOUBLE / e.weights::DOUBLE END AS target
    FROM fits f LEFT JOIN fits e ON e.nth = f.edge
), queue AS (
    SELECT s.doc_id, s.size, s.key, t.* EXCLUDE (source),
        sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.key, s.doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS words
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), places AS (
    SELECT *, (pass * source_size + words) / weight AS finish FROM queue, range({passes}) p(pass)
), merged AS (
    SELECT *, sum(size) OVER (ORDER BY finish, rank, pass, words, key ROWS UNBOUNDED PRECEDING) AS total FROM places
), taken AS (
    SELECT rank, key, doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
        count(*) FILTER (total <= budget AND pass * source_size + words <= target) AS passes
    FROM merged GROUP BY rank, key, doc_id
), missing AS (
    SELECT *, target - sum(size * passes) OVER (PARTITION BY rank) AS missing FROM taken
), candidates AS (
    SELECT *, CASE WHEN size > 0 AND passes < {passes} AND size * 8 <= missing THEN size ELSE 0 END AS more FROM missing
), filled AS (
    SELECT *, sum(more) OVER (PARTITION BY rank ORDER BY passes, key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM candidates
)
SELECT doc_id, size, source_size, target,
    (size * (passes + CASE WHEN more > 0 AND upto <= missing THEN 1 ELSE 0 END))::BIGINT AS taken
FROM filled"""


def embedding_near_dedup() -> str:
    return f"""
WITH RECURSIVE doubles AS (
    SELECT vec_id, embedding::DOUBLE[] AS v,
        coalesce(len(embedding) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(v, lambda x: x <> 0)) > 0, false) AS usable
    FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM doubles a, doubles b
    WHERE a.usable AND b.usable AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        AND list_cosine_similarity(a.v, b.v) >= {vectors.SIMILARITY}
), reach(vec_id, low) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.vec_id
), lowest AS (SELECT vec_id, min(low) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN lowest USING (vec_id) LEFT JOIN counts USING (vec_id)"""


def url_filters(rules: list[tuple[str, str, str]]) -> str:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rows}),
parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), best AS (
    SELECT page_id, host, path, max_by(rule_host || rule_path, (length(rule_host || rule_path), strlen(rule_host))) AS rule,
        max_by(rule_verdict, (length(rule_host || rule_path), strlen(rule_host))) AS verdict
    FROM parts LEFT JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best"""


def ngram_jaccard_join() -> str:
    n = jaccard.WORDS
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + {n - 1}], ' ') AS gram
    FROM words, unnest(range(1, greatest(2, len(w) - {n - 2}))) t(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE c.n >= {jaccard.SIMILARITY} * (x.n + y.n - c.n) - 1e-9
), reach(doc_id, low) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id
), lowest AS (SELECT doc_id, min(low) AS class_id FROM reach GROUP BY doc_id),
counts AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_links, class_id, class_id = d.doc_id AS kept
FROM documents d JOIN lowest USING (doc_id) LEFT JOIN counts USING (doc_id)"""


def oracle_sql(url_rules: list[tuple[str, str, str]]) -> dict[str, str]:
    return {
        "op1_chat_formatting": chat_formatting(),
        "op2_source_mixing": source_mixing(),
        "op3_embedding_near_dedup": embedding_near_dedup(),
        "op6_url_filters": url_filters(url_rules),
        "op7_ngram_jaccard_join": ngram_jaccard_join(),
    }
