"""DuckDB SQL for the operators that SQL can express."""

_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = {
    "assign": _ASSIGN,
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{24,}",
    "forge": "gh[opsru]_[A-Za-z0-9]{36,}",
    "chat": "xox[abposr]-[A-Za-z0-9-]{10,}",
    "webtoken": "(^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{5,})",
    "pem": "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----",
}
_COUNTS = {
    "assign": f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6",
    "access": "length(m) >= 20",
}


def _places(rank: int, kind: str) -> str:
    pattern = _KINDS[kind]
    # A web token has a border before it, which is no part of it.
    own = f"regexp_extract(m, '{pattern}', 2)" if kind == "webtoken" else "m"
    return f"""
        SELECT doc_id, {rank} AS kind_rank, '{kind}' AS kind, stop - length({own}) AS start, stop
        FROM (
            SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
            FROM (
                SELECT doc_id, unnest(hits) AS m, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i
                FROM (
                    SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits,
                        string_split_regex(text, '{pattern}') AS gaps
                    FROM documents WHERE regexp_matches(text, '{pattern}')
                )
            )
        )
        WHERE {_COUNTS.get(kind, 'true')}"""


SECRET_SPANS = f"""
WITH places AS ({" UNION ALL ".join(_places(i, k) for i, k in enumerate(_KINDS))}),
per_document AS (
    SELECT doc_id,
        count(*) FILTER (kind = 'assign') AS n_assign,
        count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ',' ORDER BY start, kind_rank)
            FILTER (kind_rank < 3) AS base,
        string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ',' ORDER BY start, kind_rank) AS spans
    FROM places GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_document USING (doc_id)
"""

URL_VERDICTS = """
WITH rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, coalesce(rest, '') AS rest FROM rest)
),
matched AS (
    SELECT *, '.' || host AS dotted,
        CASE
            WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/'
        END AS rule,
        CASE
            WHEN ends_with('.' || host, '.cheap-pills.example.com') THEN 'cheap-pills.example.com'
            WHEN ends_with('.' || host, '.spam-farm.example.org') THEN 'spam-farm.example.org'
        END AS listed
    FROM parts
)
SELECT page_id, host, path, rule,
    CASE
        WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
        WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
        WHEN listed IS NOT NULL THEN 'block'
        ELSE 'allow'
    END AS verdict,
    listed
FROM matched
"""

SOURCE_DIVERGENCE = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
places AS (SELECT r, lang, source, unnest(terms) AS term FROM texts),
kept AS (SELECT lang, term FROM places GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM texts),
counts AS (SELECT lang, source, term, count(*) AS n FROM places SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
shares AS (
    SELECT lang, source, term, n,
        (1 + (1000000000 * (n + 1)::HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + v))::BIGINT AS p
    FROM grid JOIN sizes USING (lang)
),
of_lang AS (
    SELECT lang, term, (1 + (1000000000 * (sum(n) + 1)::HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)))::BIGINT AS q
    FROM grid JOIN sizes USING (lang) GROUP BY lang, term
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (
    SELECT s.lang, s.source, 'term' AS part, s.term AS item, (s.p - q) * (s.p - q) // q AS value
    FROM shares s JOIN of_lang USING (lang, term) WHERE n > 0 AND s.p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
