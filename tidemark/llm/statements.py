"""SQL (DuckDB) that must give the rows of the queries on urls, sources and vector codes."""

from __future__ import annotations

from collections.abc import Sequence


def host_filter(rules: Sequence[tuple[str, str, str]], least: float = 0.5, z: float = 1.645) -> str:
    values = ", ".join(f"('{kind}', '{host}', '{path}')" for kind, host, path in rules)

    def correlation(members: str, parent: str) -> str:
        """Rounded rho of one level, from the members' counts."""
        return f"""(
    SELECT CASE WHEN sum(full_) IS NULL OR sum(full_) < 1e-9 THEN 0.5
                ELSE round(least(greatest(sum(more) / sum(full_), 1e-6), 0.999), 9) END FROM (
        SELECT kk - 2 * (K / N) * kn + (K / N) * (K / N) * nn - K * (N - K) / (N * N) * (N - nn / N) AS more,
               K * (N - K) / (N * N) * ((nn - N) * (1 + nn / (N * N)) - 2 * (nnn - nn) / N) AS full_ FROM (
            SELECT sum(n) AS N, sum(k) AS K, sum(n * n) AS nn, sum(n * n * n) AS nnn, sum(k * k) AS kk, sum(k * n) AS kn
            FROM (SELECT {parent} AS parent, n::DOUBLE AS n, k::DOUBLE AS k FROM {members} WHERE n > 0) GROUP BY parent
        )
    )
)"""

    return f"""
WITH rules(kind, rule_host, rule_path) AS (VALUES {values}),
cut AS (
    SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosted AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), parts AS (
    SELECT row_number() OVER () AS row, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosted
), fitted AS (
    SELECT row, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(kind, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row
), pages_ AS (
    SELECT page_id, host, path, rule, verdict FROM parts LEFT JOIN fitted USING (row)
), bare AS (
    SELECT host, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]+$', '') AS bare,
           count(verdict) AS n, count(*) FILTER (verdict = 'allow') AS k FROM pages_ GROUP BY host
), named AS (
    SELECT *, string_split(bare, '.') AS names, regexp_matches(bare, '^[0-9.]+$') OR starts_with(bare, '[') AS address FROM bare
), taken AS (
    SELECT *, CASE WHEN length(names[-1]) = 2 AND names[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS taken FROM named
), hosts AS (
    SELECT host, n, k, CASE WHEN address OR len(names) <= taken THEN bare ELSE array_to_string(names[-taken:], '.') END AS suffix,
           CASE WHEN address OR len(names) <= taken THEN bare ELSE array_to_string(names[-(taken + 1):], '.') END AS domain FROM taken
), domains AS (
    SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix
), rho AS (
    SELECT 1 / {correlation("suffixes", "0")} - 1 AS of_suffix, 1 / {correlation("domains", "suffix")} - 1 AS of_domain,
           1 / {correlation("hosts", "domain")} - 1 AS of_host, (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) FROM suffixes) AS share,
           (SELECT coalesce(sum(n), 0) FROM suffixes) AS total
), by_suffix AS (
    SELECT suffix, of_suffix + n AS w, (of_suffix * share + k) / w AS m,
           m * (1 - m) / (w + 1) + of_suffix * of_suffix / (w * w) * (share * (1 - share) / (total + 2.0)) AS spread FROM suffixes, rho
), by_domain AS (
    SELECT domain, suffix, of_domain + n AS w, (of_domain * s.up + k) / w AS m,
           m * (1 - m) / (w + 1) + of_domain * of_domain / (w * w) * s.spread_up AS spread
    FROM domains JOIN (SELECT suffix, m AS up, spread AS spread_up FROM by_suffix) s USING (suffix), rho
), by_host AS (
    SELECT host, of_host + n AS w, (of_host * d.up + k) / w AS mean,
           mean * (1 - mean) / (w + 1) + of_host * of_host / (w * w) * d.spread_up AS spread
    FROM hosts JOIN (SELECT domain, suffix, m AS up, spread AS spread_up FROM by_domain) d USING (domain, suffix), rho
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN least(1.0, mean + {z} * sqrt(spread)) < {least} THEN 'block' ELSE 'allow' END) AS verdict
FROM pages_ JOIN by_host USING (host)
"""


def source_divergence(least: int = 3, top: int = 200) -> str:
    share = "1 + (1000000000 * (n::HUGEINT + 1)) // ({total} + v)"
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= {least}
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM docs)
    LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) USING (lang, source)
), wide AS (
    SELECT lang, source, term, coalesce(c.n, 0) AS n, v, total FROM groups JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
), shares AS (
    SELECT lang, source, term, n, {share.format(total="total")} AS p FROM wide
), of_lang AS (
    SELECT lang, term, {share.format(total="sum(n) OVER (PARTITION BY lang)")} AS q
    FROM (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM wide GROUP BY lang, term)
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
    FROM shares JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= {top}
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds of assignment and update as a chain of tables."""
    steps = f"""
WITH sound AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), places AS (
    SELECT row, unnest(v) AS x, unnest(range(len(v))) AS place, len(v) // {parts} AS width FROM sound
), cells AS MATERIALIZED (
    SELECT row, place // width AS part, place % width AS place, x FROM places
), book0 AS MATERIALIZED (
    SELECT part, row - 1 AS entry, place, x AS y FROM cells WHERE row <= {entries}
)"""
    nearest = """, distance{i} AS (
    SELECT row, part, entry, sum((x - y) * (x - y)) AS d FROM cells JOIN book{i} USING (part, place) GROUP BY ALL
), near{i} AS MATERIALIZED (
    SELECT row, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM distance{i} GROUP BY row, part
)"""
    moved = """, sums{i} AS (
    SELECT part, entry, place, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM cells JOIN near{i} USING (row, part) GROUP BY ALL
), book{j} AS MATERIALIZED (
    SELECT part, entry, place,
           CAST(CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS y FROM book{i} LEFT JOIN sums{i} USING (part, entry, place)
)"""
    for i in range(rounds):
        steps += nearest.format(i=i) + moved.format(i=i, j=i + 1)
    return f"""{steps}{nearest.format(i=rounds)}, coded AS (
    SELECT row, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY row
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM sound JOIN coded USING (row)
"""
