"""The base columns of secret scans and quality rules as queries of their own, which SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .fertility import MAX_REPEATED_PERCENT, MIN_WORDS, base_measures
from .secrets import op2_secrets

#: Fixed values of the contract: kind, pattern, group whose length counts, and its least length, in the order of kinds.
SECRET_RULES = (
    (
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
WORD, WIDTH = r"[^\x20\x09-\x0D]+", 8


def q_secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def q_rule_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_measures(table(spark, sf_dir, "documents"))


def _secret_sql() -> str:
    """A match begins behind all matches before it and what lies between them."""
    parts = []
    for order, (kind, pattern, group, least) in enumerate(SECRET_RULES):
        quoted = pattern.replace("'", "''")
        found = f"regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS v, string_split_regex(t, '{quoted}') AS g"
        rows = f"SELECT u, unnest(m) AS m, unnest(v) AS v, unnest(g[1:len(m)]) AS g, unnest(range(len(m))) AS i FROM (SELECT u, {found} FROM d)"
        at = "(sum(length(g) + length(m)) OVER (PARTITION BY u ORDER BY i))::BIGINT"
        parts.append(f"SELECT u, '{kind}' AS kind, {order} AS o, {at} - length(m) AS b, {at} AS e, length(v) >= {least} AS good FROM ({rows})")
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}')::BIGINT AS n_{kind}" for kind, *_ in SECRET_RULES)
    return f"""WITH d AS (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t FROM documents), s AS ({' UNION ALL '.join(parts)})
SELECT any_value(doc_id) AS doc_id, {counts}, sha256(coalesce(string_agg(concat(kind, ':', b, ':', e), ',' ORDER BY b, o) FILTER (kind IS NOT NULL), '')) AS base_sha256
FROM d LEFT JOIN (SELECT * FROM s WHERE good) USING (u) GROUP BY u"""


def _rule_sql() -> str:
    return f"""WITH d AS (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
x AS (SELECT u, unnest(range(1, len(words) + 1)) AS i, words FROM w WHERE len(words) > {WIDTH}),
y AS (SELECT u, i, CASE WHEN i + {WIDTH - 1} <= len(words) THEN array_to_string(words[i:i + {WIDTH - 1}], ' ') END AS win FROM x),
z AS (SELECT u, i, win IS NOT NULL AND count(*) OVER (PARTITION BY u, win) > 1 AS twice FROM y),
r AS (SELECT u, bool_or(twice) OVER (PARTITION BY u ORDER BY i ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW) AS inside FROM z),
n AS (SELECT u, count(*) FILTER (inside) AS n_repeat_words FROM r GROUP BY u),
b AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
(len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN n USING (u))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM b"""


QUERIES = {"q_secret_base": q_secret_base, "q_rule_base": q_rule_base}
ORACLES = {"q_secret_base": _secret_sql(), "q_rule_base": _rule_sql()}
