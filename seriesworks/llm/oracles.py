"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import decontaminate, rules

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"


def quality_rules() -> str:
    n, start, prior = len(rules.RULES), rules.START, rules.PRIOR_VOTES
    vote = [f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{j}" for j, (_, bad, good) in enumerate(rules.RULES)]
    names = ", ".join(f"v{j}" for j in range(n))

    def accuracy(share: str, said: int, j: int) -> str:
        hit, voted = f"sum(n * CASE v{j} WHEN {said} THEN {share} ELSE 0 END)", f"sum(n * abs(v{j}) * {share})"
        return f"least(0.9999, greatest(0.0001, ({hit} + {start * prior}::DOUBLE) / ({voted} + {prior}::DOUBLE)))"

    fit = ", ".join(f"{accuracy('q', 1, j)} AS g{j}, {accuracy('(1 - q)', -1, j)} AS b{j}" for j in range(n))
    odds = " + ".join(
        f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in range(n)
    )
    bad = " OR ".join(f"v{j} = -1" for j in range(n))
    steps = [f"q0 AS MATERIALIZED (SELECT {names}, n, CASE WHEN {bad} THEN {1 - start} ELSE {start} END::DOUBLE AS q FROM patterns)"]
    for t in range(rules.ITERATIONS + 1):
        steps.append(f"m{t} AS MATERIALIZED (SELECT (sum(n * q) + 1) / (sum(n) + 2) AS p, {fit} FROM q{t})")
        steps.append(
            f"q{t + 1} AS MATERIALIZED (SELECT {names}, n, 1 / (1 + exp(-(ln(p / (1 - p)) + {odds}))) AS q FROM patterns, m{t})"
        )
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM base WHERE len(w) > 2
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows
  ) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclamations
  FROM base LEFT JOIN covered USING (doc_id)
), voted AS (SELECT *, {", ".join(vote)} FROM counted),
patterns AS MATERIALIZED (SELECT {names}, count(*) AS n FROM voted GROUP BY {names}),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND q >= 0.5 AS kept
FROM voted JOIN q{rules.ITERATIONS + 1} USING ({names})"""


def decontamination() -> str:
    n, share = decontaminate.SHINGLE, decontaminate.CONTAINMENT
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = WORDS.replace("text,", f"{lower},")

    def parts(key: str, source: str) -> str:
        at = f"unnest(range(1, len(w) - {n - 2})) AS i"
        return (
            f"SELECT DISTINCT {key}, array_to_string(w[i : i + {n - 1}], ' ') AS shingle FROM "
            f"(SELECT {key}, w, {at} FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) >= {n})"
        )

    return rf"""
WITH item AS ({parts("item_id", "benchmark")}), doc AS ({parts("doc_id", "documents")}),
sizes AS (SELECT item_id, count(*) AS shingles FROM item GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(shingles) AS shingles, count(*) / any_value(shingles) AS containment
FROM item JOIN doc USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= {share} * any_value(shingles)"""


def url_filters() -> str:
    from .queries import URL_RULES

    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    return rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), best AS (
  SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best"""


def phrases() -> str:
    from . import phrases as op

    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM places, (SELECT unnest(range(1, {op.LONGEST + 1})) AS k) WHERE i + k - 1 <= len(w)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {op.LEAST_COUNT}
), cuts AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1
), scored AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, cuts.a, c, x.a AS l, y.a AS r, n,
         (1000::HUGEINT * cuts.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts JOIN total USING (lang)
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[:c], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[c + 1:], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_parts AS (
  SELECT DISTINCT lang, a, array_to_string(w[s : s + size - 1], ' ') AS phrase
  FROM (SELECT lang, a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 2),
       (SELECT unnest(range(2, {op.LONGEST})) AS size), (SELECT unnest(range(1, {op.LONGEST})) AS s)
  WHERE size < k AND s + size - 1 <= k
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best ANTI JOIN inner_parts USING (lang, phrase, a)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {op.TOP}"""


def oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules(),
        "op5_decontamination": decontamination(),
        "op8_url_filters": url_filters(),
        "op13_phrases": phrases(),
    }
