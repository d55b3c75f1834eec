"""DuckDB SQL of the weakly supervised quality rules: the same votes, every EM round a CTE."""

from __future__ import annotations

from aurum.llm import quality_rules as Q


def _log_odds(k: int) -> str:
    arms = [f"CASE v{i} WHEN 1 THEN ln(good{i} / (1 - bad{i})) WHEN -1 THEN ln((1 - good{i}) / bad{i}) ELSE 0 END" for i in range(k)]
    return " + ".join(["ln(prior / (1 - prior))", *arms])


def _rate(i: int, right: int, share: str, name: str) -> str:
    lo, hi = Q.ACCURACY
    return (f"least({hi}, greatest({lo}, (coalesce(sum({share}) FILTER (v{i} = {right}), 0) + 1)"
            f" / (coalesce(sum({share}) FILTER (v{i} <> 0), 0) + 2))) AS {name}{i}")


def quality_sql(rules=Q.RULES, iterations: int = Q.ITERATIONS) -> str:
    k = len(rules)
    votes = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{i}" for i, (good, bad) in enumerate(rules.values()))
    names = ", ".join(f"v{i}" for i in range(k))
    start = ", ".join(f"{Q.START_ACCURACY}::DOUBLE AS good{i}, {Q.START_ACCURACY}::DOUBLE AS bad{i}" for i in range(k))
    rounds = []
    for r in range(1, iterations + 1):
        rates = ", ".join(_rate(i, 1, "n * g", "good") + ", " + _rate(i, -1, "n * (1 - g)", "bad") for i in range(k))
        rounds.append(f"""
t{r} AS MATERIALIZED (
  SELECT least({Q.PRIOR[1]}, greatest({Q.PRIOR[0]}, (coalesce(sum(n * g), 0) + 1) / (coalesce(sum(n), 0) + 2))) AS prior, {rates}
  FROM (SELECT p.*, 1 / (1 + exp(-({_log_odds(k)}))) AS g FROM p, t{r - 1}))""")
    return rf"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
b AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(text, '[^.!?]', '', 'g')) AS n_ends
  FROM a),
b2 AS (SELECT *, row_number() OVER () AS rid FROM b),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM b2)),
rep AS (
  SELECT rid, count(DISTINCT i + o) AS n_repeat_words
  FROM win, (SELECT unnest([0, 1, 2]) AS o) WHERE times > 1 GROUP BY rid),
c AS (
  SELECT doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars, n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(lines) AS n_lines, n_capitals, len(list_distinct(words)) AS n_distinct, n_ends
  FROM b2 LEFT JOIN rep USING (rid)),
v AS MATERIALIZED (SELECT *, {Q.BASE_FAILED} AS base_failed, {votes} FROM c),
p AS MATERIALIZED (SELECT {names}, count(*)::DOUBLE AS n FROM v WHERE NOT base_failed GROUP BY ALL),
t0 AS (SELECT {Q.START_PRIOR}::DOUBLE AS prior, {start}),{",".join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_log_odds(k)} >= 0 AS kept
FROM v, t{iterations}
"""
