"""SQL fragments shared by the statements the queries are checked against."""

from __future__ import annotations

from statistics import NormalDist

from ..operators.crosstab import CONFIDENCE
from .responses import QUESTIONS, RESPONSES_SQL

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT id, cluster, weight, '{q}' AS q_code, {q} AS answer FROM responses" for q in QUESTIONS) + ")"

COUNTS = """counts AS (
  SELECT q_code, answer, cluster, count(*) AS n, sum(weight) AS w FROM long GROUP BY q_code, answer, cluster)"""

SHOWN = """partly AS (SELECT q_code, bool_or(answer = 'Not shown') AS partly FROM counts GROUP BY q_code),
shown AS (SELECT c.* FROM counts c JOIN partly USING (q_code)
  WHERE NOT partly OR (answer <> 'Not shown' AND cluster <> 'Not shown')),
segs AS (SELECT q_code, count(DISTINCT cluster) AS n_segments FROM shown GROUP BY q_code),
full_answers AS (SELECT q_code, answer FROM shown JOIN segs USING (q_code)
  GROUP BY q_code, answer, n_segments HAVING count(*) FILTER (WHERE n >= 5) = n_segments),
usable AS (SELECT s.q_code, s.answer, s.cluster, s.n FROM shown s JOIN full_answers USING (q_code, answer))"""

CELLS = """totals AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY q_code, answer) AS BIGINT) AS row_total,
    CAST(sum(n) OVER (PARTITION BY q_code, cluster) AS BIGINT) AS col_total,
    CAST(sum(n) OVER (PARTITION BY q_code) AS BIGINT) AS total FROM usable),
shapes AS (SELECT q_code, count(DISTINCT answer) AS n_rows, count(DISTINCT cluster) AS n_cols FROM usable GROUP BY q_code),
cells AS (SELECT totals.*, n_rows, n_cols, row_total * col_total / CAST(total AS DOUBLE) AS expected
  FROM totals JOIN shapes USING (q_code))"""

TESTS = """raw_tests AS (
  SELECT q_code, CAST((n_rows - 1) * (n_cols - 1) AS INTEGER) AS dof,
    sum(power(CASE WHEN (n_rows - 1) * (n_cols - 1) = 1 THEN abs(n - expected) - least(abs(n - expected), 0.5)
      ELSE n - expected END, 2) / expected) AS raw_stat
  FROM cells GROUP BY q_code, n_rows, n_cols),
tests AS (
  SELECT q_code, dof, CASE WHEN dof = 0 THEN CAST(0 AS DOUBLE) ELSE raw_stat END AS stat,
    CASE dof WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 2 THEN exp(-raw_stat / 2)
      WHEN 4 THEN exp(-raw_stat / 2) * (1 + raw_stat / 2)
      WHEN 6 THEN exp(-raw_stat / 2) * (1 + raw_stat / 2 + power(raw_stat / 2, 2) / 2)
      WHEN 8 THEN exp(-raw_stat / 2) * (1 + raw_stat / 2 + power(raw_stat / 2, 2) / 2 + power(raw_stat / 2, 3) / 6)
      WHEN 10 THEN exp(-raw_stat / 2) * (1 + raw_stat / 2 + power(raw_stat / 2, 2) / 2 + power(raw_stat / 2, 3) / 6
        + power(raw_stat / 2, 4) / 24) END AS p
  FROM raw_tests)"""

_ALPHA = 1.0 - CONFIDENCE
_BOUNDS = " ".join(f"WHEN {m} THEN {NormalDist().inv_cdf(1 - _ALPHA / m / 2)!r}" for m in range(1, 65))


def flags(correction: bool) -> str:
    bound = f"abs(residual) >= CASE n_rows * n_cols {_BOUNDS} END" if correction else "true"
    return f"""resid AS (
  SELECT c.*, p, n > expected AS more, round((n - expected) /
    nullif(sqrt(expected * (1 - row_total / CAST(total AS DOUBLE)) * (1 - col_total / CAST(total AS DOUBLE))), 0), 3)
    AS residual
  FROM cells c JOIN tests USING (q_code)),
flagged AS (
  SELECT *, CASE WHEN p <= {_ALPHA!r} AND abs(residual) >= 1.96 AND {bound}
    THEN CASE WHEN more THEN 'pos' ELSE 'neg' END ELSE 'neu' END AS flag FROM resid)"""


MODES = """sized AS (
  SELECT *, sum(n) OVER (PARTITION BY q_code, cluster) AS size, sum(w) OVER (PARTITION BY q_code, cluster) AS w_size
  FROM counts),
modes AS (
  SELECT q_code, cluster, answer AS mode, round(n * 100.0 / size, 2) AS mode_perc FROM (
    SELECT *, row_number() OVER (PARTITION BY q_code, cluster ORDER BY n DESC, answer) AS rn
    FROM sized WHERE answer <> 'Not shown') WHERE rn = 1),
shares AS (
  SELECT q_code, answer, cluster, round(CAST(n AS DOUBLE) / size * 100, 2) AS freq_perc,
    round(w / w_size * 100, 2) AS weighted_perc FROM sized)"""

DELIVER = """deliver AS (
  SELECT f.q_code, m.mode AS pop_mode, m.mode_perc AS mode_pop_perc, round(max(f.p), 5) AS chi_2_result,
    string_agg(f.answer, '|' ORDER BY f.answer) AS sig_more_category,
    string_agg(CAST(CAST(round(freq_perc * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY f.answer) AS category_percentages,
    f.cluster AS targeting_seg, round(max(t.stat), 2) AS chi2_stat
  FROM flagged f JOIN shares s ON f.q_code = s.q_code AND f.answer = s.answer AND f.cluster = s.cluster
    JOIN modes m ON f.q_code = m.q_code AND f.cluster = m.cluster JOIN tests t ON f.q_code = t.q_code
  WHERE f.flag = 'pos' AND f.answer <> 'not selected'
  GROUP BY f.q_code, f.cluster, m.mode, m.mode_perc)"""

SIZES = "sizes AS (SELECT cluster, count(*) AS n, sum(weight) AS weighted_n, (SELECT count(*) FROM responses) AS total \
FROM responses GROUP BY cluster)"

_CHAIN = [RESPONSES_SQL, LONG, COUNTS, SHOWN, CELLS, TESTS]


def upto(part: str, final: str, extra: list[str] | None = None) -> str:
    """A statement with all the fragments up to ``part``."""
    chain = {"responses": _CHAIN[:1], "long": _CHAIN[:2], "counts": _CHAIN[:3], "usable": _CHAIN[:4],
             "cells": _CHAIN[:5], "tests": _CHAIN, "flags": [*_CHAIN, flags(True)],
             "plain_flags": [*_CHAIN, flags(False)], "deliver": [*_CHAIN, flags(True), MODES, DELIVER],
             "modes": [*_CHAIN[:3], MODES]}[part]
    return "WITH " + ",\n".join(s.strip() for s in [*chain, *(extra or [])]) + "\n" + final
