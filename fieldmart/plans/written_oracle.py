"""DuckDB SQL of the queries that write and read, and of the ordered and parted reports."""

from __future__ import annotations

from fieldmart.plans.oracle import ORACLE_SQL as BASE
from fieldmart.plans.oracle import NAME_PAIRS, PREPARED, SILVER, VISITS

FORMS = f"""{VISITS}, form AS (SELECT row_id, CAST(row_id AS VARCHAR) AS id_text, country, tabletnum, CAST(tabletnum AS INT) AS t, 'Tablet' || tabletnum AS label,
  CASE WHEN CAST(tabletnum AS INT) % 4 = 2 AND row_id % 50 = 0 THEN 'unknown' ELSE respondants_age END AS age, coalesce(dob, '') AS dob, coalesce(remarks, '') AS remarks FROM visits),
failing AS (SELECT DISTINCT label FROM form WHERE tabletnum IN ('7', '23') AND row_id % 5 = 0),
good AS (SELECT * FROM form WHERE label NOT IN (SELECT label FROM failing))"""


def _kind(x: str, column: str, where: str = "true") -> str:
    return rf"""SELECT 'label=' || label AS file, '{column}' AS "column", CASE WHEN count(*) FILTER ({x} <> '') = 0 THEN 'float64'
  WHEN bool_and(regexp_full_match({x}, '[+-]?\d+')) FILTER ({x} <> '') THEN CASE WHEN count(*) FILTER ({x} = '') = 0 THEN 'int64' ELSE 'float64' END
  WHEN bool_and(regexp_full_match({x}, '[+-]?(\d+\.?\d*|\.\d+)')) FILTER ({x} <> '') THEN 'float64' ELSE 'object' END AS dtype FROM good WHERE {where} GROUP BY label"""


_KINDS = " UNION ALL ".join([*[_kind(x, c) for x, c in (("id_text", "row_id"), ("country", "country"), ("tabletnum", "tabletnum"), ("age", "respondants_age"))], _kind("dob", "dob", "t % 4 <> 1"), _kind("remarks", "remarks", "t % 4 <> 1")])
_COMMITTED = f"WITH {FORMS} SELECT label, count(*) AS n_rows, count(DISTINCT row_id) AS n_ids FROM good GROUP BY label"


def _ordered(name: str, keys: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {', '.join(f'{k} NULLS LAST' for k in keys.split(', '))}) AS place FROM ({BASE[name]})"


def _parts(source: str, keys: str, id_: str, separator: str) -> str:
    return f"SELECT {keys}, part, string_agg(id, '{separator}' ORDER BY id) AS ids FROM (SELECT {keys}, id, (row_number() OVER (PARTITION BY {keys} ORDER BY id) - 1) // 500 AS part FROM (SELECT DISTINCT {keys}, {id_} AS id FROM {source} WHERE {id_} IS NOT NULL)) GROUP BY {keys}, part"


_TENTH = "(p // 100000 + CASE WHEN p % 100000 > 50000 OR p % 100000 = 50000 AND p // 100000 % 2 = 1 THEN 1 ELSE 0 END)"

WRITTEN_SQL: dict[str, str] = {
    "file_manifest": f"WITH {FORMS} SELECT DISTINCT label, 1 AS n_files, true AS filled, true AS dated FROM form",
    "text_scan": f"WITH {VISITS} SELECT CAST(row_id AS VARCHAR) AS row_id, country, tabletnum, coalesce(respondants_age, '') AS respondants_age, coalesce(dob, '') AS dob, coalesce(remarks, '') AS remarks FROM visits",
    "landed_files": f"WITH {FORMS} SELECT label, CASE WHEN label IN (SELECT label FROM failing) THEN 0 ELSE count(*) END AS n_rows, label NOT IN (SELECT label FROM failing) AS loaded FROM form GROUP BY label",
    "isolated_rows": f"WITH {FORMS} SELECT label, id_text AS row_id, country, tabletnum, age AS respondants_age, CASE WHEN t % 4 <> 1 THEN dob END AS dob, CASE WHEN t % 4 <> 1 THEN remarks END AS remarks FROM good",
    "isolated_failures": f"WITH {FORMS} SELECT label FROM failing",
    "drifted_column_types": f"WITH {FORMS} {_KINDS}",
    "drifted_missing_columns": f"WITH {FORMS} SELECT DISTINCT 'label=' || label AS file, 4 AS n_columns, 'dob, remarks' AS missing FROM good WHERE t % 4 = 1",
    "drifted_type_conflicts": f"WITH {FORMS}, types AS ({_KINDS}) SELECT \"column\", string_agg(DISTINCT dtype, ', ' ORDER BY dtype) AS dtypes FROM types GROUP BY 1 HAVING count(DISTINCT dtype) > 1 AND count(*) FILTER (dtype NOT IN ('int64', 'float64')) > 0",
    "provenance": f"WITH {FORMS} SELECT id_text AS row_id, label, CASE WHEN label LIKE 'Tablet1%' THEN 'kenya' ELSE 'uganda' END AS country, CASE WHEN label LIKE 'Tablet1%' THEN 'first' ELSE 'all' END AS community, 'run-1' AS run_uuid, TIMESTAMP '2001-06-30 12:00:00' AS extracted_at, true AS named FROM good",
    "append_exactly_once": _COMMITTED,
    "append_streamed": _COMMITTED,
    "overwrite_current": f"WITH {VISITS} SELECT row_id, country FROM visits WHERE row_id % 5 = 0",
    "marts_with_audit": f"WITH {SILVER}, c AS (SELECT 'baseline' AS file_name, count(*) FILTER (uniqueid IS NOT NULL) AS n FROM silver UNION ALL SELECT 'enrollment', count(*) FILTER (TRY_CAST(consent AS INT) = 1 AND subjid IS NOT NULL) FROM silver UNION ALL SELECT 'qc_checks', count(*) FROM (SELECT DISTINCT countrycode, tabletnum FROM silver)) SELECT 'run-1' AS run_uuid, file_name, n AS n_rows, TIMESTAMP '2001-06-30 12:00:00' AS extracted_at, n FROM c",
    "publish_views": f"WITH {VISITS} SELECT country, count(*) AS n, count(*) FILTER (consent = '1') AS consented, 1 AS n_versions FROM visits GROUP BY country",
    "snapshot_append": f"WITH {VISITS} SELECT DATE '2001-06-30' + CAST(d AS INT) AS snapshot_date, n, 'new new redo skip' AS actions FROM (SELECT count(*) AS n, unnest([0, 1]) AS d FROM visits)",
    "template_folder": "WITH s AS (SELECT * FROM part, (SELECT unnest(['English', 'Luganda']) AS language) WHERE CASE language WHEN 'English' THEN p_partkey % 2 ELSE p_partkey % 5 END = 0) SELECT 'arm  ' || p_partkey AS arm, language, 8 AS week, 'a b ' || p_name AS message_text, false AS has_placeholder FROM s UNION ALL SELECT 'arm  ' || p_partkey, language, 11, p_name || ' [date]', true FROM s WHERE p_partkey % 3 <> 0",
    "qc_summary_ordered": _ordered("qc_summary", "countrycode, tabletnum"),
    "flagged_messages_ordered": _ordered("flagged_messages", "health_facility_ug, subjid, week, last_error"),
    "weekly_report_ordered": _ordered("weekly_report", "health_facility_ug, week"),
    "delivery_linelist_ordered": _ordered("delivery_linelist", "site_code, week, sent_at_local, subjid, arm_text, language, mobile_number, scheduled_date, delivery_status"),
    "messages_sent_ordered": _ordered("messages_sent", "sent_at DESC, log_id"),
    "similar_name_ordered": _ordered("similar_name", "similarity DESC, row_a, row_b"),
    "similar_name_pairs": f"WITH {PREPARED}, {NAME_PAIRS}, c AS (SELECT country, site, born, name, count(*) AS n FROM prepared GROUP BY ALL) SELECT country, site, born, na AS name_a, nb AS name_b, similarity, a.n AS n_a, b.n AS n_b FROM ns JOIN c a USING (country, site, born) JOIN c b USING (country, site, born) WHERE a.name = na AND b.name = nb AND similarity >= 0.85",
    "report_export": BASE["delivery_linelist"],
    "affected_id_parts": f"WITH {PREPARED} {_parts('prepared', 'country, site', 'subject', '; ')}",
    "resend_list_parts": _parts(f"({BASE['flagged_messages']})", "week", "subjid", ", "),
    "percent_cells": f"SELECT * EXCLUDE (p), CASE WHEN metric = 'due' THEN CAST(n AS VARCHAR) WHEN pct IS NULL THEN '' ELSE n || ' (' || {_TENTH} // 10 || '.' || {_TENTH} % 10 || '%)' END AS cell FROM (SELECT *, CAST(round(pct * 1000000) AS BIGINT) AS p FROM ({BASE['weekly_percent']}))",
    "message_status_view": BASE["message_status"],
}
