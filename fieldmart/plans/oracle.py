"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

from fieldmart import codes
from fieldmart.sources.demo import ARM_TEXTS, LANGUAGE_TEXTS

DAY = "DATE '2001-06-30'"
_FORMAT = "'%d/%m/%Y %H:%M:%S'"


def _text(time: str) -> str:
    return f"strftime({time}, {_FORMAT})"


def _num(c: str) -> str:
    return rf"CASE WHEN regexp_full_match(trim({c}), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def _plain(c: str) -> str:
    return f"coalesce(CASE WHEN ({_num(c)}) = floor({_num(c)}) THEN CAST(TRY_CAST(({_num(c)}) AS BIGINT) AS VARCHAR) END, trim({c}))"


def _known(c: str) -> str:
    return f"CASE WHEN {_plain(c)} NOT IN ('', '-9') AND lower({_plain(c)}) <> 'nan' THEN {_plain(c)} END"


def _digits(c: str) -> str:
    return f"regexp_replace({_plain(c)}, '[^0-9]', '', 'g')"


def _phone(c: str) -> str:
    d = _digits(c)
    return f"nullif(CASE WHEN length({d}) = 12 AND (starts_with({d}, '254') OR starts_with({d}, '256')) THEN substr({d}, 4) WHEN length({d}) = 10 AND starts_with({d}, '0') THEN substr({d}, 2) ELSE {d} END, '')"


def _stamp(c: str) -> str:
    return f"try_strptime({c}, {_FORMAT})"


def _born(c: str) -> str:
    d = f"CAST({_stamp(c)} AS DATE)"
    return f"CASE WHEN {d} > {DAY} AND {d} - INTERVAL 100 YEAR BETWEEN {DAY} - INTERVAL 110 YEAR AND {DAY} - INTERVAL 10 YEAR THEN CAST({d} - INTERVAL 100 YEAR AS DATE) ELSE {d} END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _label(c: str, country: str) -> str:
    names = " ".join(f"WHEN {k} THEN {_quoted(v)}" for k, v in codes.FACILITIES[country].items())
    n = f"CAST({_num(c)} AS INT)"
    return f"CAST({n} AS VARCHAR) || ' (' || CASE {n} {names} ELSE 'Unknown' END || ')'"


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(_quoted(v) for v in values) + "]"


VISITS = f"""
base AS (SELECT o_orderkey AS k, o_custkey AS u, o_orderstatus AS st, CAST(o_orderdate AS TIMESTAMP) AS od, c_nationkey % 2 = 0 AS ke,
         CASE WHEN o_orderkey % 1000 < 60 THEN TIMESTAMP '2001-05-05' ELSE CAST(o_orderdate AS TIMESTAMP) END + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS start_, CASE WHEN o_custkey % 301 = 0 THEN DATE '2095-01-01' + CAST(o_custkey % 300 AS INT) ELSE DATE '1930-01-01' + CAST(o_custkey * 37 % 29000 AS INT) END AS born_
         FROM orders JOIN customer ON o_custkey = c_custkey),
visits AS (SELECT k AS row_id,
  CASE WHEN k % 97 <> 0 THEN CAST(k % 14000 AS VARCHAR) END AS uniqueid,
  CASE WHEN st = 'P' THEN '-9' WHEN k % 11 = 0 THEN '' ELSE 'S' || u END AS subjid,
  CASE WHEN k % 53 = 0 THEN 'SCR ' || k WHEN k % 59 = 0 THEN 'X' || k ELSE 'SCR-' || (k % 14500) END AS screening_id,
  CASE WHEN ke THEN 'kenya' ELSE 'uganda' END AS country,
  CASE WHEN k % 37 = 0 THEN '9' WHEN ke THEN '2' ELSE '1' END AS countrycode,
  CAST(u % 40 AS VARCHAR) AS tabletnum,
  CASE WHEN k % 1000 < 60 THEN 'I0' WHEN k % 101 <> 0 THEN 'I' || (u % 12) END AS interviewer_id,
  {_text("start_")} AS starttime,
  {_text("start_ + to_minutes(CAST(k % 45 - 3 AS BIGINT))")} AS stoptime,
  {_text("CAST(born_ AS TIMESTAMP)")} AS dob,
  CASE WHEN k % 67 = 0 THEN '-7' WHEN k % 71 = 0 THEN '150' ELSE CAST(2001 - year(born_) + k % 5 - 2 AS VARCHAR) END AS respondants_age,
  CASE WHEN k % 89 = 0 THEN '3' WHEN k % 25 = 4 THEN '-9' ELSE CAST(1 + k % 2 AS VARCHAR) END AS client_sex,
  CASE WHEN k % 83 = 0 THEN '5' WHEN k % 7 = 0 THEN '0' ELSE '1' END AS consent,
  CASE WHEN ke THEN CASE WHEN k % 61 = 0 THEN '55' ELSE CAST(21 + u % 4 AS VARCHAR) END WHEN k % 73 = 0 THEN '21' ELSE '-9' END AS health_facility_ke,
  CASE WHEN NOT ke THEN CASE WHEN k % 61 = 0 THEN '55' ELSE CAST(11 + u % 4 AS VARCHAR) END WHEN k % 79 = 0 THEN '12' ELSE '-9' END AS health_facility_ug,
  '07' || lpad(CAST((u * 7919 + k % 3) % 100000000 AS VARCHAR), 8, '0') AS mobile_number,
  substr(md5(CAST(u AS VARCHAR)), 1, 11) || CASE WHEN k % 13 = 0 THEN 'z' ELSE 'y' END AS participants_name,
  {_text("start_ + to_days(CAST(30 + k % 120 AS INT))")} AS next_appt_3m,
  {_text("start_ + to_days(CAST(k % 260 - 5 AS INT))")} AS next_appt_6m,
  CASE WHEN k % 4 = 0 THEN 'note ' || (k % 9) END AS remarks,
  '/in/Tablet' || CASE WHEN k < 3 THEN 'X' || k ELSE CAST(u % 40 AS VARCHAR) END || '/db.csv' AS _source_db,
  od AS extracted_at FROM base)"""

_VALID = "(CASE country WHEN 'kenya' THEN 2 WHEN 'uganda' THEN 1 END)"
LANDED = f"""{VISITS}, landed AS (SELECT * FROM visits UNION ALL SELECT * REPLACE ('/in/TabletCopy/db.csv' AS _source_db) FROM visits WHERE row_id % 50 = 0)"""
SILVER = f"""{LANDED},
valid AS (SELECT * FROM landed WHERE country IS NOT NULL AND ({_VALID} IS NULL OR ({_num("countrycode")}) = {_VALID})),
distinct_rows AS (SELECT * EXCLUDE (_source_db), min(_source_db) AS _source_db FROM valid GROUP BY ALL),
latest AS (SELECT * FROM distinct_rows WHERE uniqueid IS NULL OR trim(uniqueid) = ''
           UNION ALL BY NAME SELECT * FROM distinct_rows WHERE trim(uniqueid) <> '' QUALIFY row_number() OVER (PARTITION BY country, uniqueid ORDER BY extracted_at DESC NULLS LAST, row_id DESC) = 1),
silver AS (SELECT * EXCLUDE (_source_db) FROM latest)"""

_SITE = f"CASE country WHEN 'kenya' THEN coalesce({_label('health_facility_ke', 'kenya')}, '(Unknown facility)') WHEN 'uganda' THEN coalesce({_label('health_facility_ug', 'uganda')}, '(Unknown facility)') ELSE '' END"
PREPARED = f"""{VISITS},
parsed AS (SELECT *, {_SITE} AS site, {_VALID} AS expected_code, {_num("countrycode")} AS n_code, {_num("respondants_age")} AS n_age, {_num("client_sex")} AS n_sex, {_num("consent")} AS n_consent,
  {_num("health_facility_ke")} AS n_fac_ke, {_num("health_facility_ug")} AS n_fac_ug, {_known("subjid")} AS subject, nullif({_plain("tabletnum")}, '') AS tablet,
  CASE WHEN {_plain("mobile_number")} <> '-9' THEN {_phone("mobile_number")} END AS phone, nullif(lower(trim(participants_name)), '') AS name,
  trim(screening_id) AS screening_text, NOT regexp_full_match(trim(screening_id), '[A-Za-z0-9_-]+') AS screening_bad, starts_with(trim(screening_id), 'SCR') AS screening_fits,
  {_stamp("starttime")} AS start, {_stamp("stoptime")} AS stop, {_born("dob")} AS born, {_stamp("next_appt_3m")} AS appt_3m, {_stamp("next_appt_6m")} AS appt_6m,
  {DAY} AS as_of, CAST({DAY} - INTERVAL 1 YEAR AS DATE) AS year_ago FROM visits),
prepared AS (SELECT *, (epoch(stop) - epoch(start)) / 60 AS minutes, CAST(start AS DATE) AS visit_date, hour(start) AS start_hour, (as_of - born) / 365.25 AS years,
  floor((epoch(appt_3m) - epoch(start)) / 86400) AS days_3m, floor((epoch(appt_6m) - epoch(start)) / 86400) AS days_6m FROM parsed)"""

_IDS = "coalesce(string_agg(DISTINCT subject, '; ' ORDER BY subject), string_agg(DISTINCT nullif(screening_text, ''), '; ' ORDER BY nullif(screening_text, '')), '') AS affected_subjids, coalesce(string_agg(DISTINCT tablet, ', ' ORDER BY tablet), '') AS affected_tablets"


#: Written out here, apart from the operators' own predicates: check, severity, field, condition.
_ROW_CHECKS = [
    *[("missing_required_value", "ERROR", c, f"coalesce(trim({c}), '') = ''") for c in ("starttime", "stoptime", "countrycode", "tabletnum", "client_sex", "screening_id", "uniqueid")],
    ("invalid_age", "ERROR", "respondants_age", "n_age NOT IN (-9, -7) AND (n_age < 10 OR n_age > 110)"),
    ("cross_country_facility", "WARNING", "health_facility_ug", "n_code = 2 AND NOT n_fac_ug = -9"),
    ("cross_country_facility", "WARNING", "health_facility_ke", "n_code = 1 AND NOT n_fac_ke = -9"),
    ("invalid_facility_code", "ERROR", "health_facility_ke", "n_code = 2 AND NOT (n_fac_ke BETWEEN 21 AND 24 AND n_fac_ke = floor(n_fac_ke) OR n_fac_ke IN (-9, 99))"),
    ("invalid_facility_code", "ERROR", "health_facility_ug", "n_code = 1 AND NOT (n_fac_ug BETWEEN 11 AND 14 AND n_fac_ug = floor(n_fac_ug) OR n_fac_ug IN (-9, 99))"),
    ("consented_without_subjid", "ERROR", "subjid", "n_consent = 1 AND coalesce(lower(trim(subjid)), '') IN ('', 'nan')"),
    ("missing_interviewer_id", "WARNING", "interviewer_id", "interviewer_id IS NULL"),
    ("countrycode_mismatch", "ERROR", "countrycode", "n_code IS NOT NULL AND n_code <> CASE country WHEN 'kenya' THEN 2 ELSE 1 END"),
    ("impossible_duration", "ERROR", "stoptime", "stop < start"),
    ("duration_too_short", "WARNING", "stoptime", "stop >= start AND stop < start + INTERVAL 8 MINUTE AND subject IS NOT NULL"),
    ("duration_too_long", "WARNING", "stoptime", "stop > start + INTERVAL 30 MINUTE"),
    ("future_dob", "ERROR", "dob", "born > DATE '2001-06-30'"),
    ("dob_eligibility", "ERROR", "dob", "born <= DATE '2001-06-30' AND ((DATE '2001-06-30' - born) < 3652.5 OR (DATE '2001-06-30' - born) > 40177.5)"),
    ("dob_age_mismatch", "WARNING", "dob", "born <= DATE '2001-06-30' AND n_age NOT IN (-7, -9) AND abs((DATE '2001-06-30' - born) / 365.25 - n_age) > 2"),
    ("future_visit_date", "ERROR", "starttime", "start >= TIMESTAMP '2001-07-01'"),
    ("stale_visit_date", "WARNING", "starttime", "start < TIMESTAMP '2000-06-30'"),
    ("appointment_before_visit", "ERROR", "next_appt_3m", "appt_3m < start"),
    ("appointment_before_visit", "ERROR", "next_appt_6m", "appt_6m < start"),
    ("appointment_interval_unexpected", "WARNING", "next_appt_3m", "appt_3m >= start AND (appt_3m < start + INTERVAL 60 DAY OR appt_3m >= start + INTERVAL 121 DAY)"),
    ("appointment_interval_unexpected", "WARNING", "next_appt_6m", "appt_6m >= start AND (appt_6m < start + INTERVAL 150 DAY OR appt_6m >= start + INTERVAL 211 DAY)"),
    ("invalid_consent_code", "ERROR", "consent", "NOT (n_consent = 0 OR n_consent = 1 OR n_consent = -9)"),
    ("non_consented_with_subjid", "ERROR", "subjid", "n_consent = 0 AND lower(trim(subjid)) NOT IN ('', 'nan')"),
    ("invalid_sex_code", "ERROR", "client_sex", "NOT (n_sex = 1 OR n_sex = 2 OR n_sex = -9)"),
    ("missing_sex_for_consented", "WARNING", "client_sex", "n_consent = 1 AND coalesce(n_sex, -9) = -9"),
    ("unusual_interview_hour", "WARNING", "starttime", "hour(start) < 5"),
    ("invalid_screening_id_format", "ERROR", "screening_id", "regexp_matches(trim(screening_id), '[^A-Za-z0-9_-]')"),
    ("screening_id_country_mismatch", "ERROR", "screening_id", "trim(screening_id) <> '' AND substr(trim(screening_id), 1, 3) <> 'SCR'"),
]
#: check, severity, field, key, most rows of a key.
_COUNT_CHECKS = [
    ("duplicate_uniqueid", "ERROR", "uniqueid", "CASE WHEN trim(uniqueid) <> '' THEN uniqueid END", 1),
    ("duplicate_screening_id", "WARNING", "screening_id", "CASE WHEN trim(screening_id) <> '' THEN screening_id END", 1),
    ("duplicate_subjid", "ERROR", "subjid", "subject", 1),
    ("duplicate_phone", "WARNING", "mobile_number", "phone", 1),
    ("excessive_daily_interviews", "WARNING", "interviewer_id", "interviewer_id || strftime(start, '%Y%m%d')", 25),
]
_FIRST_ROWS = "'rows ' || array_to_string(list_sort(list(row_id))[1:5], ', ') AS detail"


def _counted(key: str, most: int) -> str:
    return f"(SELECT *, count(*) OVER (PARTITION BY country, site, key_) AS n_ FROM (SELECT *, {key} AS key_ FROM prepared) WHERE key_ IS NOT NULL QUALIFY n_ > {most})"


def _part(code: str, severity: str, field: str, source: str) -> str:
    return f"SELECT '{code}' AS \"check\", '{severity}' AS severity, country, site, '{field}' AS field, count(*) AS record_count, {_FIRST_ROWS}, {_IDS} FROM {source} GROUP BY country, site"


def _long(code: str, severity: str, field: str, source: str) -> str:
    return f"SELECT '{code}' AS \"check\", '{severity}' AS severity, '{field}' AS field, country, site, row_id, subject, screening_text, tablet FROM {source}"


def _each(form, code: str | None = None) -> list[str]:
    rows = [form(c, s, f, f"prepared WHERE {p}") for c, s, f, p in _ROW_CHECKS if code in (None, c)]
    return rows + [form(c, s, f, _counted(k, most)) for c, s, f, k, most in _COUNT_CHECKS if code in (None, c)]


_NONE = "'' AS detail, '' AS affected_subjids, '' AS affected_tablets"
MISSING = f"SELECT 'missing_column' AS \"check\", 'ERROR' AS severity, country, site, 'health_facility' AS field, count(*) AS record_count, {_NONE} FROM prepared GROUP BY country, site"
NAMES = f"SELECT 'duplicate_name' AS \"check\", 'WARNING' AS severity, country, site, 'participants_name' AS field, count(*) AS record_count, name AS detail, {_IDS} FROM prepared WHERE name IS NOT NULL GROUP BY country, site, name HAVING count(*) > 1 AND count(DISTINCT born) <= 1"
_PHONES = "ph AS (SELECT country, site, phone, count(*) AS n FROM prepared WHERE phone IS NOT NULL GROUP BY ALL), pp AS (SELECT a.country, a.site, a.phone AS pa, b.phone AS pb, a.n AS na, b.n AS nb, a.n * b.n AS n FROM ph a JOIN ph b ON a.country = b.country AND a.site = b.site AND a.phone < b.phone AND length(a.phone) = length(b.phone) AND hamming(a.phone, b.phone) = 1), hit AS (SELECT DISTINCT country, site, unnest([pa, pb]) AS phone FROM pp)"
PHONES = f"SELECT 'similar_phone' AS \"check\", 'WARNING' AS severity, country, site, 'mobile_number' AS field, record_count, detail, affected_subjids, affected_tablets FROM (SELECT country, site, CAST(sum(n) AS BIGINT) AS record_count, array_to_string(list_sort(list(pa || ' / ' || pb))[1:5], '; ') AS detail FROM pp GROUP BY ALL) JOIN (SELECT country, site, {_IDS} FROM prepared SEMI JOIN hit USING (country, site, phone) GROUP BY ALL) USING (country, site)"
_LCS = "list_reduce(range(1, length(na) + 1), lambda row_, i: list_reduce(range(1, length(nb) + 1), lambda new_, j: list_append(new_, CASE WHEN nb[j] = na[i] THEN row_[j] + 1 ELSE greatest(row_[j + 1], new_[j]) END), [0::BIGINT]), list_transform(range(0, length(nb) + 1), lambda z: 0::BIGINT))[-1]"
NAME_PAIRS = f"nm AS (SELECT DISTINCT country, site, born, name FROM prepared WHERE name IS NOT NULL AND born IS NOT NULL), np AS (SELECT a.country, a.site, a.born, a.name AS na, b.name AS nb FROM nm a JOIN nm b ON a.country = b.country AND a.site = b.site AND a.born = b.born AND a.name < b.name), ns AS (SELECT *, 2.0::DOUBLE * {_LCS} / (length(na) + length(nb)) AS similarity FROM np)"
SIMILAR = "SELECT 'similar_name' AS \"check\", 'WARNING' AS severity, ns.country, ns.site, 'participants_name' AS field, 2 AS record_count, '''' || na || ''' / ''' || nb || ''' (' || printf('%.2f', similarity) || ')' AS detail, coalesce(nullif(array_to_string(list_sort(list_distinct([a.subject, b.subject])), '; '), ''), array_to_string(list_sort(list_distinct([nullif(a.screening_text, ''), nullif(b.screening_text, '')])), '; '), '') AS affected_subjids, array_to_string(list_sort(list_distinct([a.tablet, b.tablet])), ', ') AS affected_tablets, na AS name_a, nb AS name_b, a.row_id AS row_a, b.row_id AS row_b, similarity FROM ns JOIN prepared a ON a.country = ns.country AND a.site = ns.site AND a.born = ns.born AND a.name = na JOIN prepared b ON b.country = ns.country AND b.site = ns.site AND b.born = ns.born AND b.name = nb WHERE similarity >= 0.85 AND NOT coalesce(a.subject = b.subject, false)"
DEVICES = f"SELECT 'low_tablet_record_count' AS \"check\", 'WARNING' AS severity, country, site, '_source_db' AS field, CAST(sum(n) AS BIGINT) AS record_count, array_to_string(list_sort(list(device))[1:5], ', ') AS detail, '' AS affected_subjids, '' AS affected_tablets FROM (SELECT country, site, string_split(_source_db, '/')[-2] AS device, count(*) AS n FROM prepared GROUP BY ALL HAVING n <= 2) GROUP BY country, site"
_SPARSE_COLUMNS = ("row_id", "uniqueid", "subjid", "screening_id", "country", "countrycode", "tabletnum", "interviewer_id", "starttime", "stoptime", "dob", "respondants_age", "client_sex", "consent", "health_facility_ke", "health_facility_ug", "mobile_number", "participants_name", "next_appt_3m", "next_appt_6m", "remarks", "extracted_at")
SPARSE = " UNION ALL ".join(f"SELECT 'sparse_column' AS \"check\", 'WARNING' AS severity, country, site, '{c}' AS field, count(*) - count({c}) AS record_count, {_NONE} FROM prepared GROUP BY country, site HAVING count(*) - count({c}) > 0.5 * count(*)" for c in _SPARSE_COLUMNS)

_REPORT = ", ".join(["\"check\"", "severity", "country", "site", "field", "record_count", "detail", "affected_subjids", "affected_tablets"])
REPORT = f"{PREPARED}, {_PHONES}, {NAME_PAIRS}, report AS (" + " UNION ALL ".join([*_each(_part), MISSING, NAMES, PHONES, f"SELECT {_REPORT} FROM ({SIMILAR})", DEVICES, SPARSE]) + ")"


_IN_SITE = "h.country = p.country AND h.site = p.site"
LONG = f"{PREPARED}, {_PHONES}, {NAME_PAIRS}, long_ AS (" + " UNION ALL ".join([
    *_each(_long),
    _long("duplicate_name", "WARNING", "participants_name", f"prepared p WHERE EXISTS (SELECT 1 FROM ({NAMES}) h WHERE {_IN_SITE} AND h.detail = p.name)"),
    _long("similar_phone", "WARNING", "mobile_number", f"prepared p WHERE EXISTS (SELECT 1 FROM hit h WHERE {_IN_SITE} AND h.phone = p.phone)"),
    _long("similar_name", "WARNING", "participants_name", f"prepared p WHERE row_id IN (SELECT unnest([row_a, row_b]) FROM ({SIMILAR}))"),
    _long("low_tablet_record_count", "WARNING", "_source_db", "(SELECT *, count(*) OVER (PARTITION BY country, site, string_split(_source_db, '/')[-2]) AS n_ FROM prepared QUALIFY n_ <= 2)"),
]) + ")"


def check_sql(code: str) -> str:
    special = {"missing_column": MISSING, "duplicate_name": NAMES, "similar_phone": PHONES, "similar_name": SIMILAR, "low_tablet_record_count": DEVICES, "sparse_column": SPARSE}
    body = special.get(code) or " UNION ALL ".join(_each(_part, code))
    return f"WITH {PREPARED}, {_PHONES}, {NAME_PAIRS} {body}"


def _day(n: str) -> str:
    return _text(f"CAST({DAY} + CAST({n} AS INT) AS TIMESTAMP)")


PEOPLE = f"""{VISITS},
newest AS (SELECT subjid, CAST(substr(subjid, 2) AS BIGINT) AS u, countrycode, mobile_number, health_facility_ug FROM visits WHERE starts_with(subjid, 'S')
           QUALIFY row_number() OVER (PARTITION BY subjid ORDER BY extracted_at DESC, row_id DESC) = 1),
people AS (SELECT subjid, countrycode, mobile_number, health_facility_ug,
  CASE WHEN u % 31 <> 0 THEN ({_list(ARM_TEXTS)})[u % 9 + 1] END AS arm_text, ({_list(LANGUAGE_TEXTS)})[u % 4 + 1] AS preferred_language_text,
  CASE WHEN u % 17 = 0 THEN NULL WHEN u % 19 = 0 THEN '00/00/0000 00:00:00' ELSE {_day("u % 14 - 7")} END AS sms_schedule_8weeks,
  CASE WHEN u % 23 = 0 THEN NULL ELSE {_day("u % 14 - 28")} END AS sms_schedule_11weeks,
  CASE WHEN u % 13 = 0 THEN '00/00/0000 00:00:00' ELSE {_day("u % 30 + 5")} END AS dflt_appt_arm_schd_appt_date FROM newest)"""


def _candidate(week: int) -> str:
    c, appt = f"sms_schedule_{week}weeks", "dflt_appt_arm_schd_appt_date"
    return f"SELECT subjid, mobile_number, arm_text, preferred_language_text AS language, {week} AS week, CAST({_stamp(c)} AS DATE) AS scheduled_date, CASE WHEN left({appt}, 2) <> '00' THEN CAST({_stamp(appt)} AS DATE) END AS appointment_date FROM people WHERE countrycode = '1' AND {c} IS NOT NULL AND left({c}, 2) <> '00' AND mobile_number IS NOT NULL AND arm_text NOT IN ('Control (SOC)', 'Incentive')"


QUEUE = f"""{PEOPLE}, candidates AS ({_candidate(8)} UNION ALL {_candidate(11)}),
opt_outs AS (SELECT subjid FROM people WHERE CAST(substr(subjid, 2) AS BIGINT) % 29 = 0),
queue AS (SELECT *, subjid || '-' || week AS queue_id, subjid IN (SELECT subjid FROM opt_outs) AS opted_out, 'pending' AS status FROM candidates),
tries AS (SELECT *, CAST(substr(subjid, 2) AS BIGINT) AS u, unnest(range(1, CAST(substr(subjid, 2) AS BIGINT) % 3 + 1)) AS attempt FROM queue),
log AS (SELECT queue_id || '/' || attempt AS log_id, queue_id, subjid, mobile_number, week, attempt, scheduled_date,
  CASE WHEN (u + attempt) % 4 <> 0 THEN 'sent' ELSE 'failed' END AS status, CASE WHEN (u + attempt) % 4 <> 0 THEN 'P' || queue_id || attempt END AS provider_message_id,
  CASE WHEN (u + attempt) % 4 <> 0 THEN CASE (u + week + attempt) % 5 WHEN 0 THEN 'DELIVERED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'NOT_FOUND' END END AS delivery_status,
  CASE WHEN (u + attempt) % 4 <> 0 THEN CAST(scheduled_date AS TIMESTAMP) + to_minutes(attempt * 60 + u % 60) END AS sent_at,
  CASE WHEN (u + attempt) % 4 = 0 THEN 'error ' || (u % 7) END AS error_message FROM tries),
sent_queue AS (SELECT queue.* EXCLUDE (status), coalesce(l.status, queue.status) AS status FROM queue LEFT JOIN (SELECT queue_id, max(status) AS status FROM log GROUP BY queue_id) l USING (queue_id)),
receipts AS (SELECT provider_message_id, CASE (CAST(substr(subjid, 2) AS BIGINT) + week) % 6 WHEN 0 THEN 'DELIVERED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'NOT_FOUND' WHEN 3 THEN 'PENDING' WHEN 4 THEN 'QUEUED' END AS receipt FROM log WHERE provider_message_id IS NOT NULL),
due AS (SELECT queue_id, subjid, mobile_number, arm_text, language, week, appointment_date FROM queue q WHERE scheduled_date = {DAY} AND status = 'pending' AND NOT opted_out AND NOT EXISTS (SELECT 1 FROM log l WHERE l.subjid = q.subjid AND l.week = q.week AND l.status = 'sent')),
outcomes AS (SELECT queue_id, CASE WHEN u % 5 = 0 THEN 'failed' WHEN u % 7 = 0 THEN 'skipped' ELSE 'sent' END AS outcome FROM (SELECT queue_id, CAST(substr(subjid, 2) AS BIGINT) AS u FROM queue))"""

_ARMS = "CASE lower(arm_text) " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in codes.ARMS.items()) + " ELSE arm_text END"
_LANGS = "CASE lower(language) " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in codes.LANGUAGES.items()) + " ELSE language END"
_TEMPLATES = """arms AS (SELECT unnest(['Community benefits', 'Education-based 1', 'HIV Risk Assessment', 'Social Norms', 'U=U Messaging', '"Reserved for you" Messaging']) AS arm),
langs AS (SELECT unnest(['English', 'Luganda', 'Runyankole']) AS language), weeks AS (SELECT unnest([8, 11]) AS week),
templates AS (SELECT arm, language, week, language || ' ' || arm || ' week ' || week || CASE WHEN week = 11 THEN ' on [date here]' ELSE '' END AS message_text, week = 11 AS has_placeholder
  FROM arms, langs, weeks WHERE NOT (arm = 'Social Norms' AND week = 8))"""
MESSAGES = f"{QUEUE}, {_TEMPLATES}, canonical AS (SELECT *, {_ARMS} AS arm, {_LANGS} AS template_language FROM queue), resolved AS (SELECT c.*, message_text, has_placeholder FROM canonical c LEFT JOIN templates t ON t.arm = c.arm AND t.language = c.template_language AND t.week = c.week), rendered AS (SELECT queue_id, subjid, week, CASE WHEN has_placeholder AND appointment_date IS NOT NULL THEN regexp_replace(message_text, '\\[.*?\\]', strftime(appointment_date, '%d/%m/%Y'), 'g') ELSE message_text END AS message, CASE WHEN message_text IS NULL THEN 'skipped' ELSE 'ready' END AS outcome FROM resolved)"

_ROWS = "joined AS (SELECT l.*, q.status AS queue_status, q.arm_text, q.language, q.mobile_number AS queue_number, p.health_facility_ug FROM log l JOIN sent_queue q USING (queue_id) JOIN people p ON p.subjid = l.subjid WHERE p.countrycode = '1')"


def _report(sent: str, due: str) -> str:
    return f"""{QUEUE}, {_ROWS}, reached AS (SELECT * FROM joined WHERE status = 'sent' AND {sent} QUALIFY row_number() OVER (PARTITION BY queue_id ORDER BY sent_at DESC, log_id DESC) = 1),
sc AS (SELECT health_facility_ug, week, count(*) AS submitted, count(*) FILTER (delivery_status = 'DELIVERED') AS delivered, count(*) FILTER (delivery_status IN ('FAILED', 'NOT_FOUND')) AS undelivered, count(*) FILTER (delivery_status IS NULL) AS pending FROM reached GROUP BY ALL),
dc AS (SELECT health_facility_ug, week, count(*) AS due FROM queue q JOIN people p ON p.subjid = q.subjid WHERE p.countrycode = '1' AND {due} GROUP BY ALL),
counts AS (SELECT health_facility_ug, week, coalesce(due, 0) AS due, submitted, delivered, undelivered, pending FROM sc LEFT JOIN dc USING (health_facility_ug, week))"""


WEEKLY = _report("sent_at >= DATE '2001-06-20' AND sent_at < DATE '2001-06-28'", "scheduled_date BETWEEN DATE '2001-06-20' AND DATE '2001-06-27'")
CUMULATIVE = _report("true", f"scheduled_date <= {DAY}")
_METRICS = " UNION ALL ".join(f"SELECT health_facility_ug AS site, week, '{m}' AS metric, {m} AS n, {d} AS d FROM c2" for m, d in (("due", "NULL"), ("submitted", "due"), ("delivered", "submitted"), ("undelivered", "submitted"), ("pending", "submitted")))
_PATHS = """paths AS (SELECT event_id AS last_modified, event_id % 3 = 0 AS loaded, 'Tablet' || (user_id % 500) || '_' || strftime(ts, '%Y_%m_%d-%H_%M_%S') AS nm, user_id % 500 AS dev, ts, event_id FROM events),
files AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN '/in/' || nm || '/DataBackup/pilot.mdb' WHEN event_id % 13 = 0 THEN '/in/other/' || dev || '.mdb' ELSE '/in/' || nm || '/pilot.mdb' END AS file_path, nm || CASE WHEN event_id % 7 = 0 THEN '.txt' ELSE '.7z' END AS archive FROM paths)"""
_TYPES = """types AS (SELECT 'file' || k AS file, 'c' || i AS "column", CASE WHEN i = 3 THEN CASE WHEN k % 2 = 0 THEN 'int64' ELSE 'float64' END WHEN i = 4 THEN 'object' WHEN i = 5 AND k % 100 = 1 THEN 'object' WHEN i < 5 THEN 'int64' ELSE 'float64' END AS dtype
  FROM (SELECT p_partkey AS k, unnest(range(0, 10)) AS i FROM part) WHERE k % 10 <> i OR k % 7 = 0)"""

ORACLE_SQL: dict[str, str] = {
    "country_filter": f"WITH {SILVER} SELECT * FROM valid",
    "dedup_exact": f"WITH {SILVER} SELECT * FROM distinct_rows",
    "dedup_latest": f"WITH {LANDED}, once AS (SELECT * EXCLUDE (_source_db), min(_source_db) AS _source_db FROM landed GROUP BY ALL) SELECT * FROM once WHERE uniqueid IS NULL OR trim(uniqueid) = '' UNION ALL SELECT * FROM once WHERE trim(uniqueid) <> '' QUALIFY row_number() OVER (PARTITION BY country, uniqueid ORDER BY extracted_at DESC NULLS LAST, row_id DESC) = 1",
    "silver_build": f"WITH {SILVER} SELECT * FROM silver",
    "cleaning_audit": f"WITH {SILVER} SELECT country, n_rows, n_rows - v AS wrong_code, v - d AS exact_copies, d - l AS older_rows FROM (SELECT country, count(*) AS n_rows FROM landed GROUP BY 1) JOIN (SELECT country, count(*) AS v FROM valid GROUP BY 1) USING (country) JOIN (SELECT country, count(*) AS d FROM distinct_rows GROUP BY 1) USING (country) JOIN (SELECT country, count(*) AS l FROM latest GROUP BY 1) USING (country)",
    "gold_baseline": f"WITH {SILVER} SELECT * EXCLUDE (extracted_at) FROM silver WHERE uniqueid IS NOT NULL",
    "enrollment_mart": f"WITH {SILVER} SELECT uniqueid, subjid, screening_id, countrycode, tabletnum, CAST(NULL AS VARCHAR) AS health_facility, consent, CAST(NULL AS VARCHAR) AS vdate, starttime, stoptime, interviewer_id FROM silver WHERE TRY_CAST(consent AS INT) = 1 AND subjid IS NOT NULL",
    "qc_summary": f"WITH {SILVER} SELECT countrycode, tabletnum, count(*) AS total_records, count(*) FILTER (TRY_CAST(consent AS INT) = 1) AS consented, count(*) FILTER (subjid IS NOT NULL AND TRY_CAST(consent AS INT) = 1) AS enrolled, count(*) FILTER (uniqueid IS NULL) AS missing_uniqueid, count(*) FILTER (screening_id IS NULL) AS missing_screening_id, count(*) FILTER (mobile_number IS NULL AND TRY_CAST(consent AS INT) = 1) AS missing_phone_consented FROM silver GROUP BY ALL",
    "decode_codes": f"WITH {VISITS} SELECT row_id, {_label('health_facility_ke', 'kenya')} AS facility_ke, {_label('health_facility_ug', 'uganda')} AS facility_ug FROM visits",
    "coerce_types": f"WITH {VISITS} SELECT row_id, {_stamp('starttime')} AS starttime, {_stamp('dob')} AS dob, {_num('respondants_age')} AS respondants_age FROM visits",
    "union_by_name": f"WITH {VISITS} SELECT row_id, country, consent FROM visits WHERE country = 'kenya' UNION ALL BY NAME SELECT row_id, country, dob FROM visits WHERE country = 'uganda'",
    "align_schema": f"WITH {VISITS} SELECT uniqueid, CAST(NULL AS VARCHAR) AS vdate, subjid FROM visits",
    "site_groups": f"WITH {PREPARED} SELECT country, site, count(*) AS n FROM prepared GROUP BY ALL",
    "affected_ids": f"WITH {PREPARED} SELECT country, site, {_IDS} FROM prepared GROUP BY ALL",
    "issue_rows": f"WITH {LONG} SELECT * FROM long_",
    "similar_phone_pairs": f"WITH {PREPARED}, {_PHONES} SELECT country, site, pa AS phone_a, pb AS phone_b, na AS n_a, nb AS n_b FROM pp",
    "issue_examples": f"WITH {LONG} SELECT * FROM (SELECT \"check\", country, site, field, row_number() OVER (PARTITION BY \"check\", field, country, site ORDER BY row_id) AS place, row_id FROM long_) WHERE place <= 5",
    "report_window": "SELECT day, tuesday - 6 AS week_start, tuesday + 1 AS week_end, tuesday + 2 AS sent_end FROM (SELECT day, day - CAST((isodow(day) + 5) % 7 AS INT) AS tuesday FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events))",
    **{code: check_sql(code) for code in [*dict.fromkeys(c[0] for c in [*_ROW_CHECKS, *_COUNT_CHECKS]), "missing_column", "duplicate_name", "similar_phone", "similar_name", "low_tablet_record_count", "sparse_column"]},
    "quality_report": f"WITH {REPORT} SELECT * FROM report",
    "validation_summary": f"WITH {REPORT} SELECT severity, country, site, \"check\", count(*) AS issues FROM report GROUP BY ALL",
    "severity_totals": f"WITH {REPORT} SELECT count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings, count(*) > 0 AS any_issue, count(*) FILTER (severity = 'ERROR') > 0 AS any_failure FROM report",
    "report_country_filter": f"WITH {REPORT} SELECT * FROM report WHERE lower(country) = 'uganda'",
    "report_with_source_errors": f"WITH {REPORT}, {_PATHS} SELECT 'corrupt_archive' AS \"check\", 'ERROR' AS severity, 'kenya' AS country, '' AS site, archive AS field, 1 AS record_count, {_NONE} FROM files WHERE archive LIKE '%.txt' UNION ALL SELECT * FROM report",
    "latest_snapshot_per_device": f"WITH {_PATHS} SELECT 'Tablet' || dev AS device, file_path FROM files WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND dev <> 7 AND NOT ends_with(file_path, '/3.mdb') QUALIFY row_number() OVER (PARTITION BY dev ORDER BY date_trunc('second', ts) DESC, file_path DESC) = 1",
    "latest_archive_per_device": f"WITH {_PATHS} SELECT 'Tablet' || dev AS device, archive FROM files WHERE event_id % 7 <> 0 QUALIFY row_number() OVER (PARTITION BY dev ORDER BY date_trunc('second', ts) DESC, archive DESC) = 1",
    "incremental_new_files": f"WITH {_PATHS}, ledger AS (SELECT file_path, last_modified - CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS last_modified FROM files WHERE loaded AND event_id % 5 <> 0) SELECT file_path, last_modified FROM files f WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.file_path = f.file_path AND l.last_modified = f.last_modified)",
    "schema_missing_columns": f"WITH {_TYPES}, s AS (SELECT file, list_sort(list(\"column\")) AS cols, count(*) AS n_columns FROM types GROUP BY file), w AS (SELECT cols AS all_ FROM s ORDER BY n_columns DESC, cols DESC LIMIT 1) SELECT file, n_columns, array_to_string(list_filter(all_, lambda c: NOT list_contains(cols, c)), ', ') AS missing FROM s, w WHERE len(list_filter(all_, lambda c: NOT list_contains(cols, c))) > 0",
    "schema_type_conflicts": f"WITH {_TYPES} SELECT \"column\", string_agg(DISTINCT dtype, ', ' ORDER BY dtype) AS dtypes FROM types GROUP BY 1 HAVING count(DISTINCT dtype) > 1 AND count(*) FILTER (dtype NOT IN ('int64', 'float64')) > 0",
    "csv_safe_export": "SELECT p_partkey, CASE WHEN regexp_matches(t, '^[=+@\\t\\r-]') THEN '''' || t ELSE t END AS text FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '=' WHEN 1 THEN '-' WHEN 2 THEN '@' ELSE '' END || p_name AS t FROM part)",
    "templates_long": "WITH s AS (SELECT ' arm  ' || p_partkey || ' ' AS arm, 'English' AS language, '  a   b ' || p_name AS w8, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name || ' [date] ' END AS w11 FROM part) SELECT trim(arm) AS arm, language, 8 AS week, trim(regexp_replace(w8, '[ \\t]+', ' ', 'g')) AS message_text, false AS has_placeholder FROM s UNION ALL SELECT trim(arm), language, 11, trim(regexp_replace(w11, '[ \\t]+', ' ', 'g')), true FROM s WHERE w11 IS NOT NULL",
    "snapshot_status": f"WITH {VISITS} SELECT n AS source_rows, m AS stored_rows, CASE WHEN m = 0 THEN 'new' WHEN m = n THEN 'skip' ELSE 'redo' END AS action FROM (SELECT count(*) AS n, unnest([count(*), count(*) FILTER (row_id % 2 = 0), 0]) AS m FROM visits)",
    "queue_candidates": f"WITH {QUEUE} SELECT * FROM candidates",
    "queue_sync": f"WITH {QUEUE} SELECT * FROM queue",
    "apply_opt_outs": f"WITH {QUEUE} SELECT queue_id, opted_out FROM queue",
    "due_messages": f"WITH {QUEUE} SELECT * FROM due",
    "canonical_values": f"WITH {MESSAGES} SELECT queue_id, arm, template_language FROM canonical",
    "resolve_templates": f"WITH {MESSAGES} SELECT queue_id, message_text, has_placeholder FROM resolved",
    "render_messages": f"WITH {MESSAGES} SELECT * FROM rendered",
    "attempt_log": f"WITH {MESSAGES} SELECT queue_id, subjid, week, message AS message_text, 1 AS attempt, o.outcome AS status, CASE WHEN o.outcome = 'sent' THEN 'N' || queue_id END AS provider_message_id, CASE WHEN o.outcome = 'sent' THEN TIMESTAMP '2001-06-30 08:00:00' END AS sent_at FROM rendered r JOIN outcomes o USING (queue_id) WHERE r.outcome = 'ready' AND o.outcome <> 'skipped'",
    "queue_transition": f"WITH {QUEUE} SELECT queue_id, outcome AS status FROM queue JOIN outcomes USING (queue_id)",
    "campaign_outcome": f"WITH {QUEUE} SELECT count(*) FILTER (outcome = 'sent') AS sent, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped FROM outcomes",
    "receipt_candidates": f"WITH {QUEUE} SELECT log_id, queue_id, subjid, provider_message_id FROM log WHERE status = 'sent' AND provider_message_id IS NOT NULL AND delivery_status IS NULL",
    "apply_receipts": f"WITH {QUEUE} SELECT log_id, coalesce(delivery_status, CASE WHEN receipt IN ('DELIVERED', 'FAILED', 'NOT_FOUND') THEN receipt END) AS delivery_status FROM log LEFT JOIN receipts USING (provider_message_id)",
    "receipt_outcome": f"WITH {QUEUE}, c AS (SELECT receipt FROM log JOIN receipts USING (provider_message_id) WHERE delivery_status IS NULL) SELECT count(*) AS checked, count(*) FILTER (receipt IN ('DELIVERED', 'FAILED', 'NOT_FOUND')) AS updated, count(*) FILTER (receipt IN ('PENDING', 'QUEUED')) AS pending, count(*) FILTER (receipt IS NULL) AS errors, count(*) > 0 AND count(receipt) = 0 AS run_failed FROM c",
    "template_upsert": f"WITH {_TEMPLATES} SELECT arm, language, week, CASE WHEN week = 8 THEN upper(message_text) ELSE message_text END AS message_text, has_placeholder FROM templates UNION ALL SELECT 'p' || p_partkey, 'English', 8, p_name, false FROM part",
    "retry_failed": f"WITH {QUEUE} SELECT queue_id, CASE WHEN status = 'failed' AND CAST(substr(subjid, 2) AS BIGINT) % 2 = 0 THEN 'pending' ELSE status END AS status FROM sent_queue",
    "constraint_violations": f"WITH {QUEUE} SELECT 'queue status' AS rule, queue_id AS \"key\", 1 AS \"rows\" FROM queue WHERE week = 8 AND CAST(substr(subjid, 2) AS BIGINT) % 10 = 3 UNION ALL SELECT 'log status', log_id, 1 FROM log WHERE attempt = 2",
    "message_status": f"WITH {QUEUE} SELECT q.queue_id, q.subjid, q.mobile_number, q.week, q.arm_text, q.language, p.health_facility_ug, q.status AS queue_status, q.scheduled_date, t.sent_at, t.provider_message_id, d.s AS delivery_status, coalesce(d.n, 0) AS attempts FROM sent_queue q JOIN people p ON p.subjid = q.subjid LEFT JOIN (SELECT queue_id, count(*) AS n, coalesce(max(delivery_status) FILTER (delivery_status = 'DELIVERED'), max(delivery_status) FILTER (delivery_status = 'FAILED'), max(delivery_status) FILTER (delivery_status = 'NOT_FOUND')) AS s FROM log GROUP BY 1) d USING (queue_id) LEFT JOIN (SELECT queue_id, sent_at, provider_message_id FROM log WHERE status = 'sent' QUALIFY row_number() OVER (PARTITION BY queue_id ORDER BY sent_at DESC) = 1) t USING (queue_id)",
    "flagged_messages": f"WITH {QUEUE}, {_ROWS} SELECT subjid, health_facility_ug, week, max(error_message) AS last_error FROM joined WHERE queue_status = 'failed' AND provider_message_id IS NULL GROUP BY ALL",
    "latest_attempt": f"WITH {CUMULATIVE} SELECT queue_id, health_facility_ug, week, sent_at, delivery_status FROM reached",
    "weekly_report": f"WITH {WEEKLY} SELECT * FROM counts",
    "cumulative_report": f"WITH {CUMULATIVE} SELECT * FROM counts",
    "weekly_pivot": f"WITH {CUMULATIVE}, c2 AS (SELECT * FROM counts), m AS ({_METRICS}) SELECT week, metric, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (site = '{s}'), 0) AS BIGINT) AS site_{s}" for s in ("11", "12", "13", "14")) + ", CAST(coalesce(sum(n) FILTER (site IN ('11', '12', '13', '14')), 0) AS BIGINT) AS total FROM m GROUP BY ALL",
    "weekly_percent": f"WITH {CUMULATIVE}, c2 AS (SELECT * FROM counts UNION ALL SELECT 'total', week, sum(due), sum(submitted), sum(delivered), sum(undelivered), sum(pending) FROM counts GROUP BY week), m AS ({_METRICS}) SELECT week, metric, site, CAST(n AS BIGINT) AS n, CASE WHEN d > 0 THEN round(100.0::DOUBLE * n / d, 6) END AS pct FROM m",
    "delivery_linelist": f"WITH {QUEUE}, {_ROWS} SELECT subjid, health_facility_ug AS site_code, week, arm_text, language, queue_number AS mobile_number, scheduled_date, sent_at + INTERVAL 3 HOUR AS sent_at_local, coalesce(delivery_status, 'Pending') AS delivery_status FROM joined WHERE status = 'sent'",
    "messages_sent": f"WITH {QUEUE} SELECT log_id, l.subjid, l.mobile_number, l.week, q.arm_text, q.language, sent_at, error_message, delivery_status FROM log l JOIN queue q USING (queue_id) WHERE l.status = 'sent'",
    "messages_failed": f"WITH {QUEUE} SELECT log_id, l.subjid, l.mobile_number, l.week, q.arm_text, q.language, sent_at, error_message, delivery_status FROM log l JOIN queue q USING (queue_id) WHERE l.status = 'failed'",
    "queue_status_counts": f"WITH {QUEUE} SELECT status, count(*) AS n FROM sent_queue GROUP BY 1",
    "delivery_status_week": f"WITH {QUEUE} SELECT delivery_status, count(*) AS n FROM log WHERE status = 'sent' AND sent_at >= date_trunc('week', {DAY}) GROUP BY 1",
    "resend_lists": f"WITH {QUEUE}, {_ROWS} SELECT week, string_agg(subjid, ', ' ORDER BY subjid) AS subjids FROM (SELECT DISTINCT subjid, health_facility_ug, week FROM joined WHERE queue_status = 'failed' AND provider_message_id IS NULL) GROUP BY week",
}
