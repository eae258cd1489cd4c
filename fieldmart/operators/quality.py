"""Thirty-five quality checks of survey rows, as one plan for all countries and sites.

``prepared`` parses every column once. Most checks are a predicate on a prepared row or a count within (country, site, key).
``report`` explodes the true flags of a row to long form, so that only flagged rows are shuffled, and unions the checks
on groups, pairs, devices and columns. A check whose column is absent is skipped, but for the missing column itself.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart import codes
from fieldmart.functions import parse, similarity
from fieldmart.operators.ordering import id_parts
from fieldmart.session import stored, tasks_import_here

SCOPE = ("country", "site")
REPORT = ("check", "severity", "country", "site", "field", "record_count", "detail", "affected_subjids", "affected_tablets")
SIMILAR = 0.85
#: Examples of an issue that its detail names.
EXAMPLES = 5


def _known_facilities(country: str) -> str:
    return ", ".join(str(c) for c in [*codes.FACILITIES[country], codes.SKIPPED])


#: code -> severity, field, columns it needs, predicate on prepared columns (SQL)
_FILLED = "{0} is null or trim({0}) = ''"
ROW_CHECKS: list[tuple[str, str, str, tuple[str, ...], str]] = [
    *[("missing_required_value", "ERROR", c, (c,), _FILLED.format(c)) for c in codes.REQUIRED],
    ("invalid_age", "ERROR", "respondants_age", ("respondants_age",), "n_age is not null and not (n_age between 10 and 110 or n_age in (-7, -9))"),
    ("cross_country_facility", "WARNING", "health_facility_ug", ("health_facility_ug",), "n_code = 2 and n_fac_ug <> -9"),
    ("cross_country_facility", "WARNING", "health_facility_ke", ("health_facility_ke",), "n_code = 1 and n_fac_ke <> -9"),
    ("invalid_facility_code", "ERROR", "health_facility_ke", ("health_facility_ke",), f"n_code = {codes.COUNTRY_CODES['kenya']} and n_fac_ke not in ({_known_facilities('kenya')})"),
    ("invalid_facility_code", "ERROR", "health_facility_ug", ("health_facility_ug",), f"n_code = {codes.COUNTRY_CODES['uganda']} and n_fac_ug not in ({_known_facilities('uganda')})"),
    ("consented_without_subjid", "ERROR", "subjid", ("consent", "subjid"), "n_consent = 1 and (subjid is null or trim(subjid) = '' or lower(trim(subjid)) = 'nan')"),
    ("missing_interviewer_id", "WARNING", "interviewer_id", ("interviewer_id",), "interviewer_id is null"),
    ("countrycode_mismatch", "ERROR", "countrycode", ("countrycode",), "n_code <> expected_code"),
    ("impossible_duration", "ERROR", "stoptime", ("starttime", "stoptime"), "minutes < 0"),
    ("duration_too_short", "WARNING", "stoptime", ("starttime", "stoptime"), "minutes >= 0 and minutes < 8 and subject is not null"),
    ("duration_too_long", "WARNING", "stoptime", ("starttime", "stoptime"), "minutes > 30"),
    ("future_dob", "ERROR", "dob", ("dob",), "born > as_of"),
    ("dob_eligibility", "ERROR", "dob", ("dob",), "born <= as_of and (years < 10 or years > 110)"),
    ("dob_age_mismatch", "WARNING", "dob", ("dob", "respondants_age"), "born <= as_of and n_age not in (-7, -9) and abs(years - n_age) > 2"),
    ("future_visit_date", "ERROR", "starttime", ("starttime",), "visit_date > as_of"),
    ("stale_visit_date", "WARNING", "starttime", ("starttime",), "visit_date < year_ago"),
    ("appointment_before_visit", "ERROR", "next_appt_3m", ("starttime", "next_appt_3m"), "appt_3m < start"),
    ("appointment_before_visit", "ERROR", "next_appt_6m", ("starttime", "next_appt_6m"), "appt_6m < start"),
    ("appointment_interval_unexpected", "WARNING", "next_appt_3m", ("starttime", "next_appt_3m"), "appt_3m >= start and not (days_3m between 60 and 120)"),
    ("appointment_interval_unexpected", "WARNING", "next_appt_6m", ("starttime", "next_appt_6m"), "appt_6m >= start and not (days_6m between 150 and 210)"),
    ("invalid_consent_code", "ERROR", "consent", ("consent",), "n_consent not in (0, 1, -9)"),
    ("non_consented_with_subjid", "ERROR", "subjid", ("consent", "subjid"), "n_consent = 0 and trim(subjid) <> '' and lower(trim(subjid)) <> 'nan'"),
    ("invalid_sex_code", "ERROR", "client_sex", ("client_sex",), "n_sex not in (1, 2, -9)"),
    ("missing_sex_for_consented", "WARNING", "client_sex", ("client_sex", "consent"), "n_consent = 1 and (n_sex is null or n_sex = -9)"),
    ("unusual_interview_hour", "WARNING", "starttime", ("starttime", "interviewer_id"), "start_hour between 0 and 4"),
    ("invalid_screening_id_format", "ERROR", "screening_id", ("screening_id",), "screening_text <> '' and screening_bad"),
    ("screening_id_country_mismatch", "ERROR", "screening_id", ("screening_id",), "screening_text <> '' and not screening_fits"),
]
#: code -> severity, field, columns it needs, key (SQL), most rows that a key may have in its country and site
COUNT_CHECKS: list[tuple[str, str, str, tuple[str, ...], str, int]] = [
    ("duplicate_uniqueid", "ERROR", "uniqueid", ("uniqueid",), "case when trim(uniqueid) <> '' then uniqueid end", 1),
    ("duplicate_screening_id", "WARNING", "screening_id", ("screening_id",), "case when trim(screening_id) <> '' then screening_id end", 1),
    ("duplicate_subjid", "ERROR", "subjid", ("subjid",), "subject", 1),
    ("duplicate_phone", "WARNING", "mobile_number", ("mobile_number",), "phone", 1),
    ("excessive_daily_interviews", "WARNING", "interviewer_id", ("interviewer_id", "starttime"), "concat(interviewer_id, ' ', cast(visit_date as string))", 25),
]
_TEXT = ("row_id", "uniqueid", "subjid", "screening_id", "country", "countrycode", "tabletnum", "interviewer_id", "starttime", "stoptime", "dob", "respondants_age", "client_sex", "consent", "health_facility", "health_facility_ke", "health_facility_ug", "mobile_number", "participants_name", "next_appt_3m", "next_appt_6m")


def site(country: Column, columns: list[str], numbers: dict[str, str] | None = None) -> Column:
    """The decoded facility of the country's own column; '(Unknown facility)' without a code, '' without such a column. numbers: columns that have the codes parsed."""
    out = F.lit("")
    for name, column in codes.FACILITY_COLUMNS.items():
        if column in columns:
            number = F.col(numbers[column]) if numbers else parse.number(F.col(column))
            value = F.when(number.isNotNull(), parse.number_label(number, name)).otherwise("(Unknown facility)")
            out = F.when(country == name, value).otherwise(out)
    return out


def prepared(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """Every column that a check uses, parsed once. Absent columns are null; rows without a country belong to no report.

    The file that a row comes from is _source_db, or file_path where there is no such column.
    """
    have = [c for c in _TEXT if c in df.columns]
    source = next((c for c in ("_source_db", "file_path") if c in df.columns), None)
    text = df.filter("country is not null").select(*have, *([F.col(source).alias("_source_db")] if source else []))
    text = text.withColumns({c: F.lit(None).cast("string") for c in _TEXT if c not in have}).withColumn("country", F.lower("country"))
    fits = F.lit(None).cast("boolean")
    for name, prefix in codes.ID_PREFIXES.items():
        fits = F.when(F.col("country") == name, F.trim("screening_id").startswith(prefix)).otherwise(fits)
    expected = F.lit(None).cast("int")
    for name, code in codes.COUNTRY_CODES.items():
        expected = F.when(F.col("country") == name, F.lit(code)).otherwise(expected)
    num = lambda c: parse.number(F.col(c))
    out = text.withColumns({
        "expected_code": expected, "n_code": num("countrycode"), "n_age": num("respondants_age"), "n_sex": num("client_sex"), "n_consent": num("consent"),
        "n_fac_ke": num("health_facility_ke"), "n_fac_ug": num("health_facility_ug"), "subject": parse.known_id(F.col("subjid")), "tablet": F.nullif(parse.plain(F.col("tabletnum")), F.lit("")),
        "phone": F.when(F.coalesce(num("mobile_number") != codes.SKIPPED, F.lit(True)), parse.phone(F.col("mobile_number"))), "name": F.nullif(F.lower(F.trim("participants_name")), F.lit("")),
        "screening_text": F.trim("screening_id"), "screening_bad": ~F.trim("screening_id").rlike(r"^[A-Za-z0-9_\-]+$"), "screening_fits": fits,
        "start": parse.stamp(F.col("starttime")), "stop": parse.stamp(F.col("stoptime")), "born": parse.birth_date(F.col("dob"), as_of),
        "appt_3m": parse.stamp(F.col("next_appt_3m")), "appt_6m": parse.stamp(F.col("next_appt_6m")), "as_of": F.lit(as_of), "year_ago": F.add_months(F.lit(as_of), -12),
    })
    seconds = lambda a, b: F.unix_timestamp(b) - F.unix_timestamp(a)
    return out.withColumns({
        "site": site(F.col("country"), df.columns, {"health_facility_ke": "n_fac_ke", "health_facility_ug": "n_fac_ug"}),
        "minutes": seconds("start", "stop") / 60, "visit_date": F.to_date("start"), "start_hour": F.hour("start"), "years": F.datediff("as_of", "born") / 365.25,
        "days_3m": F.floor(seconds("start", "appt_3m") / 86400), "days_6m": F.floor(seconds("start", "appt_6m") / 86400),
    })


def ids() -> Column:
    """Distinct sorted subject ids of a group's rows, else screening ids, '; '-joined; '' if none.

    One cell for a whole group: for the report that people read. ``issue_rows`` has the same as rows, however many.
    """
    join = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(c)), "; "), F.lit(""))
    return F.coalesce(join("subject"), join(F.nullif(F.col("screening_text"), F.lit(""))), F.lit(""))


def tablets() -> Column:
    return F.array_join(F.array_sort(F.collect_set("tablet")), ", ")


_LONG = ("check", "severity", "field", *SCOPE, "row_id", "subject", "screening_text", "tablet")
_GROUP = ("check", "severity", *SCOPE, "field", "topic")
#: Parts of a group whose examples are cut before the group's own.
PARTS = 16


def _as_reported(df: DataFrame, topic: Column | None = None, weight: Column | None = None, example_id: Column | None = None, example: Column | None = None) -> DataFrame:
    """Long rows as the report adds them up: what is counted, which example it may give, and the ids it names."""
    null = lambda kind: F.lit(None).cast(kind)
    ids_ = [F.col(c) if c in df.columns else null("string").alias(c) for c in ("subject", "screening_text", "tablet")]
    own = {"topic": null("string") if topic is None else topic, "weight": (F.lit(1) if weight is None else weight).cast("long"), "example_id": null("long") if example_id is None else example_id.cast("long"), "example": null("string") if example is None else example}
    return df.select("check", "severity", *SCOPE, "field", *[v.alias(k) for k, v in own.items()], *ids_)


def _reported(long: DataFrame) -> DataFrame:
    """Report rows of long rows: count, ids and first examples of each group, by two sums; in the first a group is in parts, and keeps few examples."""
    part = F.pmod(F.xxhash64("example_id", "example"), F.lit(PARTS))
    least = lambda c: F.slice(F.array_sort(c), 1, EXAMPLES)
    # screening ids are named only where a group has no subject at all
    sets = {"s": F.col("subject"), "q": F.when(F.col("subject").isNull(), F.nullif(F.col("screening_text"), F.lit(""))), "t": F.col("tablet")}
    some = long.groupBy(*_GROUP, part.alias("part")).agg(F.sum("weight").alias("n"), *[F.collect_set(c).alias(k) for k, c in sets.items()], least(F.collect_list("example_id")).alias("i"), least(F.collect_set("example")).alias("e"))
    all_ = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    out = some.groupBy(*_GROUP).agg(F.sum("n").alias("record_count"), *[all_(k).alias(k) for k in sets], *[least(F.flatten(F.collect_list(c))).alias(c) for c in "ie"])
    text = lambda c, by: F.nullif(F.array_join(c, by), F.lit(""))
    named = F.when(F.col("check") == "similar_phone", text("e", "; ")).otherwise(text("e", ", "))
    detail = F.coalesce("topic", F.concat(F.lit("rows "), text("i", ", ")), named, F.lit(""))
    known = {"detail": detail, "affected_subjids": F.coalesce(text("s", "; "), text("q", "; "), F.lit("")), "affected_tablets": F.array_join("t", ", ")}
    return out.withColumns(known).select(*REPORT)


def _first(df: DataFrame, group: list[str], most: int = EXAMPLES) -> DataFrame:
    """The first rows of each group by row_id, with their ``place``. df is read twice.

    The least ids of 64 parts of a group are rows of it, so that none of its first rows is after the last of as many of them: what is after goes
    before anything is sorted. Groups are few.
    """
    spread = F.pmod(F.xxhash64("row_id"), F.lit(64))
    least = df.groupBy(*group, spread.alias("_part")).agg(F.min("row_id").alias("_least"))
    last = least.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(group)]).agg(F.get(F.array_sort(F.collect_list("_least")), F.lit(most - 1)).alias("_last"))
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(group)]
    df = df.join(F.broadcast(last), same).filter("_last is null or row_id <= _last").select(*df.columns)
    order = lambda *more: F.row_number().over(Window.partitionBy(*group, *more).orderBy("row_id"))
    part = df.withColumn("_part", F.pmod(F.xxhash64("row_id"), F.lit(64))).withColumn("_place", order("_part")).filter(F.col("_place") <= most)
    return part.drop("_part", "_place").withColumn("place", order()).filter(F.col("place") <= most)


def _flags(columns: list[str], only: str | None = None) -> list[Column]:
    """For each check of rows whose columns are there, its place in ROW_CHECKS where it is true."""
    return [F.when(F.expr(p), F.lit(i)) for i, (code, _, _, needs, p) in enumerate(ROW_CHECKS) if set(needs) <= set(columns) and only in (None, code)]


def judged(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """The rows parsed and judged once, and stored: what ids, keys, phones and names need, and the places of the true checks in ``flags``."""
    rows = prepared(df, as_of)
    kept = [c for c in ("row_id", *SCOPE, "subject", "screening_text", "tablet", "born", "phone", "name", "uniqueid", "screening_id", "interviewer_id", "visit_date", "_source_db") if c in rows.columns]
    return stored(rows.select(*kept, F.array_compact(F.array(*_flags(df.columns)).cast("array<int>")).alias("flags")), "prepared")


def row_issues(rows: DataFrame, columns: list[str], only: str | None = None) -> DataFrame:
    """A row for each true flag of each row: check, severity, field beside the prepared ids."""
    flags = _flags(columns, only)
    if not flags:
        return rows.limit(0).select(F.lit("").alias("check"), F.lit("").alias("severity"), F.lit("").alias("field"), *SCOPE, "row_id", "subject", "screening_text", "tablet")
    # the outer form: the filter that Spark infers from a plain explode would be pushed below and parse everything twice
    kinds = F.array(*[F.struct(F.lit(code).alias("check"), F.lit(sev).alias("severity"), F.lit(field).alias("field")) for code, sev, field, _, _ in ROW_CHECKS])
    known = F.col("flags") if "flags" in rows.columns else F.array_compact(F.array(*flags))
    long = rows.select(*SCOPE, "row_id", "subject", "screening_text", "tablet", F.explode_outer(known).alias("i")).filter("i is not null").withColumn("f", F.get(kinds, "i"))
    return long.select("f.*", *SCOPE, "row_id", "subject", "screening_text", "tablet")


def keyed_issues(rows: DataFrame, columns: list[str], only: str | None = None, most: int | None = None, few: int = 2) -> DataFrame:
    """Rows by what their key has in its country and site: more rows than a check allows, one name with one date of birth, or a device with few rows.

    All checks share one sum by key, and the rows of the keys found are joined, so that a key of very many rows is no task's own. Has
    ``key`` beside the columns of long rows.
    """
    kinds = [(code, severity, field, F.expr(key), limit if most is None else most, None) for code, severity, field, needs, key, limit in COUNT_CHECKS if set(needs) <= set(columns) and only in (None, code)]
    if only in (None, "duplicate_name"):
        kinds.append(("duplicate_name", "WARNING", "participants_name", F.col("name"), 1, None))
    if "_source_db" in rows.columns and only in (None, "low_tablet_record_count"):
        kinds.append(("low_tablet_record_count", "WARNING", "_source_db", _device(), 0, few))
    if not kinds:
        return row_issues(rows, []).withColumn("key", F.lit(""))
    of = lambda i, type_: F.get(F.array(*[F.lit(k[i]).cast(type_) for k in kinds]), F.col("kind"))
    own = ["row_id", "subject", "screening_text", "tablet"]
    long = rows.select(*SCOPE, *own, "born", F.posexplode_outer(F.array(*[k[3].cast("string") for k in kinds])).alias("kind", "key")).filter("key is not null")
    counts = long.groupBy("kind", *SCOPE, "key").agg(F.count("*").alias("n"), F.min("born").eqNullSafe(F.max("born")).alias("one"))
    kept = (F.col("n") > of(4, "long")) & F.coalesce(F.col("n") <= of(5, "long"), F.lit(True)) & ((of(0, "string") != "duplicate_name") | F.col("one"))
    # one number to shuffle and sort by; what it stands for is compared
    hashed = lambda df: df.withColumn("hash", F.xxhash64("kind", *SCOPE, "key"))
    a, b = hashed(long.drop("born")).alias("a"), hashed(counts.filter(kept).select("kind", *SCOPE, "key")).alias("b")
    found = a.join(b, reduce(Column.__and__, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("hash", "kind", *SCOPE, "key")]), "left_semi")
    return found.withColumns({"check": of(0, "string"), "severity": of(1, "string"), "field": of(2, "string")}).select(*_LONG, "key")


def _device() -> Column:
    return F.element_at(F.split("_source_db", "/"), -2)


def count_issues(rows: DataFrame, columns: list[str], only: str | None = None, most: int | None = None) -> DataFrame:
    """Rows whose key has more rows in its country and site than its check allows."""
    codes_ = [c[0] for c in COUNT_CHECKS]
    return keyed_issues(rows, columns, only, most).filter(F.col("check").isin(codes_)).select(*_LONG)


def _keyed_as_reported(found: DataFrame) -> DataFrame:
    """Names are reported one by one; devices by name, without ids."""
    device = F.col("check") == "low_tablet_record_count"
    out = _as_reported(found, F.when(F.col("check") == "duplicate_name", F.col("key")), None, F.when(~device, F.col("row_id")), F.when(device, F.col("key")))
    bare = {c: F.when(~device, F.col(c)) for c in ("subject", "screening_text", "tablet")}
    return out.withColumns(bare)


def _fixed(df: DataFrame, check: str, severity: str, field: Column | str) -> DataFrame:
    field = F.lit(field) if isinstance(field, str) else field
    return df.withColumns({"check": F.lit(check), "severity": F.lit(severity), "field": field})


def missing_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    absent = [c for c in codes.REQUIRED if c not in columns]
    counts = rows.groupBy(*SCOPE).agg(F.count("*").alias("record_count")).withColumn("field", F.explode(F.array(*[F.lit(c) for c in absent]).cast("array<string>")))
    return _fixed(counts, "missing_column", "ERROR", F.col("field")).withColumns({"detail": F.lit(""), "affected_subjids": F.lit(""), "affected_tablets": F.lit("")}).select(*REPORT)


def similar_phone_pairs(rows: DataFrame) -> DataFrame:
    """Distinct phones of a site, of equal length with exactly one other digit: phone_a < phone_b, and their rows.

    Each phone gives a key for every position with that digit left out; equal keys differ there or are equal.
    """
    phones = rows.filter("phone is not null").groupBy(*SCOPE, "phone").agg(F.count("*").alias("n"))
    before, after = lambda phone, i: F.substring(phone, F.lit(1), i - 1), lambda phone, i: F.substring(phone, i + 1, F.length(phone))
    keyed = phones.withColumn("i", F.explode_outer(F.sequence(F.lit(1), F.length("phone"))))
    keyed = keyed.withColumn("hole", F.xxhash64(*SCOPE, "i", before(F.col("phone"), F.col("i")), F.lit("?"), after(F.col("phone"), F.col("i"))))
    a, b = keyed.alias("a"), keyed.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in SCOPE] + [F.col("a.i") == F.col("b.i"), *[f(F.col("a.phone"), F.col("a.i")) == f(F.col("b.phone"), F.col("b.i")) for f in (before, after)]]
    # one number to shuffle and sort by; what it stands for is compared
    pairs = a.join(b, reduce(Column.__and__, [F.col("a.hole") == F.col("b.hole"), F.col("a.phone") < F.col("b.phone"), *same]))
    return pairs.select("a.country", "a.site", F.col("a.phone").alias("phone_a"), F.col("b.phone").alias("phone_b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))


def _rows_of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows with a phone of some pair, as long rows."""
    found = pairs.select(*SCOPE, F.explode(F.array("phone_a", "phone_b")).alias("phone")).distinct()
    return _fixed(rows.join(found, [*SCOPE, "phone"], "left_semi"), "similar_phone", "WARNING", "mobile_number").select(*_LONG)


def _phones_as_reported(rows: DataFrame) -> DataFrame:
    """What counts are pairs of rows, the examples are the first pairs of numbers, and the rows give the ids. ``similar_phone_pairs`` lists all."""
    pairs = stored(similar_phone_pairs(rows), "phone-pairs")
    counted = _as_reported(_fixed(pairs, "similar_phone", "WARNING", "mobile_number"), None, F.col("n_a") * F.col("n_b"), None, F.concat_ws(" / ", "phone_a", "phone_b"))
    return counted.unionByName(_as_reported(_rows_of(rows, pairs), None, F.lit(0)))


def _rare_letters(name: Column, share: Column) -> Column:
    """The letters of a name, each with its how-manieth it is, in one order for all names: the first that a share of them leaves.

    Two names with a common subsequence of n letters have n such letters in common, so they have one among the first
    (length - n + 1) of either.
    """
    place = lambda letters: lambda ch, i: F.struct(F.size(F.filter(F.slice(letters, F.lit(1), i + 1), lambda x: x == ch)).alias("k"), ch.alias("ch"))
    counted = parse.let(F.split(name, ""), lambda letters: F.transform(letters, place(letters)))
    return F.slice(F.sort_array(counted, asc=False), F.lit(1), F.length(name) - F.ceil(F.round(share * F.length(name), 6)) + 1)


def similar_name_pairs(rows: DataFrame, has_dob: bool = True, least: float = SIMILAR) -> DataFrame:
    """Distinct names of a site, and of one date of birth if there is such a column, that are similar and not equal: name_a < name_b, similarity, and the rows of each (n_a, n_b).

    Names meet by country, site, date of birth and their rarest letters, so many that no similar pair is missed and a
    date that many share is split. Lengths, then the edit distance, which is never above that of insertions and
    deletions, leave out nearly all pairs before the common subsequence is measured. Two names that very many rows have are one pair
    here, where ``similar_names`` has one for each two rows.
    """
    tasks_import_here(rows.sparkSession)
    keys = [*SCOPE, *(["born"] if has_dob else [])]
    named = rows.filter("name is not null")
    distinct = (named.filter("born is not null") if has_dob else named).groupBy(*keys, "name").agg(F.count("*").alias("n"))
    # the common subsequence has least / 2 of both lengths, and the other name at most (2 - least) / least of this one's
    share = F.lit(least / 2) * (1 + F.lit(least / (2 - least)))
    distinct = distinct.withColumn("letter", F.explode_outer(_rare_letters(F.col("name"), share))).withColumn("letter", F.xxhash64(*keys, "letter"))
    a, b = distinct.alias("a"), distinct.alias("b")
    la, lb = F.length("a.name"), F.length("b.name")
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in SCOPE] + [F.col(f"a.{c}") == F.col(f"b.{c}") for c in keys[2:]]
    on += [F.col("a.letter") == F.col("b.letter"), F.col("a.name") < F.col("b.name"), F.lit(2.0) * F.least(la, lb) >= least * (la + lb)]
    on.append(F.levenshtein(F.col("a.name"), F.col("b.name")) <= F.floor(F.round((1 - least) * (la + lb), 6)))
    names = a.join(b, reduce(Column.__and__, on)).select(*[F.col(f"a.{c}") for c in keys], F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).distinct()
    return names.withColumn("similarity", similarity.name_similarity(F.col("name_a"), F.col("name_b"))).filter(F.col("similarity") >= least)


def similar_names(rows: DataFrame, has_dob: bool = True, least: float = SIMILAR) -> DataFrame:
    """A row for each pair of rows with similar, not equal names (``similar_name_pairs``), but of one subject."""
    keys = [*SCOPE, *(["born"] if has_dob else [])]
    named = rows.filter("name is not null").select(*SCOPE, "row_id", "name", "born", "subject", "tablet", "screening_text")
    names = similar_name_pairs(rows, has_dob, least)
    side = lambda x: named.select(*keys, F.col("name").alias(f"name_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("row_id", "subject", "tablet", "screening_text")])
    pairs = names.join(side("a"), [*keys, "name_a"]).join(side("b"), [*keys, "name_b"])
    pairs = pairs.filter(~F.coalesce(F.col("subject_a") == F.col("subject_b"), F.lit(False)))
    of_both = lambda c: F.array_sort(F.array_distinct(F.array_compact(F.array(F.nullif(F.col(f"{c}_a"), F.lit("")), F.nullif(F.col(f"{c}_b"), F.lit(""))))))
    known = F.coalesce(F.nullif(F.array_join(of_both("subject"), "; "), F.lit("")), F.array_join(of_both("screening_text"), "; "))
    detail = F.concat(F.lit("'"), F.col("name_a"), F.lit("' / '"), F.col("name_b"), F.lit("' ("), F.format_string("%.2f", "similarity"), F.lit(")"))
    more = {"record_count": F.lit(2).cast("long"), "detail": detail, "affected_subjids": known, "affected_tablets": F.array_join(of_both("tablet"), ", "), "row_a": F.col("row_id_a"), "row_b": F.col("row_id_b")}
    return _fixed(pairs, "similar_name", "WARNING", "participants_name").withColumns(more).select(*REPORT, "name_a", "name_b", "row_a", "row_b", "similarity")


def sparse_columns(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Columns that are null in more than ``share`` of a site's rows: one aggregate over all columns, then one row for each."""
    names = [c for c in df.columns if not c.startswith("_") and c not in codes.MAY_BE_EMPTY]
    placed = df.filter("country is not null").withColumn("_site", site(F.lower("country"), df.columns)).withColumn("_country", F.lower("country"))
    counts = placed.groupBy("_country", "_site").agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    long = counts.select(F.col("_country").alias("country"), F.col("_site").alias("site"), "_n", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*names))).alias("field", "record_count"))
    return _fixed(long.filter(F.col("record_count") > share * F.col("_n")), "sparse_column", "WARNING", F.col("field")).withColumns({"detail": F.lit(""), "affected_subjids": F.lit(""), "affected_tablets": F.lit("")}).select(*REPORT)


def check(df: DataFrame, code: str, as_of: datetime.date, most: int | None = None) -> DataFrame:
    """The report rows of one check."""
    rows = prepared(df, as_of)
    if code in ("similar_phone", "similar_name"):  # which read them several times
        rows = stored(rows.select("row_id", *SCOPE, "subject", "screening_text", "tablet", *(["phone"] if code == "similar_phone" else ["name", "born"])), "prepared")
    special = {"missing_column": lambda: missing_columns(rows, df.columns), "similar_phone": lambda: _reported(_phones_as_reported(rows)), "similar_name": lambda: similar_names(rows, "dob" in df.columns), "sparse_column": lambda: sparse_columns(df)}
    if code in special:
        return special[code]()
    if code in {*(c[0] for c in COUNT_CHECKS), "duplicate_name", "low_tablet_record_count"}:
        return _reported(_keyed_as_reported(keyed_issues(rows, df.columns, code, most)))
    return _reported(_as_reported(row_issues(rows, df.columns, code), None, None, F.col("row_id")))


def report(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """Report rows of all checks.

    The parsed rows, which every check reads, and the phone pairs are stored once in the shared folder. All that is counted by row, key or phone is added up
    together, in two sums.
    """
    rows = judged(df, as_of)
    flagged = _as_reported(row_issues(rows, df.columns), None, None, F.col("row_id"))
    long = flagged.unionByName(_keyed_as_reported(keyed_issues(rows, df.columns))).unionByName(_phones_as_reported(rows))
    out = _reported(long)
    for part in (missing_columns(rows, df.columns), similar_names(rows, "dob" in df.columns), sparse_columns(df)):
        out = out.unionByName(part.select(*REPORT))
    text = [c for c, kind in out.dtypes if kind == "string"]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in text})


def issue_rows(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """Every row of every issue: check, severity, country, site, field, row_id, subject, screening_text, tablet.

    The report's counts and ids as a table that grows with the rows and gathers no group. Columns that are absent or
    sparse have no rows here.
    """
    rows = judged(df, as_of)
    out = row_issues(rows, df.columns).select(*_LONG).unionByName(keyed_issues(rows, df.columns).select(*_LONG))
    alike = similar_names(rows, "dob" in df.columns).select(*SCOPE, F.explode(F.array("row_a", "row_b")).alias("row_id")).distinct()
    names = _fixed(rows.join(alike, [*SCOPE, "row_id"], "left_semi"), "similar_name", "WARNING", "participants_name").select(*_LONG)
    return out.unionByName(_rows_of(rows, similar_phone_pairs(rows))).unionByName(names)


def affected_id_parts(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """check, country, site, field, part, ids: the subject ids of every issue, in parts of bounded size. The report has them in one cell, for people."""
    return id_parts(issue_rows(df, as_of), ["check", *SCOPE, "field"], "subject")


def issue_examples(df: DataFrame, as_of: datetime.date, most: int = EXAMPLES) -> DataFrame:
    """The first rows of every issue, by row id: check, country, site, field, place, row_id."""
    found = _first(stored(issue_rows(df, as_of).select("check", *SCOPE, "field", "row_id"), "issues"), ["check", "field", *SCOPE], most)
    return found.select("check", *SCOPE, "field", "place", "row_id")


def severity_totals(report_: DataFrame) -> DataFrame:
    kinds = report_.agg(F.count_if(F.col("severity") == "ERROR").alias("errors"), F.count_if(F.col("severity") == "WARNING").alias("warnings"))
    return kinds.withColumns({"any_issue": (F.col("errors") + F.col("warnings")) > 0, "any_failure": F.col("errors") > 0})


def validation_summary(report_: DataFrame) -> DataFrame:
    return report_.groupBy("severity", "country", "site", "check").agg(F.count("*").alias("issues"))


def of_countries(report_: DataFrame, countries: list[str]) -> DataFrame:
    return report_.filter(F.lower("country").isin([c.lower() for c in countries]))


def with_source_errors(report_: DataFrame, failures: DataFrame) -> DataFrame:
    """Files that could not be read (file_path, country) come as ERROR rows before the report's own."""
    rows = failures.select(F.lit("corrupt_archive").alias("check"), F.lit("ERROR").alias("severity"), "country", F.lit("").alias("site"), F.col("file_path").alias("field"), F.lit(1).cast("long").alias("record_count"), F.lit("").alias("detail"), F.lit("").alias("affected_subjids"), F.lit("").alias("affected_tablets"))
    return rows.unionByName(report_.select(*REPORT))
