import datetime
import itertools
import random

from fieldmart.operators import quality

AS_OF = datetime.date(2026, 3, 1)


def frame(spark, rows, **columns):
    names = list(columns)
    data = [(i, "uganda", *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "row_id long, country string, " + ", ".join(f"{n} string" for n in names))


def counts(df, code, most=None):
    return [r.record_count for r in quality.check(df, code, AS_OF, most).collect()]


def test_duplicate_subjid(spark):
    df = frame(spark, [("S001", "1"), ("S001", "0"), ("S002", "1"), ("-9", "1"), ("-9", "1")], subjid=1, consent=1)
    assert counts(df, "duplicate_subjid") == [2]


def test_duplicate_phone(spark):
    assert counts(frame(spark, [("0712345678",), ("+254712345678",)], mobile_number=1), "duplicate_phone") == [2]


def test_similar_phone(spark):
    pairs = lambda *p: counts(frame(spark, [(x,) for x in p], mobile_number=1), "similar_phone")
    assert pairs("712345678", "712345679") == [1]
    assert pairs("712345678", "712345600") == []
    assert pairs("712345678", "712345678") == []
    assert pairs("71234567", "712345678") == []
    assert pairs("712345678", "712345679", "712345679") == [2]


def test_duplicate_name(spark):
    assert counts(frame(spark, [("Alice Wanjiru",), ("alice wanjiru",), ("Bob Otieno",)], participants_name=1), "duplicate_name") == [2]


def test_duplicate_name_of_different_people(spark):
    df = frame(spark, [("Ann", "01/01/1990 00:00:00"), ("Ann", "01/01/1991 00:00:00")], participants_name=1, dob=1)
    assert counts(df, "duplicate_name") == []


def test_similar_name_without_date_of_birth(spark):
    names = lambda *n: counts(frame(spark, [(x,) for x in n], participants_name=1), "similar_name")
    assert names("Alice Wanjiru", "Alice Wanjru") == [2]
    assert names("Alice Wanjiru", "Alice Wanjiru") == []
    assert names("Alice Wanjiru", "John Otieno") == []
    assert names("Alice") == []


def test_similar_names_against_all_pairs(spark):
    """Without and with a date of birth that all share: edits at both ends, in the middle, and names of other lengths."""
    rng = random.Random(4)
    names = ["hanna maria jones", "anna maria jonas", "abcdefghijk", "abcdefghijkl", "aaaa", "aaaab", "baaaa", "ab", "abc"]
    for _ in range(40):
        base = "".join(rng.choice("abcde ") for _ in range(rng.randint(4, 22))).strip() or "a"
        edited = list(base)
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(edited) + 1)
            edited[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        names += [base, "".join(edited).strip() or "b"]
    names = sorted({n for n in names if n.strip()})

    def similarity(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return 2 * row[-1] / (len(a) + len(b))

    expected = {(a, b) for a, b in itertools.combinations(names, 2) if similarity(a, b) >= 0.85}
    assert len(expected) > 20
    for more in ({}, {"dob": 1}):
        df = frame(spark, [(n, *["01/01/1990 00:00:00"] * len(more)) for n in names], participants_name=1, **more)
        found = {(r.name_a, r.name_b) for r in quality.check(df, "similar_name", AS_OF).collect()}
        assert found == expected


def test_report_names_what_to_look_at(spark):
    rows = [("Alice Wanjiru", "712345678", "S1", "1"), ("Alice Wanjru", "712345679", "S2", "2"), ("Bob", "1", "S3", "2"), ("bob", "2", "S3", "2")]
    df = frame(spark, rows, participants_name=1, mobile_number=1, subjid=1, tabletnum=1)
    report = {r.check: r for r in quality.report(df, AS_OF).collect() if r.check in ("similar_name", "similar_phone", "duplicate_name", "duplicate_subjid")}
    assert report["similar_name"].detail == "'alice wanjiru' / 'alice wanjru' (0.96)"
    assert (report["similar_name"].affected_subjids, report["similar_name"].affected_tablets) == ("S1; S2", "1, 2")
    assert report["similar_phone"].detail == "1 / 2; 712345678 / 712345679"
    assert report["duplicate_name"].detail == "bob" and report["duplicate_subjid"].detail == "rows 2, 3"
    long = quality.issue_rows(df, AS_OF).filter("check = 'similar_phone'")
    assert sorted(r.row_id for r in long.collect()) == [0, 1, 2, 3]


def test_devices_by_file_path(spark):
    df = frame(spark, [("/in/T1/a.csv",), ("/in/T2/a.csv",), ("/in/T2/b.csv",), ("/in/T2/c.csv",)], file_path=1)
    assert [(r.record_count, r.detail) for r in quality.check(df, "low_tablet_record_count", AS_OF).collect()] == [(1, "T1")]


def test_boundaries_of_the_row_checks(spark):
    """The last value that passes and the first that doesn't."""
    hit = lambda code, values, **columns: [r.record_count for r in quality.check(frame(spark, values, **columns), code, AS_OF).collect()]
    at = lambda minutes: f"01/02/2026 {10 + minutes // 60:02d}:{minutes % 60:02d}:00"
    assert hit("invalid_age", [("10",), ("110",), ("-7",), ("-9",)], respondants_age=1) == [] and hit("invalid_age", [("9",), ("111",), ("-8",)], respondants_age=1) == [3]
    assert hit("duration_too_short", [(at(0), at(8), "S")], starttime=1, stoptime=1, subjid=1) == [] and hit("duration_too_short", [(at(0), at(7), "S")], starttime=1, stoptime=1, subjid=1) == [1]
    assert hit("duration_too_long", [(at(0), at(30))], starttime=1, stoptime=1) == [] and hit("duration_too_long", [(at(0), at(31))], starttime=1, stoptime=1) == [1]
    assert hit("unusual_interview_hour", [("01/02/2026 05:00:00", "I")], starttime=1, interviewer_id=1) == [] and hit("unusual_interview_hour", [("01/02/2026 04:59:59", "I")], starttime=1, interviewer_id=1) == [1]
    assert hit("future_visit_date", [("01/03/2026 23:59:59",)], starttime=1) == [] and hit("future_visit_date", [("02/03/2026 00:00:00",)], starttime=1) == [1]
    assert hit("stale_visit_date", [("01/03/2025 00:00:00",)], starttime=1) == [] and hit("stale_visit_date", [("28/02/2025 23:59:59",)], starttime=1) == [1]
    assert hit("invalid_facility_code", [("1", "14"), ("1", "99"), ("1", "-9")], countrycode=1, health_facility_ug=1) == [] and hit("invalid_facility_code", [("1", "15")], countrycode=1, health_facility_ug=1) == [1]


def test_absent_columns_are_skipped_but_required_ones_reported(spark):
    df = frame(spark, [("1",)], countrycode=1)
    report = quality.report(df, AS_OF).collect()
    missing = {r.field for r in report if r.check == "missing_column"}
    assert "starttime" in missing and "countrycode" not in missing
    assert not [r for r in report if r.check == "duplicate_phone"]


def test_excessive_daily_interviews_default(spark):
    rows = [("I1", "01/02/2026 09:00:00")] * 26 + [("I2", "01/02/2026 09:00:00")] * 25
    assert counts(frame(spark, rows, interviewer_id=1, starttime=1), "excessive_daily_interviews") == [26]


def test_sparse_column(spark):
    df = frame(spark, [(None, "a"), (None, "b"), ("x", "c")], sometimes=1, always=1)
    assert [(r.field, r.record_count) for r in quality.sparse_columns(df).collect()] == [("sometimes", 2)]


def test_row_flags(spark):
    df = frame(spark, [("1", None, "01/03/2026 10:00:00", "01/03/2026 09:00:00", "7"), ("0", "S1", "02/03/2026 02:00:00", "02/03/2026 02:05:00", "200")], consent=1, subjid=1, starttime=1, stoptime=1, respondants_age=1)
    codes = {r.check for r in quality.report(df.withColumn("interviewer_id", df.subjid), AS_OF).collect()}
    assert {"consented_without_subjid", "impossible_duration", "non_consented_with_subjid", "duration_too_short", "invalid_age", "unusual_interview_hour", "future_visit_date", "missing_interviewer_id"} <= codes


def test_no_pair_check_is_a_nested_loop(spark):
    df = frame(spark, [("712345678", "Ann", "01/01/1990 00:00:00")], mobile_number=1, participants_name=1, dob=1)
    rows = quality.prepared(df, AS_OF)
    for pairs in (quality.similar_phone_pairs(rows), quality.similar_names(rows)):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_are_judged_once_and_stored_narrow(spark):
    """What every check reads again has the true checks as numbers, and none of the survey's text that only they need."""
    df = frame(spark, [("1", "07/01/2026 10:00:00", "2"), ("150", "07/01/2026 10:00:00", "9")], respondants_age=1, starttime=1, client_sex=1)
    rows = quality.judged(df, AS_OF)
    assert not {"starttime", "respondants_age", "client_sex", "start", "minutes"} & set(rows.columns)
    of = lambda r: sorted((x.check, x.row_id) for x in quality.row_issues(r, df.columns).collect())
    assert of(rows) == of(quality.prepared(df, AS_OF)) != []


def test_first_examples_of_groups_of_any_size(spark):
    rows = [(g, None if g == "none" else "s", i) for g, ids in {"one": [7], "same": [4] * 9, "many": range(3000, 0, -1), "none": range(10, 20)}.items() for i in ids]
    df = spark.createDataFrame(rows, "check string, site string, row_id long")
    found = quality._first(df, ["check", "site"], 5).collect()
    by = {g: sorted(r.row_id for r in found if r.check == g) for g in ("one", "same", "many", "none")}
    assert by == {"one": [7], "same": [4] * 5, "many": [1, 2, 3, 4, 5], "none": [10, 11, 12, 13, 14]}
    assert sorted(r.place for r in found if r.check == "many") == [1, 2, 3, 4, 5]
