import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from fieldmart import codes
from fieldmart.functions import parse, similarity

AS_OF = datetime.date(2026, 3, 1)


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_number(spark):
    assert values(spark, ["1", " 2.5 ", "-.5", "1e3", "7d", "nan", "", None, "1.2.3"], parse.number) == [1.0, 2.5, -0.5, 1000.0, None, None, None, None, None]


def test_plain(spark):
    assert values(spark, ["712345678.0", "S001 ", "007", "1e2", "1.5", None], parse.plain) == ["712345678", "S001", "7", "100", "1.5", None]


def test_known_id(spark):
    assert values(spark, ["S1", "-9", "-9.0", "", "NaN", None], parse.known_id) == ["S1", None, None, None, None, None]


def test_phone(spark):
    texts = ["254712345678", "256712345678", "0712345678", "+254712345678", "0712-345 678", "123", "", "abc"]
    assert values(spark, texts, parse.phone) == ["712345678"] * 5 + ["123", None, None]


def test_stamp_takes_short_fields_and_rejects_bad_days(spark):
    got = values(spark, ["05/02/2026 01:02:03", "5/2/2026 1:2:3", "29/02/2026 00:00:00", "00/00/0000 00:00:00", "x", None], parse.stamp)
    assert got == [datetime.datetime(2026, 2, 5, 1, 2, 3)] * 2 + [None] * 4


def test_birth_date_repairs_the_century(spark):
    got = values(spark, ["01/01/2040 00:00:00", "01/01/2020 00:00:00", "01/01/2027 00:00:00"], lambda c: parse.birth_date(c, AS_OF))
    assert got == [datetime.date(1940, 1, 1), datetime.date(2020, 1, 1), datetime.date(1927, 1, 1)]


def test_facility_label(spark):
    assert values(spark, ["11", "55", "x", None], lambda c: parse.facility_label(c, "uganda")) == ["11 (Bushenyi HCIV)", "55 (Unknown)", "x", None]


def test_canonical(spark):
    assert values(spark, ["Runyonkole", "english", "Kiswahili"], lambda c: parse.canonical(c, codes.LANGUAGES)) == ["Runyankole", "English", "Kiswahili"]


def test_filled(spark):
    date = F.lit(datetime.date(2025, 12, 25))
    assert values(spark, ["on [insert date]", "a [x] b [y]", "none"], lambda c: parse.filled(c, date)) == ["on 25/12/2025", "a 25/12/2025 b 25/12/2025", "none"]
    assert values(spark, ["on [x]"], lambda c: parse.filled(c, F.lit(None).cast("date"))) == ["on [x]"]


@pytest.mark.parametrize("a,b,expected", [("alice wanjiru", "alice wanjru", 0.96), ("abc", "abc", 1.0), ("abc", "xyz", 0.0), ("", "a", 0.0)])
def test_name_similarity(spark, a, b, expected):
    row = spark.range(1).select(similarity.name_similarity(F.lit(a), F.lit(b)).alias("v")).first()
    assert row.v == pytest.approx(expected, abs=1e-9)


def test_common_lengths_equal_dynamic_programming():
    rng = random.Random(2)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *itertools.accumulate(range(1, len(b) + 1), lambda left, j: row[j - 1] + 1 if b[j - 1] == x else max(row[j], left), initial=0)][1:]
        return row[-1]

    letters = "abcé🙂\0"
    words = ["", "a", *["".join(rng.choice(letters) for _ in range(n)) for n in (1, 5, 12, 30, 63, 64, 65, 90, 130) for _ in range(6)]]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(400)]
    assert similarity.common_lengths([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [plain(a, b) for a, b in pairs]
    assert similarity.common_lengths([], []).tolist() == []
