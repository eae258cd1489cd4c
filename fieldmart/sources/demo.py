"""Survey and campaign tables derived from the star-schema tables, so that every operator has data that grows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.session import table

AS_OF = datetime.date(2001, 6, 30)
ARM_TEXTS = ("Community benefits", "education-based", "HIV Risk Assessment", "Social Norms - default", "social norms - sex-age-matched", "U=U Messaging", "Reserved for you", "Control (SOC)", "Incentive")
LANGUAGE_TEXTS = ("English", "luganda", "Runyonkole", "Kiswahili")


def _text(time: Column) -> Column:
    return F.date_format(time, "dd/MM/yyyy HH:mm:ss")


def _minutes(time: Column, n: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(time) + n * 60)


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey row for each order; all columns are text but row_id and extracted_at."""
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k, u, kenya = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey") % 2 == 0
    od = F.col("o_orderdate").cast("timestamp")
    # a crowded day of one interviewer
    crowded = k % 1000 < 60
    start = _minutes(F.when(crowded, F.lit(datetime.datetime(2001, 5, 5, tzinfo=datetime.UTC))).otherwise(od), k % 1440)
    text = lambda c: c.cast("string")
    born = F.when(u % 301 == 0, F.date_add(F.lit(datetime.date(2095, 1, 1)), (u % 300).cast("int"))).otherwise(F.date_add(F.lit(datetime.date(1930, 1, 1)), (u * 37 % 29000).cast("int")))
    return joined.select(
        k.alias("row_id"),
        F.when(k % 97 != 0, text(k % 14000)).alias("uniqueid"),
        F.when(F.col("o_orderstatus") == "P", "-9").when(k % 11 == 0, "").otherwise(F.concat(F.lit("S"), text(u))).alias("subjid"),
        F.when(k % 53 == 0, F.concat(F.lit("SCR "), text(k))).when(k % 59 == 0, F.concat(F.lit("X"), text(k))).otherwise(F.concat(F.lit("SCR-"), text(k % 14500))).alias("screening_id"),
        F.when(kenya, "kenya").otherwise("uganda").alias("country"),
        F.when(k % 37 == 0, "9").when(kenya, "2").otherwise("1").alias("countrycode"),
        text(u % 40).alias("tabletnum"),
        F.when(crowded, "I0").when(k % 101 != 0, F.concat(F.lit("I"), text(u % 12))).alias("interviewer_id"),
        _text(start).alias("starttime"),
        _text(_minutes(start, k % 45 - 3)).alias("stoptime"),
        _text(born).alias("dob"),
        F.when(k % 67 == 0, "-7").when(k % 71 == 0, "150").otherwise(text(2001 - F.year(born) + k % 5 - 2)).alias("respondants_age"),
        F.when(k % 89 == 0, "3").when(k % 25 == 4, "-9").otherwise(text(1 + k % 2)).alias("client_sex"),
        F.when(k % 83 == 0, "5").when(k % 7 == 0, "0").otherwise("1").alias("consent"),
        F.when(kenya, F.when(k % 61 == 0, "55").otherwise(text(21 + u % 4))).otherwise(F.when(k % 73 == 0, "21").otherwise("-9")).alias("health_facility_ke"),
        F.when(~kenya, F.when(k % 61 == 0, "55").otherwise(text(11 + u % 4))).otherwise(F.when(k % 79 == 0, "12").otherwise("-9")).alias("health_facility_ug"),
        F.concat(F.lit("07"), F.lpad(text((u * 7919 + k % 3) % 100000000), 8, "0")).alias("mobile_number"),
        F.concat(F.substring(F.md5(text(u).cast("binary")), 1, 11), F.when(k % 13 == 0, "z").otherwise("y")).alias("participants_name"),
        _text(_minutes(start, (30 + k % 120) * 1440)).alias("next_appt_3m"),
        _text(_minutes(start, (k % 260 - 5) * 1440)).alias("next_appt_6m"),
        F.when(k % 4 == 0, F.concat(F.lit("note "), text(k % 9))).alias("remarks"),
        F.concat(F.lit("/in/Tablet"), F.when(k < 3, F.concat(F.lit("X"), text(k))).otherwise(text(u % 40)), F.lit("/db.csv")).alias("_source_db"),
        od.alias("extracted_at"),
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits, with every fiftieth row a second time from another file."""
    rows = visits(spark, sf_dir)
    return rows.unionByName(rows.filter("row_id % 50 = 0").withColumn("_source_db", F.lit("/in/TabletCopy/db.csv")))


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest visit of every participant with an id, and a message schedule."""
    rows = visits(spark, sf_dir).filter(F.col("subjid").startswith("S"))
    newest = rows.groupBy("subjid").agg(F.max_by(F.struct("countrycode", "mobile_number", "health_facility_ug"), F.struct("extracted_at", "row_id")).alias("v"))
    u = F.substring("subjid", 2, 20).cast("bigint")
    pick = lambda values, i: F.get(F.array(*[F.lit(v) for v in values]), i.cast("int"))
    day = lambda n: _text(F.date_add(F.lit(AS_OF), n.cast("int")))
    zero = F.lit("00/00/0000 00:00:00")
    return newest.select(
        "subjid", "v.countrycode", "v.mobile_number", "v.health_facility_ug",
        F.when(u % 31 != 0, pick(ARM_TEXTS, u % 9)).alias("arm_text"),
        pick(LANGUAGE_TEXTS, u % 4).alias("preferred_language_text"),
        F.when(u % 17 == 0, None).when(u % 19 == 0, zero).otherwise(day(u % 14 - 7)).alias("sms_schedule_8weeks"),
        F.when(u % 23 == 0, None).otherwise(day(u % 14 - 28)).alias("sms_schedule_11weeks"),
        F.when(u % 13 == 0, zero).otherwise(day(u % 30 + 5)).alias("dflt_appt_arm_schd_appt_date"),
    )


def templates(spark: SparkSession) -> DataFrame:
    """Messages of seven arms in two of the languages, for both weeks; the later week has a placeholder."""
    arms = ("Community benefits", "Education-based 1", "HIV Risk Assessment", "Social Norms", "U=U Messaging", '"Reserved for you" Messaging')
    rows = [(a, lang, w, f"{lang} {a} week {w}" + (" on [date here]" if w == 11 else "")) for a in arms for lang in ("English", "Luganda", "Runyankole") for w in (8, 11) if not (a == "Social Norms" and w == 8)]
    return spark.createDataFrame(rows, "arm string, language string, week int, message_text string").withColumn("has_placeholder", F.col("message_text").rlike(r"\[.*?\]"))


def opt_outs(people: DataFrame) -> DataFrame:
    u = F.substring("subjid", 2, 20).cast("bigint")
    return people.filter(u % 29 == 0).select("subjid", "mobile_number", F.lit("asked").alias("reason"))


def message_log(queue: DataFrame) -> DataFrame:
    """No, one or two attempts for each queue row, by its participant's number."""
    u = F.substring("subjid", 2, 20).cast("bigint")
    rows = queue.withColumn("attempt", F.explode(F.sequence(F.lit(0), (u % 3).cast("int")))).filter("attempt > 0")
    kind = (u + F.col("week") + F.col("attempt")) % 5
    sent = (u + F.col("attempt")) % 4 != 0
    return rows.select(
        F.concat_ws("/", "queue_id", F.col("attempt").cast("string")).alias("log_id"), "queue_id", "subjid", "mobile_number", "week", F.lit("text").alias("message_text"), "attempt",
        F.when(sent, "sent").otherwise("failed").alias("status"),
        F.when(sent, F.concat(F.lit("P"), F.col("queue_id"), F.col("attempt").cast("string"))).alias("provider_message_id"),
        F.when(sent, F.when(kind == 0, "DELIVERED").when(kind == 1, "FAILED").when(kind == 2, "NOT_FOUND")).alias("delivery_status"),
        F.when(sent, _minutes(F.col("scheduled_date").cast("timestamp"), F.col("attempt") * 60 + u % 60)).alias("sent_at"),
        F.when(~sent, F.concat(F.lit("error "), (u % 7).cast("string"))).alias("error_message"),
    )


def receipts(log: DataFrame) -> DataFrame:
    """What a gateway says of messages with an id; a null status is an error."""
    u = F.substring("subjid", 2, 20).cast("bigint")
    kind = (u + F.col("week")) % 6
    status = F.when(kind == 0, "DELIVERED").when(kind == 1, "FAILED").when(kind == 2, "NOT_FOUND").when(kind == 3, "PENDING").when(kind == 4, "QUEUED")
    return log.filter("provider_message_id is not null").select("provider_message_id", status.alias("status"))


def outcomes(due: DataFrame) -> DataFrame:
    """What came of sending: queue_id and outcome."""
    u = F.substring("subjid", 2, 20).cast("bigint")
    return due.select("queue_id", F.when(u % 5 == 0, "failed").when(u % 7 == 0, "skipped").otherwise("sent").alias("outcome"), F.when(u % 5 != 0, F.concat(F.lit("N"), F.col("queue_id"))).alias("provider_message_id"))


def snapshot_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of device snapshots, one for each event: file_path, last_modified, loaded."""
    e = table(spark, sf_dir, "events")
    device, stamp_ = (F.col("user_id") % 500).cast("string"), F.date_format(F.col("ts").cast("timestamp"), "yyyy_MM_dd-HH_mm_ss")
    name = F.concat(F.lit("Tablet"), device, F.lit("_"), stamp_)
    path = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("/in/"), name, F.lit("/DataBackup/pilot.mdb"))).when(F.col("event_id") % 13 == 0, F.concat(F.lit("/in/other/"), device, F.lit(".mdb")))
    return e.select(path.otherwise(F.concat(F.lit("/in/"), name, F.lit("/pilot.mdb"))).alias("file_path"), F.concat(name, F.when(F.col("event_id") % 7 == 0, ".txt").otherwise(".7z")).alias("archive"), F.col("event_id").alias("last_modified"), (F.col("event_id") % 3 == 0).alias("loaded"))


def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, column, dtype of a file for each part: most lack some column, some have another type."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    files = p.select(key.alias("k"), F.concat(F.lit("file"), key.cast("string")).alias("file"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).filter((F.col("k") % 10 != F.col("i")) | (F.col("k") % 7 == 0))
    dtype = F.when(F.col("i") == 3, F.when(F.col("k") % 2 == 0, "int64").otherwise("float64")).when((F.col("i") == 5) & (F.col("k") % 100 == 1), "object").when(F.col("i") < 5, "int64").otherwise("float64")
    return files.select("file", F.concat(F.lit("c"), F.col("i").cast("string")).alias("column"), F.when((F.col("i") == 3) | (F.col("i") == 5) | (F.col("i") != 4), dtype).otherwise("object").alias("dtype"))
