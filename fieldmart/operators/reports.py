"""Delivery reports: status by message, weekly and cumulative counts, pivots, line lists, resend lists."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .campaign import COUNTRY_CODE
from .ordering import id_parts

SITE = "health_facility_ug"
METRICS = ("due", "submitted", "delivered", "undelivered", "pending")
SITES = ("11", "12", "13", "14")
ZONE = "Africa/Kampala"


def message_status(queue: DataFrame, log: DataFrame, people: DataFrame, distinct_participants: bool = False) -> DataFrame:
    """One row for each queue row and facility: the latest sent attempt, the best delivery status, and attempts.

    A participant listed twice multiplies attempts, unless distinct_participants.
    """
    who = people.select("subjid", SITE)
    who = who.distinct() if distinct_participants else who
    entries = log.groupBy("queue_id").agg(
        F.count("log_id").alias("n"),
        F.max_by(F.struct("sent_at", "provider_message_id"), F.when(F.col("status") == "sent", F.struct("sent_at", "provider_message_id"))).alias("latest"),
        *[F.bool_or(F.col("delivery_status") == s).alias(s) for s in ("DELIVERED", "FAILED", "NOT_FOUND")],
    )
    best = F.coalesce(*[F.when(F.col(s), s) for s in ("DELIVERED", "FAILED", "NOT_FOUND")])
    rows = queue.join(entries, "queue_id", "left").join(who, "subjid")
    keys = ["queue_id", "subjid", "mobile_number", "week", "arm_text", "language", SITE, F.col("status").alias("queue_status"), "scheduled_date", F.col("latest.sent_at").alias("sent_at"), F.col("latest.provider_message_id").alias("provider_message_id"), best.alias("delivery_status")]
    return rows.groupBy(*keys).agg(F.sum(F.coalesce("n", F.lit(0))).alias("attempts"))


MESSAGE_STATUS = f"""
SELECT q.queue_id, q.subjid, q.mobile_number, q.week, q.arm_text, q.language, p.{SITE}, q.status AS queue_status, q.scheduled_date, latest.sent_at, latest.provider_message_id,
       coalesce(max(l.delivery_status) FILTER (WHERE l.delivery_status = 'DELIVERED'), max(l.delivery_status) FILTER (WHERE l.delivery_status = 'FAILED'),
                max(l.delivery_status) FILTER (WHERE l.delivery_status = 'NOT_FOUND')) AS delivery_status, count(l.log_id) AS attempts
FROM {{queue}} q JOIN {{people}} p ON p.subjid = q.subjid LEFT JOIN {{log}} l ON l.queue_id = q.queue_id
LEFT JOIN LATERAL (SELECT sent_at, provider_message_id FROM {{log}} s WHERE s.queue_id = q.queue_id AND s.status = 'sent' ORDER BY sent_at DESC NULLS LAST LIMIT 1) latest
GROUP BY ALL
"""


def message_status_view(queue: DataFrame, log: DataFrame, people: DataFrame, name: str = "message_status") -> DataFrame:
    """Registers ``message_status`` as a temporary view over temporary views of its tables (name_queue, name_log, name_people), and returns it.

    The latest sent attempt is the first row of a lateral subquery, which Spark plans as a ranking by queue row.
    """
    spark, parts = queue.sparkSession, {"queue": queue, "log": log, "people": people}
    for part, df in parts.items():
        df.createOrReplaceTempView(f"{name}_{part}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {MESSAGE_STATUS.format(**{part: f'{name}_{part}' for part in parts})}")
    return spark.table(name)


def _joined(log: DataFrame, queue: DataFrame, people: DataFrame, country_code: str) -> DataFrame:
    q = queue.select("queue_id", F.col("status").alias("queue_status"), "arm_text", "language", F.col("mobile_number").alias("queue_number"), "scheduled_date")
    who = people.filter(F.col("countrycode") == country_code).select("subjid", SITE)
    return log.join(q, "queue_id").join(who, "subjid")


def flagged_messages(log: DataFrame, queue: DataFrame, people: DataFrame, country_code: str = COUNTRY_CODE) -> DataFrame:
    """Failed rows that got no provider id, with their last error."""
    rows = _joined(log, queue, people, country_code).filter("queue_status = 'failed' and provider_message_id is null")
    return rows.groupBy("subjid", SITE, "week").agg(F.max("error_message").alias("last_error"))


def latest_attempt(log: DataFrame, queue: DataFrame, people: DataFrame, sent: Column | None = None, country_code: str = COUNTRY_CODE) -> DataFrame:
    """The latest sent attempt of each queue row."""
    rows = _joined(log, queue, people, country_code).filter("status = 'sent'")
    rows = rows if sent is None else rows.filter(sent)
    place = F.row_number().over(Window.partitionBy("queue_id").orderBy(F.col("sent_at").desc_nulls_first(), F.col("log_id").desc()))
    return rows.withColumn("_place", place).filter("_place = 1").select("queue_id", SITE, "week", "sent_at", "delivery_status")


def _counts(reached: DataFrame, due: DataFrame) -> DataFrame:
    status = F.col("delivery_status")
    sent = reached.groupBy(SITE, "week").agg(F.count("*").alias("submitted"), F.count_if(status == "DELIVERED").alias("delivered"), F.count_if(status.isin("FAILED", "NOT_FOUND")).alias("undelivered"), F.count_if(status.isNull()).alias("pending"))
    d = due.groupBy(SITE, "week").agg(F.count("*").alias("due"))
    return sent.join(d, [SITE, "week"], "left").select(SITE, "week", F.coalesce("due", F.lit(0)).alias("due"), "submitted", "delivered", "undelivered", "pending")


def _due(queue: DataFrame, people: DataFrame, country_code: str) -> DataFrame:
    return queue.join(people.filter(F.col("countrycode") == country_code).select("subjid", SITE), "subjid")


def window_of(day: Column) -> tuple[Column, Column, Column]:
    """week_start, week_end, sent_end of the report of a day: the last Wednesday to Wednesday, and the day after.

    The last Tuesday on or before the day less six days begins it; one day more ends it, counted in.
    """
    tuesday = F.date_sub(F.next_day(day, "TU"), 7)
    return F.date_sub(tuesday, 6), F.date_add(tuesday, 1), F.date_add(tuesday, 2)


def report_window(days: DataFrame) -> DataFrame:
    """day, week_start, week_end, sent_end for each row of days (day)."""
    return days.select("day", *[c.alias(n) for c, n in zip(window_of(F.col("day")), ("week_start", "week_end", "sent_end"), strict=True)])


def weekly_report(log: DataFrame, queue: DataFrame, people: DataFrame, start: datetime.date, end: datetime.date, country_code: str = COUNTRY_CODE, closed: str = "code") -> DataFrame:
    """Counts by site and week of messages sent from start to end, both counted in; ``closed='tue'`` leaves the last day out."""
    last = end if closed == "code" else end - datetime.timedelta(days=1)
    sent = (F.col("sent_at") >= F.lit(start)) & (F.col("sent_at") < F.lit(last + datetime.timedelta(days=1)))
    return _counts(latest_attempt(log, queue, people, sent, country_code), _due(queue, people, country_code).filter(F.col("scheduled_date").between(F.lit(start), F.lit(last))))


def cumulative_report(log: DataFrame, queue: DataFrame, people: DataFrame, as_of: datetime.date, country_code: str = COUNTRY_CODE) -> DataFrame:
    return _counts(latest_attempt(log, queue, people, None, country_code), _due(queue, people, country_code).filter(F.col("scheduled_date") <= F.lit(as_of)))


def weekly_pivot(counts: DataFrame) -> DataFrame:
    """A row for each week and metric, a column for each site in fixed order, and the total."""
    long = counts.unpivot([SITE, "week"], list(METRICS), "metric", "n")
    wide = long.groupBy("week", "metric").pivot(SITE, list(SITES)).agg(F.sum("n"))
    cells = [F.coalesce(F.col(s), F.lit(0)) for s in SITES]
    return wide.select("week", "metric", *[c.alias(f"site_{s}") for s, c in zip(SITES, cells, strict=True)], sum(cells[1:], cells[0]).alias("total"))


def weekly_percent(counts: DataFrame) -> DataFrame:
    """week, metric, site ('total' for all), n, pct: sent over due, the rest over sent; null over 0."""
    sites = counts.select(F.col(SITE).alias("site"), "week", *METRICS)
    total = sites.groupBy("week").agg(*[F.sum(m).alias(m) for m in METRICS]).withColumn("site", F.lit("total"))
    long = sites.unionByName(total).select("site", "week", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("n"), F.lit(None).cast("bigint").alias("d") if m == "due" else F.col("due" if m == "submitted" else "submitted").alias("d")) for m in METRICS])).alias("x"))
    return long.select("week", "x.metric", "site", "x.n", F.when(F.col("x.d") > 0, F.round(100.0 * F.col("x.n") / F.col("x.d"), 6)).alias("pct"))


def percent_cells(percents: DataFrame) -> DataFrame:
    """Text of the cells: 'n (p%)', blank over 0, and n alone for due."""
    shown = F.format_string("%d (%s%%)", F.col("n"), F.bround(F.col("pct").cast("decimal(20,6)"), 1).cast("decimal(20,1)").cast("string"))
    return percents.withColumn("cell", F.when(F.col("metric") == "due", F.col("n").cast("string")).when(F.col("pct").isNull(), "").otherwise(shown))


def delivery_linelist(log: DataFrame, queue: DataFrame, people: DataFrame, country_code: str = COUNTRY_CODE) -> DataFrame:
    """One row for each sent message, in local time."""
    rows = _joined(log, queue, people, country_code).filter("status = 'sent'")
    return rows.select("subjid", F.col(SITE).alias("site_code"), "week", "arm_text", "language", F.col("queue_number").alias("mobile_number"), "scheduled_date", F.from_utc_timestamp("sent_at", ZONE).alias("sent_at_local"), F.coalesce("delivery_status", F.lit("Pending")).alias("delivery_status"))


def messages(log: DataFrame, queue: DataFrame, status: str) -> DataFrame:
    """The log's sent or failed messages beside their queue rows."""
    return log.filter(F.col("status") == status).join(queue.select("queue_id", "arm_text", "language"), "queue_id").select("log_id", "subjid", "mobile_number", "week", "arm_text", "language", "sent_at", "error_message", "delivery_status")


def queue_status_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(F.count("*").alias("n"))


def delivery_status_week(log: DataFrame, as_of: datetime.date) -> DataFrame:
    """Delivery statuses of messages sent since the beginning of the week."""
    begin = F.date_trunc("week", F.lit(as_of).cast("timestamp"))
    return log.filter((F.col("status") == "sent") & (F.col("sent_at") >= begin)).groupBy("delivery_status").agg(F.count("*").alias("n"))


def resend_list_parts(flagged: DataFrame) -> DataFrame:
    """week, part, ids: the ids to send again to, in parts of bounded size; any number of them in a week."""
    return id_parts(flagged, ["week"], "subjid")


def resend_lists(flagged: DataFrame) -> DataFrame:
    """A week's ids in one cell, for people; ``resend_list_parts`` for any number of them."""
    return flagged.groupBy("week").agg(F.array_join(F.array_sort(F.collect_list("subjid")), ", ").alias("subjids"))
