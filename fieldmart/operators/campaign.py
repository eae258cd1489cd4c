"""A message campaign as table transitions: queue, opt-outs, due messages, rendering, attempts, receipts.

Tables are immutable; each function returns the next version or the rows to append. ``as_of`` stands for today.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart import codes
from fieldmart.functions import parse

COUNTRY_CODE = "1"


def _date(text: Column) -> Column:
    """A date; null for zero dates ('00...'), blanks and bad text."""
    return F.when(F.substring(text, 1, 2) != "00", F.to_date(parse.stamp(text)))


def queue_candidates(people: DataFrame, country_code: str = COUNTRY_CODE) -> DataFrame:
    """One row for each participant and week with a scheduled date; arms without messages and unknown arms go."""
    long = people.unpivot(["subjid", "mobile_number", "arm_text", "preferred_language_text", "countrycode", "dflt_appt_arm_schd_appt_date"], ["sms_schedule_8weeks", "sms_schedule_11weeks"], "which", "schedule")
    long = long.filter((F.col("countrycode") == country_code) & F.col("mobile_number").isNotNull() & ~F.col("arm_text").isin(*codes.ARMS_WITHOUT_MESSAGES))
    week = F.when(F.col("which") == "sms_schedule_8weeks", 8).otherwise(11)
    rows = long.select("subjid", "mobile_number", "arm_text", F.col("preferred_language_text").alias("language"), week.alias("week"), _date(F.col("schedule")).alias("scheduled_date"), _date(F.col("dflt_appt_arm_schd_appt_date")).alias("appointment_date"))
    return rows.filter("scheduled_date is not null")


def queue_sync(queue: DataFrame | None, people: DataFrame, opted_out: DataFrame, country_code: str = COUNTRY_CODE) -> DataFrame:
    """queue with the candidates whose (subjid, week) it lacks, and opt-outs marked. Twice is the same as once."""
    new = queue_candidates(people, country_code)
    first = F.row_number().over(Window.partitionBy("subjid", "week").orderBy("scheduled_date", "mobile_number", "arm_text", "language"))
    new = new.withColumn("_place", first).filter("_place = 1").drop("_place")
    new = new.withColumns({"queue_id": F.concat_ws("-", "subjid", F.col("week").cast("string")), "opted_out": F.lit(False), "status": F.lit("pending")})
    if queue is not None:
        new = queue.unionByName(new.join(queue, ["subjid", "week"], "left_anti"), allowMissingColumns=True)
    return apply_opt_outs(new, opted_out)


def apply_opt_outs(queue: DataFrame, opted_out: DataFrame) -> DataFrame:
    out = opted_out.select("subjid").distinct().withColumn("_out", F.lit(True))
    return queue.join(out, "subjid", "left").withColumn("opted_out", F.col("opted_out") | F.coalesce("_out", F.lit(False))).drop("_out")


def due_messages(queue: DataFrame, log: DataFrame, as_of: datetime.date) -> DataFrame:
    """Pending rows of today, not opted out and never sent."""
    due = queue.filter((F.col("scheduled_date") == F.lit(as_of)) & (F.col("status") == "pending") & ~F.col("opted_out"))
    return due.join(log.filter("status = 'sent'").select("subjid", "week"), ["subjid", "week"], "left_anti").select("queue_id", "subjid", "mobile_number", "arm_text", "language", "week", "appointment_date")


def canonical_values(due: DataFrame) -> DataFrame:
    return due.withColumns({"arm": parse.canonical(F.col("arm_text"), codes.ARMS), "template_language": parse.canonical(F.col("language"), codes.LANGUAGES)})


def resolve_templates(due: DataFrame, templates: DataFrame) -> DataFrame:
    """due with message_text and has_placeholder, null where no template fits."""
    wanted = canonical_values(due)
    t = templates.select(F.col("arm"), F.col("language").alias("template_language"), "week", "message_text", "has_placeholder")
    return wanted.join(t, ["arm", "template_language", "week"], "left")


def render_messages(due: DataFrame, templates: DataFrame) -> DataFrame:
    """queue_id, subjid, week, message, outcome: 'ready', or 'skipped' without a template."""
    rows = resolve_templates(due, templates)
    text = F.when(F.col("has_placeholder"), parse.filled(F.col("message_text"), F.col("appointment_date"))).otherwise(F.col("message_text"))
    return rows.select("queue_id", "subjid", "week", text.alias("message"), F.when(F.col("message_text").isNull(), "skipped").otherwise("ready").alias("outcome"))


def attempt_log(rendered: DataFrame, outcomes: DataFrame, now: datetime.datetime) -> DataFrame:
    """Rows to append to the log: one for each message that was tried; sent_at only if it was sent."""
    tried = rendered.filter("outcome = 'ready'").drop("outcome").join(outcomes.filter("outcome in ('sent', 'failed')"), "queue_id")
    sent = F.col("outcome") == "sent"
    return tried.select("queue_id", "subjid", "week", F.col("message").alias("message_text"), F.lit(1).alias("attempt"), F.col("outcome").alias("status"), F.when(sent, F.col("provider_message_id")).alias("provider_message_id"), F.when(sent, F.lit(now)).alias("sent_at"))


def queue_transition(queue: DataFrame, outcomes: DataFrame, dry_run: bool = False) -> DataFrame:
    """The queue after sending; a dry run leaves it as it is."""
    if dry_run:
        return queue
    return queue.join(outcomes.select("queue_id", "outcome"), "queue_id", "left").withColumn("status", F.coalesce("outcome", "status")).drop("outcome")


def campaign_outcome(outcomes: DataFrame, dry_run: bool = False) -> DataFrame:
    """sent, failed, skipped; everything is skipped in a dry run."""
    what = F.lit("skipped") if dry_run else F.col("outcome")
    return outcomes.agg(*[F.count_if(what == s).alias(s) for s in ("sent", "failed", "skipped")])


def receipt_candidates(log: DataFrame) -> DataFrame:
    return log.filter("status = 'sent' and provider_message_id is not null and delivery_status is null").select("log_id", "queue_id", "subjid", "provider_message_id")


def _received(log: DataFrame, receipts: DataFrame) -> DataFrame:
    return receipt_candidates(log).join(receipts.select("provider_message_id", F.col("status").alias("receipt"), F.lit(True).alias("answered")), "provider_message_id", "left")


def apply_receipts(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """The log with terminal receipts written; others stay null and are asked for again."""
    got = _received(log, receipts).filter(F.col("receipt").isin(*codes.TERMINAL)).select("log_id", "receipt")
    return log.join(got, "log_id", "left").withColumn("delivery_status", F.coalesce("delivery_status", "receipt")).drop("receipt")


def receipt_outcome(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """checked, updated, pending, errors (no answer), and whether the run failed: every row checked was an error."""
    rows = _received(log, receipts)
    counts = rows.agg(F.count("*").alias("checked"), F.count_if(F.col("receipt").isin(*codes.TERMINAL)).alias("updated"), F.count_if(F.col("receipt").isNotNull() & ~F.col("receipt").isin(*codes.TERMINAL)).alias("pending"), F.count_if(F.col("receipt").isNull()).alias("errors"))
    return counts.withColumn("run_failed", (F.col("checked") > 0) & (F.col("errors") == F.col("checked")))


def template_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with new's rows in place of those of the same arm, language and week."""
    keys = ["arm", "language", "week"]
    n = new.select(*keys, F.col("message_text").alias("new_text"), F.col("has_placeholder").alias("new_flag"))
    return old.join(n, keys, "full").select(*keys, F.coalesce("new_text", "message_text").alias("message_text"), F.coalesce("new_flag", "has_placeholder").alias("has_placeholder"))


def retry_failed(queue: DataFrame, subjects: DataFrame, week: int | None = None) -> DataFrame:
    """Failed rows of the given subjects (and week) are pending again."""
    wanted = subjects.select("subjid").distinct().withColumn("_again", F.lit(True))
    chosen = F.coalesce("_again", F.lit(False)) & (F.col("status") == "failed") & (F.lit(True) if week is None else F.col("week") == week)
    return queue.join(wanted, "subjid", "left").withColumn("status", F.when(chosen, "pending").otherwise(F.col("status"))).drop("_again")


def constraint_violations(queue: DataFrame, log: DataFrame) -> DataFrame:
    """rule, key, rows: statuses outside their domain and keys that repeat."""
    bad = lambda df, rule, states, key: df.filter(F.col("status").isNull() | ~F.col("status").isin(*states)).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), "key", "rows")
    twice = queue.groupBy(F.concat_ws("-", "subjid", F.col("week").cast("string")).alias("key")).agg(F.count("*").alias("rows")).filter("rows > 1").select(F.lit("queue key").alias("rule"), "key", "rows")
    return bad(queue, "queue status", codes.QUEUE_STATES, "queue_id").unionByName(bad(log, "log status", codes.LOG_STATES, "log_id")).unionByName(twice)
