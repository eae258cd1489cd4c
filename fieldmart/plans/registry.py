"""Every registered query of the engine, each over whole tables of a folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions import parse
from fieldmart.operators import campaign, clean, marts, ordering, quality, reports
from fieldmart.plans import oracle, written
from fieldmart.plans.written_oracle import WRITTEN_SQL
from fieldmart.session import shared_folder, table
from fieldmart.sources import demo, ingest, publish

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
ORACLE_SQL = oracle.ORACLE_SQL | WRITTEN_SQL
Query = Callable[[SparkSession, str], DataFrame]
WEEK_START, WEEK_END = datetime.date(2001, 6, 20), datetime.date(2001, 6, 27)
SENT_AT = datetime.datetime(2001, 6, 30, 8, 0, tzinfo=datetime.UTC)


def _visits(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(demo.visits(spark, d))


def _landed(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(demo.landed(spark, d))


def _silver(f: Callable[[DataFrame], DataFrame]) -> Query:
    return _landed(lambda v: f(clean.silver(v)))


def _prepared(f: Callable[[DataFrame], DataFrame]) -> Query:
    return _visits(lambda v: f(quality.prepared(v, demo.AS_OF)))


def _check(code: str, most: int | None = None) -> Query:
    return _visits(lambda v: quality.check(v, code, demo.AS_OF, most))


def _report(f: Callable[[DataFrame], DataFrame]) -> Query:
    return _visits(lambda v: f(quality.report(v, demo.AS_OF)))


class Campaign:
    """The campaign's tables, derived from a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.people = demo.participants(spark, sf_dir)
        self.opt_outs = demo.opt_outs(self.people)
        self.templates = demo.templates(spark)
        self.queue = campaign.queue_sync(None, self.people, self.opt_outs)
        self.log = demo.message_log(self.queue)
        last = self.log.groupBy("queue_id").agg(F.max("status").alias("outcome"))
        self.sent_queue = campaign.queue_transition(self.queue, last)
        self.receipts = demo.receipts(self.log)
        self.outcomes = demo.outcomes(self.queue)


def _campaign(f: Callable[[Campaign], DataFrame]) -> Query:
    return lambda spark, d: f(Campaign(spark, d))


def _cumulative(c: Campaign) -> DataFrame:
    return reports.cumulative_report(c.log, c.sent_queue, c.people, demo.AS_OF)


def _paths(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(demo.snapshot_paths(spark, d))


def _union(v: DataFrame) -> DataFrame:
    kenya, uganda = v.filter("country = 'kenya'").select("row_id", "country", "consent"), v.filter("country = 'uganda'").select("row_id", "country", "dob")
    return ingest.union_by_name([kenya, uganda])


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    sign = F.when(k % 4 == 0, "=").when(k % 4 == 1, "-").when(k % 4 == 2, "@").otherwise("")
    return publish.csv_safe(table(spark, sf_dir, "part").select("p_partkey", F.concat(sign, "p_name").alias("text")))


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    sheet = table(spark, sf_dir, "part").select(F.concat(F.lit(" arm  "), k.cast("string"), F.lit(" ")).alias("arm"), F.concat(F.lit("  a   b "), "p_name").alias("week_8"), F.when(k % 3 != 0, F.concat("p_name", F.lit(" [date] "))).alias("week_11"))
    return ingest.templates_long(sheet, "English")


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = demo.templates(spark)
    new = old.filter("week = 8").withColumn("message_text", F.upper("message_text"))
    added = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("arm"), F.lit("English").alias("language"), F.lit(8).alias("week"), F.col("p_name").alias("message_text"), F.lit(False).alias("has_placeholder"))
    return campaign.template_upsert(old, new.unionByName(added))


def _violations(c: Campaign) -> DataFrame:
    u = F.substring("subjid", 2, 20).cast("bigint")
    queue = c.queue.withColumn("status", F.when((F.col("week") == 8) & (u % 10 == 3), "lost").otherwise(F.col("status")))
    return campaign.constraint_violations(queue, c.log.withColumn("status", F.when(F.col("attempt") == 2, "open").otherwise(F.col("status"))))


def _corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = demo.snapshot_paths(spark, sf_dir).filter(F.col("archive").endswith(".txt")).select(F.col("archive").alias("file_path"), F.lit("kenya").alias("country"))
    return quality.with_source_errors(quality.report(demo.visits(spark, sf_dir), demo.AS_OF), bad)


def _snapshot(v: DataFrame) -> DataFrame:
    """The day's snapshot as a whole, by half and not there."""
    store = v.withColumn("snapshot_date", F.lit(demo.AS_OF))
    day = demo.AS_OF - datetime.timedelta(days=1)
    out = publish.snapshot_status(v, store, demo.AS_OF).unionByName(publish.snapshot_status(v, store.filter("row_id % 2 = 0"), demo.AS_OF))
    return out.unionByName(publish.snapshot_status(v, store, day))


def _late_queue(c: Campaign) -> DataFrame:
    """The queue that two thirds of the participants and half of the opt-outs give, before the others come."""
    u = F.substring("subjid", 2, 20).cast("bigint")
    queue = campaign.queue_sync(None, c.people.filter(u % 3 != 0), c.opt_outs.filter(u % 2 == 0))
    return campaign.queue_sync(queue, c.people, c.opt_outs)


def _late_opt_outs(c: Campaign) -> DataFrame:
    queue = campaign.queue_sync(None, c.people, c.opt_outs.filter("false"))
    return campaign.apply_opt_outs(queue, c.opt_outs).select("queue_id", "opted_out")


def _new_files(p: DataFrame) -> DataFrame:
    """The ledger lacks some files and has others as of an older time or as not loaded."""
    id_ = F.col("last_modified")
    ledger = p.filter(id_ % 5 != 0).select("file_path", (id_ - F.when(id_ % 7 == 0, 1).otherwise(0)).alias("last_modified"), "loaded")
    return ingest.incremental_new_files(p.select("file_path", "last_modified"), ledger)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's window for every day of the events."""
    return reports.report_window(table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct())


def _ordered(name: str, ties: tuple[str, ...] = ()) -> Query:
    """A registered report with the place of each row in its order."""
    return lambda spark, d: ordering.placed(QUERIES[name](spark, d), [*ordering.ORDERS[name], *ties])


def _export(c: Campaign) -> DataFrame:
    """The line list as exported, read back."""
    folder = shared_folder(c.spark, "exports")
    rows = reports.delivery_linelist(c.log, c.sent_queue, c.people)
    place = publish.report_exports({"delivery_linelist": rows}, folder)["delivery_linelist"]
    return c.spark.read.schema(rows.schema).option("header", "true").option("nullValue", "").csv(place)


QUERIES: dict[str, Query] = {
    "country_filter": _landed(clean.country_filter),
    "dedup_exact": _landed(lambda v: clean.dedup_exact(clean.country_filter(v))),
    "dedup_latest": _landed(lambda v: clean.dedup_latest(clean.dedup_exact(v))),
    "silver_build": _silver(lambda s: s),
    "cleaning_audit": _landed(clean.cleaning_audit),
    "gold_baseline": _silver(marts.baseline),
    "enrollment_mart": _silver(marts.enrolment),
    "qc_summary": _silver(marts.qc_summary),
    "decode_codes": _visits(lambda v: v.select("row_id", parse.facility_label(F.col("health_facility_ke"), "kenya").alias("facility_ke"), parse.facility_label(F.col("health_facility_ug"), "uganda").alias("facility_ug"))),
    "coerce_types": _visits(lambda v: ingest.coerce_types(v.select("row_id", "starttime", "dob", "respondants_age"), ["starttime", "dob"], ["respondants_age"])),
    "union_by_name": _visits(_union),
    "align_schema": _visits(lambda v: ingest.align_schema(v, ["uniqueid", "vdate", "subjid"])),
    "site_groups": _prepared(lambda p: p.groupBy("country", "site").agg(F.count("*").alias("n"))),
    "affected_ids": _prepared(lambda p: p.groupBy("country", "site").agg(quality.ids().alias("affected_subjids"), quality.tablets().alias("affected_tablets"))),
    "issue_rows": _visits(lambda v: quality.issue_rows(v, demo.AS_OF)),
    "similar_phone_pairs": _prepared(quality.similar_phone_pairs),
    "similar_name_pairs": _prepared(quality.similar_name_pairs),
    "issue_examples": _visits(lambda v: quality.issue_examples(v, demo.AS_OF)),
    **{code: _check(code) for code in dict.fromkeys(c[0] for c in [*quality.ROW_CHECKS, *quality.COUNT_CHECKS])},
    **{code: _check(code) for code in ("missing_column", "duplicate_name", "similar_phone", "similar_name", "low_tablet_record_count", "sparse_column")},
    "quality_report": _report(lambda r: r),
    "validation_summary": _report(quality.validation_summary),
    "severity_totals": _report(quality.severity_totals),
    "report_country_filter": _report(lambda r: quality.of_countries(r, ["Uganda"])),
    "report_with_source_errors": _corrupt,
    "latest_snapshot_per_device": _paths(lambda p: ingest.latest_snapshot_per_device(p, ["tablet7"], ["/3.mdb"])),
    "latest_archive_per_device": _paths(ingest.latest_archive_per_device),
    "incremental_new_files": _paths(_new_files),
    "schema_missing_columns": lambda spark, d: ingest.schema_missing_columns(demo.column_types(spark, d)),
    "schema_type_conflicts": lambda spark, d: ingest.schema_type_conflicts(demo.column_types(spark, d)),
    "csv_safe_export": _csv,
    "templates_long": _sheet,
    "snapshot_status": _visits(_snapshot),
    "report_window": _windows,
    "queue_candidates": _campaign(lambda c: campaign.queue_candidates(c.people)),
    "queue_sync": _campaign(_late_queue),
    "apply_opt_outs": _campaign(_late_opt_outs),
    "due_messages": _campaign(lambda c: campaign.due_messages(c.queue, c.log, demo.AS_OF)),
    "canonical_values": _campaign(lambda c: campaign.canonical_values(c.queue).select("queue_id", "arm", "template_language")),
    "resolve_templates": _campaign(lambda c: campaign.resolve_templates(c.queue, c.templates).select("queue_id", "message_text", "has_placeholder")),
    "render_messages": _campaign(lambda c: campaign.render_messages(c.queue, c.templates)),
    "attempt_log": _campaign(lambda c: campaign.attempt_log(campaign.render_messages(c.queue, c.templates), c.outcomes, SENT_AT)),
    "queue_transition": _campaign(lambda c: campaign.queue_transition(c.queue, c.outcomes).select("queue_id", "status")),
    "campaign_outcome": _campaign(lambda c: campaign.campaign_outcome(c.outcomes)),
    "receipt_candidates": _campaign(lambda c: campaign.receipt_candidates(c.log)),
    "apply_receipts": _campaign(lambda c: campaign.apply_receipts(c.log, c.receipts).select("log_id", "delivery_status")),
    "receipt_outcome": _campaign(lambda c: campaign.receipt_outcome(c.log, c.receipts)),
    "template_upsert": _upsert,
    "retry_failed": _campaign(lambda c: campaign.retry_failed(c.sent_queue, c.people.filter(F.substring("subjid", 2, 20).cast("bigint") % 2 == 0)).select("queue_id", "status")),
    "constraint_violations": _campaign(_violations),
    "message_status": _campaign(lambda c: reports.message_status(c.sent_queue, c.log, c.people)),
    "flagged_messages": _campaign(lambda c: reports.flagged_messages(c.log, c.sent_queue, c.people)),
    "latest_attempt": _campaign(lambda c: reports.latest_attempt(c.log, c.sent_queue, c.people)),
    "weekly_report": _campaign(lambda c: reports.weekly_report(c.log, c.sent_queue, c.people, WEEK_START, WEEK_END)),
    "cumulative_report": _campaign(_cumulative),
    "weekly_pivot": _campaign(lambda c: reports.weekly_pivot(_cumulative(c))),
    "weekly_percent": _campaign(lambda c: reports.weekly_percent(_cumulative(c))),
    "delivery_linelist": _campaign(lambda c: reports.delivery_linelist(c.log, c.sent_queue, c.people)),
    "messages_sent": _campaign(lambda c: reports.messages(c.log, c.queue, "sent")),
    "messages_failed": _campaign(lambda c: reports.messages(c.log, c.queue, "failed")),
    "queue_status_counts": _campaign(lambda c: reports.queue_status_counts(c.sent_queue)),
    "delivery_status_week": _campaign(lambda c: reports.delivery_status_week(c.log, demo.AS_OF)),
    "qc_summary_ordered": _ordered("qc_summary"),
    "flagged_messages_ordered": _ordered("flagged_messages"),
    "weekly_report_ordered": _ordered("weekly_report"),
    "delivery_linelist_ordered": _ordered("delivery_linelist"),
    "messages_sent_ordered": _ordered("messages_sent"),
    "similar_name_ordered": _ordered("similar_name", ("row_a", "row_b")),
    "report_export": _campaign(_export),
    "affected_id_parts": _prepared(lambda p: ordering.joined(ordering.id_parts(p, ["country", "site"], "subject"), "; ")),
    "resend_list_parts": _campaign(lambda c: ordering.joined(reports.resend_list_parts(reports.flagged_messages(c.log, c.sent_queue, c.people)), ", ")),
    "percent_cells": _campaign(lambda c: reports.percent_cells(reports.weekly_percent(_cumulative(c)))),
    "message_status_view": _campaign(lambda c: reports.message_status_view(c.sent_queue, c.log, c.people)),
    **written.QUERIES,
    "resend_lists": _campaign(lambda c: reports.resend_lists(reports.flagged_messages(c.log, c.sent_queue, c.people))),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["quality_report"](spark, sf_dir)
