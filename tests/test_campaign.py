import datetime

from fieldmart.operators import campaign, reports

DAY = datetime.date(2026, 3, 4)
PEOPLE = "subjid string, mobile_number string, arm_text string, preferred_language_text string, countrycode string, sms_schedule_8weeks string, sms_schedule_11weeks string, dflt_appt_arm_schd_appt_date string, health_facility_ug string"


def people(spark, *rows):
    return spark.createDataFrame(list(rows), PEOPLE)


ANN = ("S1", "0712", "Community benefits", "English", "1", "04/03/2026 00:00:00", "00/00/0000 00:00:00", "10/03/2026 00:00:00", "11")


def test_queue_sync_twice_adds_nothing(spark):
    p = people(spark, ANN, ("S2", "0713", "Incentive", "English", "1", "04/03/2026 00:00:00", None, None, "11"), ("S3", "0714", None, "English", "1", "04/03/2026 00:00:00", None, None, "11"))
    out = spark.createDataFrame([("S1",)], "subjid string")
    once = campaign.queue_sync(None, p, out.limit(0))
    twice = campaign.queue_sync(once, p, out)
    assert [(r.subjid, r.week, r.opted_out) for r in once.collect()] == [("S1", 8, False)]
    assert [(r.subjid, r.week, r.opted_out) for r in twice.collect()] == [("S1", 8, True)]


def test_due_render_and_transition(spark):
    queue = campaign.queue_sync(None, people(spark, ANN), spark.createDataFrame([], "subjid string"))
    log = spark.createDataFrame([], "subjid string, week int, status string")
    due = campaign.due_messages(queue, log, DAY)
    templates = spark.createDataFrame([("Community benefits", "English", 8, "Come [date]", True)], "arm string, language string, week int, message_text string, has_placeholder boolean")
    assert [(r.message, r.outcome) for r in campaign.render_messages(due, templates).collect()] == [("Come 10/03/2026", "ready")]
    assert [r.outcome for r in campaign.render_messages(due, templates.limit(0)).collect()] == ["skipped"]
    outcomes = due.selectExpr("queue_id", "'sent' as outcome")
    assert campaign.queue_transition(queue, outcomes).first().status == "sent"
    assert campaign.queue_transition(queue, outcomes, dry_run=True).first().status == "pending"
    assert campaign.campaign_outcome(outcomes, dry_run=True).first().skipped == 1
    sent = spark.createDataFrame([("S1", 8, "sent")], "subjid string, week int, status string")
    assert campaign.due_messages(queue, sent, DAY).count() == 0


LOG = "log_id string, queue_id string, subjid string, week int, status string, provider_message_id string, delivery_status string, sent_at timestamp, error_message string"


def test_receipts(spark):
    log = spark.createDataFrame([("1", "q", "S1", 8, "sent", "a", None, None, None), ("2", "q", "S1", 8, "sent", "b", None, None, None), ("3", "q", "S1", 8, "sent", "c", None, None, None)], LOG)
    receipts = spark.createDataFrame([("a", "DELIVERED"), ("b", "PENDING"), ("c", None)], "provider_message_id string, status string")
    assert tuple(campaign.receipt_outcome(log, receipts).first()) == (3, 1, 1, 1, False)
    assert sorted((r.log_id, r.delivery_status) for r in campaign.apply_receipts(log, receipts).collect()) == [("1", "DELIVERED"), ("2", None), ("3", None)]
    assert campaign.receipt_outcome(log, receipts.selectExpr("provider_message_id", "cast(null as string) as status")).first().run_failed


def test_weekly_percent(spark):
    counts = spark.createDataFrame([("11", 8, 6, 5, 4, 1, 0), ("12", 8, 0, 0, 0, 0, 0)], "health_facility_ug string, week int, due long, submitted long, delivered long, undelivered long, pending long")
    cells = {(r.metric, r.site): r.cell for r in reports.percent_cells(reports.weekly_percent(counts)).collect()}
    assert cells["submitted", "11"] == "5 (83.3%)" and cells["delivered", "11"] == "4 (80.0%)" and cells["undelivered", "11"] == "1 (20.0%)" and cells["pending", "11"] == "0 (0.0%)"
    assert cells["submitted", "12"] == "" and cells["due", "12"] == "0"
    assert reports.weekly_pivot(counts).filter("metric = 'submitted'").first().total == 5


def test_report_window(spark):
    days = [datetime.date(2026, 3, 1) + datetime.timedelta(days=i) for i in range(14)]
    for r in reports.report_window(spark.createDataFrame([(d,) for d in days], "day date")).collect():
        tuesday = max(d for d in (r.day - datetime.timedelta(days=i) for i in range(7)) if d.weekday() == 1)
        assert (r.week_start, r.week_end, r.sent_end) == tuple(tuesday + datetime.timedelta(days=i) for i in (-6, 1, 2))



def test_constraint_violations(spark):
    queue = spark.createDataFrame([("a", "S1", 8, "lost"), ("b", "S1", 8, "sent")], "queue_id string, subjid string, week int, status string")
    log = spark.createDataFrame([("1", "sent")], "log_id string, status string")
    assert sorted(tuple(r) for r in campaign.constraint_violations(queue, log).collect()) == [("queue key", "S1-8", 2), ("queue status", "a", 1)]
