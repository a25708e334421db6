import random
from datetime import timedelta

from pyspark.sql import functions as F

from builders import START, commands, history
from txnwatch import schemas as S
from txnwatch.operators import cases
from txnwatch.sources import records


def after(spark, *log, **alert):
    folded = cases.apply_commands(history(spark, [alert]), commands(spark, list(log)))
    return folded.first()


def test_transitions_and_first_completion(spark):
    row = after(spark, {"status": "COMPLETED"}, {"status": "IN_PROGRESS"}, {"status": "COMPLETED"})
    assert (row.status, row.processed_at) == ("COMPLETED", START)
    row = after(spark, {"status": "COMPLETED"}, {"status": "UNREAD"})
    assert (row.status, row.processed_at) == ("UNREAD", START)
    kept = START - timedelta(days=1)
    assert after(spark, {"status": "COMPLETED"}, processed_at=kept).processed_at == kept


def test_limits(spark):
    def to(text):
        return {"cmd": "ASSIGN", "assigned_to": text}

    def note(text, complete=False):
        return {"cmd": "ACTION", "action_note": text, "complete": complete}

    assert after(spark, to("x" * 100)).assigned_to == "x" * 100
    assert after(spark, to("old"), to("x" * 101)).assigned_to == "old"
    assert after(spark, to("old"), to(None)).assigned_to is None
    assert after(spark, note("y" * 2000)).action_note == "y" * 2000
    assert after(spark, note("old"), note("y" * 2001), note(""), note(None)).action_note == "old"
    done = after(spark, note("fixed", complete=True))
    assert (done.status, done.processed_at, done.action_note) == ("COMPLETED", START, "fixed")
    assert after(spark, {"status": "NO_SUCH"}, {"status": None}).status == "UNREAD"


def test_outer_interface_rejects_empty_assignee(spark):
    log = commands(spark, [{"cmd": "ASSIGN", "assigned_to": "kim"}, {"cmd": "ASSIGN"}, {"cmd": "ASSIGN", "assigned_to": ""}])
    alerts = history(spark, [{}])
    assert cases.apply_commands(alerts, log, require_assignee=True).first().assigned_to == "kim"
    assert cases.apply_commands(alerts, log).first().assigned_to == ""


def test_unknown_alert_has_no_effect(spark):
    log = commands(spark, [{"alert_id": "nobody", "status": "COMPLETED"}, {"alert_id": "", "status": "COMPLETED"}])
    alerts = history(spark, [{}])
    assert cases.apply_commands(alerts, log).first().status == "UNREAD"
    assert cases.status_events(alerts, log).count() == 0


def random_log(seed, n=200, alerts=4):
    rng = random.Random(seed)
    log = []
    for i in range(n):
        row = {"alert_id": f"a{rng.randrange(alerts):04d}" if rng.random() < 0.6 else "a0000",
               "ts": START + timedelta(seconds=rng.randrange(40) * 400), "cmd": rng.choice(["STATUS", "ASSIGN", "ACTION"])}
        if row["cmd"] == "STATUS":
            row["status"] = rng.choice([*S.STATUSES, "BAD"])
        elif row["cmd"] == "ASSIGN":
            row["assigned_to"] = rng.choice(["kim", "lee", None, "z" * 101])
        else:
            row["action_note"], row["complete"] = rng.choice(["n1", "n2", "", None]), rng.random() < 0.3
        log.append({**row, "seq": i})
    return log


def replay(log, alerts):
    """The command rules applied one by one."""
    state = {a: ["UNREAD", None, None, None] for a in alerts}
    events = {}
    for row in sorted(log, key=lambda r: (r["ts"], r["seq"])):
        case = state.get(row["alert_id"])
        if case is None:
            continue
        status = None
        if row["cmd"] == "STATUS":
            status = row["status"]
            if status not in S.STATUSES:
                continue
        elif row["cmd"] == "ASSIGN":
            if row["assigned_to"] is not None and len(row["assigned_to"]) > 100:
                continue
            case[1] = row["assigned_to"]
        else:
            if not row["action_note"]:
                continue
            case[2] = row["action_note"]
            status = "COMPLETED" if row["complete"] else None
        case[0] = status or case[0]
        if status == "COMPLETED" and case[3] is None:
            case[3] = row["ts"]
        events[row["seq"]] = (row["alert_id"], *case)
    return state, events


def test_fold_and_events_equal_replay(spark):
    log = random_log(11)
    alerts = history(spark, [{} for _ in range(3)])  # the fourth id is unknown
    state, events = replay(log, ["a0000", "a0001", "a0002"])
    frame = commands(spark, log)
    for slab in (1_000, 3_600_000, 10**9):
        got = {
            r.seq: (r.alert_id, r.status, r.assigned_to, r.action_note, r.processed_at)
            for r in cases.status_events(alerts, frame, slab_ms=slab).collect()
        }
        assert got == events, slab
    folded = cases.apply_commands(alerts, frame).collect()
    assert {r.alert_id: [r.status, r.assigned_to, r.action_note, r.processed_at] for r in folded} == state


def test_status_event_wire_format(spark):
    log = commands(spark, [{"status": "IN_PROGRESS"}, {"status": "COMPLETED"}, {"cmd": "ASSIGN", "assigned_to": "kim"}])
    events = cases.status_events(history(spark, [{}]), log)
    values = [r.value for r in records.encode_status_events(events, keep=("seq",)).orderBy("seq").collect()]
    assert values == [
        '{"alertId":"a0000","status":"IN_PROGRESS"}',
        '{"alertId":"a0000","status":"COMPLETED","processedAt":"2025-11-06T10:00:01.000Z"}',
        '{"alertId":"a0000","status":"COMPLETED","processedAt":"2025-11-06T10:00:01.000Z","assignedTo":"kim"}',
    ]


def test_merge_keeps_absent_keys(spark):
    texts = [
        '{"alertId":"a0000","status":"COMPLETED","processedAt":"2025-11-06T11:00:00.000Z","assignedTo":"kim"}',
        '{"alertId":"a0000","status":"IN_PROGRESS","assignedTo":null,"processedAt":""}',
        '{"status":"UNREAD"}',
        "not json",
    ]
    wire = spark.createDataFrame(list(enumerate(texts)), "seq bigint, value string")
    events, rejected = records.decode_status_events(wire)
    assert rejected.count() == 2 and {r.type for r in events.collect()} == {S.STATUS_EVENT_TYPE}
    row = cases.apply_status_events(history(spark, [{"action_note": "n"}]), events).first()
    assert (row.status, row.assigned_to, row.action_note) == ("IN_PROGRESS", None, "n")
    assert row.processed_at == START + timedelta(hours=1)


def test_recent_list_keeps_the_newest_hundred(spark):
    alerts = history(spark, [{} for _ in range(101)])
    ids = [r.alert_id for r in cases.recent(alerts).collect()]
    assert len(ids) == 100 and ids[0] == "a0100" and "a0000" not in ids
    assert cases.recent(alerts, 0).count() == cases.recent(alerts, -5).count() == 0
    assert cases.recent(alerts, 10_000).count() == 100


def test_filters_apply_after_the_cut(spark):
    alerts = history(spark, [{"status": "COMPLETED" if i == 0 else "UNREAD"} for i in range(101)])
    assert cases.list_alerts(alerts, status="COMPLETED").count() == 0
    assert cases.list_alerts(alerts, status=None).count() == 0


def test_assignee_filter(spark):
    alerts = history(spark, [{"assigned_to": f"agent-{i % 10}"} for i in range(100)])
    assert cases.list_alerts(alerts, assigned_to="agent-3").count() == 10
    assert cases.list_alerts(alerts, assigned_to="AGENT-3").count() == 0
    assert cases.list_alerts(alerts, assigned_to="").count() == cases.list_alerts(alerts, assigned_to=None).count() == 0
    # the first given filter alone, and an empty assignee counts as not given
    assert cases.list_alerts(alerts, status="UNREAD", assigned_to="agent-3", precedence=True).count() == 100
    assert cases.list_alerts(alerts, assigned_to="", severity="HIGH", precedence=True).count() == 100


def test_severity_order(spark):
    alerts = history(spark, [{"severity": s} for s in ["LOW", "odd", "CRITICAL", "medium", "HIGH", None, "HIGH"]])
    found = [(r.severity, r.alert_id) for r in cases.list_alerts(alerts, sort_by="Severity").collect()]
    assert [s for s, _ in found] == ["CRITICAL", "HIGH", "HIGH", "medium", "LOW", None, "odd"]
    assert found[1][1] > found[2][1]


def test_lookup_and_new_only(spark):
    alerts = history(spark, [{} for _ in range(3)])
    assert cases.find(alerts, "a0001").count() == 1
    assert cases.find(alerts, None).count() == cases.find(alerts, "").count() == cases.find(alerts, "zz").count() == 0
    fresh = cases.new_only(alerts.unionByName(alerts), alerts.filter(F.col("alert_id") == "a0000"))
    assert sorted(r.alert_id for r in fresh.collect()) == ["a0001", "a0002"]
