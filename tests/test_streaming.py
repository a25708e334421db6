import random
from datetime import timedelta

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import test_cases
from builders import BASE_MS, START, commands, history, transactions
from txnwatch import schemas as S
from txnwatch.operators import cases, dynamic_rules, rules
from txnwatch.sources import ledger, records, tables
from txnwatch.streaming import jobs, upkeep
from txnwatch.streaming.state import TrailingCounter, count_arrivals


def arrival_model(batches, window):
    """The rule as stated, row by row: add, drop what is older than this row's window, count the rest."""
    kept, counts = set(), []
    for batch in batches:
        for t in batch:
            kept.add(t)
            kept = {x for x in kept if x >= t - window}
            counts.append((t, len(kept)))
    return counts, sorted(kept)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 30))
def test_count_arrivals_equals_the_rule(batches, window):
    kept, got = [], []
    for batch in batches:
        counts, kept = count_arrivals(kept, batch, window)
        got += list(zip(batch, counts))
    assert (got, kept) == arrival_model(batches, window)


def as_stream(spark, folder, frames):
    """One file per frame, read one per micro-batch in the order written."""
    path = f"{folder}/events.parquet"
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return tables.stream_table(spark, str(folder), "events", files_per_batch=1)


def finish(stream, folder, name, **kw):
    query = jobs.to_table(stream, f"{folder}/{name}", f"{folder}/{name}-checkpoint", **kw)
    assert query.awaitTermination(90)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/{name}")


def random_batches(seed, n=3):
    rng = random.Random(seed)
    return [[rng.randrange(0, 200) + 60 * i for _ in range(25)] for i in range(n)]


def arriving(spark, batches):
    """A frame per batch; ``offset`` numbers the rows in order of arrival."""
    frames, offset = [], 0
    for batch in batches:
        rows = [{"id": f"r{offset + i:04d}", "ms": ms} for i, ms in enumerate(batch)]
        frames.append(transactions(spark, rows).withColumn("offset", F.substring("transaction_id", 2, 9).cast("long")))
        offset += len(batch)
    return frames


def test_borders_of_batches_do_not_matter(spark, tmp_path):
    """Rows fold in order of arrival: one batch and three give the alerts of the rule as stated."""
    batches = random_batches(3)
    counts, _ = arrival_model(batches, 50)
    want = sorted(f"{n}회" for _, n in counts if n > 5)
    for name, split in (("three", batches), ("one", [sum(batches, [])])):
        stream = as_stream(spark, tmp_path / name, arriving(spark, split))
        alerts = jobs.high_frequency(stream, threshold=5, window_ms=50, order=("offset",), alert_ts=F.col("event_ts"))
        got = finish(alerts, tmp_path / name, "alerts").collect()
        assert want and sorted(r.reason.rsplit(", ", 1)[1] for r in got) == want


class CountedState:
    """A value of the state that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema, ttl_ms=None):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_state_calls_of_a_user_do_not_follow_its_rows():
    state, counter = CountedState(), TrailingCounter(window_ms=50, threshold=5, ttl_ms=None, timers=False)
    counter.init(state)
    batches = random_batches(8)
    want, kept = arrival_model(batches, 50)
    got = []
    for batch in batches:
        frame = pd.DataFrame({"event_ms": batch, "order0": range(len(batch)), "row": [str(t) for t in batch]})
        # rows come in any order and in several frames
        frame, before = frame.sample(frac=1, random_state=1), state.calls
        for found in counter.handleInputRows(("u",), iter([frame[:9], frame[9:]]), None):
            got += [(int(r.row), r.n) for r in found.itertuples()]
        assert state.calls - before <= 2
    assert got and got == [(t, n) for t, n in want if n > 5] and state.value == (kept,)


def test_rows_fold_in_the_given_order_not_in_that_of_the_file(spark, tmp_path):
    batch = random_batches(3)[0]
    counts, _ = arrival_model([batch], 50)
    mixed = arriving(spark, [batch])[0].repartition(1).sortWithinPartitions(F.xxhash64("offset"))
    stream = as_stream(spark, tmp_path, [mixed])
    alerts = jobs.high_frequency(stream, threshold=2, window_ms=50, order=("offset",), alert_ts=F.col("event_ts"))
    got = sorted((r.original_transaction.transaction_id, r.reason.rsplit(", ", 1)[1]) for r in finish(alerts, tmp_path, "alerts").collect())
    assert got == sorted((f"r{i:04d}", f"{n}회") for i, (_, n) in enumerate(counts) if n > 2)


def test_rows_pass_the_state_unchanged(spark, tmp_path):
    rows = [{"id": f't"{i}\n한', "ms": 1_000 * i, "country": None if i % 2 else "KR"} for i in range(9)]
    given = transactions(spark, rows).withColumn("event_ts", F.timestamp_micros(F.unix_micros("event_ts") + 7))
    stream = as_stream(spark, tmp_path, [given])
    got = finish(jobs.high_frequency(stream, threshold=5, window_ms=50_000, alert_ts=F.col("event_ts")), tmp_path, "alerts")
    want = rules.window_alerts(given, rules.high_frequency(threshold=5, window_ms=50_000), F.col("event_ts"))
    assert want.count() == 4 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_timers_equal_batch_on_ordered_input(spark, tmp_path):
    rng = random.Random(4)
    times = sorted(rng.sample(range(1_000), 90))
    rows = [{"id": f"t{i}", "ms": ms, "user": "user-1" if i % 3 else "user-2"} for i, ms in enumerate(times)]
    frames = [transactions(spark, rows[i : i + 45]) for i in (0, 45)]
    stream = as_stream(spark, tmp_path, frames).withWatermark("event_ts", "5 seconds")
    alerts = jobs.high_frequency(stream, threshold=5, window_ms=100, alert_ts=F.col("event_ts"), time_mode="EventTime")
    got = finish(alerts, tmp_path, "alerts")
    want = rules.window_alerts(
        transactions(spark, rows), rules.high_frequency(threshold=5, window_ms=100), F.col("event_ts")
    )
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("rule", [rules.high_frequency(4, 60_000), rules.multi_country(3, 60_000)])
def test_detection_by_event_time_in_any_order(spark, tmp_path, rule):
    """Rows of one window in different batches, hours late, twice over a slab border."""
    rng = random.Random(6)
    times = [rng.randrange(0, 1_900_000) for _ in range(150)] + [600_000 + 1_000 * i for i in range(-5, 6)]
    rows = [
        {"id": f"t{i}", "ms": ms, "user": f"user-{1 + i % 2}", "country": rng.choice(["KR", "US", "JP", "FR"])}
        for i, ms in enumerate(times)
    ]
    rng.shuffle(rows)
    stream = as_stream(spark, tmp_path, [transactions(spark, rows[i::4]) for i in range(4)])
    job = upkeep.detect(stream, f"{tmp_path}/out", f"{tmp_path}/c", windows=[rule], window_ms=60_000, alert_ts=F.col("event_ts"))
    assert job.awaitTermination(120)
    want = rules.detect(transactions(spark, rows), windows=[rule], alert_ts=F.col("event_ts"))
    got = upkeep.current(spark, want.schema, f"{tmp_path}/out")
    assert want.filter(F.col("rule_name") == rule.name).count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_counts_keep_late_rows_and_last_windows(spark, tmp_path):
    batches = [[0, 9_000, 7_200_000], [4_999, 5_000], [1, 7_200_001]]
    stream = as_stream(spark, tmp_path, arriving(spark, batches))
    assert upkeep.counts(stream, f"{tmp_path}/n", f"{tmp_path}/c").awaitTermination(90)
    got = {r.point_ms - BASE_MS: r.n for r in upkeep.total_counts(spark, f"{tmp_path}/n").collect()}
    assert got == {0: 3, 5_000: 2, 7_200_000: 2}


def test_cases_learn_new_alerts(spark, tmp_path):
    """Alerts and commands arrive mixed, commands before their alert too."""
    log = sorted(test_cases.random_log(21, n=90), key=lambda r: (r["ts"], r["seq"]))
    opening = history(spark, [{}, {}, {}])
    given = as_stream(spark, tmp_path / "commands", [commands(spark, log[i::3]) for i in range(3)])
    alerts = as_stream(spark, tmp_path / "alerts", [opening.filter("alert_id = 'a0001'"), opening.filter("alert_id <> 'a0001'")])
    job = upkeep.case_states(alerts, given, f"{tmp_path}/out", f"{tmp_path}/c")
    assert job.awaitTermination(120)
    want = cases.status_events(opening, commands(spark, log))
    got = upkeep.current(spark, want.schema, f"{tmp_path}/out")
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_recent_table_over_batches(spark, tmp_path):
    rows = [{"alert_timestamp": START + timedelta(seconds=(i * 37) % 250)} for i in range(250)]
    everything = history(spark, rows)
    parts = [everything.filter(F.pmod(F.crc32("alert_id"), F.lit(3)) == i) for i in range(3)]
    query = jobs.to_recent(as_stream(spark, tmp_path, parts), f"{tmp_path}/recent", f"{tmp_path}/c")
    assert query.awaitTermination(90)
    got = jobs.read_recent(spark, f"{tmp_path}/recent", everything.schema)
    assert jobs.read_recent(spark, f"{tmp_path}/nothing", everything.schema).count() == 0
    want = cases.recent(everything)
    assert {r.alert_id for r in got.collect()} == {r.alert_id for r in want.collect()} and got.count() == 100


def test_history_sink_and_dedup(spark, tmp_path):
    rows = history(spark, [{} for _ in range(5)])
    stream = as_stream(spark, tmp_path, [rows, rows])
    assert jobs.to_history(stream, f"{tmp_path}/history", f"{tmp_path}/c").awaitTermination(90)
    assert tables.read_history(spark, f"{tmp_path}/history").count() == 5
    job = upkeep.once(stream, f"{tmp_path}/once", f"{tmp_path}/c2", time="alert_timestamp")
    assert job.awaitTermination(90)
    assert upkeep.current(spark, rows.schema, f"{tmp_path}/once").count() == 5


def test_history_sink_knows_copies_of_other_days(spark, tmp_path):
    days = [history(spark, [{"alert_timestamp": START + timedelta(days=d)} for _ in range(3)]) for d in (0, 1, 40)]
    stream = as_stream(spark, tmp_path, days)
    assert upkeep.once(stream, f"{tmp_path}/once", f"{tmp_path}/c", time="alert_timestamp").awaitTermination(120)
    got = upkeep.current(spark, days[0].schema, f"{tmp_path}/once")
    assert {(r.alert_id, r.alert_timestamp) for r in got.collect()} == {(f"a{i:04d}", START) for i in range(3)}
    assert got.count() == 3


def test_rows_without_a_time_meet_the_stateless_rules(spark, tmp_path):
    rows = transactions(spark, [{"id": f"t{i}", "ms": i * 1000, "country": "US"} for i in range(8)])
    untimed = F.col("transaction_id").isin("t2", "t5")
    rows = rows.withColumns({c: F.when(~untimed, F.col(c)) for c in ("event_ms", "event_ts")})
    stream = as_stream(spark, tmp_path, [rows.limit(4), rows.subtract(rows.limit(4))])
    rule = rules.high_frequency(4, 60_000)
    upkeep.detect(stream, f"{tmp_path}/out", f"{tmp_path}/c", windows=[rule], window_ms=60_000, alert_ts=F.lit(START)).awaitTermination(120)
    want = rules.detect(rows, windows=[rule], alert_ts=F.lit(START))
    got = upkeep.current(spark, want.schema, f"{tmp_path}/out")
    assert got.count() == want.count() == 10
    assert got.exceptAll(want).count() == 0


def test_what_expired_and_what_came_too_late(spark, tmp_path):
    minute = 60_000
    batches = [[0, minute], [30 * minute, 31 * minute], [500, 31 * minute + 1]]
    stream = as_stream(spark, tmp_path, arriving(spark, batches))
    job = upkeep.detect(
        stream, f"{tmp_path}/out", f"{tmp_path}/c", windows=[rules.high_frequency(1, minute, minute)], window_ms=minute,
        slab_ms=minute, alert_ts=F.col("event_ts"), retain=5 * minute,
    )
    assert job.awaitTermination(120)
    layout = rules.detect(transactions(spark, [{}]), alert_ts=F.col("event_ts")).schema
    got = upkeep.current(spark, layout, f"{tmp_path}/out").collect()
    # the pairs of the first minutes have left; the row of the third batch that belongs to them is set aside
    assert sorted(r.original_transaction.transaction_id for r in got) == ["r0003", "r0005"]
    late = upkeep.set_aside(spark, stream.schema, f"{tmp_path}/out").collect()
    assert [r.transaction_id for r in late] == ["r0004"]


def test_a_batch_of_cases_reads_what_it_names(spark, tmp_path, monkeypatch):
    """The alerts known grow fivefold; a batch of three commands reads no more rows than before."""
    read = []
    monkeypatch.setattr(ledger, "BUCKET_ROWS", 20)
    commit = ledger.Batch.commit
    monkeypatch.setattr(ledger.Batch, "commit", lambda self: (read.append(self.rows_read), commit(self))[1])
    log = lambda ids, start: commands(spark, [
        {"alert_id": f"a{i:04d}", "seq": start + k, "ts": START + timedelta(seconds=start + k), "status": "IN_PROGRESS"}
        for k, i in enumerate(ids)
    ])
    every = history(spark, [{} for _ in range(400)])
    bulk = [log(range(80), 0), log(range(80, 400), 1_000)]
    few = [log([3, 50, 70], 500), log([5, 60, 399], 5_000)]
    layout = cases.status_events(every, bulk[0]).schema
    for i, (lo, hi) in enumerate(((0, 80), (80, 400))):
        alerts = as_stream(spark, tmp_path / "alerts", [every.filter(f"alert_id >= 'a{lo:04d}' AND alert_id < 'a{hi:04d}'")])
        for given in (bulk[i], few[i]):
            stream = as_stream(spark, tmp_path / "commands", [given])
            job = upkeep.case_states(alerts, stream, f"{tmp_path}/out", f"{tmp_path}/c")
            assert job.awaitTermination(120)
    want = cases.status_events(every, bulk[0].unionByName(bulk[1]).unionByName(few[0]).unionByName(few[1]))
    got = upkeep.current(spark, layout, f"{tmp_path}/out")
    assert got.count() == want.count() == 406 and got.exceptAll(want).count() == 0
    assert read[3] <= 2 * read[1]


def test_replayed_batch_uses_the_rules_it_used_first(spark, tmp_path, monkeypatch):
    def save(value):
        condition = f'{{"type":"simple","field":"amount","operator":">","value":{value}}}'
        row = ("r1", "RULE", "rule", S.SIMPLE_RULE, "HIGH", True, condition, None, None)
        spark.createDataFrame([row], S.RULES).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/rules")

    def run():
        stream = tables.stream_table(spark, str(tmp_path), "events", files_per_batch=1)
        return jobs.dynamic_rules_to_table(stream, f"{tmp_path}/rules", f"{tmp_path}/out", f"{tmp_path}/c")

    def die(*_, **__):
        raise RuntimeError("executor lost")

    save(100_000)
    as_stream(spark, tmp_path, [transactions(spark, [{"id": "a", "amount": 50_000}, {"id": "b", "amount": 200_000}])])
    with monkeypatch.context() as patch, pytest.raises(StreamingQueryException):
        patch.setattr(dynamic_rules, "dynamic_alerts", die)
        run().awaitTermination(90)
    save(10_000)  # changed before the batch runs again
    assert run().awaitTermination(90)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [r.original_transaction.transaction_id for r in got] == ["b"]
    assert jobs.used_rules(spark, f"{tmp_path}/out").count() == 1


def test_watermark_split_agrees_with_the_windowed_count(spark, tmp_path):
    """Every row is in time or behind; a watermarked count over the rows in time drops none of them."""
    batches = [[0, 60_000, 61_000], [59_000, 50_000, 200_000], [10, 196_000, 190_000, 400_000], [500_000]]
    stream = as_stream(spark, tmp_path, arriving(spark, batches))
    assert jobs.split_by_watermark(stream, f"{tmp_path}/out", f"{tmp_path}/c", delay_ms=5_000).awaitTermination(120)
    rows = jobs.split_rows(spark, stream.schema, f"{tmp_path}/out")
    late = {r.event_ms - BASE_MS for r in rows.filter("late").collect()}
    assert late == {50_000, 10, 190_000} | set() and rows.count() == 11
    kept = [rows.filter(~F.col("late")).filter(F.col("offset").between(*o)).select(stream.columns) for o in ((0, 2), (3, 5), (6, 9), (10, 10))]
    again = as_stream(spark, tmp_path / "kept", kept).withWatermark("event_ts", "5 seconds")
    counted = again.groupBy(F.window("event_ts", "10 seconds")).agg(F.count("*").alias("n"))
    closed = finish(counted, tmp_path, "closed").agg(F.sum("n")).first()[0]
    assert closed == rows.filter(~F.col("late")).count() - 1  # the newest window stays open


def test_live_list_over_batches(spark, tmp_path):
    """Alerts and their changes batch by batch: the merge over everything, cut to the newest."""
    everything = history(spark, [{"alert_timestamp": START + timedelta(seconds=i)} for i in range(150)])
    log = commands(spark, [{"alert_id": f"a{i % 150:04d}", "cmd": "ASSIGN", "assigned_to": f"agent-{i}"} for i in range(0, 300, 7)])
    events, _ = records.decode_status_events(records.encode_status_events(cases.status_events(everything, log), keep=("seq",)))
    wire = records.encode_status_events(cases.status_events(everything, log), keep=("seq",))
    alerts = as_stream(spark, tmp_path / "alerts", [everything, everything.limit(20)])
    changes, _ = records.decode_status_events(as_stream(spark, tmp_path / "changes", [wire.filter("seq < 20"), wire.filter("seq >= 20")]))
    assert jobs.to_live_list(alerts, changes, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination(120)
    want = cases.recent(cases.apply_status_events(everything, events))
    got = jobs.read_recent(spark, f"{tmp_path}/out", everything.schema)
    assert got.count() == 100 and got.exceptAll(want).count() == 0
    assert got.filter("assigned_to IS NOT NULL").count() > 10


def test_latency_join_reports_what_found_nothing(spark, tmp_path):
    txns = transactions(spark, [{"id": f"t{i}", "ms": i * 60_000} for i in range(60)])
    alerts = txns.select(
        F.concat(F.lit("a"), "transaction_id").alias("alert_id"), "transaction_id", (F.col("event_ts") + F.expr("INTERVAL 2 SECONDS")).alias("alert_timestamp")
    )
    few = txns.filter("transaction_id <> 't3'")
    left = as_stream(spark, tmp_path / "a", [alerts.limit(30), alerts.subtract(alerts.limit(30))])
    right = as_stream(spark, tmp_path / "t", [few.limit(29), few.subtract(few.limit(29))])
    got = finish(jobs.join_latency(left, right), tmp_path, "out").collect()
    assert {r.alert_id for r in got if r.event_ts is None} == {"at3"}
    assert all((r.alert_timestamp - r.event_ts).total_seconds() == 2 for r in got if r.event_ts)
    assert len(got) == 60


def test_rule_changes_apply_without_a_restart(spark, tmp_path):
    def save(value):
        condition = f'{{"type":"simple","field":"amount","operator":">","value":{value}}}'
        row = ("r1", "RULE", "rule", S.SIMPLE_RULE, "HIGH", True, condition, None, None)
        spark.createDataFrame([row], S.RULES).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/rules")

    def run():
        stream = tables.stream_table(spark, str(tmp_path), "events", files_per_batch=1)
        query = jobs.dynamic_rules_to_table(stream, f"{tmp_path}/rules", f"{tmp_path}/out", f"{tmp_path}/c")
        assert query.awaitTermination(90)
        return sorted(
            r.original_transaction.transaction_id for r in spark.read.parquet(f"{tmp_path}/out").collect()
        )

    save(100_000)
    as_stream(spark, tmp_path, [transactions(spark, [{"id": "a", "amount": 50_000}, {"id": "b", "amount": 200_000}])])
    assert run() == ["b"]
    save(10_000)
    as_stream(spark, tmp_path, [transactions(spark, [{"id": "c", "amount": 50_000}])])
    assert run() == ["b", "c"]


def test_the_live_list_merges_only_changes_to_its_own_alerts(spark, tmp_path, monkeypatch):
    reached, merge = [], cases.apply_status_events

    def watched(alerts, events):
        reached.append(events.count())
        return merge(alerts, events)

    monkeypatch.setattr(jobs.cases, "apply_status_events", watched)
    rows = history(spark, [{} for _ in range(300)])
    changes = rows.select("alert_id", F.lit(1).cast("long").alias("seq"), F.lit("COMPLETED").alias("status"), F.expr("map('status', 'COMPLETED')").alias("change"))
    for name, some in (("alerts", rows), ("changes", changes)):
        some.write.parquet(f"{tmp_path}/{name}")
    alerts, changes = (spark.readStream.schema(some.schema).parquet(f"{tmp_path}/{name}") for name, some in (("alerts", rows), ("changes", changes)))
    assert jobs.to_live_list(alerts, changes, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination(120)
    got = jobs.read_recent(spark, f"{tmp_path}/out", rows.schema).collect()
    assert reached == [100] and len(got) == 100 and {r.status for r in got} == {"COMPLETED"}


def test_tasks_of_a_batch_of_cases_follow_its_rows(spark, tmp_path, monkeypatch):
    dealt, fold = [], cases.apply_commands

    def watched(alerts, commands, *more):
        dealt.append(int(alerts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return fold(alerts, commands, *more)

    monkeypatch.setattr(upkeep, "TASK_ROWS", 100, raising=False)
    monkeypatch.setattr(upkeep.cases, "apply_commands", watched)
    every = history(spark, [{} for _ in range(300)])
    log = commands(spark, [{"alert_id": f"a{i:04d}", "status": "IN_PROGRESS"} for i in range(300)])
    alerts, given = as_stream(spark, tmp_path / "alerts", [every]), as_stream(spark, tmp_path / "commands", [log])
    assert upkeep.case_states(alerts, given, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination(120)
    want = cases.status_events(every, log)
    got = upkeep.current(spark, want.schema, f"{tmp_path}/out")
    assert dealt == [6] and got.count() == 300 and got.exceptAll(want).count() == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
