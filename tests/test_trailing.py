import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.operators import prefix, trailing

LAYOUT = T.StructType(
    [T.StructField("user_id", T.StringType()), T.StructField("event_ms", T.LongType()), T.StructField("country_code", T.StringType())]
)


def points(seed, n=300, span=5_000, users=3):
    """A third and more of the rows belong to one user; times repeat and are partly negative."""
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", *[f"u{i}" for i in range(users)]]), rng.randrange(-500, span), rng.choice("ABCDE"))
        for _ in range(n)
    ]


def test_trailing_count_equals_brute_force(spark):
    for seed, window, slab in [(1, 100, 1), (2, 1_000, 1_500), (3, 7, 50), (4, 5_000, 5_000)]:
        rows = points(seed)
        got = {
            (r.user_id, r.event_ms): r.n
            for r in trailing.trailing_count(
                spark.createDataFrame(rows, LAYOUT), ["user_id"], window, slab_ms=slab
            ).collect()
        }
        times = {}
        for user, ms, _ in rows:
            times.setdefault(user, set()).add(ms)
        want = {(u, t): sum(t - window <= x <= t for x in ts) for u, ts in times.items() for t in ts}
        assert got == want, (seed, window, slab)


def test_trailing_distinct_equals_brute_force(spark):
    for seed, window, slab in [(5, 100, 1), (6, 400, 700), (7, 10, 10)]:
        rows = points(seed)
        got = {
            (r.user_id, r.event_ms): (r.n, tuple(r["values"]))
            for r in trailing.trailing_distinct(
                spark.createDataFrame(rows, LAYOUT), ["user_id"], "country_code", window, 3, slab_ms=slab
            ).collect()
        }
        want = {}
        for user, t, _ in rows:
            seen = {c for u, x, c in rows if u == user and t - window <= x <= t}
            if len(seen) >= 3:
                want[user, t] = (len(seen), tuple(sorted(seen)))
        assert got == want, (seed, window, slab)


def test_one_busy_user_spreads_over_slabs(spark):
    rows = spark.range(5_000).select(F.lit("hot").alias("user_id"), (F.col("id") * 1_000).alias("event_ms"))
    counted = trailing.trailing_count(rows, ["user_id"], 60_000, slab_ms=600_000)
    assert counted.agg(F.max("n"), F.count("*")).first() == (61, 5_000)
    slabs = trailing.with_carry(rows, 60_000, slab_ms=600_000).groupBy("slab").count()
    assert slabs.count() == 9 and slabs.agg(F.max("count")).first()[0] <= 661


def test_running_total(spark):
    rng = random.Random(8)
    rows = [(k, rng.randrange(10)) for k in rng.sample(range(-500, 5_000), 400)]
    frame = spark.createDataFrame(rows, "k bigint, v bigint")
    got = {r.k: r.total for r in prefix.running_total(frame, "k", "v", "total", cell=100).collect()}
    want, total = {}, 0
    for k, v in sorted(rows):
        total += v
        want[k] = total
    assert got == want


def test_order_statistics(spark):
    rng = random.Random(9)
    fractions = {"low": 0.0, "mid": 0.5, "p95": 0.95, "p99": 0.99}
    for n in (1, 2, 19, 20, 500):
        values = [rng.randrange(0, 60) ** 3 for _ in range(n)]
        frame = spark.createDataFrame([(v,) for v in values], "v bigint")
        row = prefix.order_statistics(frame, "v", fractions, cell=1_000).first()
        ordered = sorted(values)
        assert (row.n, row["sum"], row["min"], row["max"]) == (n, sum(values), ordered[0], ordered[-1])
        assert [row[name] for name in fractions] == [ordered[int(n * q)] for q in fractions.values()]


def test_order_statistics_of_nothing(spark):
    row = prefix.order_statistics(spark.createDataFrame([], "v bigint"), "v", {"p95": 0.95}).first()
    assert (row.n, row.p95) == (0, None)
