import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from regisight.operators import history as H
from regisight.operators import temporal as W

DAY0 = date(2000, 1, 1)


def d(n):
    return None if n is None else DAY0 + timedelta(days=n)


def lookup(intervals, k):
    """Slow restatement: latest start among the covering intervals, then the first one."""
    covering = [(s, -p, v) for s, e, v, p in intervals if s <= k and (e is None or k < e)]
    return max(covering)[2] if covering else None


def test_as_of_with_nested_intervals(spark):
    rng = random.Random(11)
    rows, points, want = [], [], {}
    for key in range(60):
        mine = []
        for p in range(rng.randint(0, 25)):
            s = rng.randint(0, 200)
            e = None if rng.random() < 0.1 else s + rng.choice([0, 1, 3, 30, 400, 5000])
            mine.append((s, e, f"v{p}", p))
            rows.append((key, d(s), d(e), f"v{p}", p))
        for _ in range(30):
            k = rng.randint(-5, 400)
            points.append((key, d(k)))
            want[(key, d(k))] = lookup([x for x in mine if x[1] is None or x[1] > x[0]], k)
    iv = spark.createDataFrame(rows, "k int, start date, end date, value string, pos bigint")
    pts = spark.createDataFrame(points, "k int, day date")
    got = {(r.k, r.day): r.value for r in W.as_of(pts, iv, ["k"]).collect()}
    assert got == want


def test_as_of_over_the_whole_calendar(spark):
    """An open interval holds to the last day, also under nested ones far in the future."""
    iv = spark.createDataFrame([
        ("k", date(2000, 1, 1), None, "open", 0), ("k", date(2500, 1, 1), date(2600, 1, 1), "nested", 1), ("k", date(1, 1, 1), date(1990, 1, 1), "old", 2),
        ("k", date(9000, 1, 1), date(9999, 12, 31), "late", 3)], "k string, start date, end date, value string, pos bigint")
    want = {date(1, 1, 1): "old", date(1995, 1, 1): None, date(2550, 1, 1): "nested", date(2700, 1, 1): "open", date(2900, 1, 1): "open",
            date(9500, 1, 1): "late", date(9999, 12, 31): "open"}
    got = W.as_of(spark.createDataFrame([("k", x) for x in want], "k string, day date"), iv, ["k"])
    assert {r.day: r.value for r in got.collect()} == want
    assert {r.start for r in W.overlap_violations(iv, ["k"]).collect()} == {date(2500, 1, 1), date(9000, 1, 1)}


def test_as_of_of_a_hot_key(spark):
    """A third of all intervals belongs to one key; every point still gets exactly its value."""
    hot = spark.range(20000).select(F.lit(0).cast("bigint").alias("k"), (F.col("id") % 3000).cast("int").alias("s"), "id")
    cold = spark.range(40000).select((F.col("id") + 1).alias("k"), F.lit(5).alias("s"), "id")
    iv = hot.unionByName(cold).select("k", F.date_add(F.lit(DAY0), F.col("s")).alias("start"), F.date_add(F.lit(DAY0), F.col("s") + 1).alias("end"),
                                      F.col("s").cast("string").alias("value"), F.col("id").alias("pos"))
    pts = iv.select("k", F.col("start").alias("day"))
    got = W.as_of(pts, iv, ["k"])
    assert got.count() == 43000
    assert got.filter(F.date_diff("day", F.lit(DAY0)).cast("string") != F.col("value")).count() == 0


def test_as_of_over_small_batches(spark):
    """Keys and points that go on from one batch of the pass to the next; several attributes, NULL keys and days."""
    rng = random.Random(12)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice("xy"), d(s := rng.randint(0, 40)), None if rng.random() < 0.2 else d(s + rng.randint(0, 20)), f"v{p}", p)
            for p in range(150)]
    points = [(k, m, d(n)) for k in ("a", "b", None, "without") for m in (1, 2) for n in range(-2, 70, 3)] + [("a", 1, None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = W.as_of(spark.createDataFrame(points * 2, "k string, m int, day date"), spark.createDataFrame(rows, "k string, m int, attribute string, start date, end date, value string, pos int"),
                      ["k", "m"], attributes=["x", "y"], following="next").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(points)
    n = lambda day: None if day is None else (day - DAY0).days
    for r in got:
        for a in "xy":
            mine = [(n(s), n(e), v, p) for k, m, at, s, e, v, p in rows if (k, m, at) == (r.k, r.m, a) and (e is None or e > s)]
            assert r[a] == (lookup(mine, n(r.day)) if r.day else None)
        later = [p[2] for p in points if p[:2] == (r.k, r.m) and p[2] and (r.day is None or p[2] > r.day)]
        assert r.next == min(later, default=None)


def test_as_of_plan_is_one_pass(spark):
    iv = spark.createDataFrame([("a", d(0), d(9), "v", 0)], "k string, start date, end date, value string, pos bigint")
    plan = W.as_of(iv.select("k", F.col("start").alias("day")), iv, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan and "Window" not in plan


def test_slices_of_a_renamed_subject(spark):
    rows = [("1", "name", d(0), d(100), "Old", 0), ("1", "name", d(100), None, "New", 1), ("1", "form", d(0), None, "112", 0), ("1", "mark", d(-50), d(20), "B 1", 0)]
    iv = spark.createDataFrame(rows, "ico string, attribute string, start date, end date, value string, pos bigint")
    closing = spark.createDataFrame([("1", d(200))], "ico string, closed date")
    got = [tuple(r) for r in W.version_slices(iv, ["ico"], ["name", "form", "mark"], "name", closing).orderBy("start").select(
        "start", "end", "name", "form", "mark", "gone").collect()]
    assert got == [(d(0), d(20), "Old", "112", "B 1", False), (d(20), d(100), "Old", "112", None, False),
                   (d(100), d(200), "New", "112", None, False), (d(200), None, "New", "112", None, True)]


def test_coalesce_keeps_gaps(spark):
    df = spark.createDataFrame([("a", d(0), d(1), "x"), ("a", d(1), d(2), "x"), ("a", d(3), d(4), "x"), ("a", d(4), None, "y")],
                               "k string, start date, end date, v string")
    got = [tuple(r) for r in W.coalesce_adjacent(df, ["k"], ["v"]).orderBy("start").select("start", "end", "v").collect()]
    assert got == [(d(0), d(2), "x"), (d(3), d(4), "x"), (d(4), None, "y")]


def test_clip_and_overlap(spark):
    df = spark.createDataFrame([("a", d(0), None, "x", 0), ("a", d(5), d(9), "y", 1), ("a", d(5), None, "z", 2), ("a", d(8), d(8), "empty", 3)],
                               "k string, start date, end date, v string, pos bigint")
    assert {(r.start, r.overlaps_until, r.rows) for r in W.overlap_violations(df, ["k"]).collect()} == {(d(5), date(9999, 12, 31), 2)}
    clipped = W.clip_overlaps(df, ["k"], ["v"])
    assert sorted((r.start, r.end, r.v, r.clipped, r.replaced) for r in clipped.collect()) == [(d(0), d(5), "x", True, 0), (d(5), None, "z", False, 1)]
    assert W.overlap_violations(clipped, ["k"]).count() == 0


def test_sync_is_idempotent_and_leaves_other_keys_alone(spark):
    content = ["v", "start"]
    stored = spark.createDataFrame([("a", "1", d(0), d(50), 1), ("a", "2", d(1), d(50), 1), ("b", "1", d(0), d(50), 1)],
                                   "k string, v string, start date, recorded_from date, batch_id int")
    new = spark.createDataFrame([("a", "1", d(0)), ("a", "3", d(2)), ("a", "3", d(2))], "k string, v string, start date")
    out = H.synchronise(stored, new, "k", content, F.lit(d(60)), F.lit(2))
    assert sorted((r.k, r.v, r.action) for r in out.collect()) == [("a", "1", "keep"), ("a", "2", "close"), ("a", "3", "insert"), ("b", "1", "keep")]
    again = H.synchronise(out.filter(F.col("recorded_to").isNull()).drop("recorded_to", "action"), new, "k", content, F.lit(d(70)), F.lit(3))
    assert {r.action for r in again.collect()} == {"keep"}


def test_merge_candidates_equal_the_pairs(spark):
    rng = random.Random(2)
    people = [(i, rng.choice(["Jan", "JAN", "Eva"]), rng.choice(["Nová", "Nova", "Malá", "Černá"]), d(rng.randint(0, 6)) if rng.random() < 0.9 else None) for i in range(60)]
    df = spark.createDataFrame(people, "person_id int, first string, last string, born date")
    key = {"Nová": "nova", "Nova": "nova", "Malá": "mala", "Černá": "cerna"}
    want = {a[0] for a in people for b in people if a[3] and a[3] == b[3] and a[1].lower() == b[1].lower() and key[a[2]] != key[b[2]]}
    assert {r.person_id for r in H.merge_candidates(df).collect()} == want
    flags = spark.createDataFrame([(i, i == 0) for i in range(60)], "person_id int, candidate boolean")
    once = H.flag_merge_candidates(df, flags)
    assert {r.person_id for r in once.filter("candidate").collect()} == want | {0}
    assert once.filter("newly").count() == len(want - {0})
    assert H.flag_merge_candidates(df, once.select("person_id", "candidate")).filter("newly").count() == 0
