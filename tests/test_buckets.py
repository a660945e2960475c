"""Stored tables in buckets: what a batch touches, repeats, refuses, and what a common key does."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from regisight.operators import history as H
from regisight.sources import buckets as T
from regisight.sources.tables import LoadRefused

SCHEMA = "k string, v string, start date"


def d(n):
    return date(2000, 1, 1) + timedelta(days=n)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def store(spark, root, data, day, batch, keys=None, **more):
    keys = spark.createDataFrame([(k,) for k in keys], "k string") if keys is not None else None
    return T.synchronise(spark, root, "t", "k", ["v", "start"], rows(spark, data), F.lit(d(day)), batch, keys, **more)


def held(spark, root):
    return sorted((r.k, r.v, str(r.start), str(r.recorded_from), str(r.recorded_to), r.batch_id) for r in T.versions(spark, root, "t").collect())


def files(root):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, fs in os.walk(f"{root}/t/data") for f in fs if f.endswith(".parquet")}


def test_random_batches_equal_a_plain_history(spark, folder):
    rng = random.Random(4)
    want = []  # k, v, start, from, to, batch
    for b in range(4):
        touched = rng.sample([f"k{i}" for i in range(25)] + [None, ""], 8)
        new = {(k, rng.choice("abc"), d(rng.randint(0, 2))) for k in touched if k is not None for _ in range(rng.randint(0, 3))}
        store(spark, folder, [*new, *list(new)[:2]], 100 + b, f"b{b}", touched, buckets=7)
        for r in want:
            if r[4] is None and r[0] in touched and tuple(r[:3]) not in new:
                r[4] = d(100 + b)
        still = {tuple(r[:3]) for r in want if r[4] is None}
        want += [[*n, d(100 + b), None, f"b{b}"] for n in new if n not in still]
        assert held(spark, folder) == sorted((k, v, str(s), str(a), str(z), x) for k, v, s, a, z, x in want)


def test_untouched_buckets_keep_their_files(spark, folder):
    store(spark, folder, [(f"k{i}", "a", d(0)) for i in range(200)], 1, "b1", buckets=16)
    before, at = files(folder), T.state(spark, folder, "t", 16)
    out = store(spark, folder, [("k7", "b", d(0))], 2, "b2")
    assert out == {"buckets": 1, "kept": at.rows[T.OPEN, bucket(spark, "k7")] - 1, "closed": 1, "opened": 1}
    after, now = files(folder), T.state(spark, folder, "t", 16)
    assert before.items() <= after.items() and now.buckets == 16
    changed = {b for (p, b), f in now.files.items() if p == T.OPEN and f != at.files[p, b]}
    assert changed == {bucket(spark, "k7")} and len(at.files) == 16
    assert all("bucket=" + str(bucket(spark, "k7")) in f for f in set(after) - set(before))


def bucket(spark, key):
    return spark.createDataFrame([(key,)], "k string").select(T.bucket_of("k", 16)).first()[0]


def test_a_batch_that_comes_again_changes_nothing(spark, folder):
    first = store(spark, folder, [("a", "1", d(0)), ("b", "1", d(0))], 1, "feed-0")
    assert first["opened"] == 2
    seen, before = held(spark, folder), files(folder)
    assert store(spark, folder, [("a", "2", d(0))], 9, "feed-0") == {"buckets": 0, "kept": 0, "closed": 0, "opened": 0}
    assert held(spark, folder) == seen and files(folder) == before
    again = store(spark, folder, [("a", "1", d(0)), ("b", "1", d(0))], 2, "feed-1")  # the same rows in a new batch
    assert again["closed"] == again["opened"] == 0 and held(spark, folder) == seen


def test_an_attempt_without_its_log_is_not_seen(spark, folder, monkeypatch):
    store(spark, folder, [("a", "1", d(0))], 1, "b1")
    seen = held(spark, folder)
    with monkeypatch.context() as m:
        m.setattr(T, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store(spark, folder, [("a", "2", d(0))], 2, "b2")
    assert held(spark, folder) == seen
    store(spark, folder, [("a", "2", d(0))], 2, "b2")
    assert len(held(spark, folder)) == 2


def test_a_second_writer_is_refused(spark, folder, monkeypatch):
    store(spark, folder, [("a", "1", d(0))], 1, "b1")
    real, once = T.audit, []

    def meanwhile(*a):
        if not once:
            once.append(1)
            store(spark, folder, [("b", "1", d(0))], 2, "other")
        return real(*a)

    monkeypatch.setattr(T, "audit", meanwhile)
    with pytest.raises(LoadRefused, match="meanwhile"):
        store(spark, folder, [("a", "2", d(0))], 2, "b2")
    assert [r[:2] for r in held(spark, folder)] == [("a", "1"), ("b", "1")]


def test_a_store_that_loses_or_changes_versions_is_refused(spark, folder, monkeypatch):
    store(spark, folder, [("a", "1", d(0)), ("a", "2", d(0))], 1, "b1", buckets=1)
    seen = held(spark, folder)
    for spoil in (lambda x: x.filter("v <> '1'"), lambda x: x.withColumn("v", F.lit("9")), lambda x: x.withColumn("recorded_from", F.lit(d(3)))):
        with monkeypatch.context() as m:
            m.setattr(T.H, "synchronise", lambda *a, real=H.synchronise, **b: spoil(real(*a, **b)))
            with pytest.raises(LoadRefused):
                store(spark, folder, [("b", "1", d(0))], 2, "b2")
        assert held(spark, folder) == seen


def test_a_common_key_is_written_in_several_files(spark, folder):
    many = [("hot", f"v{i}", d(0)) for i in range(900)] + [(f"k{i}", "a", d(0)) for i in range(50)]
    store(spark, folder, many, 1, "b1", buckets=4, file_rows=100)
    hot = [f for f in files(folder) if f"bucket={spark.range(1).select(F.pmod(F.xxhash64(F.lit('hot')), F.lit(4))).first()[0]}/" in f]
    assert len(hot) >= 6 and len(held(spark, folder)) == 950
    store(spark, folder, many[1:], 2, "b2", file_rows=100)
    assert [r[:2] for r in held(spark, folder) if r[4] != "None"] == [("hot", "v0")]


def test_insert_new_and_compact(spark, folder):
    add = lambda data, batch: T.insert_new(spark, folder, "ids", "k", spark.createDataFrame(data, "k string, n int"), batch, buckets=3)
    assert add([("a", 1), ("b", 1), ("b", 1), (None, 1)], "b0") == 2
    assert add([("a", 2), ("c", 2)], "b1") == 1 and add([("d", 2)], "b1") == 0 and add([], "b2") == 0
    for i in range(5):
        assert add([(f"x{j}{i}", i) for j in range(6)], f"c{i}") == 6
    read = lambda: sorted((r.k, r.n) for r in T.read_part(spark, folder, "ids", T.ROWS).collect())
    seen = read()
    assert len(seen) == 33 and seen[:3] == [("a", 1), ("b", 1), ("c", 2)]
    done = T.compact(spark, folder, "ids", T.ROWS, many=3)
    assert done and read() == seen and all(len(T.state(spark, folder, "ids", 3).files[T.ROWS, b]) == 1 for b in done)
    assert T.compact(spark, folder, "ids", T.ROWS, many=4) == [] and add([("a", 9), ("new", 9)], "z") == 1


def test_an_empty_table_has_no_versions(spark, folder):
    with pytest.raises(LoadRefused):
        T.versions(spark, folder, "t")
    store(spark, folder, [], 1, "b0")
    with pytest.raises(LoadRefused):
        T.versions(spark, folder, "t")
    with pytest.raises(ValueError):
        T.state(spark, folder, "t", 0)
