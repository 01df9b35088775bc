"""Intervals, tiers, histories, measures, features, models and streams on small frames."""

import math
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from casework.operators import audit, boosting, clustering, features, history, intervals, metrics, models, routing, sales
from casework.session import scratch_path
from casework.sources.versions import Conflict, VersionedTable
from casework.streaming import jobs, ladder

START = datetime(2024, 1, 1)


def test_conflicts_equal_brute_force_in_a_crowded_room(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        s = START + timedelta(minutes=rng.randrange(5000))
        rows.append((i, "big" if rng.random() < 0.6 else rng.choice("xyz"), s, s + timedelta(minutes=rng.choice([0, 30, 60, 600]))))
    df = spark.createDataFrame(rows, "id int, room string, start timestamp_ntz, end timestamp_ntz")
    want = {
        (a[1], a[0], b[0]) for a in rows for b in rows
        if a[0] < b[0] and a[1] == b[1] and a[2] < b[3] and b[2] < a[3] and a[2] < a[3] and b[2] < b[3]
    }
    for seconds in (1, 60, 3600):
        pairs = [(r.room, r.a, r.b) for r in intervals.interval_conflicts(df, "room", "id", grain_seconds=seconds).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert intervals.conflict_counts(df, "room", "id").groupBy().sum("earlier").first()[0] == len(want)


def test_covers_are_exact_and_logarithmic(spark):
    rng = random.Random(4)
    spans = [(a, a + n) for a in (-9, -1, 0, 1, 7, 2**33 + 5) for n in (0, 1, 2, 5, 63)] + [(a := rng.randrange(-1000, 1000), a + rng.randrange(200)) for _ in range(60)]
    df = spark.createDataFrame(spans, "first long, last long").select("*", intervals.cover(F.col("first"), F.col("last"), F.lit(9)).alias("nodes"))
    for r in df.collect():
        cells = [c for n in r.nodes for c in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(cells) == list(range(r.first, r.last + 1))
        assert len(r.nodes) <= 2 * math.ceil(math.log2(r.last - r.first + 2))


def test_a_year_and_a_minute_meet_in_few_rows(spark):
    rows = [(0, "r", START, START + timedelta(days=365))]
    rows += [(i, "r", START + timedelta(days=i), START + timedelta(days=i, minutes=1)) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "id int, room string, start timestamp_ntz, end timestamp_ntz")
    found = intervals.interval_conflicts(df, "room", "id")
    assert [(r.a, r.b) for r in found.orderBy("b").collect()] == [(0, i) for i in range(1, 200)]
    year = df.where("id = 0").select(F.explode(intervals.cover(intervals._cell("start", 60), intervals._last_cell("end", "start", 60), F.lit(20))))
    assert year.count() <= 40  # hours alone would be 8,760 rows
    other = df.where("id > 0").withColumn("id", F.col("id") + 1000)
    assert intervals.overlapping(df, other, "room", "id").count() == len(rows)
    assert intervals.overlapping(other, df.where("id = 0"), "room", "id").count() == len(rows) - 1


def test_conflict_flags_equal_pairs(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None]), s, s + rng.choice([0, 1, 5, 40]) if s % 7 else None) for i in range(300) for s in [rng.randrange(900)]]
    df = spark.createDataFrame(rows, "id int, room string, start int, end int")
    meet = lambda x, y: x[0] != y[0] and x[1] and x[1] == y[1] and max(x[2], y[2]) < min(x[3], y[3])
    whole = [r for r in rows if r[3] is not None and r[2] < r[3]]
    want = {r[0]: r in whole and any(meet(r, o) for o in whole) for r in rows}
    assert {r.id: r.conflict for r in intervals.in_conflict(df, "room", "id").collect()} == want


def test_tiers(spark):
    tiers = spark.createDataFrame([("s", 1, 99, 48.50), ("s", 100, 499, 44.0), ("s", 500, None, 39.5)], "sku string, lo int, hi int, price double")
    asked = spark.createDataFrame([("s", 500), ("s", 99), ("s", 100), ("s", 0), ("t", 5)], "sku string, quantity int")
    got = {(r.sku, r.quantity): (r.total, r.flag) for r in intervals.tier_lookup(asked, tiers).collect()}
    assert got == {("s", 500): (19750.0, "ok"), ("s", 99): (4801.5, "ok"), ("s", 100): (4400.0, "ok"), ("s", 0): (None, "no_tier"), ("t", 5): (None, "no_tier")}


def test_recurring_four_weeks(spark):
    df = spark.createDataFrame([(1, START, START + timedelta(hours=1))] * 2, "id int, start timestamp_ntz, end timestamp_ntz")
    out = intervals.recurring(df, "id", weeks=4).orderBy("occurrence").collect()
    assert [r.start for r in out] == [START + timedelta(days=7 * i) for i in range(4)]


def test_transcript_parts_keep_every_turn(spark):
    df = spark.range(25).select(F.lit(1).alias("s"), F.col("id").alias("t"), F.lit("user").alias("r"), F.col("id").cast("string").alias("x"))
    out = history.transcript(df, "s", "t", "r", "x", part_turns=10).orderBy("part").collect()
    assert [r.turns for r in out] == [10, 10, 5] and out[2].transcript.startswith("user: 20\n")


@pytest.mark.parametrize("n,turn", [(1, 0), (2, 2)])
def test_clarify_limit(spark, n, turn):
    df = spark.createDataFrame([(1, 0, True), (1, 1, False), (1, 2, True), (1, 3, True)], "s int, t int, low boolean")
    out = history.clarify_limit(df, "s", "t", F.col("low"), n=n).where("hand_over").collect()
    assert [r.t for r in out] == [turn]


def test_reached_stages(spark):
    df = spark.createDataFrame([(s,) for s in ["Discovery", "Proposal", "Closed Won", "Closed Lost"]], "stage string")
    got = {r.stage: (r.reached, r.went_on) for r in sales.reached_stages(df).collect()}
    assert got == {"Discovery": (4, 2), "Proposal": (2, 1), "Negotiation": (1, 1), "Closed Won": (1, None)}


def test_severity_flag(spark):
    df = spark.createDataFrame([("critical", False), ("critical", True), ("high", False)], "severity string, flag boolean").withColumn("ts", F.lit(START))
    out = routing.severity_route(df, "severity", "ts", "flag")
    assert [r.flag_mismatch for r in out.collect()] == [True, False, False]


def test_escalation_wording(spark):
    texts = ["My PASSWORD is lost", "pursue this", "speak to someone", "tell me the rules"]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    assert [bool(r.e) for r in df.select(routing.escalation("q").alias("e")).collect()] == [True, False, True, False]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    pick = lambda d: {r.id for r in features.split(d, 0.3, key="id").where("part = 'test'").collect()}
    assert pick(df.repartition(7)) == pick(df.coalesce(1)) and 0.25 < len(pick(df)) / 2000 < 0.35


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    for options in ({}, {"split_bytes": 0, "segments": 8, "samples": 1}):
        assert metrics.roc_auc(metrics.roc_points(df, **options)).first().auc == pytest.approx(want, abs=1e-6)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        label = i % 2
        rows.append((i, float(rng.normal(label * 2, 1)), float(rng.normal(0, 1)), label))
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    return df.cache(), models.assemble(df, ["a", "b"], F.col("y"), keep=["id"]).cache()


def accuracy(df):
    return df.where("label = prediction").count() / df.count()


def test_models_learn(spark, blobs):
    df, data = blobs
    assert accuracy(models.fit_logistic(data, "l1", C=10).transform(data)) > 0.75
    assert accuracy(models.fit_mlp(data, hidden=(4,), max_iter=60).transform(data)) > 0.75
    assert accuracy(models.fit_stack(data, {"t": models.DecisionTreeClassifier(maxDepth=2), "l": models.LogisticRegression()}, "id", folds=3)(data)) > 0.75
    one, many = (accuracy(boosting.predict(data, boosting.fit(data, rounds=r)[0])) for r in (1, 8))
    assert many >= one > 0.75
    ranks = {r.feature: r["rank"] for r in models.rfe(df, ["a", "b"], F.col("y"), numTrees=5, maxDepth=3).collect()}
    assert ranks == {"a": 1, "b": 2}
    summary = {r.term: r for r in models.logit_summary(data, ["a", "b"]).collect()}
    assert summary["a"].p < 0.001 < summary["b"].p
    table = models.cross_val(data, {"logistic": models.LogisticRegression()}, "id", folds=3)
    assert {r.metric for r in table.collect()} == {"accuracy", "precision", "recall"}


def test_cluster_indices(spark, blobs):
    df, _ = blobs
    with_v = df.withColumn("v", F.array("a", "b"))
    rows = with_v.collect()
    x, y = np.array([r.v for r in rows]), np.array([r.y for r in rows])
    centres = np.array([x[y == k].mean(0) for k in (0, 1)])
    within = sum(((x[y == k] - centres[k]) ** 2).sum() for k in (0, 1))
    between = sum((y == k).sum() * ((centres[k] - x.mean(0)) ** 2).sum() for k in (0, 1))
    assert clustering.calinski_harabasz(with_v, "v", "y") == pytest.approx(between / (within / (len(x) - 2)))
    spread = [np.sqrt(((x[y == k] - centres[k]) ** 2).sum(1)).mean() for k in (0, 1)]
    assert clustering.davies_bouldin(with_v, "v", "y") == pytest.approx(sum(spread) / np.linalg.norm(centres[0] - centres[1]))
    data = clustering.as_features(with_v, "v")
    costs = [r.wcss for r in clustering.elbow(data, range(1, 4)).orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True)
    assert clustering.pca(data, 2)[1].explainedVariance.toArray().sum() == pytest.approx(1)


def test_latency_sketch_is_close(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 5000).cast("double").alias("ms"))
    exact = audit.latency_stats(df, ["g"], "ms", 100).first()
    near = audit.latency_stats(df, ["g"], "ms", 100, exact=False).first()
    assert exact.p95 == pytest.approx(4749.05) and near.p95 == pytest.approx(exact.p95, rel=0.01)


def test_ladder_steps_before_and_after_an_ack(spark):
    jobs.use_rocksdb(spark)
    minute = lambda m: START + timedelta(minutes=m)
    schema = "incident_id long, kind string, severity string, ts timestamp_ntz"
    first = [(1, "incident", "critical", minute(0)), (2, "incident", "high", minute(0)), (3, "incident", "high", minute(0)), (4, "incident", "standard", minute(0))]
    first.append((5, "ack", None, minute(130)))  # comes before its incident
    second = [(1, "ack", None, minute(10)), (2, "ack", None, minute(150)), (5, "incident", "high", minute(0)), (9, "ack", None, minute(900))]
    third = [(3, "incident", "high", minute(901)), (9, "ack", None, minute(2000))]  # reported again after its last step
    folder = scratch_path(spark, "ladder-test")
    for rows in (first, second, third):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.read_stream(spark, folder, spark.read.parquet(folder).schema, "ts", files_per_trigger=1)
    out = scratch_path(spark, "ladder-out")
    writer = ladder.escalation_ladder(stream).writeStream.format("parquet").option("path", out).outputMode("append")
    jobs.run_available(writer, scratch_path(spark, "ladder-checkpoint"))
    got = sorted((r.incident_id, r.step) for r in spark.read.parquet(out).collect())
    assert got == [(1, 0), (2, 0), (3, 0), (3, 1), (5, 0)]


def test_retried_batch_counts_once(spark):
    table = VersionedTable(spark, scratch_path(spark, "versions"), "k")
    write = jobs.versioned_sink(table, lambda df: df)
    write(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), 0)
    write(spark.createDataFrame([(1, "c")], "k int, v string"), 1)
    write(spark.createDataFrame([(1, "c")], "k int, v string"), 1)
    assert [r.v for r in table.read().collect()] == ["c"] and table.versions() == [1, 2]


def test_late_older_change_does_not_win(spark):
    table = VersionedTable(spark, scratch_path(spark, "catalogue"), "k", ["approved"])
    table.apply(spark.createDataFrame([(1, 2, "new"), (None, 1, "none")], "k int, approved int, v string"), "a")
    table.apply(spark.createDataFrame([(1, 1, "old"), (None, 3, "later")], "k int, approved int, v string"), "b")
    assert sorted(r.v for r in table.read().collect()) == ["later", "new"]


def test_document_without_chunks_loses_its_old_ones(spark):
    folder, table = scratch_path(spark, "emptied"), VersionedTable(spark, scratch_path(spark, "emptied-index"), "doc_id")
    for rows in ([(1, "old"), (2, "same")], [(1, "")]):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.read_stream(spark, folder, spark.read.parquet(folder).schema, files_per_trigger=1)
    jobs.run_available(jobs.index_stream(stream, table, lambda df: df.where("text <> ''")), scratch_path(spark, "emptied-checkpoint"))
    assert [tuple(r) for r in table.read().collect()] == [(2, "same")]
    jobs.forget(table, spark.createDataFrame([(2,)], "doc_id long"), "library")
    assert table.read().collect() == []


def loads_of(table):
    return sorted(os.listdir(f"{table.path.removeprefix('file:')}/loads"))


def test_compaction_halves_the_folders_while_a_reader_keeps_its_version(spark):
    table = VersionedTable(spark, scratch_path(spark, "compacted"), "k")
    want = {}
    for i in range(4):
        rows = {k: f"{k}-{i}" for k in range(i, 40, i + 1)}
        gone = [k for k in want if k % 7 == i and k not in rows]
        want = {k: v for k, v in want.items() if k not in gone} | rows
        table.apply(spark.createDataFrame(list(rows.items()), "k int, v string").repartition(3), f"load {i}", spark.createDataFrame([(k,) for k in gone], "k int"))
    reader, version = table.read(), table.versions()[-1]
    assert len(table.manifest().folders) == 4
    table.compact()
    table.apply(spark.createDataFrame([(0, "newest")], "k int, v string"), "load 4")
    assert len(table.manifest().folders) == 2 < 4
    assert dict(map(tuple, reader.collect())) == want == dict(map(tuple, table.read(version).collect()))
    want[0] = "newest"
    assert dict(map(tuple, table.read().collect())) == want
    assert len(table.clean(keep=1)) == 4 and len(loads_of(table)) == 2
    assert dict(map(tuple, table.read().collect())) == want
    base = spark.read.parquet(f"{table.path}/{table.manifest().folders[0]}")
    assert base.where("__deleted").count() == 0 and base.groupBy("k").count().where("count > 1").count() == 0


def test_two_writers_of_one_version_conflict(spark):
    table = VersionedTable(spark, scratch_path(spark, "conflict"), "k")
    with pytest.raises(ValueError, match="no version"):
        table.read()
    first = table.apply(spark.createDataFrame([(1, "a")], "k int, v string"), "a")
    with pytest.raises(Conflict):
        table._publish(first)
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")] and table.compact() == first


def test_a_hot_user_is_spread_over_time(spark):
    jobs.use_rocksdb(spark)
    minute = lambda m: START + timedelta(minutes=m)
    rng = random.Random(8)
    opened = [(i, 1, rng.choice(["critical", "high", "standard"]), minute(rng.randrange(3000))) for i in range(150)]
    answered = [(1, minute(rng.randrange(3000))) for _ in range(40)]
    limits = {"critical": 15, "high": 120}
    want = {i for i, _, s, at in opened if s in limits and not any(at <= a <= at + timedelta(minutes=limits[s]) for _, a in answered)}
    folders = {"i": scratch_path(spark, "hot-incidents"), "a": scratch_path(spark, "hot-acks")}
    schemas = {"i": "id long, user long, severity string, ts timestamp", "a": "user long, ts timestamp"}
    out, checkpoint = scratch_path(spark, "hot-out"), scratch_path(spark, "hot-checkpoint")
    end = minute(100_000)
    for rows in ({"i": opened, "a": answered}, {"i": [(-1, -1, "high", end)], "a": [(-1, end)]}):
        for k, part in rows.items():
            spark.createDataFrame(part, schemas[k]).write.mode("append").parquet(folders[k])
        streams = [jobs.read_stream(spark, folders[k], spark.createDataFrame([], schemas[k]).schema, "ts") for k in ("i", "a")]
        unacked = jobs.unacked_stream(*streams, "user", "ts", limits)
        jobs.run_available(unacked.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint)
    got = [r.id for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) - {-1} == want


class _CountedState:
    """A value or list state that counts its calls."""

    def __init__(self):
        self.value, self.items, self.calls = None, [], 0

    def __getattribute__(self, name):
        if name in ("exists", "get", "update", "clear", "appendValue", "put"):
            object.__setattr__(self, "calls", object.__getattribute__(self, "calls") + 1)
        return object.__getattribute__(self, name)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _CountedList(_CountedState):
    def get(self):
        return iter(self.items)

    def appendValue(self, value):
        self.items.append(value)

    def put(self, values):
        self.items = list(values)

    def clear(self):
        self.items = []


def test_ladder_reads_and_writes_state_once_per_call():
    class Handle:
        registerTimer = staticmethod(lambda at: None)

    class Expiry:
        def __init__(self, minutes):
            self.at = minutes * 60_000

        def getExpiryTimeInMs(self):
            return self.at

    one = ladder.Ladder(ladder.LADDER)
    one.handle, one.open, one.early = Handle(), _CountedState(), _CountedList()
    calls = lambda: one.open.calls + one.early.calls
    rows = pd.DataFrame({"kind": ["ack", "incident"], "severity": ["critical", "critical"], "ts": pd.to_datetime([10, 0], unit="m")})
    got = pd.concat(one.handleInputRows((7,), iter([rows]), None))
    assert got[["incident_id", "severity", "step"]].values.tolist() == [[7, "critical", 0]]
    assert got["due"].tolist() == [pd.Timestamp(0)] and calls() <= 3
    spent = calls()
    assert list(one.handleExpiredTimer((7,), None, Expiry(15))) == [] and calls() - spent <= 1
    spent = calls()
    assert list(one.handleExpiredTimer((7,), None, Expiry(15 + ladder.KEPT_MINUTES))) == [] and calls() - spent <= 2
    assert one.open.value is None


def test_ladder_has_one_timer_at_a_time_and_catches_up():
    class At:
        def __init__(self, minutes):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: minutes * 60_000

    timers = []
    one = ladder.RowLadder(ladder.LADDER)
    one.handle, one.open, one.early = type("Handle", (), {"registerTimer": staticmethod(timers.append)}), _CountedState(), _CountedList()
    event = Row("at", "kind", "severity")
    assert list(one.handleInputRows((7,), iter([event(0, "incident", "high")]), None)) == [] and timers == [120 * 60_000]
    got = list(one.handleExpiredTimer((7,), At(300), At(120)))
    assert [(r.incident_id, r.step, r.due.hour) for r in got] == [(7, 0, 2), (7, 1, 4)]
    forget = (240 + ladder.KEPT_MINUTES) * 60_000
    assert timers == [120 * 60_000, forget]
    assert list(one.handleExpiredTimer((7,), At(240 + ladder.KEPT_MINUTES), At(240 + ladder.KEPT_MINUTES))) == [] and one.open.value is None
    timers.clear()
    assert list(one.handleInputRows((8,), iter([event(0, "incident", "high"), event(60_000, "ack", None)]), None)) == [] and timers == [forget]
