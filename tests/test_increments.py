"""Late rows, bucketed folds with two writers, and open sessions on a stream."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from pitfeat.sources.buckets import BucketedTable
from pitfeat.streaming import incremental as inc
from pitfeat.streaming import open_sessions as so
from pitfeat.streaming.sessions import run_to_table

GAP = 100
SESSIONS = ["k", "session_start", "session_end", "number_of_hits"]


def frame(spark, rows):
    d = spark.createDataFrame(rows, "k long, s double")
    return d.withColumn("t", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))


def found(df):
    return sorted(map(tuple, df.select(*SESSIONS).collect()))


@pytest.mark.parametrize("slice_rows", [None, 20])
def test_late_rows_equal_one_run(spark, slice_rows):
    r = random.Random(4)
    rows = [(r.randrange(4), float(r.randrange(6000))) for _ in range(300)] + [(9, 5.0), (9, 5.0), (None, 1.0), (1, None)]
    r.shuffle(rows)  # the order of arrival has nothing to do with time
    table = inc.session_table(frame(spark, rows[:100]), ["k"], "t", GAP)
    for part in (rows[100:101], rows[101:250], rows[250:]):
        table = inc.refresh_with_late_rows(table, frame(spark, part), ["k"], "t", GAP, slice_rows)
        table = spark.createDataFrame(table.collect(), table.schema)
    assert found(table) == found(inc.session_table(frame(spark, rows), ["k"], "t", GAP))


def test_only_touched_sessions_are_reopened(spark):
    base = frame(spark, [(1, 0.0), (1, 500.0), (1, 700.0), (1, 2000.0), (2, 0.0)])
    table = inc.session_table(base, ["k"], "t", GAP)
    # a row between two sessions joins them (600 is 100 s from both), one lies too far from any
    late = frame(spark, [(1, 600.9), (1, 1000.0)])
    merged = inc.merge_sessions(table, inc.session_table(late, ["k"], "t", GAP), ["k"], GAP)
    got = {(r.session_start.timestamp(), r.session_end.timestamp(), r.number_of_hits, r.reopened) for r in merged.collect()}
    assert got == {(0, 0, 1, False), (500, 700, 3, True), (1000, 1000, 1, True), (2000, 2000, 1, False)}
    again = inc.rows_of_sessions(base.unionByName(late), merged.where("reopened"), ["k"], "t")
    assert sorted(r.s for r in again.collect()) == [500, 600.9, 700, 1000]


def fold(stored, delta):
    new = delta.groupBy("k").agg(F.count("*").alias("n"))
    both = new if stored is None else stored.unionByName(new)
    return both.groupBy("k").agg(F.sum("n").alias("n"))


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "k")


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    assert table.read() is None and table.version() == 0
    assert table.fold(numbers(spark, 100), fold, "q", 0)
    assert not table.fold(numbers(spark, 100), fold, "q", 0)
    few = numbers(spark, 2)
    before, mine = table.manifest(), table.touched(few)
    assert table.fold(few, fold, "q", 1)
    after = table.manifest()
    changed = {int(b) for b in after["buckets"] if after["buckets"][b] != before["buckets"][b]}
    assert changed == set(mine) and len(mine) < 8
    assert {r.k: r.n for r in table.read().collect()} == {k: 2 if k < 2 else 1 for k in range(100)}
    assert table.read(version=1).agg(F.sum("n")).first()[0] == 100  # an older version stays readable
    assert table.fold(numbers(spark, 0), fold, "q", 2) and table.read().count() == 100
    # nothing young is cleared away; of old folders those that the newest version does not name are
    assert table.vacuum(keep=1) == 0
    assert table.vacuum(keep=1, older_than_s=0) == 0  # the first folder still holds the untouched buckets
    table.fold(numbers(spark, 100), fold, "q", 3)
    assert table.vacuum(keep=1, older_than_s=0) == 2 and table.read().count() == 100
    with pytest.raises(ValueError):
        BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=9).read()
    with pytest.raises(ValueError):  # keys must stay in the buckets they were read from
        table.fold(few, lambda stored, delta: numbers(spark, 100).withColumn("n", F.lit(1).cast("long")))


def test_two_writers_lose_nothing(spark, tmp_path):
    """One writer commits while the other is folding: in the same bucket, then in another."""
    path = str(tmp_path / "t")
    one, two = (BucketedTable(spark, path, ["k"], buckets=8) for _ in range(2))
    one.fold(numbers(spark, 50), fold)
    for other, again in ((numbers(spark, 50), 2), (None, 1)):
        if other is None:
            mine = set(one.touched(numbers(spark, 1)))
            other = next(d for k in range(1, 50) for d in [numbers(spark, 50).where(F.col("k") == k)]
                         if not mine & set(two.touched(d)))
        folds, before = [], {r.k: r.n for r in one.read().collect()}

        def slow(stored, delta):
            out = fold(stored, delta)
            if not folds:
                assert two.fold(other, fold)
            folds.append(1)
            return out

        assert one.fold(numbers(spark, 1), slow)
        assert len(folds) == again  # a bucket that both changed is folded again, others are not
        got = {r.k: r.n for r in one.read().collect()}
        theirs = {r.k for r in other.collect()}
        assert got == {k: n + (k in theirs) + (k == 0) for k, n in before.items()}


def test_writers_in_threads(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    runs = [threading.Thread(target=lambda i=i: table.fold(numbers(spark, 10), fold, f"q{i}", 0)) for i in range(4)]
    for t in runs:
        t.start()
    for t in runs:
        t.join()
    assert {r.k: r.n for r in table.read().collect()} == dict.fromkeys(range(10), 4)
    assert table.version() == 4 and len(table.manifest()["marks"]) == 4


def test_spans():
    assert so.spans(so.np.array([0, 1_900_000, 5_000_000, 4_999_999]), 2) == [(0, 1_900_000, 2), (4_999_999, 5_000_000, 2)]
    assert so.joined([(8, 9, 1), (0, 2, 3)], 0) == [(0, 9, 4)]
    assert so.joined([(5_000_000, 6_000_000, 1), (0, 2_000_000, 3)], 2) == [(0, 2_000_000, 3), (5_000_000, 6_000_000, 1)]


def test_open_sessions_and_corrections(spark, tmp_path):
    other = so.stateful_session(spark)
    folder, log_folder = str(tmp_path / "in"), str(tmp_path / "log")
    schema = frame(spark, [(1, 0.0)]).schema
    read = []
    for part in ([(1, 100.0), (1, 150.0), (1, 400.0), (2, 100.0), (None, 5.0), (1, None)],
                 [(1, 50.0), (1, 275.0), (2, 5000.0)],  # late: before the first, and between the two
                 [(2, 9000.0)], [(2, 9001.0)]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
        log = so.session_log(inc.read_stream(other, folder, schema), ["k"], "t", GAP, "1000 seconds")
        run_to_table(log, log_folder, str(tmp_path / "cp"))
        state = so.sessions_so_far(spark.read.schema(log.schema).parquet(log_folder), ["k"])
        read.append({(r.k, r.session_start.timestamp(), r.session_end.timestamp(), r.number_of_hits, r.final)
                     for r in state.collect()})
    assert read[0] == {(1, 100, 150, 2, False), (1, 400, 400, 1, False), (2, 100, 100, 1, False)}
    # 275 is 125 s from both, so it stays alone; 50 moves the start of the first session
    assert {x[:4] for x in read[1]} == {(1, 50, 150, 3), (1, 275, 275, 1), (1, 400, 400, 1), (2, 100, 100, 1), (2, 5000, 5000, 1)}
    closed = {x[:4] for x in read[3] if x[4]}
    assert closed >= {(1, 50, 150, 3), (1, 400, 400, 1), (2, 100, 100, 1), (2, 5000, 5000, 1)}
    assert {x[:4] for x in read[3] if not x[4]} == {(2, 9000, 9001, 2)}


class Trips:
    """State and timers of one key in memory; counts what would be trips to the executor."""

    def __init__(self):
        self.value, self.timers, self.made = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.made += 1
        return self.value

    def update(self, value):
        self.made += 1
        self.value = value

    def registerTimer(self, at):
        self.made += 1
        self.timers.add(at)


class Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_a_key_costs_few_trips_however_many_sessions(spark):
    log, kept = so.SessionLog(["k"], "t", 10), Trips()
    log.init(kept)

    def come(at, mark):
        return [(r.session_start.timestamp(), r.number_of_hits, r.status, r.revision) for r in log.handleInputRows(
            (1,), iter([so.Row(k=1, t=so._time(a * 1_000_000)) for a in at]), Mark(mark))]

    def pass_to(mark):
        out, fired = [], sorted(t for t in kept.timers if t <= mark)
        for t in fired:
            out += [(r.session_start.timestamp(), r.status) for r in log.handleExpiredTimer((1,), Mark(mark), Mark(t))]
            kept.timers.discard(t)
        return out

    assert len(come([100 * i for i in range(1, 501)], 0)) == 500
    assert kept.made <= 3  # one read, one write, one timer
    # a late row ends before all others, another joins the first session
    assert come([20, 105], 0) == [(20, 1, "provisional", 1), (100, 2, "provisional", 1)]
    assert pass_to(29_000) == []
    assert pass_to(216_000) == [(20, "final"), (100, "final"), (200, "final")]
    assert min(kept.timers) == 311_000
    assert len(pass_to(60_000_000)) == 498 and not kept.timers
    # a key whose sessions all ended starts again, with a timer of its own
    assert come([70_000], 60_000_000)[0][:3] == (70_000, 1, "provisional")
    assert kept.timers == {70_011_000} and pass_to(70_011_000) == [(70_000, "final")]
