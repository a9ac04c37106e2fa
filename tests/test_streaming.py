import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from tabwright import FeatureLookup, FeatureSpec
from tabwright.operators.lookup import point_in_time_lookup
from tabwright.operators.metrics import classifier_evaluation
from tabwright.plans import training
from tabwright.session import work_path
from tabwright.sources import registry
from tabwright.sources.commits import CommitLog
from tabwright.streaming import scoring
from tabwright.streaming.lookup import PROVIDER, point_in_time_stream

SPEC = FeatureSpec(("x",), (), "label", ("id",))
PARAMS = {"eta": 0.3, "max_depth": 2, "min_child_weight": 1.0, "subsample": 1.0, "colsample_bytree": 1.0}


def rows_of(spark, low, high):
    return spark.range(low, high).select("id", (F.col("id") % 10).cast("double").alias("x"))


def fitted(spark, flip):
    df = rows_of(spark, 0, 100).withColumn("label", ((F.col("x") > 4) != F.lit(flip)).cast("int"))
    return training.fit_classifier(df, SPEC, PARAMS, training.boosted_trees(trees=2))


@pytest.fixture(scope="module")
def two_models(spark):
    return fitted(spark, False), fitted(spark, True)


def registered(spark, models):
    found = registry.ModelRegistry(spark, work_path(spark, "registry"), "m")
    return found, [found.register(m, registry.signature_of(rows_of(spark, 0, 1))) for m in models]


# --- the log of commits ---------------------------------------------------------------


def test_numbers_never_change_whatever_the_clocks_say(spark, two_models, monkeypatch):
    models, (first,) = registered(spark, two_models[:1])
    models.set_alias("champion", first)

    class Early(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return dt.datetime(2001, 1, 1, tzinfo=tz)

    monkeypatch.setattr(registry, "datetime", Early)
    second = models.register(two_models[1], "{}")
    models.set_alias("champion", second)
    models.set_alias("champion", first)
    monkeypatch.undo()
    assert (first, second) == (1, 2)
    versions = {r["version"]: r for r in models.versions().collect()}
    assert versions[2]["ts"] < versions[1]["ts"]
    assert models.version_of("champion") == 1 and models.latest_version() == 2
    alias = models.aliases().first()
    assert alias["path"] == versions[1]["path"] != versions[2]["path"]


def test_writers_at_once_get_numbers_of_their_own(spark):
    path = work_path(spark, "log")
    got, problems = [], []

    def write(name):
        try:
            log = CommitLog(spark, path, "who string, of long")
            for _ in range(3):
                record = log.append(lambda rows: {"who": name, "of": rows.count() + 1})
                got.append((record["number"], name))
        except Exception as error:  # seen by the test, not swallowed
            problems.append(error)

    writers = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not problems
    assert sorted(n for n, _ in got) == list(range(1, 13))
    rows = CommitLog(spark, path, "who string, of long").rows().collect()
    # what was returned is what is stored, and each was made knowing all before it
    assert sorted((r["number"], r["who"]) for r in rows) == sorted(got)
    assert all(r["of"] == r["number"] for r in rows)


def test_an_empty_log_has_no_rows(spark):
    log = CommitLog(spark, work_path(spark, "log"), "a int")
    assert log.last() == 0 and log.rows().columns == ["number", "a"] and log.rows().count() == 0


# --- scoring that follows an alias ----------------------------------------------------


def test_a_stream_follows_the_alias_and_repeats_nothing(spark, two_models):
    models, versions = registered(spark, two_models)
    source, out, checkpoint = (work_path(spark, n) for n in ("source", "scored", "checkpoint"))

    def run():
        stream = scoring.parquet_stream(spark, source, rows_of(spark, 0, 1).schema)
        scoring.score_stream_by_alias(stream, models, "champion", SPEC, out, checkpoint).awaitTermination()
        rows = spark.read.parquet(out).select("id", "prediction", "model_version").collect()
        assert len({r["id"] for r in rows}) == len(rows)
        return {r["id"]: (r["prediction"], r["model_version"]) for r in rows}

    def expected(low, high, version):
        scored = training.score(two_models[version - 1], rows_of(spark, low, high), SPEC)
        return {r["id"]: (r["prediction"], version) for r in scored.collect()}

    models.set_alias("champion", versions[0])
    rows_of(spark, 0, 30).write.mode("append").parquet(source)
    assert run() == expected(0, 30, 1)
    models.set_alias("champion", versions[1])
    rows_of(spark, 30, 50).write.mode("append").parquet(source)
    after = expected(0, 30, 1) | expected(30, 50, 2)
    assert run() == after
    # the second batch fails after its rows are written: it runs again, after another swap
    models.set_alias("champion", versions[0])
    jvm = spark._jvm.org.apache.hadoop.fs
    for name in ("commits/1", "commits/.1.crc"):
        file = jvm.Path(f"{checkpoint}/{name}")
        file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)
    assert run() == after
    assert run() == after


def test_a_stream_needs_an_alias(spark, two_models):
    models, _ = registered(spark, two_models[:1])
    source = work_path(spark, "source")
    rows_of(spark, 0, 3).write.parquet(source)
    stream = scoring.parquet_stream(spark, source, rows_of(spark, 0, 1).schema)
    query = scoring.score_stream_by_alias(
        stream, models, "nobody", SPEC, work_path(spark, "out"), work_path(spark, "checkpoint")
    )
    with pytest.raises(Exception, match="no version of"):
        query.awaitTermination()


# --- labels that never come -----------------------------------------------------------


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def streamed(spark, parts, schema):
    """A stream of one file per part, in order."""
    folder = work_path(spark, "parts")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return scoring.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)


def test_predictions_without_label_come_out_with_none(spark):
    predictions = [[(i, at(10 * i), i % 2) for i in range(12)], [(99, at(2000), 0)]]
    labels = [[(i, at(10 * i + 30), (i // 2) % 2) for i in range(0, 12, 3)] + [(1, at(500), 1)], [(98, at(2000), 0)]]
    joined = scoring.join_late_labels_stream(
        streamed(spark, predictions, "id long, ts timestamp, prediction int"),
        streamed(spark, labels, "id long, label_ts timestamp, label int"),
        ["id"], "ts", "label_ts", "1 HOURS", unanswered=True,
    )
    out = work_path(spark, "joined")
    scoring.write_available(joined, out, work_path(spark, "checkpoint")).awaitTermination()
    found = {r["id"]: r["label"] for r in spark.read.parquet(out).collect()}
    # the label of 1 came too late; 99 still waits
    assert found == {i: (i // 2) % 2 if i % 3 == 0 else None for i in range(12)}

    figures, checkpoint = work_path(spark, "figures"), work_path(spark, "checkpoint")
    schema = spark.read.parquet(out).schema
    scoring.running_evaluation(
        scoring.parquet_stream(spark, out, schema), "label", "prediction", figures, checkpoint
    ).awaitTermination()
    last = spark.read.parquet(figures).orderBy(F.desc("batch")).drop("batch").first()
    assert last == classifier_evaluation(spark.read.parquet(out), "label", "prediction").first()


# --- point-in-time lookup on streams --------------------------------------------------

FACTS = "id long, user long, ts timestamp, note string"
FEATURES = "user long, ts timestamp, seen double, first timestamp, place int"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    yield
    spark.conf.set(key, old)


def test_the_stream_gives_what_the_batch_gives(spark, rocks):
    rng = random.Random(4)
    end = [(None, 10_000 + k) for k in range(1)]
    facts, features = [], []
    for part in range(4):
        # out of order by up to 50 minutes
        f = [(100 * part + k, rng.randrange(4), at(60 * part + rng.randrange(60)), f"n{k}") for k in range(25)]
        g = [(rng.randrange(4), at(60 * part + rng.randrange(60)), rng.random(), at(k), 100 * part + k) for k in range(15)]
        facts.append(f)
        features.append(g)
    facts[0] += [(7001, None, at(5), "no key"), (7002, 1, None, "no time"), (7003, 9, at(5), "no feature")]
    features[1][3] = (*features[1][2][:2], 0.5, None, 10_000)  # a tie, settled by place
    closing = [(9999, -1, at(100_000), "end")]

    def lookup(df):
        return FeatureLookup(df, ("seen", "first"), "user", "ts", tie_break="place", rename={"seen": "last_seen"})

    found = point_in_time_stream(
        streamed(spark, [*facts, closing], FACTS),
        lookup(streamed(spark, [*features, [(-2, at(100_000), 0.0, None, 0)]], FEATURES)),
        "2 hours",
        matched_ts="matched",
    )
    out = work_path(spark, "looked-up")
    scoring.write_available(found, out, work_path(spark, "checkpoint")).awaitTermination()
    batch = point_in_time_lookup(
        spark.createDataFrame([r for part in facts for r in part], FACTS),
        lookup(spark.createDataFrame([r for part in features for r in part], FEATURES)),
        matched_ts="matched",
    )
    got = spark.read.parquet(out)
    assert got.columns == batch.columns
    assert sorted(map(tuple, got.where("id != 9999").collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)


def test_state_of_a_key_is_called_per_batch_and_stays_small():
    """Features of a key without facts are thinned out too, and no state call is made per row."""
    import pandas as pd

    from tabwright.streaming.lookup import AsOf

    class State(list):
        calls = 0

        def __getattribute__(self, name):
            if name in ("exists", "get", "appendList", "clear"):
                State.calls += 1
            return super().__getattribute__(name)

        exists, get, appendList = list.__len__, list.__iter__, list.extend

    class Handle:
        timers = []

        def getListState(self, name, schema):
            return State()

        def registerTimer(self, at):
            self.timers.append(at)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 900

    one = AsOf("int")
    one.init(Handle())
    rows = [(1000 * k, False, float(k), f"f{k}") for k in range(1000)]
    rows.append((5000, False, 3.0, "loses"))
    one.handleInputRows(None, iter([pd.DataFrame(rows, columns=["at", "fact", "tie", "row"])]), None)
    assert Handle.timers == [1] and list(one.handleExpiredTimer(None, Times(), None)) == []
    assert [r[0] for r in one.history] == [1000 * k for k in range(899, 1000)] and Handle.timers == [1, 901]
    rows = [(1000 * k + 500, True, None, f"n{k}") for k in (898, 899, 950)]
    one.handleInputRows(None, iter([pd.DataFrame(rows, columns=["at", "fact", "tie", "row"])]), None)
    found = [tuple(r) for part in one.handleExpiredTimer(None, Times(), None) for r in part.itertuples(index=False)]
    assert found[1] == ("n899", "f899", 899_000) and len(found) == 2 and len(one.waiting) == 1
    assert State.calls < 20
