"""Selection among text ids, the day-partitioned log, and daily monitoring state against the plain window."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from policylens.operators import daily_state, monitor, radix
from policylens.sources import sinks
from policylens.sources.tables import POLICY_AS_OF, Fixtures
from policylens.sources import requests as RQ
from policylens.streaming import pipelines as P
from tests.conftest import SMOKE

AS_OF = "2024-01-31 00:00:00"


def test_kth_text_equals_sorting(spark):
    r = random.Random(1)
    letters = ["a", "b", "\x00", "é", "😀", "zz"]
    texts = {g: ["common-prefix-of-all-ids-" * (g % 2) + "".join(r.choice(letters) for _ in range(r.randint(0, 9))) for _ in range(r.randint(1, 300))] for g in range(12)}
    texts[12], texts[13] = ["same"] * 50, ["", "", "a"]
    rows = [(g, t) for g, ts in texts.items() for t in ts] + [(0, None), (99, "x")]
    ranks = {g: r.randrange(len(ts)) for g, ts in texts.items()}
    got = radix.kth_text(spark.createDataFrame(rows, "g int, t string"), ["g"], "t", spark.createDataFrame(list(ranks.items()), "g int, k long"))
    assert {x.g: x.value for x in got.collect()} == {g: sorted(texts[g], key=str.encode)[k] for g, k in ranks.items()}


def test_million_equal_times_with_text_ids(spark):
    """One timestamp for all rows and random ids: the halves are exact and no plan ranks rows."""
    n = 1_000_000
    ids = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("pricing_id"), F.lit("m").alias("model_id"), F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"))
    split = monitor.period_split(ids)
    plan = split._jdf.queryExecution().toString()
    assert "Window" not in plan and "Sort" not in plan
    half = split.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.min("pricing_id").alias("low"), F.max("pricing_id").alias("high")).collect()
    by = {r.period: r for r in half}
    assert by["reference"].n == by["current"].n == n // 2 and by["reference"].high < by["current"].low


def log_rows(spark, n=4000):
    """A log of 50 days: two models, one with few rows, one with one row, one whose rows share one time; nulls and booleans among the features."""
    start = dt.datetime(2023, 12, 15)
    r = random.Random(7)
    rows = []
    for k in range(n):
        model = "a" if k % 3 else "b"
        t = start + dt.timedelta(minutes=r.randrange(50 * 1440))
        feats = f'{{"x": {r.gauss(5, 2):.3f}, "flag": {str(r.random() < 0.5).lower()}, "word": "w", "some": {r.randrange(4) if k % 5 else "null"}}}'
        rows.append((f"id{r.random()}", model, feats, 100 + r.random(), None if k % 97 == 0 else 90 + 30 * r.random(), t))
    rows += [("one", "single", '{"x": 1}', 5.0, 6.0, dt.datetime(2024, 1, 20)), ("z", None, '{"x": 1}', 5.0, 6.0, dt.datetime(2024, 1, 20))]
    rows += [(f"s{k:03}", "same", '{"x": %d}' % k, 5.0, 0.0, dt.datetime(2024, 1, 10, 12)) for k in range(101)]
    return spark.createDataFrame(rows, "pricing_id string, model_id string, input_features string, base_premium double, final_premium double, created_at timestamp_ntz")


def table(df, keys):
    """Rows by key with doubles rounded."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        out[tuple(d.pop(k) for k in keys)] = {k: round(v, 9) if isinstance(v, float) else v for k, v in d.items()}
    return out


@pytest.mark.parametrize("as_of", [AS_OF, "2024-01-29 13:37:11", "2024-01-14 00:00:00", "2026-01-01 00:00:00"])
def test_daily_state_equals_the_plain_window(spark, tmp_path, as_of):
    log = log_rows(spark).where("model_id is not null")
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    state = daily_state.DailyState(spark, str(tmp_path / "state"))
    late = F.crc32("pricing_id") % 10 == 0  # rows that come in after others of their day
    for k, part in enumerate((~late & (F.col("created_at") < F.lit("2024-01-05")), ~late & (F.col("created_at") >= F.lit("2024-01-05")), late)):
        state.add(log.where(part), k)
    state.add(log.where(late), 2)  # a replay
    got = state.window(log, as_of, 30)
    hist = monitor.history_window(log, as_of, 30)
    split = monitor.period_split(hist)
    assert table(got.performance, ["model_id"]) == table(monitor.performance(hist), ["model_id"])
    want = monitor.feature_drift(split)
    assert table(got.features.select(*want.columns), ["model_id", "feature"]) == table(want, ["model_id", "feature"])
    want = monitor.prediction_drift(split)
    assert table(got.predictions.select(*want.columns), ["model_id"]) == table(want, ["model_id"])
    assert table(got.bounds, ["model_id", "period"]) == table(monitor.period_bounds(split), ["model_id", "period"])


def test_second_run_reads_new_days_and_the_edges_only(spark, tmp_path):
    """Old days of the log may be unreadable once they are in the state; only the day of the halves' boundary is read again."""
    log = log_rows(spark).where("model_id in ('a', 'same')").withColumn("dt", F.to_date("created_at")).cache()
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    log.where("dt < '2024-01-25'").write.partitionBy("dt").parquet(path)
    P.run_scheduled_monitoring(spark, path, out, AS_OF, log.schema, name=f"twice-{tmp_path.name}").awaitTermination()
    split = monitor.period_split(monitor.history_window(log, AS_OF, 30))
    cut = {str(r[0]) for r in split.where("period = 'reference'").groupBy("model_id").agg(F.max("created_at").alias("t")).select(F.to_date("t")).collect()}
    for day in os.listdir(path):
        if day.startswith("dt=") and day[3:] not in cut:
            for file in os.listdir(f"{path}/{day}"):
                with open(f"{path}/{day}/{file}", "wb") as f:
                    f.write(b"no parquet")
    log.where("dt >= '2024-01-25'").write.mode("append").partitionBy("dt").parquet(path)
    P.run_scheduled_monitoring(spark, path, out, AS_OF, log.schema, name=f"twice-{tmp_path.name}").awaitTermination()
    rows = spark.read.parquet(out).where("batch_id = 1")
    hist = monitor.history_window(log, AS_OF, 30)
    want = sinks.monitoring_rows(monitor.performance(hist), monitor.feature_drift(split), monitor.prediction_drift(split), monitor.period_bounds(split))
    long = lambda df: table(sinks.monitoring_long(df).select("model_id", "metric_type", "metric_name", "metric_value"), ["model_id", "metric_type", "metric_name"])
    assert long(rows) == long(want)


def test_log_by_day_is_pruned_and_replays_replace(spark, tmp_path):
    fx = Fixtures(spark, SMOKE)
    docs = RQ.parse_requests(RQ.request_documents(fx.request_tables())).limit(200)
    write = P.quote_batch_writer(str(tmp_path / "log"), str(tmp_path / "bad"), POLICY_AS_OF)
    for batch in (0, 1, 0):
        write(docs, batch)
    log = spark.read.parquet(str(tmp_path / "log"))
    ids = log.groupBy("policy_id").count()
    assert "dt" in log.columns and ids.where("count != 2").count() == 0 < ids.count()
    plan = monitor.history_window(log, AS_OF)._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "dt" in pruned
