import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.operators import forecast, ranking, segments, stats, zonehour
from zoneflow.sources import given

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def hours(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hours"))
    given.zone_hour(spark, FOLDER).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_running_total_matches_brute_force_for_any_number_of_blocks(spark):
    rng = random.Random(7)
    values = sorted({rng.uniform(-50, 50) for _ in range(200)})
    rows = [(v, rng.randint(1, 9)) for v in values]
    df = spark.createDataFrame(rows, "v double, n long")
    expected = {v: sum(n for w, n in rows if w < v) for v in values}
    for blocks in (1, 3, 40):
        found = {r.v: r.n_before for r in ranking.running_total(df, "v", ["n"], blocks).collect()}
        assert found == expected


@pytest.mark.parametrize("values", [[None, None, 3.0], [1.0] * 450 + [2.0] * 50, [float(10**12 - i) for i in range(50)] + [0.0]])
def test_row_numbers_keep_nulls_and_split_heavy_values(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    found = {r.i: r.r for r in ranking.row_numbers(df, "v", ["i"], "r", 6).collect()}
    order = sorted(range(len(values)), key=lambda i: (values[i] is not None, values[i] or 0.0, i))
    assert found == {i: n for n, i in enumerate(order, 1)}


def test_a_heavy_value_is_dealt_to_several_ranges(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") < 8100, 1.0).otherwise(2.0).alias("v"))
    ranged = df.repartitionByRange(8, "v", "id").groupBy(F.spark_partition_id()).count()
    assert ranged.agg(F.max("count")).first()[0] < 4500


@pytest.mark.parametrize("rows", [1, 4, 5, 13])
def test_quantile_groups_match_ntile(spark, rows):
    df = spark.createDataFrame([(f"z{i:02d}", float((i * 7) % 5)) for i in range(rows)], "z string, v double")
    mine = {r.z: r.g for r in ranking.quantile_groups(df, "v", ["z"], 5, "g").collect()}
    df.createOrReplaceTempView("ranked_input")
    theirs = {r.z: r.g for r in spark.sql("select z, ntile(5) over (order by v, z) g from ranked_input").collect()}
    assert mine == theirs


def brute_ranks(values):
    ordered = sorted(values)
    return {v: (ordered.index(v) + 1 + len(ordered) - ordered[::-1].index(v)) / 2 for v in set(values)}


def test_rank_sum_matches_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 12), rng.random() < 0.4) for _ in range(400)]
    row = stats.rank_sum(spark.createDataFrame(data, "v long, g boolean"), "v", "g", blocks=3).first()
    ranks = brute_ranks([v for v, _ in data])
    n1 = sum(not g for _, g in data)
    n2 = len(data) - n1
    w = sum(ranks[v] for v, g in data if not g) - n1 * (n1 + 1) / 2
    n = n1 + n2
    counts = [[v for v, _ in data].count(v) for v in ranks]
    sd = math.sqrt(n1 * n2 / 12 * (n + 1 - sum(t**3 - t for t in counts) / (n * (n - 1))))
    z = (w - n1 * n2 / 2 - math.copysign(0.5, w - n1 * n2 / 2)) / sd
    assert row.statistic == pytest.approx(w) and row.z == pytest.approx(z)
    assert row.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-5)
    assert (row.n_false, row.n_true) == (n1, n2)


def test_kruskal_matches_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.randint(0, 9), rng.choice("abcd")) for _ in range(300)]
    row = stats.kruskal(spark.createDataFrame(data, "v long, g string"), "v", "g", blocks=2).first()
    ranks, n = brute_ranks([v for v, _ in data]), len(data)
    groups = {g: [ranks[v] for v, h in data if h == g] for g in "abcd"}
    h = 12 / (n * (n + 1)) * sum(sum(r) ** 2 / len(r) for r in groups.values()) - 3 * (n + 1)
    ties = sum(t**3 - t for t in ([v for v, _ in data].count(v) for v in ranks))
    assert row.statistic == pytest.approx(h / (1 - ties / (n**3 - n)))
    assert row.degrees == 3


def test_tail_probabilities(spark):
    # Upper chi-square tails from published tables.
    cases = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (13.276704, 4, 0.01), (11.070498, 5, 0.05), (18.307038, 10, 0.05)]
    df = spark.createDataFrame([(x, k) for x, k, _ in cases], "x double, k long")
    found = [r.p for r in df.select(stats.chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()]
    assert found == pytest.approx([p for *_, p in cases], rel=1e-5)
    xs = [-3.0, -0.5, 0.0, 0.1, 1.0, 4.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(stats.erfc(F.col("x")).alias("e"))
    assert [r.e for r in df.collect()] == pytest.approx([math.erfc(x) for x in xs], rel=2e-7)


def test_ols_matches_least_squares(spark, hours):
    features = ["temperature_2m", "precipitation", "is_weekend", "is_after_hours", "month", "hour"]
    rows = {r.term: r for r in stats.ols(hours).collect()}
    pdf = hours.select("target_demand_count", *features).toPandas().dropna().astype(float)
    used = [f for f in features if pdf[f].nunique() > 1]
    x = np.column_stack([pdf[used].to_numpy(), np.ones(len(pdf))])
    beta, *_ = np.linalg.lstsq(x, pdf["target_demand_count"].to_numpy(), rcond=None)
    assert [rows[t].estimate for t in [*used, "(Intercept)"]] == pytest.approx(beta.tolist(), rel=1e-6)
    assert rows["month"].estimate is None and rows["hour"].rows == len(pdf)
    errors, p = least_squares_errors(x, pdf["target_demand_count"].to_numpy())
    assert [rows[t].std_error for t in [*used, "(Intercept)"]] == pytest.approx(errors, rel=1e-6)
    few = {r.term: r for r in stats.ols(hours.limit(100)).collect()}
    assert few["hour"].estimate is not None and few["hour"].rows <= 100
    assert {r.estimate for r in stats.ols(hours.limit(1)).collect()} == {None}
    assert {r.rows for r in stats.ols(hours.limit(0)).collect()} == {0}


def least_squares_errors(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rest = y - x @ beta
    variance = rest @ rest / (len(y) - x.shape[1])
    return np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * variance).tolist(), beta


def test_student_tail():
    # Upper tails from published tables.
    for t, degrees, p in [(12.706205, 1, 0.025), (2.228139, 10, 0.025), (1.959964, 10**7, 0.025), (0.0, 5, 0.5), (3.169273, 10, 0.005)]:
        assert stats.student_tail(t, degrees) == pytest.approx(p, rel=1e-5)


def test_rank_tests_on_equal_values(spark):
    df = spark.createDataFrame([(5, i % 2 == 0) for i in range(10)], "v long, g boolean")
    row = stats.rank_sum(df, "v", "g").first()
    assert row.z is None and row.p_value is None and row.n_true == 5
    assert stats.kruskal(df, "v", "g").first().statistic is None
    assert stats.rank_sum(df.limit(0), "v", "g").first().z is None


def test_constant_zone_has_zero_sensitivity(spark):
    df = spark.createDataFrame(
        [("Z", h, 1, 2, 0.0, 0.0, 0.5, False, False, False) for h in (1, 2)] + [("one", 1, 1, 3, 1.0, 0.0, 0.5, True, True, False)],
        "zone_id string, hour int, month int, target_demand_count long, precipitation double, rain double, "
        "category_mix_top_1_share double, is_weekend boolean, is_after_hours boolean, is_business_hour boolean",
    )
    rows = {r.zone_id: r for r in segments.zone_features(df).collect()}
    assert rows["Z"].weather_sensitivity_proxy == 0 and rows["Z"].peak_hour_concentration == 0.5
    assert rows["one"].demand_volatility == 0 and rows["one"].month_to_month_variability == 0


def test_clusters(spark, hours):
    features = segments.zone_features(hours)
    model, segmented = segments.fit_clusters(features, k=3)
    rows = segments.profiles(segmented).collect()
    assert len(rows) == 9 and {r.cluster_id for r in rows} == {0, 1, 2}
    assert {r.cluster_name for r in rows} <= {segments.STEADY, segments.EVENTS, segments.NIGHT, segments.WEATHER, segments.STABLE}
    x = np.array([[r[f] for f in segments.FEATURES] for r in rows])
    x = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    scores = np.array([[r.pca_1, r.pca_2] for r in rows])
    singular = np.linalg.svd(x, compute_uv=False)[:2]
    assert np.linalg.norm(scores, axis=0) == pytest.approx(singular, rel=1e-6)
    assert model.transform(features).count() == 9
    with pytest.raises(ValueError):
        segments.fit_clusters(features.limit(1))


def test_split_is_disjoint_in_time(spark, hours):
    frame = forecast.model_frame(hours)
    train, test = forecast.split(frame)
    assert train.count() + test.count() == frame.count()
    assert train.agg(F.max("date_hour")).first()[0] < test.agg(F.min("date_hour")).first()[0]
    same_hour = frame.filter(F.col("date_hour") == frame.agg(F.min("date_hour")).first()[0])
    train, test = forecast.split(same_hour)
    assert train.count() == test.count() == same_hour.count()


def test_metrics_against_brute_force(spark):
    rng = random.Random(11)
    data = [(rng.randint(0, 1), rng.choice([0.1, 0.2, 0.35, 0.35, 0.9])) for _ in range(200)]
    df = spark.createDataFrame([(y, int(s > 0.3), s) for y, s in data], "actual_high_demand int, p int, s double")
    row = forecast.auc(df, "s", blocks=3).first()
    pairs = [(a, b) for y, a in data if y for z, b in data if not z]
    assert row.roc_auc == pytest.approx(sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs))
    assert forecast.auc(df.filter("actual_high_demand = 1"), "s").first().roc_auc is None
    m = forecast.metrics(df, "p", "m").first()
    tp = sum(y == 1 and s > 0.3 for y, s in data)
    assert m.tp == tp and m.accuracy == pytest.approx(sum(y == (s > 0.3) for y, s in data) / 200)
    none = forecast.metrics(df.withColumn("p", F.lit(0)), "p", "none").first()
    assert (none.precision, none.f1) == (0.0, 0.0)
    report = {r.label: r for r in forecast.class_report(df, "p").collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["1"].recall == pytest.approx(m.recall) and report["accuracy"].f1 == pytest.approx(m.accuracy)


@pytest.mark.parametrize("pipeline", [lambda: forecast.forest_pipeline(trees=8, depth=6), lambda: forecast.mlp_pipeline((8,), 30)])
def test_models_learn_and_can_be_saved(spark, hours, tmp_path, pipeline):
    """On a label that follows the last hour's demand, a model must beat chance."""
    learnable = hours.withColumn("high_demand_flag", (F.col("lag_1_hour_demand") > 2).cast("int"))
    model, predicted = forecast.fit_and_predict(pipeline(), learnable)
    compared = {r.model: r for r in forecast.compare(predicted).collect()}
    assert compared["traditional_ml"].roc_auc > 0.95
    assert forecast.highest_risk(predicted, 5).count() == 5
    model.write().overwrite().save(str(tmp_path / "model"))
    assert forecast.PipelineModel.load(str(tmp_path / "model")).stages
    one_class = hours.withColumn("high_demand_flag", F.lit(0))
    with pytest.raises(ValueError, match="two classes"):
        forecast.fit_and_predict(pipeline(), one_class)


def test_sparse_and_dense_forecast_input(spark):
    dense = given.zone_hour(spark, "/root/testdata/sf0.001", dense=True)
    assert forecast.model_frame(dense).filter(F.col("date_hour_epoch").isNull()).count() == 0
    assert zonehour.ZONE_HOUR_COLUMNS == dense.columns


def test_network_stops_when_held_back_rows_no_longer_gain(spark):
    """Labels by chance: training goes on to fit them, the rows held back get worse."""
    rows = spark.range(600).select(
        F.concat(F.lit("Z"), F.col("id") % 5).alias("zone_id"),
        (F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("date_hour"),
        *[(F.hash(F.col("id"), F.lit(c)) % 100).cast("double").alias(c) for c in forecast.FEATURES],
        (F.abs(F.hash(F.col("id"), F.lit("label"))) % 2).alias(forecast.LABEL),
    )
    stopping = forecast.Stopping(step=5, most=100, patience=2)
    model, steps = forecast.fit_network(rows, (16,), stopping)
    found = sorted(steps.collect())
    losses, kept = [r.validation_loss for r in found], [r.step for r in found if r.kept]
    assert len(found) < 20 and kept == [len(found) - 2] and found[0].fit_rows + found[0].validation_rows == 600
    assert losses[kept[0] - 1] <= min(losses) + stopping.tolerance
    held = [r.validation_rows for r in found]
    assert held[0] == sorted(forecast.fit_network(rows.repartition(7), (4,), forecast.Stopping(5, 5)) [1].collect())[0].validation_rows
    assert "ml_prediction" in model.transform(rows).columns
    with pytest.raises(ValueError):
        forecast.fit_network(rows.limit(0), (4,), stopping)
