"""High-demand classification of zone-hours: split, baseline, models and metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import numeric as nu
from zoneflow.functions.text import UNKNOWN_ZONE
from zoneflow.functions.time import epoch_seconds
from zoneflow.operators import schema
from zoneflow.operators.enrich import WEATHER_COLUMNS
from zoneflow.operators.ranking import running_total
from zoneflow.operators.sampling import draw
from zoneflow.operators.sizing import cut_lineage

# Features of the demand models.
FEATURES = [
    "hour", "weekday", "month", "quarter", "is_weekend", "is_holiday", "is_business_hour", "is_after_hours",
    *WEATHER_COLUMNS, "lag_1_hour_demand", "lag_24_hour_demand", "rolling_7_day_avg",
    "prior_week_same_hour_demand", "category_mix_top_1_share", "category_mix_top_3_share",
]
FLAGS = ["is_weekend", "is_holiday", "is_business_hour", "is_after_hours"]
LABEL = "actual_high_demand"
SEED = 42


def model_frame(zone_hour: DataFrame) -> DataFrame:
    """Zone-hour rows as doubles with 0 for gaps, a zone default and the hour as epoch seconds."""
    z = zone_hour.withColumns({c: F.col(c).cast("double") for c in FLAGS if c in zone_hour.columns})
    z = schema.coerce_numbers(z, [*FEATURES, "target_demand_count"])
    return z.withColumns(
        {
            "zone_id": F.coalesce(F.col("zone_id").cast("string"), F.lit(UNKNOWN_ZONE)),
            LABEL: F.coalesce(F.col("high_demand_flag").cast("int"), F.lit(0)),
            "date_hour_epoch": epoch_seconds("date_hour"),
        }
    ).select("zone_id", "date", "date_hour", "date_hour_epoch", "target_demand_count", LABEL, *FEATURES)


def discrete_quantile(column: str, q: float):
    """Smallest value with at least a share ``q`` of rows at or below it.

    The aggregate counts rows per distinct value; here the values are hours of
    the calendar or small demand counts.
    """
    return F.expr(f"percentile_disc({q}) within group (order by {column})")


def split(frame: DataFrame, q: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rows up to the q-quantile of time for training, later ones for testing.

    When no row is later, the training rows serve as test rows.  The cutoff is
    a scalar subquery: nothing is collected and no global sort is needed.
    """
    bounds = frame.agg(
        F.struct(
            discrete_quantile("date_hour_epoch", q).alias("cutoff"), F.max("date_hour_epoch").alias("last")
        ).alias("b")
    ).scalar()
    timed = frame.withColumn("_b", bounds)
    cutoff, last = F.col("_b.cutoff"), F.col("_b.last")
    train = timed.filter(F.col("date_hour_epoch") <= cutoff).drop("_b")
    test = timed.filter((F.col("date_hour_epoch") > cutoff) | (cutoff == last)).drop("_b")
    return train, test


def add_baseline(train: DataFrame, test: DataFrame, q: float = 0.75) -> DataFrame:
    """Predict high demand where last week's same-hour demand reaches the training quantile."""
    threshold = train.agg(discrete_quantile("target_demand_count", q)).scalar()
    prior = F.coalesce("prior_week_same_hour_demand", F.lit(0.0))
    scored = test.withColumn("_threshold", threshold)
    return scored.withColumns(
        {
            "baseline_prediction": (prior >= F.col("_threshold")).cast("int"),
            "baseline_probability": nu.clip01(prior / F.greatest(F.col("_threshold"), F.lit(1.0))),
        }
    ).drop("_threshold")


def forest_pipeline(trees: int = 100, depth: int = 18, min_leaf: int = 3, seed: int = SEED) -> Pipeline:
    """Median imputation, scaling and one-hot zone in front of a random forest."""
    filled = [f"{c}_filled" for c in FEATURES]
    return Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=FEATURES, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True),
            StringIndexer(inputCol="zone_id", outputCol="_zone", handleInvalid="keep"),
            OneHotEncoder(inputCol="_zone", outputCol="_zone_vector", dropLast=True),
            VectorAssembler(inputCols=["_scaled", "_zone_vector"], outputCol="features"),
            RandomForestClassifier(
                labelCol=LABEL, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
                maxMemoryInMB=1024, predictionCol="ml_prediction",
            ),
        ]
    )


def mlp_pipeline(hidden: tuple[int, ...] = (32, 16), iterations: int = 220, seed: int = SEED) -> Pipeline:
    """Median imputation and scaling in front of a feed-forward network."""
    filled = [f"{c}_filled" for c in FEATURES]
    return Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=FEATURES, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="features", withMean=True),
            MultilayerPerceptronClassifier(
                labelCol=LABEL, layers=[len(FEATURES), *hidden, 2], maxIter=iterations, seed=seed,
                predictionCol="ml_prediction",
            ),
        ]
    )


@dataclass(frozen=True)
class Stopping:
    """When the training of a network ends: ``most`` iterations in steps of ``step``, or ``patience`` steps without a
    validation loss that is lower by ``tolerance``; ``share`` percent of the training rows are for validation."""

    step: int = 20
    most: int = 220
    patience: int = 3
    tolerance: float = 1e-4
    share: int = 10


def log_loss(scored: DataFrame):
    """Mean negative logarithm of the probability of the true class, as a one-row table ``loss``."""
    p = F.get(vector_to_array("probability"), F.col(LABEL).cast("int"))
    return scored.agg(F.avg(-F.ln(F.greatest(p, F.lit(1e-15)))).alias("loss"))


def fit_network(
    train: DataFrame, hidden: tuple[int, ...] = (32, 16), stopping: Stopping = Stopping(), seed: int = SEED
) -> tuple[PipelineModel, DataFrame]:
    """A network whose training stops when the rows held back no longer gain, and its steps.

    Each step goes on from the weights of the last one; the weights with the lowest validation loss stay.  Validation
    rows are drawn by a seeded hash of zone and hour, the same under any partitioning.  Steps are ``step, iterations,
    validation_loss, kept, fit_rows, validation_rows``.  A step is a pass over the written rows; the driver holds one set
    of weights and the losses.
    """
    drawn = F.conv(F.substring(draw(["zone_id", "date_hour"], seed), 1, 8), 16, 10).cast("long") % 100
    is_held = drawn < stopping.share
    sizes = train.agg(F.count_if(~is_held), F.count_if(is_held)).first()
    if not all(sizes):
        raise ValueError("too few training rows to hold some back")
    filled = [f"{c}_filled" for c in FEATURES]
    front = Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=FEATURES, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="features", withMean=True),
        ]
    ).fit(train)
    rows = cut_lineage(front.transform(train).select("features", LABEL, is_held.alias("_held")))
    fitted, held = rows.where("not _held"), rows.where("_held")
    best, weights, losses = None, None, []
    while len(losses) * stopping.step < stopping.most:
        network = MultilayerPerceptronClassifier(
            labelCol=LABEL, layers=[len(FEATURES), *hidden, 2], maxIter=stopping.step, seed=seed,
            predictionCol="ml_prediction",
        )
        model = (network if weights is None else network.setInitialWeights(weights)).fit(fitted).copy()
        weights = model.weights
        losses.append(log_loss(model.transform(held)).first()[0])
        if best is None or losses[-1] < losses[best[0]] - stopping.tolerance:
            best = len(losses) - 1, model
        elif len(losses) - 1 - best[0] >= stopping.patience:
            break
    steps = [(i + 1, (i + 1) * stopping.step, loss, i == best[0], *sizes) for i, loss in enumerate(losses)]
    columns = "step int, iterations int, validation_loss double, kept boolean, fit_rows long, validation_rows long"
    return PipelineModel(stages=[*front.stages, best[1]]), train.sparkSession.createDataFrame(steps, columns)


def _two_parts(zone_hour: DataFrame, q: float) -> tuple[DataFrame, DataFrame]:
    """Training rows, of two classes, and test rows with the baseline, both written."""
    train, test = split(cut_lineage(model_frame(zone_hour)), q)
    train = cut_lineage(train)
    test = cut_lineage(add_baseline(train, test))
    classes = train.agg(F.min(LABEL), F.max(LABEL)).first()
    if classes[0] == classes[1]:
        raise ValueError("training rows hold fewer than two classes")
    return train, test


def _scored(model: PipelineModel, test: DataFrame) -> DataFrame:
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return prediction_table(
        model.transform(test).withColumns(
            {"ml_prediction": F.col("ml_prediction").cast("int"), "predicted_high_demand_probability": probability}
        )
    )


def network_and_predict(
    zone_hour: DataFrame, q: float = 0.8, stopping: Stopping = Stopping(), hidden: tuple[int, ...] = (32, 16)
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """A network with early stopping, the steps of its training, and the predictions for the later rows."""
    train, test = _two_parts(zone_hour, q)
    model, steps = fit_network(train, hidden, stopping)
    return model, steps, _scored(model, test)


def fit_and_predict(pipeline: Pipeline, zone_hour: DataFrame, q: float = 0.8) -> tuple[PipelineModel, DataFrame]:
    """Train on the earlier rows, all of them, and predict the later ones next to the baseline.

    Training reads its input many times, so both parts are written as tables
    first; the models then run on plain scans without the split's subqueries.
    Raises when the training rows hold one class only.
    """
    train, test = _two_parts(zone_hour, q)
    # A fitted forest holds its training summary and with it the session, which cannot be sent to executors once an
    # observation has run in it; a copy leaves the summary behind.
    model = pipeline.fit(train).copy()
    return model, _scored(model, test)


def prediction_table(scored: DataFrame) -> DataFrame:
    """Actual and predicted flags with probability and risk score per test zone-hour."""
    return scored.withColumn(
        "workload_risk_score", nu.risk_from_probability("predicted_high_demand_probability")
    ).select(
        "zone_id", "date_hour", "target_demand_count", LABEL, "baseline_prediction", "baseline_probability",
        "ml_prediction", "predicted_high_demand_probability", "workload_risk_score",
    )


def baseline_table(zone_hour: DataFrame, q: float = 0.8) -> DataFrame:
    """The prediction table filled from the baseline, as when no model could be trained."""
    train, test = split(model_frame(zone_hour), q)
    scored = add_baseline(train, test)
    return prediction_table(
        scored.withColumns(
            {
                "ml_prediction": F.col("baseline_prediction"),
                "predicted_high_demand_probability": F.col("baseline_probability"),
            }
        )
    )


def _ratio(part, whole):
    return nu.safe_divide(part, whole)


def metrics(predictions: DataFrame, predicted: str, model: str) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 in one pass; 0 where a ratio is undefined."""
    y, p = F.col(LABEL) == 1, F.col(predicted) == 1
    counts = predictions.agg(
        F.count(F.when(~y & ~p, 1)).alias("tn"), F.count(F.when(~y & p, 1)).alias("fp"),
        F.count(F.when(y & ~p, 1)).alias("fn"), F.count(F.when(y & p, 1)).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        F.lit(model).alias("model"), "tn", "fp", "fn", "tp",
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def auc(predictions: DataFrame, score: str, blocks: int | None = None) -> DataFrame:
    """Area under the ROC curve from the table of distinct scores; null for one class."""
    y = F.col(LABEL) == 1
    table = predictions.groupBy(F.col(score).alias("score")).agg(
        F.count(F.when(y, 1)).alias("pos"), F.count(F.when(~y, 1)).alias("neg")
    )
    ranked = running_total(table, "score", ["neg"], blocks)
    won = F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    return ranked.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        (F.sum(won) / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("roc_auc"),
    )


def class_report(predictions: DataFrame, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted means and the accuracy."""
    counts = predictions.groupBy(F.col(LABEL).alias("y"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"),
                         F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    per_class = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit")
    )
    scored = per_class.select(
        F.col("label").cast("string").alias("label"),
        _ratio("hit", "said").alias("precision"),
        _ratio("hit", "support").alias("recall"),
        _ratio(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1"),
        "support", "hit",
    )
    measures = ["precision", "recall", "f1"]
    n = F.sum("support")
    total = scored.agg(
        n.alias("support"), _ratio(F.sum("hit"), n).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * F.col("support")), n).alias(f"weighted_{m}") for m in measures],
    )

    def summary(label, prefix):
        return F.struct(
            F.lit(label).alias("label"), *[F.col(f"{prefix}_{m}" if prefix else "accuracy").alias(m) for m in measures],
            F.col("support"),
        )

    means = total.select(
        F.inline(F.array(summary("accuracy", ""), summary("macro avg", "macro"), summary("weighted avg", "weighted")))
    )
    return scored.drop("hit").unionByName(means)


def compare(predictions: DataFrame) -> DataFrame:
    """Baseline and model side by side, each with its metrics and area under the curve.

    The predictions are written first, so the model scores every row once.
    """
    used = ["baseline_prediction", "baseline_probability", "ml_prediction", "predicted_high_demand_probability"]
    predictions = cut_lineage(predictions.select(LABEL, *used))
    pairs = [
        ("baseline", "baseline_prediction", "baseline_probability"),
        ("traditional_ml", "ml_prediction", "predicted_high_demand_probability"),
    ]
    rows = [
        metrics(predictions, predicted, name).withColumn("roc_auc", auc(predictions, score).select("roc_auc").scalar())
        for name, predicted, score in pairs
    ]
    return rows[0].unionByName(rows[1])


def highest_risk(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The n zone-hours with the highest predicted probability."""
    return predictions.orderBy(F.desc("predicted_high_demand_probability"), "zone_id", "date_hour").limit(n)
