"""Model training and scoring on pyspark.ml, anomaly flags, churn features and forecasts."""

from __future__ import annotations

import json
from functools import reduce
from statistics import NormalDist

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import number_rows, previous_value, running_sum
from tidemark.sources.readers import latest_by


def _features(cat: list[str], num: list[str]) -> list:
    indexed, hot = [f"{c}__ix" for c in cat], [f"{c}__oh" for c in cat]
    stages = []
    if cat:
        stages += [
            StringIndexer(inputCols=cat, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot),
        ]
    filled = [f"{c}__filled" for c in num]
    if num:  # the mean of training stands in for a missing number, so that no row is lost
        stages.append(Imputer(inputCols=num, outputCols=filled))
    return [*stages, VectorAssembler(inputCols=[*filled, *hot], outputCol="features")]


def train_linear(df: DataFrame, label: str, cat: list[str], num: list[str]) -> PipelineModel:
    """Linear regression on one-hot text columns and plain number columns."""
    return Pipeline(stages=[*_features(cat, num), LinearRegression(labelCol=label, featuresCol="features")]).fit(df)


def train_logistic(df: DataFrame, label: str, cat: list[str], num: list[str], reg: float = 0.0) -> PipelineModel:
    learner = LogisticRegression(labelCol=label, featuresCol="features", regParam=reg)
    return Pipeline(stages=[*_features(cat, num), learner]).fit(df)


def train_kmeans(df: DataFrame, features: list[str], k: int, seed: int = 42) -> PipelineModel:
    """K-means with the parallel form of k-means++ seeding."""
    return Pipeline(stages=[*_features([], features), KMeans(k=k, seed=seed, featuresCol="features")]).fit(df)


def predict(model: PipelineModel, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Score rows; a classifier adds the probability of class 1 as ``probability``."""
    keep = [F.col(c) for c in df.columns]
    out = model.transform(df)
    extra = [vector_to_array("probability")[1].alias("probability")] if "probability" in out.columns else []
    return out.select(*keep, F.col("prediction").alias(name), *extra)


def regression_report(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    err = F.col(predicted) - F.col(actual)
    return scored.agg(
        F.count("*").alias("rows"),
        F.round(F.avg(F.abs(err)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"),
        F.round(1 - F.sum(err * err) / (F.var_pop(actual) * F.count("*")), 6).alias("r2"),
    )


def evaluate(scored: DataFrame, label: str, probability: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, accuracy, F1 and log loss at a threshold, in one pass."""
    yes, hit = F.col(label) == 1, F.col(probability) >= threshold
    p = F.greatest(F.least(F.col(probability), F.lit(1 - 1e-15)), F.lit(1e-15))
    counts = scored.agg(
        F.count_if(yes & hit).alias("tp"), F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"), F.count_if(~yes & ~hit).alias("tn"),
        F.avg(-F.when(yes, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
    )
    precision = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    recall = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    total = (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).cast("double")
    return counts.select(
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round((F.col("tp") + F.col("tn")) / total, 6).alias("accuracy"),
        F.round(F.try_divide(2 * precision * recall, precision + recall), 6).alias("f1_score"),
        F.round("log_loss", 6).alias("log_loss"),
    )


def roc_auc(scored: DataFrame, label: str, probability: str) -> DataFrame:
    """Area under the ROC curve from ranks; equal scores count half."""
    steps = scored.select(F.col(probability).alias("p"), F.col(label).cast("long").alias("pos"), (1 - F.col(label)).cast("long").alias("neg"))
    below = running_sum(steps, [], ["p"], {"neg": "neg_upto", "pos": "pos_upto"})
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    return below.agg(F.round(wins / (F.sum("pos") * F.sum("neg")), 6).alias("roc_auc"))


def explain(model: PipelineModel, df: DataFrame, key: str, top_n: int) -> DataFrame:
    """Largest feature attributions per row of a linear model: coefficient times value; features that add nothing are left out.

    Coefficients and names are two literal arrays, so the plan does not grow with the categories of a column.
    """
    learner = model.stages[-1]
    out = model.transform(df)
    meta = out.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    coefs = learner.coefficients.toArray()
    labels = F.from_json(F.lit(json.dumps([names[i] for i in range(len(coefs))])), "array<string>")
    weights = F.from_json(F.lit(json.dumps([float(c) for c in coefs])), "array<double>")
    # the leading field sorts the largest share first without a comparator function
    shares = F.zip_with(F.zip_with("__f", "__w", lambda x, w: x * w), "__n", lambda share, n: F.struct((-F.abs(share)).alias("order"), n.alias("feature"), share.alias("attribution")))
    ranked = F.slice(F.array_sort(F.filter(shares, lambda s: s["attribution"] != 0)), 1, top_n)
    rows = out.select(key, vector_to_array("features").alias("__f"), weights.alias("__w"), labels.alias("__n")).select(key, F.posexplode(ranked).alias("rank", "p"))
    return rows.select(key, (F.col("rank") + 1).alias("rank"), "p.feature", "p.attribution")


def compare_models(df: DataFrame, actual: Column, a: Column, b: Column, names: tuple[str, str]) -> DataFrame:
    """Rounded errors of two predictions and which one is closer; a tie goes to the second."""
    diff_a, diff_b = F.round(actual - a, 3), F.round(actual - b, 3)
    return df.withColumns({
        "diff_a": diff_a, "diff_b": diff_b, "winner": F.when(F.abs(diff_a) < F.abs(diff_b), names[0]).otherwise(names[1])
    })


def score_grid(model: PipelineModel, entities: DataFrame, grid: list[dict[str, object]], key: str, threshold: float = 0.5) -> DataFrame:
    """Score each entity under each scenario of a short list, and keep its best scenario."""
    scenario = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in g.items()]) for g in grid]))
    rows = entities.withColumn("__s", scenario).select(*entities.columns, "__s.*")
    scored = predict(model, rows, "score")
    best = latest_by(scored, [key], [F.desc("score"), *[F.asc(c) for c in grid[0]]])
    return best.withColumn("is_high", F.col("score") > threshold)


def write_prediction(df: DataFrame, model: PipelineModel, key: str, name: str) -> DataFrame:
    """Predicted value joined back to the entity rows."""
    return df.join(predict(model, df, name).select(key, name), key, "left")


def nearest_centroid(df: DataFrame, centroids: list[list[float]], features: list[str]) -> DataFrame:
    """Nearest of a short list of centroids (ids from 1) and the Euclidean distance to it."""
    def gap(c: list[float]) -> Column:
        return F.sqrt(reduce(lambda a, b: a + b, (F.pow(F.col(f) - F.lit(float(v)), 2) for f, v in zip(features, c))))

    pairs = [F.struct(gap(c).alias("distance"), F.lit(i + 1).alias("centroid_id")) for i, c in enumerate(centroids)]
    best = F.array_min(F.array(*pairs))
    return df.withColumns({"centroid_id": best["centroid_id"], "distance": best["distance"]})


def detect_anomalies(df: DataFrame, centroids: list[list[float]], features: list[str], contamination: float, key: str) -> DataFrame:
    """Distance over the mean distance of its cluster; the top ``contamination`` share is flagged.

    The cut is exact, equal distances going by key. An approximate quantile with a known rank
    error sets a bar safely below it, and only the rows above that bar are ranked.
    """
    near = nearest_centroid(df, centroids, features)
    means = near.groupBy("centroid_id").agg(F.avg("distance").alias("__mean"))
    norm = near.join(F.broadcast(means), "centroid_id").withColumn("normalized_distance", F.col("distance") / F.col("__mean"))
    norm = norm.drop("__mean")
    # the estimate may be off by 1/10000 of the rows; the bar lies ten times that below the cut
    quantile = F.percentile_approx("normalized_distance", max(0.0, 1 - contamination - 0.001), 10000)
    total, bar = norm.agg(F.count("*"), quantile).first()
    cut = int(total * contamination)
    above = F.coalesce(F.col("normalized_distance") >= F.lit(bar), F.lit(False))
    ranked = number_rows(norm.filter(above), [F.desc("normalized_distance"), F.asc(key)], "__rank")
    flagged = ranked.withColumn("is_anomaly", F.col("__rank") <= cut).drop("__rank")
    return flagged.unionByName(norm.filter(~above).withColumn("is_anomaly", F.lit(False)))


def touch_features(events: DataFrame, user: str, ts: str, horizon: str = "24 HOURS", bounce: str = "10 MINUTES") -> DataFrame:
    """First and last touch per user with churn (no touch after the horizon) and bounce labels."""
    return _touch_labels(events.groupBy(user).agg(F.min(ts).alias("first_touch"), F.max(ts).alias("last_touch")), horizon, bounce)


def _touch_labels(touch: DataFrame, horizon: str, bounce: str) -> DataFrame:  # both are the caller's choice
    first, last = F.col("first_touch"), F.col("last_touch")
    return touch.withColumns({
        "month": F.month(first), "day_of_year": F.dayofyear(first), "dayofweek": F.dayofweek(first),
        "horizon_end": first + F.expr(f"INTERVAL {horizon}"),
        "churned": (last < first + F.expr(f"INTERVAL {horizon}")).cast("int"),
        "bounced": (last <= first + F.expr(f"INTERVAL {bounce}")).cast("int"),
    })


def churn_features(
    events: DataFrame, user: str, ts: str, event: str, kinds: list[str], demographics: list[str], horizon: str = "24 HOURS", bounce: str = "10 MINUTES"
) -> DataFrame:
    """Training rows: latest demographics, event counts within the horizon, and the labels."""
    latest = F.max(F.struct(ts, *demographics)).alias("__latest")
    touch = events.groupBy(user).agg(F.min(ts).alias("first_touch"), F.max(ts).alias("last_touch"), latest)
    touch = _touch_labels(touch, horizon, bounce).withColumns({c: F.col("__latest")[c] for c in demographics}).drop("__latest")
    early = events.select(user, ts, event).join(touch.select(user, "horizon_end"), user).filter(F.col(ts) <= F.col("horizon_end"))
    counts = early.groupBy(user).agg(*[F.count_if(F.col(event) == k).alias(f"cnt_{k}") for k in kinds])
    return touch.join(counts, user, "left").fillna(0, [f"cnt_{k}" for k in kinds])


def infer_granularity(df: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    """Most common gap in seconds between consecutive times (the least of equally common ones), and its share of all gaps."""
    points = df.select(*keys, ts).distinct()
    gaps = previous_value(points, list(keys), ts, "__prev").filter("__prev IS NOT NULL")
    gap = F.timestamp_diff("SECOND", "__prev", ts)
    counts = gaps.groupBy(*keys, gap.alias("gap_seconds")).agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("gap_seconds")).alias("less"))).alias("__best"), F.sum("n").alias("gaps"))
    share = F.round(F.col("__best.n") / F.col("gaps"), 6)
    return best.filter("gaps IS NOT NULL").select(*keys, (-F.col("__best.less")).alias("gap_seconds"), "gaps", share.alias("confidence"))


def horizon_steps(duration_seconds: Column, gap_seconds: Column) -> Column:
    return F.ceil(duration_seconds / gap_seconds).cast("int")


def forecast(
    df: DataFrame, data_col: str, step_col: str, horizon: int, confidence_level: float = 0.95, id_cols: list[str] = ()
) -> DataFrame:
    """Linear trend per series over integer steps, with a normal prediction interval.

    A series becomes six sums with map-side combine, whatever its length; the future steps are
    generated from them.
    """
    x, y = F.col(step_col).cast("double"), F.col(data_col).cast("double")
    z = NormalDist().inv_cdf(0.5 + confidence_level / 2)
    fit = df.filter(x.isNotNull() & y.isNotNull()).groupBy(*id_cols).agg(
        F.count("*").alias("n"), F.max(step_col).alias("last_step"), F.avg(x).alias("mx"),
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
    )
    spread = F.when(F.col("n") > 2, F.sqrt(F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / (F.col("n") - 2)))
    future = fit.withColumns({"s": spread, "h": F.explode(F.sequence(F.lit(1), F.lit(horizon)))})
    step = F.col("last_step") + F.col("h")
    value = F.col("intercept") + F.col("slope") * step
    margin = z * F.col("s") * F.sqrt(1 + 1 / F.col("n") + F.pow(step - F.col("mx"), 2) / F.col("sxx"))
    return future.select(
        *id_cols, step.alias("forecast_step"), value.alias("forecast_value"),
        (value - margin).alias("interval_lower"), (value + margin).alias("interval_upper"),
        F.lit(confidence_level).alias("confidence_level"),
    )


def forecast_by_time(
    df: DataFrame, data_col: str, timestamp_col: str, horizon: int, confidence_level: float = 0.95, id_cols: list[str] = ()
) -> DataFrame:
    """Forecast over a timestamp column: the usual gap of each series is its step, and the answer has timestamps."""
    keys = list(id_cols)
    first = df.groupBy(*keys).agg(F.min(timestamp_col).alias("__first"))
    gaps = infer_granularity(df.filter(F.col(timestamp_col).isNotNull()), timestamp_col, keys).select(*keys, "gap_seconds")
    scale = first.join(gaps, keys) if keys else first.withColumn("gap_seconds", gaps.select("gap_seconds").scalar())
    rows = df.join(scale, keys) if keys else df.withColumns({c: scale.select(c).scalar() for c in ("__first", "gap_seconds")})
    step = F.round(F.timestamp_diff("SECOND", "__first", timestamp_col) / F.col("gap_seconds")).cast("long")
    ahead = forecast(rows.withColumn("__step", step), data_col, "__step", horizon, confidence_level, keys)
    timed = ahead.join(scale, keys) if keys else ahead.withColumns({c: scale.select(c).scalar() for c in ("__first", "gap_seconds")})
    at = F.timestamp_add("SECOND", F.col("forecast_step") * F.col("gap_seconds"), "__first")
    return timed.select(*keys, at.alias("forecast_timestamp"), "forecast_value", "interval_lower", "interval_upper", "confidence_level")


def first_crossing(fc: DataFrame, id_cols: list[str], limit: float) -> DataFrame:
    """First forecast step at or below the limit."""
    return fc.filter(F.col("forecast_value") <= limit).groupBy(*id_cols).agg(F.min("forecast_step").alias("crossing_step"))
