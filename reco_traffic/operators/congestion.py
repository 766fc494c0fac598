"""Congestion classifier over lagged camera features: multinomial logistic
regression with intercept. One set of rows is fitted by Spark ML, one model per
target camera by ``softmax_fit``, all targets together."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dot
from .softmax_fit import fit_all

DEFAULT_CLASSES = 11


def with_class_count(rows: DataFrame, num_classes: int = DEFAULT_CLASSES, label_col: str = "label") -> DataFrame:
    """Attach nominal metadata so Spark ML uses exactly ``num_classes``
    classes even when the highest class is absent from the data (the
    reference fixes 11). Labels are clamped to [0, num_classes - 1]."""
    meta = {"ml_attr": {"type": "nominal", "num_vals": int(num_classes), "name": label_col}}
    lab = F.least(F.greatest(F.col(label_col), F.lit(0.0)), F.lit(float(num_classes - 1)))
    return rows.withColumn(label_col, lab.alias(label_col, metadata=meta))


# The reference's optimizer settings (L-BFGS, 100 iterations,
# convergence tolerance 1e-6, no regularisation, intercept).
DEFAULT_MAX_ITER = 100
DEFAULT_TOL = 1e-6


def fit_congestion_classifier(
    rows: DataFrame,
    num_classes: int = DEFAULT_CLASSES,
    max_iter: int = DEFAULT_MAX_ITER,
    reg: float = 0.0,
    tol: float = DEFAULT_TOL,
) -> LogisticRegressionModel:
    """Multinomial logistic regression (L-BFGS) on (label, features). Every
    iteration is one job over all partitions."""
    lr = LogisticRegression(family="multinomial", fitIntercept=True, maxIter=max_iter, regParam=reg, tol=tol,
                            labelCol="label", featuresCol="features")
    return lr.fit(with_class_count(rows, num_classes))


def predict_congestion(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """rows + prediction (double)."""
    return model.transform(rows).drop("rawPrediction", "probability")


def accuracy(predictions: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """One row (accuracy): share of rows whose prediction equals the label
    (the reference calls it precision); NULL on no rows."""
    hit = (F.col(prediction_col) == F.col(label_col)).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"))


MODEL_SCHEMA = "target_id string, class int, intercept double, coefficients array<double>"
SPLIT_KEY = ("target_id", "minute")


def fit_per_target(rows: DataFrame, targets, fraction: float = 0.8, seed: int = 0,
                   num_classes: int = DEFAULT_CLASSES, max_iter: int = DEFAULT_MAX_ITER, tol: float = DEFAULT_TOL) -> DataFrame:
    """One model per target camera, as the reference trains them ->
    (target_id, class, intercept, coefficients).

    ``targets`` are the configured cameras, a list. Each is split by a repeatable
    hash of (target, minute) and fitted on its training part; a target without
    training rows gives no model. All targets share the jobs of one fit
    (``softmax_fit``); only the models (targets x classes rows) pass the driver.
    """
    from .als import in_train

    fitted = fit_all(rows.where(in_train(fraction, seed, SPLIT_KEY)), list(targets), num_classes, max_iter, tol)
    models = [(t, k, float(bias[k]), weights[k].tolist()) for t, (weights, bias) in fitted.items() for k in range(num_classes)]
    return rows.sparkSession.createDataFrame(models, MODEL_SCHEMA)


def predict_per_target(models: DataFrame, rows: DataFrame) -> DataFrame:
    """rows + prediction by the model of their target: one join for all
    targets, the class of the largest margin (ties to the smaller class).
    Rows without a model are left out."""
    by = models.groupBy("target_id").agg(F.collect_list(F.struct("class", "intercept", "coefficients")).alias("_m"))
    x = vector_to_array("features") if rows.schema["features"].dataType.simpleString() == "vector" else F.col("features")
    margin = F.transform("_m", lambda m: F.struct((m["intercept"] + dot(m["coefficients"], F.col("_x"))).alias("g"),
                                                  (-m["class"]).alias("k")))
    scored = rows.withColumn("_x", x).join(by, "target_id").withColumn("prediction", (-F.array_max(margin)["k"]).cast("double"))
    return scored.drop("_m", "_x").select(*rows.columns, "prediction")


def evaluate_per_target(rows: DataFrame, targets, fraction: float = 0.8, seed: int = 0,
                        num_classes: int = DEFAULT_CLASSES, max_iter: int = DEFAULT_MAX_ITER,
                        models: DataFrame | None = None) -> DataFrame:
    """(target_id, n_train, n_test, accuracy) with one model per target, fitted
    here unless ``models`` are given; scored and measured for all targets in one
    join and one aggregate. ``rows`` must be a stored table."""
    from .als import in_train

    if models is None:
        models = fit_per_target(rows, targets, fraction, seed, num_classes, max_iter)
    train = in_train(fraction, seed, SPLIT_KEY)
    hit = F.when(~F.col("_train"), (F.col("prediction") == F.col("label")).cast("double"))
    return predict_per_target(models, rows).withColumn("_train", train).groupBy("target_id").agg(
        F.count_if("_train").alias("n_train"), F.count_if(~F.col("_train")).alias("n_test"), F.avg(hit).alias("accuracy"))
