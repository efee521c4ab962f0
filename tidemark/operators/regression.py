"""Feature scaling, linear regression and scoring of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample variance and standard deviation, in one pass."""
    one = df.agg(*[F.struct(
        F.lit(c).alias("feature"), F.count(c).alias("n"), F.avg(c).alias("mean"),
        F.var_samp(c).alias("variance"), F.stddev_samp(c).alias("stddev")).alias(c) for c in columns])
    return one.select(F.inline(F.array(*columns)))


def scale(df: DataFrame, columns: Sequence[str], with_mean: bool = True, suffix: str = "_scaled") -> DataFrame:
    """Mean-variance normalisation of each column; ``with_mean=False`` only divides.

    A constant column becomes 0.
    """
    def stat(f, c):
        return df.agg(f(c)).scalar()

    def scaled(c):
        divided = F.try_divide((F.col(c) - stat(F.avg, c)) if with_mean else F.col(c), stat(F.stddev_samp, c))
        return F.when(F.col(c).isNotNull(), F.coalesce(divided, F.lit(0.0)))
    return df.withColumns({c + suffix: scaled(c) for c in columns})


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Concatenate columns to one feature vector; a NULL is NaN in it, and every row stays."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="keep").transform(df)


def _usable(columns: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])


def usable_rows(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """How many rows a fit uses, and how many it leaves out for a NULL or NaN."""
    ok = _usable([label, *features])
    return df.agg(F.count_if(ok).alias("used"), F.count_if(~ok).alias("left_out"))


def fit_regression(df: DataFrame, label: str, features: Sequence[str], with_mean: bool = True,
                   reg: float = 0.0) -> PipelineModel:
    """Scaler and linear regression as one pipeline. The normal equations of a few
    features are one aggregation over the table. Rows with a NULL or NaN in the label or
    a feature take no part in the fit (:func:`usable_rows` counts them)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=with_mean, withStd=True),
        LinearRegression(labelCol=label, featuresCol="_scaled", predictionCol="prediction", regParam=reg,
                         solver="normal" if len(features) <= 1024 else "auto"),
    ]).fit(df.filter(_usable([label, *features])))


def coefficients(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Slope per unscaled feature and the intercept."""
    scaler, line = model.stages[-2], model.stages[-1]
    slopes = [float(w) / float(s) if s else 0.0 for w, s in zip(line.coefficients, scaler.std)]
    shift = sum(k * float(m) for k, m in zip(slopes, scaler.mean)) if scaler.getWithMean() else 0.0
    return dict(zip(features, slopes)) | {"intercept": float(line.intercept) - shift}


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All rows with their ``prediction``, which is NULL where a feature is NULL or NaN."""
    scored = model.transform(df).drop("_raw", "_scaled")
    return scored.withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Mean absolute and squared error, root of the latter and R squared (NULL for a constant label), in one pass."""
    e = F.col(label) - F.col(prediction)
    a = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(label).alias("_var"))
    return a.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
