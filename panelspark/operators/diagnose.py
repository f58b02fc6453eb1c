"""Error diagnostics on scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.columns import value_band
from panelspark.operators.quantiles import quantiles_wide
from panelspark.operators.regress import score_all
from panelspark.operators.stats import seeded_sample

# --- fixed values ---------------------------------------------------------
# Probabilities and names of the value bands of the error-by-band table.
BAND_PROBS = (0.5, 0.9)
BAND_LABELS = ("up to p50", "p50 to p90", "above p90")
# ---------------------------------------------------------------------------


def residuals(pred: DataFrame, label: str, prediction: str = "prediction",
              residual_col: str = "residual") -> DataFrame:
    """actual - predicted (positive = under-prediction)."""
    return pred.withColumn(residual_col, F.col(label) - F.col(prediction))


def _error_aggs(err):
    return [F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
            F.avg(err).alias("mean_error"), F.sqrt(F.avg(err * err)).alias("rmse")]


def errors_by_group(pred: DataFrame, label: str, groups: Sequence[str],
                    prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, mean error and RMSE per value of each grouping column (and of
    ``by``, e.g. the model, of rows made long with ``regress.by_model``).

    Several groupings in one pass: the grouping columns are stacked (narrow)
    to ``grouping, group_value`` and aggregated once (partial aggregation, so
    a hot group is combined on the map side).
    """
    groups, by = list(groups), list(by)
    base = pred.select(*by, *[F.col(g).cast("string").alias(g) for g in groups],
                       (F.col(label) - F.col(prediction)).alias("_err"))
    stacked = base.unpivot([*by, "_err"], groups, "grouping", "group_value")
    return stacked.groupBy(*by, "grouping", "group_value").agg(*_error_aggs(F.col("_err")))


def errors_by_band(pred: DataFrame, label: str, prediction: str = "prediction",
                   probs: Sequence[float] = BAND_PROBS,
                   labels: Sequence[str] = BAND_LABELS,
                   thresholds_from: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Errors by band of the *actual* value; band edges are exact quantiles
    of ``label`` in ``thresholds_from`` (default: the scored rows): one scalar
    subquery gives them all.  Output: ``*by, band, n, mae, mean_error, rmse``."""
    src = thresholds_from if thresholds_from is not None else pred
    names = [f"_q{i}" for i in range(len(probs))]
    edges = quantiles_wide(src, label, list(probs), names).select(F.struct(*names)).scalar()
    banded = pred.withColumn("band", value_band(label, [edges[n] for n in names], list(labels)))
    err = F.col(label) - F.col(prediction)
    return banded.groupBy(*by, "band").agg(*_error_aggs(err))


def band_edges(df: DataFrame, label: str, probs: Sequence[float] = BAND_PROBS) -> DataFrame:
    names = [f"p{int(round(p * 100))}" for p in probs]
    return quantiles_wide(df, label, list(probs), names)


def paired_sample(scored: DataFrame, key: Sequence[str], columns: Sequence[str],
                  n: int = 5000, salt: str = "42") -> DataFrame:
    """At most ``n`` rows of a frame that already carries every model's
    prediction (see ``regress.score_both``): the same rows for all models
    without joining per-model outputs back on a key."""
    return seeded_sample(scored, n, key, salt, columns=list(key) + list(columns))


def paired_scores(rows: DataFrame, models: Sequence[tuple[str, PipelineModel]], key: Sequence[str],
                  label: str, n: int = 5000, salt: str = "42", train_mean: Column | None = None) -> DataFrame:
    """Actual value and every frozen model's prediction on at most ``n`` rows.

    The keys are sampled first, by hash, so the models score only the sample,
    in one chain: ``*key, actual, <model>...``.  Rows that share a key are
    told apart by their other columns, so equal runs sample equal rows."""
    chosen = seeded_sample(rows, n, key, salt)
    scored, names = score_all(chosen, models, train_mean)
    return scored.select(*key, F.col(label).alias("actual"), *names)
