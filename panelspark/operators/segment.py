"""Segmentation: standardised features, KMeans sweep, silhouette, cluster
profiles (M1-M9).

The fits are MLlib estimators (distributed aggregations per iteration).  The
feature frame is persisted (memory and disk) around the iterative fits and
released afterwards; a lost executor recomputes its blocks from lineage.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.columns import map_literal
from panelspark.operators import rounds
from panelspark.operators.quantiles import quantiles_of, widened
from panelspark.operators.stats import combine_by_key


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist for the duration of an iterative fit, then release."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def materialize(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cut the lineage of rows that several branches read: the needed columns
    are written once as Parquet under the shared ``spark.checkpoint.dir``
    folder and read back.

    Scored rows carry MLlib UDFs that Spark treats as nondeterministic, so
    without this every branch would re-run the scoring and no exchange over
    them could be reused; a lost executor re-reads the files instead of
    recomputing the model.  Parquet (columnar, compressed, vectorised reads)
    rather than ``checkpoint()``'s serialised rows.
    """
    from panelspark.session import shared_dir
    from panelspark.sources.store import write_parquet
    path = shared_dir(df.sparkSession, "materialized", unique=True)
    write_parquet(df.select(*columns) if columns is not None else df, path)
    return df.sparkSession.read.parquet(path)


#: Rows of an input whose fit runs in one partition, as a square root (see ``fit_partitions``).
ROOT_ROWS = 32


def fit_partitions(rows: int) -> int:
    """Partitions of a fit: the square root of its rows over ``ROOT_ROWS``.

    It follows the input alone, never the cores of the session, so the same rows
    give the same fit on any cluster.  Partitions and rows in one grow together
    (8 of 7,500 rows, 989 of a million, 9,883 of ten million): neither tasks nor
    a task's rows get out of hand."""
    return max(1, math.isqrt(rows) // ROOT_ROWS + 1)


def fit_input(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
              partitions: int | None = None) -> DataFrame:
    """Rows laid out for an iterative fit: dealt by the hash of all orderable
    columns and vectors, and sorted by them within partitions, ``keys`` first.

    KMeans, forests and the quasi-Newton solvers give results that depend on
    how rows are split into partitions (and on their order), even with a
    seed.  This layout depends on the rows alone: not on the input files, and
    not on the number of cores (``fit_partitions`` of the counted rows, which
    costs one scan of a column).  Rows of one key are spread by their other
    values, so a key that holds a third of them is no hot partition; only rows
    equal in everything meet.  ``columns`` prunes what is shuffled and persisted.
    """
    n = partitions or fit_partitions(df.count())
    cols = list(dict.fromkeys([*keys, *columns])) if columns is not None else df.columns
    narrow = df.select(*cols)
    orderable = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
                 T.TimestampNTZType)
    others = [f for f in narrow.schema.fields if f.name not in keys]
    ties = [F.col(f.name) for f in others if isinstance(f.dataType, orderable)]
    ties += [vector_to_array(F.col(f.name)) for f in others if isinstance(f.dataType, VectorUDT)]
    order = [*[F.col(k) for k in keys], *ties]
    return narrow.repartition(n, *order).sortWithinPartitions(*order)


def scaler_pipeline(columns: Sequence[str], raw_col: str = "features_raw",
                    out_col: str = "features") -> Pipeline:
    """VectorAssembler + StandardScaler(withMean, withStd) (sample std)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol=raw_col),
        StandardScaler(inputCol=raw_col, outputCol=out_col, withMean=True, withStd=True),
    ])


def standardized_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
                         prefix: str = "z_") -> DataFrame:
    """``(x - mean) / stddev_samp`` per column, through the fitted scaler."""
    model = scaler_pipeline(columns).fit(df)
    arr = vector_to_array(F.col("features"))
    return model.transform(df).select(
        *keep, *[arr[i].alias(f"{prefix}{c}") for i, c in enumerate(columns)])


def kmeans_sweep(df: DataFrame, features_col: str, ks: Sequence[int] = (2, 3, 4, 5),
                 seed: int = 42, prediction_col: str = "cluster", max_iter: int = 20,
                 keys: Sequence[str] | None = None, rows_of: int | None = None, count_col: str | None = None,
                 raw: Sequence[str] = ()) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """Fit KMeans for every k; silhouette (squared Euclidean) and WSSSE.

    Returns the result table ``k, silhouette, wssse, chosen`` (chosen = max
    silhouette, smallest k on ties) and the fitted models.  With ``keys`` the
    features are first laid out by ``fit_input`` (reproducible fits).  More than
    ``rounds.MANY_ROWS`` rows are not laid out: all k are then fitted in shared
    passes that follow the rows alone (``operators.rounds``).  ``rows_of``: the
    number of rows, where known; ``count_col``: how many of them a row stands for;
    ``raw``: the columns that the features are scaled from.
    """
    # Rounds over blocks of rows as matrices; over persisted rows MLlib would
    # by itself decode and compare them one by one in every round.
    estimators = {int(k): KMeans(featuresCol=features_col, predictionCol=prediction_col, k=k,
                                 seed=seed, maxIter=max_iter, solver="block") for k in ks}
    n = df.count() if rows_of is None else rows_of
    if n > rounds.MANY_ROWS or count_col is not None:
        fitted = rounds.shared_sweep(df, estimators, seed, count_col, raw)
    else:
        fitted = _row_sweep(df, estimators, keys, n)
    rows = [(k, float(sil), float(cost)) for k, (_, sil, cost) in fitted.items()]
    models = {k: model for k, (model, _, _) in fitted.items()}
    best = sorted(rows, key=lambda r: (-r[1], r[0]))[0][0]
    schema = T.StructType([T.StructField("k", T.IntegerType()),
                           T.StructField("silhouette", T.DoubleType()),
                           T.StructField("wssse", T.DoubleType()),
                           T.StructField("chosen", T.BooleanType())])
    table = df.sparkSession.createDataFrame([(k, s, w, k == best) for k, s, w in rows], schema)
    return table, models


def _row_sweep(df: DataFrame, estimators: Mapping[int, KMeans], keys: Sequence[str] | None, n: int
               ) -> dict[int, tuple[KMeansModel, float, float]]:
    """(model, silhouette, cost) of every k, fitted by MLlib one after another."""
    features_col, prediction_col = (next(iter(estimators.values())).getOrDefault(c) for c in ("featuresCol", "predictionCol"))
    evaluator = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                                    metricName="silhouette", distanceMeasure="squaredEuclidean")
    fitted = {}
    source = fit_input(df, keys, [features_col], fit_partitions(n)) if keys else df.select(features_col)
    with persisted(source.select(features_col)) as feats:
        for k, estimator in estimators.items():
            model = estimator.fit(feats)
            fitted[k] = (model, evaluator.evaluate(model.transform(feats)), model.summary.trainingCost)
    return fitted


def canonical_cluster_map(model: KMeansModel) -> dict[int, int]:
    """Cluster id -> rank of its centre in lexicographic order.

    KMeans numbers clusters arbitrarily; ranking the k centres (k values on
    the driver) gives ids that do not depend on the initialisation."""
    centres = [tuple(float(v) for v in c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    return {old: new for new, old in enumerate(order)}


def assign_clusters(model: KMeansModel, df: DataFrame, cluster_col: str = "cluster",
                    canonical: bool = True) -> DataFrame:
    out = model.transform(df)
    pred = model.getPredictionCol()
    if canonical:
        mapping = {str(k): str(v) for k, v in canonical_cluster_map(model).items()}
        out = out.withColumn(pred, map_literal(mapping)[F.col(pred).cast("string")].cast("int"))
    if pred != cluster_col:
        out = out.withColumnRenamed(pred, cluster_col)
    return out


def silhouette(df: DataFrame, features_col: str, cluster_col: str) -> float:
    """Mean silhouette (squared Euclidean), MLlib's distributed evaluator."""
    return ClusteringEvaluator(featuresCol=features_col, predictionCol=cluster_col,
                               metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(df)


def cluster_profile(df: DataFrame, cluster_col: str, means: Sequence[str], median_of: str,
                    modes: Mapping[str, str], cluster_bound: int | None = None) -> DataFrame:
    """Per cluster: n, mean of ``means`` (``<c>_mean``), median of
    ``median_of`` and the mode of each ``modes`` column (``column -> name``;
    ties: the smallest value; NULLs are no candidates).

    Each row is stacked once for the cluster, once for its value and once for
    each of its codes, and one aggregate counts (cluster, what, value, code) with
    map-side combine: the rows are read once and no cluster is held in one task.
    Counts, means and modes are then one aggregate over these groups, and the
    median is selected among the counts of values (``quantiles.quantiles_of``).
    A cluster without a value has a NULL median.
    """
    names, of = list(modes), range(len(means))
    inputs = [F.col(c).cast("double") for c in means]

    def part(what: int, value: Column, code: Column, measures: Sequence[Column]) -> Column:
        return F.struct(F.lit(what).alias("_what"), value.alias("_v"), code.alias("_t"),
                        *[m.alias(f"_a{i}") for i, m in enumerate(measures)])
    no_value = F.lit(None).cast(df.schema[median_of].dataType)
    no_code, nothing = F.lit(None).cast("string"), [F.lit(None).cast("double") for _ in of]
    stacked = F.array(part(0, no_value, no_code, inputs), part(1, F.col(median_of), no_code, nothing),
                      *[part(2 + i, no_value, F.col(c).cast("string"), nothing) for i, c in enumerate(names)])
    counted = df.select(F.col(cluster_col).alias("_k"), F.explode(stacked).alias("_p")).select("_k", "_p.*") \
        .groupBy("_k", "_what", "_v", "_t").agg(F.count(F.lit(1)).alias("_c"), *[F.avg(f"_a{i}").alias(f"_a{i}") for i in of])
    best = [F.min(F.when((F.col("_what") == 2 + i) & F.col("_t").isNotNull(), F.struct(-F.col("_c"), F.col("_t").alias("v"))))["v"]
            .alias(modes[c]) for i, c in enumerate(names)]
    table = counted.groupBy("_k").agg(
        F.max(F.when(F.col("_what") == 0, F.col("_c"))).alias("n"),
        *[F.max(F.when(F.col("_what") == 0, F.col(f"_a{i}"))).alias(f"{c}_mean") for i, c in enumerate(means)], *best)
    # The condition reads all aggregates: a filter on keys alone would sink below the
    # aggregate, and unread means would be pruned; either way the rows would be read
    # and counted once more for the median instead of sharing the exchange.
    complete = F.size(F.array(F.col("_c").cast("double"), *[F.col(f"_a{i}") for i in of])) > 0
    values = counted.select("_k", F.when((F.col("_what") == 1) & complete, F.col("_v")).alias("_x"), "_c")
    median = f"{median_of}_median"
    med = widened(quantiles_of(values.where(F.col("_x").isNotNull()).repartitionByRange("_k", "_x"),
                               [0.5], ["_k"], cluster_bound), [0.5], [median], ["_k"])
    cols = ["n", *[f"{c}_mean" for c in means], median, *modes.values()]
    return combine_by_key([table, med], ["_k"]).select(F.col("_k").alias(cluster_col), *cols)


def describe_clusters(profile: DataFrame, data: DataFrame, means: Sequence[str],
                      mode_col: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Adds ``description``: each mean against the overall mean (higher /
    lower) and the dominant category.  Overall means are scalar subqueries."""
    names = dict(names or {})
    overall = data.agg(*[F.avg(c).alias(c) for c in means])
    parts = []
    for c in means:
        g = overall.select(c).scalar()
        word = F.when(F.col(f"{c}_mean") >= g, F.lit("higher")).otherwise(F.lit("lower"))
        parts.append(F.concat(word, F.lit(" "), F.lit(names.get(c, c))))
    text = F.concat(F.concat_ws(", ", *parts), F.lit("; mostly "), F.lower(F.col(mode_col)))
    return profile.withColumn("description", text)


def nearest(columns: Sequence[str], model: PipelineModel) -> Column:
    """The cluster of a row by a fitted scaler and KMeans, as one SQL expression
    over ``columns``: the canonical number of the nearest centre (ties: the
    smallest number); NULL if a column is NULL.

    k x d numbers of the model become literals (raw units: centres are scaled
    back, distances divided by the squared deviations).  Unlike MLlib's UDF the
    expression is deterministic and stays in generated code, so plans over
    scored rows share exchanges and need no written copy."""
    scaler, km = model.stages[-2], model.stages[-1]
    mean, std = [float(v) for v in scaler.mean], [float(v) for v in scaler.std]
    centres = sorted(tuple(float(v) for v in c) for c in km.clusterCenters())

    def distance(centre: tuple[float, ...]) -> Column:
        parts = [F.pow((F.col(c).cast("double") - F.lit(m)) / F.lit(s) - F.lit(x), F.lit(2.0)) if s else F.lit(0.0)
                 for c, m, s, x in zip(columns, mean, std, centre)]
        return reduce(lambda a, b: a + b, parts)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(known, F.least(*[F.struct(distance(c).alias("d"), F.lit(i).alias("k")) for i, c in enumerate(centres)])["k"]
                  if len(centres) > 1 else F.lit(0))


def fit_segments(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42,
                 cluster_col: str = "cluster", keys: Sequence[str] | None = None
                 ) -> tuple[PipelineModel, DataFrame]:
    """Scale ``columns``, fit KMeans(k) and return (model, rows with clusters
    numbered canonically, by ``nearest``).  With ``keys`` the fit input is laid
    out by ``fit_input``; all rows of ``df`` are scored."""
    pipe = Pipeline(stages=[*scaler_pipeline(columns).getStages(),
                            KMeans(featuresCol="features", predictionCol="_cluster", k=k, seed=seed)])
    source = fit_input(df, keys, columns) if keys else df.select(*columns)
    with persisted(source) as cached:
        model = pipe.fit(cached)
    return model, df.withColumn(cluster_col, nearest(columns, model))


def scaled_sweep(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = (2, 3, 4, 5), seed: int = 42,
                 keys: Sequence[str] = ()) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """``kmeans_sweep`` over standardised ``columns``: the scaler too is fitted
    on the rows as ``fit_input`` lays them out, so nothing depends on the
    number of cores or on the files.  Of many rows (``rounds.MANY_ROWS``) the
    scaler is fitted as they lie, and rows equal in ``columns`` are scaled once."""
    n = df.count()
    if n > rounds.MANY_ROWS:
        counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
        scaled = scaler_pipeline(columns).fit(df.select(*columns)).transform(counted)
        return kmeans_sweep(scaled, "features", ks, seed, rows_of=n, count_col="rows", raw=columns)
    with persisted(fit_input(df, keys, columns, fit_partitions(n)).select(*columns)) as rows:
        return kmeans_sweep(scaler_pipeline(columns).fit(rows).transform(rows), "features", ks, seed, rows_of=n)
