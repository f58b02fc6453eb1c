"""The whole study, in the order an analyst runs it, on the library.

    python examples/panel_study.py [sf_dir] [--quick]

Uses the driver tables in the panel roles (``panelspark.plans.standin``):
quality audits -> eligibility funnel -> labels -> descriptive statistics ->
segmentation -> regression sweeps -> temporal holdout -> error diagnostics.
Only aggregated result tables (a few rows each) are brought to the driver
for printing; every step runs as Spark jobs.  ``--quick`` uses smaller sweeps.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from panelspark.operators import audit, diagnose, funnel, labels, regress, segment, stats  # noqa: E402
from panelspark.plans import standin as S  # noqa: E402
from panelspark.session import get_session  # noqa: E402

KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
DICTS = {"l_returnflag": S.RETURNFLAG_LABELS, "priority_code": S.PRIORITY_LABELS}


def show(title: str, df, n: int = 20) -> None:
    print(f"\n== {title}")
    for row in df.limit(n).collect():
        print("  ", row.asDict())


def run(spark, sf_dir: str, quick: bool = False) -> dict:
    panel = S.panel(spark, sf_dir)
    rules = S.eligibility_rules()

    # 1 quality: provenance vs the data's own quarter, missing values, funnel, keys
    show("period x ship quarter", audit.crosstab_counts(panel, ["period", "ship_quarter"]).orderBy("period", "ship_quarter"), 8)
    show("missing values", audit.missing_audit(panel, ["dirty", "parcels", "l_quantity", "priority_code"]))
    show("eligibility funnel", funnel.funnel(panel, rules).orderBy("step_no"))
    eligible = labels.label_codes(funnel.apply_rules(panel, rules), DICTS)
    dev = eligible.where(F.col("year") < S.HOLDOUT_YEAR)
    holdout = eligible.where(F.col("year") == S.HOLDOUT_YEAR)
    versions = audit.duplicate_versions(dev, ["period", "l_orderkey", "l_linenumber"])
    show("distinct versions of repeated keys", audit.version_histogram(versions))

    # 2 descriptive statistics
    show("numeric summary", stats.numeric_summary(dev, ["l_extendedprice", "l_quantity", "charge", "days_to_ship"]))
    show("median price by priority", stats.group_median(dev, "l_extendedprice", ["priority_code", "priority_code_label"],
                                                        group_bound=len(S.PRIORITY_LABELS) + 1))
    show("median price by period", stats.group_median(dev, "l_extendedprice", ["period"], group_bound=len(S.YEARS)))
    show("histogram (first bins)", stats.histogram(dev, "l_extendedprice", 60).orderBy("bin"), 5)

    # 3 correlation
    corr = stats.correlation_long(dev, ["l_extendedprice", "l_quantity", "charge", "days_to_ship"])
    show("strongest association with price", stats.top_association(corr, "l_extendedprice"))

    # 4 segmentation
    feats = segment.scaler_pipeline(["l_quantity", "charge", "days_to_ship"]).fit(dev).transform(dev)
    sweep, models = segment.kmeans_sweep(feats, "features", ks=(2, 3) if quick else (2, 3, 4, 5), keys=KEY)
    show("k sweep", sweep.orderBy("k"))
    best_k = sweep.where("chosen").first()["k"]
    scored = segment.materialize(
        segment.assign_clusters(models[best_k], feats),
        ["cluster", "l_quantity", "charge", "days_to_ship", "l_extendedprice", "l_returnflag_label", "priority_code_label"])
    profile = segment.cluster_profile(scored, "cluster", ["l_quantity", "charge", "days_to_ship"], "l_extendedprice",
                                      {"l_returnflag_label": "flag_mode", "priority_code_label": "priority_mode"},
                                      cluster_bound=best_k)
    show("cluster profile", segment.describe_clusters(profile, scored, ["l_quantity", "charge", "days_to_ship"],
                                                      "priority_mode").orderBy("cluster"))

    # 5-6 regression: one split for both families, feature stages fitted on training rows only
    spec = regress.FeatureSpec(("l_quantity", "charge", "days_to_ship"), ("l_returnflag", "priority_code"), "l_extendedprice")
    train, valid = regress.split_frames(dev, KEY)
    ridge = regress.ridge_sweep(train, valid, spec, reg_params=(0.0, 10.0) if quick else (0.0, 0.1, 1.0, 10.0), keys=KEY)
    show("ridge sweep", ridge.table.orderBy("reg_param"))
    configs = ((10, 4),) if quick else ((60, 8), (120, 12))
    forest = regress.forest_sweep(train, valid, spec, configs=configs, keys=KEY)
    show("forest sweep", forest.table)
    base = regress.regression_metrics(regress.baseline_mean(train, valid, spec.label), spec.label)
    board = regress.leaderboard([("baseline_mean", base),
                                 ("linear", regress.regression_metrics(ridge.best_model.transform(valid), spec.label)),
                                 ("forest", regress.regression_metrics(forest.best_model.transform(valid), spec.label))],
                                baseline_name="baseline_mean")
    show("validation leaderboard", board.orderBy("rmse"))

    # 7 temporal holdout, scored once by the frozen pipelines
    mean = train.agg(F.avg(spec.label)).scalar()
    show("holdout", regress.holdout_evaluation([("linear", ridge.best_model), ("forest", forest.best_model)],
                                               holdout, spec.label, train_mean=mean).orderBy("rmse"))

    # 8 diagnostics on the holdout: one chain scores both models
    both = regress.score_both(holdout, [("pred_linear", ridge.best_model), ("pred_forest", forest.best_model)])
    show("forest errors by priority", diagnose.errors_by_group(both, spec.label, ["priority_code_label"], "pred_forest"))
    show("forest errors by value band", diagnose.errors_by_band(both, spec.label, "pred_forest"))
    sample = diagnose.paired_sample(both, S.SAMPLE_KEY[:3], [spec.label, "pred_linear", "pred_forest"], n=5000)
    return {"best_k": best_k, "sample_rows": sample.count()}


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = get_session("local[*]", 8)
    print(run(spark, sf_dir, quick="--quick" in sys.argv))


if __name__ == "__main__":
    main()
