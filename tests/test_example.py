"""The end-to-end study example runs on the small tables."""

from examples.panel_study import run
from tests.conftest import SF_SMALL


def test_panel_study_runs(spark, capsys):
    out = run(spark, SF_SMALL, quick=True)
    assert out["best_k"] in (2, 3) and out["sample_rows"] > 0
    printed = capsys.readouterr().out
    for title in ("eligibility funnel", "k sweep", "validation leaderboard", "holdout",
                  "forest errors by value band"):
        assert f"== {title}" in printed
