"""Plan shape: one-row fits and bounded products must not become cross joins."""

import contextlib
import io

import pytest

from paths import SF_SMALL
from tessera.plans.registry import queries

NO_CROSS = ["impute_median", "winsorize", "iqr_outlier_report", "remove_outliers_iqr", "standard_scale",
            "threshold_target", "histogram", "prf_per_class", "roc_curve", "expanding_folds",
            "compare_models", "normalise_by_max", "feature_groups", "split_features_target"]


def _physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", NO_CROSS)
def test_no_cross_join_in_plan(spark, name):
    plan = _physical_plan(queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
