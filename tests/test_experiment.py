"""A/B read-out against numpy on the same numbers (FIXTURES 5: group of one row)."""

import math

import numpy as np

from kpiforge.operators import experiment as X


def _ab(spark, g0, g1, single=None):
    rows = [(f"a{i}", 2018, 1, float(v), 0) for i, v in enumerate(g0)]
    rows += [(f"b{i}", 2018, 1, float(v), 1) for i, v in enumerate(g1)]
    if single is not None:
        rows.append(("z", 2018, 2, float(single), 0))
    return spark.createDataFrame(rows, "order_id string, year int, quarter int, order_revenue double, group_id int")


def test_welch_matches_numpy(spark):
    g0 = [10, 12, 9, 30, 11, 10]
    g1 = [13, 12, 15, 9, 40]
    w = {r["quarter"]: r for r in X.ab_welch(_ab(spark, g0, g1, single=7)).collect()}
    r = w[1]
    v0, v1 = np.var(g0, ddof=1), np.var(g1, ddof=1)
    n0, n1 = len(g0), len(g1)
    se = math.sqrt(v0 / n0 + v1 / n1)
    dof = (v0 / n0 + v1 / n1) ** 2 / (v0 ** 2 / (n0 ** 2 * (n0 - 1)) + v1 ** 2 / (n1 ** 2 * (n1 - 1)))
    pooled = math.sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2))
    assert math.isclose(r["se"], se) and math.isclose(r["welch_df"], dof)
    assert math.isclose(r["sd_pool"], pooled)
    assert math.isclose(r["t_stat"], (np.mean(g1) - np.mean(g0)) / se)
    assert w[2]["baseline_sd"] is None                       # group of one row: SD NULL


def test_summary_grid_and_winsor(spark):
    g0 = list(range(1, 101))
    g1 = list(range(2, 102))
    ab = _ab(spark, g0, g1)
    s = {r["group_id"]: r for r in X.ab_summary(ab).collect()}
    assert s[0]["median"] == np.median(g0) and math.isclose(s[0]["std"], np.std(g0, ddof=1))
    grid = X.ab_effect_grid(X.ab_welch(ab)).collect()
    assert sorted(round(r["mde_rel"], 2) for r in grid) == [0.02, 0.03, 0.05, 0.08, 0.10]
    wz = X.ab_winsor(ab).first()
    cap0 = np.quantile(g0, 0.999)
    assert math.isclose(wz["baseline_mean"], float(np.mean(np.minimum(g0, cap0))))
