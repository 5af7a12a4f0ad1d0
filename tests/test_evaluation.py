"""AUC, confusion table and smoothing against plain Python."""

import datetime as dt
import random

from starmart.operators.evaluation import confusion, rank_auc
from starmart.operators.smoothing import GRID, best_models, smoothed_forecast, smoothing_models


def test_rank_auc_with_ties_and_groups(spark):
    r = random.Random(5)
    rows = [(g, r.choice([0.1, 0.2, 0.2, 0.5, 0.9, -3.0, None]), r.choice([0, 1, 1, None])) for g in ("a", "b", None) for _ in range(150)]
    rows += [("one", 0.3, 1)] * 3
    df = spark.createDataFrame(rows, "g string, score double, label int").repartition(5)
    got = {x.g: x for x in rank_auc(df, "score", "label", ("g",), ranges=3).collect()}
    for g in ("a", "b", None):
        pos = [s for k, s, y in rows if k == g and y == 1 and s is not None]
        neg = [s for k, s, y in rows if k == g and y == 0 and s is not None]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert (got[g].n_pos, got[g].n_neg) == (len(pos), len(neg)) and abs(got[g].auc - want) < 1e-12
    assert got["one"].auc is None
    assert rank_auc(df.limit(0), "score", "label").first().auc is None
    c = {x.g: x for x in confusion(df, "score", "label", 0.2, ("g",)).collect()}["a"]
    known = [(s >= 0.2, y) for k, s, y in rows if k == "a" and s is not None and y is not None]
    assert (c.tp, c.fp, c.fn, c.tn) == tuple(known.count(x) for x in ((True, 1), (True, 0), (False, 1), (False, 0)))
    assert abs(c.f1 - 2 * c.precision * c.recall / (c.precision + c.recall)) < 1e-12


def holt_winters(y, m, tail, a, b, g):
    m1, m2 = sum(y[:m]) / m, sum(y[m:2 * m]) / m
    level, trend, season, err = m1, (m2 - m1) / m, [v - m1 for v in y[:m]], 0.0
    for i in range(m, len(y)):
        s = season[i % m] if i >= m else 0
        if i >= len(y) - tail:
            err += abs(y[i] - (level + trend + s))
        new = a * (y[i] - s) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        season[i % m] = g * (y[i] - new) + (1 - g) * s
        level = new
    return err / tail, level, trend, [season[(len(y) + h) % m] for h in range(m)]


def test_smoothing_follows_trend_and_season(spark):
    r = random.Random(2)
    start = dt.date(2020, 1, 1)
    season = [0, 5, 9, 2, -4, -8, -4]
    rising = [100 + 0.8 * t + season[t % 7] + r.uniform(-1, 1) for t in range(120)]
    weekly = [50.0 + season[t % 7] for t in range(60)]
    rows = [("rising", start + dt.timedelta(days=t), v) for t, v in enumerate(rising)] + [("weekly", start + dt.timedelta(days=t), v) for t, v in enumerate(weekly) if t != 20]
    rows += [("short", start + dt.timedelta(days=t), float(t)) for t in range(15)]
    df = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    weekly[20] = 0.0  # a day without a value counts as 0
    got = {(x.unique_id, x.model_name): x for x in smoothing_models(df).collect()}
    for name, y in (("rising", rising), ("weekly", weekly)):
        for p in GRID:
            mae, level, trend, s = holt_winters(y, 7, 28, *p)
            x = got[name, f"ETS({p[0]},{p[1]},{p[2]})"]
            assert max(abs(u - v) for u, v in zip([mae, level, trend, *s], [x.mae, x.level, x.trend, *x.season])) < 1e-6
    best = {x.unique_id: x.model_name for x in best_models(smoothing_models(df)).collect()}
    assert best["rising"].startswith("ETS") and best["weekly"] == best["short"] == "SeasonalNaive"
    f = [x.yhat for x in smoothed_forecast(df, 30).where("unique_id = 'rising'").orderBy("ds").collect()]
    assert max(abs(v - (100 + 0.8 * t + season[t % 7])) for v, t in zip(f, range(120, 150))) < 6
