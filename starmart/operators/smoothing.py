"""Exponential smoothing with level, trend and season, and a choice of model per series.

Each series is one ordered array (bounded by the calendar); the recursion is a
native ``aggregate`` over it, once for each point of a small parameter grid.
Rolling-origin back-test: every value is forecast from the values before it, and
the mean absolute error over the last ``tail`` values decides, per series,
between the grid's models and the seasonal-naive one (a season before).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)
NAIVE = "SeasonalNaive"
#: (alpha, beta, gamma): weights of the newest value in level, trend and season
GRID = tuple((a, b, g) for a in (0.1, 0.3, 0.6) for b in (0.0, 0.05) for g in (0.1, 0.3))


def dense_series(series: DataFrame) -> DataFrame:
    """(unique_id, first, y): the values of every day from the first to the last, 0 where there is none."""
    s = series.select("unique_id", F.datediff("ds", F.lit(EPOCH)).alias("t"), F.col("y").cast("double").alias("y"))
    each = s.groupBy("unique_id").agg(F.min("t").alias("first"), F.max("t").alias("last"),
                                      F.map_from_entries(F.collect_list(F.struct("t", "y"))).alias("at"))
    return each.select("unique_id", "first", F.transform(F.sequence("first", "last"), lambda t: F.coalesce(F.try_element_at("at", t), F.lit(0.0))).alias("y"))


def _mean(values):
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def smoothing_models(series: DataFrame, period: int = 7, tail: int = 28) -> DataFrame:
    """A row for each series and model: unique_id, first, n, model_name, mae, level, trend, season (what forecasts go on from).

    Series shorter than two seasons and the tail have the seasonal-naive model only."""
    s = dense_series(series).withColumn("n", F.size("y"))
    grid = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(g).alias("g"),
                                        F.lit(f"ETS({a},{b},{g})").alias("model_name")) for a, b, g in GRID])).alias("p")
    long = s.where(F.col("n") >= 2 * period + tail).select("*", grid)
    one, two = F.slice("y", 1, period), F.slice("y", period + 1, period)
    start = F.struct(_mean(one).alias("level"), ((_mean(two) - _mean(one)) / period).alias("trend"),
                     F.transform(one, lambda x: x - _mean(one)).alias("season"), F.lit(0.0).alias("err"), F.lit(period).alias("i"))
    a, b, g = F.col("p.a"), F.col("p.b"), F.col("p.g")

    def step(st, y):
        old = F.element_at(st["season"], 1)
        level = a * (y - old) + (1 - a) * (st["level"] + st["trend"])
        trend = b * (level - st["level"]) + (1 - b) * st["trend"]
        season = F.concat(F.slice(st["season"], 2, period - 1), F.array(g * (y - level) + (1 - g) * old))
        err = F.when(st["i"] >= F.col("n") - tail, F.abs(y - (st["level"] + st["trend"] + old))).otherwise(0.0)
        return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"), (st["err"] + err).alias("err"), (st["i"] + 1).alias("i"))

    rest = F.slice("y", F.lit(period + 1), F.col("n") - period)
    fitted = long.select("unique_id", "first", "n", "p.model_name", F.aggregate(rest, start, step).alias("st")).select(
        "unique_id", "first", "n", "model_name", (F.col("st.err") / tail).alias("mae"), "st.level", "st.trend", "st.season")
    last = F.slice("y", F.greatest(F.col("n") - tail + 1, F.lit(period + 1)), F.lit(tail))
    before = F.slice("y", F.greatest(F.col("n") - tail + 1, F.lit(period + 1)) - period, F.lit(tail))
    misses = F.zip_with(last, F.slice(before, F.lit(1), F.size(last)), lambda x, y: F.abs(x - y))
    naive = s.where(F.col("n") > period).select(
        "unique_id", "first", "n", F.lit(NAIVE).alias("model_name"), _mean(misses).alias("mae"), F.lit(0.0).alias("level"),
        F.lit(0.0).alias("trend"), F.slice("y", F.col("n") - period + 1, F.lit(period)).alias("season"))
    return fitted.unionByName(naive)


def best_models(models: DataFrame) -> DataFrame:
    """The model of least error of each series; equal errors go to the first name."""
    return models.groupBy("unique_id").agg(F.min_by(F.struct(*models.columns), F.struct("mae", "model_name")).alias("m")).select("m.*")


def smoothed_forecast(series: DataFrame, horizon: int = 30, period: int = 7, tail: int = 28) -> DataFrame:
    """(unique_id, ds, model_name, yhat) of the days after each series, by its best model."""
    best = best_models(smoothing_models(series, period, tail))
    h = best.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    yhat = F.col("level") + F.col("h") * F.col("trend") + F.element_at("season", (F.col("h") - 1) % period + 1)
    return h.select("unique_id", F.date_add(F.lit(EPOCH), F.col("first") + F.col("n") + F.col("h") - 1).alias("ds"), "model_name",
                    F.round(yhat, 2).alias("yhat"))
