"""The next-day forecast (M14, L1-L13) on MLlib."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions.numeric import either_flag, portable_round
from sensorloom.operators import filters, scoring, timeseries
from sensorloom.operators.keys import dense_ids
from sensorloom.operators.reshape import concatenate
from sensorloom.session import scratch_path, stored

# The names of the features, in the order of the published table.
NEXT_DAY_WEATHER = {
    "temp_mean_c": "temp_next",
    "wind_mean_ms": "wind_next",
    "wind_dir_deg": "wind_dir_next",
    "rain_mm": "rain_next",
    "pressure_mean_hpa": "pressure_next",
    "humidity_mean_pct": "humidity_next",
}
FEATURES = [
    "pm25_d",
    "pm25_d1",
    "pm25_d2",
    "pm25_mean7",
    "nox_d",
    "o3max_d",
    *NEXT_DAY_WEATHER.values(),
    "pressure_change",
    "month",
    "day_of_week",
    "holiday_next",
]
TARGET = "target"

# Trees of a forest that are fitted together. A forest's parts are independent, so they run side by side.
PART_TREES = 25
# Parts that are fitted side by side on few cores, and per core on more; a task holds a group of nodes of up to 256 MB.
FITS_AT_ONCE = 6
FITS_PER_CORE = 2


def feature_rows(
    dataset: DataFrame,
    series: Sequence[str] = (),
    value: str = "pm25",
    companion: str = "nox",
    peak: str = "o3_max",
) -> DataFrame:
    """L1 before rows are dropped: what is known on the evening of a day, and the next day's value.

    The dataset is dense, so all lags, leads and the rolling mean share one window per series.
    """

    def tomorrow(column):
        return timeseries.lead_days(column, 1, series)

    today = F.col(value)
    return dataset.select(
        *series,
        "date",
        today.alias("pm25_d"),
        timeseries.lag_days(today, 1, series).alias("pm25_d1"),
        timeseries.lag_days(today, 2, series).alias("pm25_d2"),
        timeseries.rolling_mean(today, 7, 5, series, is_dense=True).alias("pm25_mean7"),
        F.col(companion).alias("nox_d"),
        F.col(peak).alias("o3max_d"),
        *[tomorrow(F.col(column)).alias(name) for column, name in NEXT_DAY_WEATHER.items()],
        timeseries.change_to_next(F.col("pressure_mean_hpa"), series).alias("pressure_change"),
        tomorrow(F.col("month")).alias("month"),
        tomorrow(F.col("day_of_week")).alias("day_of_week"),
        tomorrow(either_flag(F.col("is_public_holiday"), F.col("is_school_holiday"))).alias("holiday_next"),
        tomorrow(today).alias(TARGET),
    )


def features(dataset: DataFrame, series: Sequence[str] = (), **columns: str) -> DataFrame:
    """L1: complete rows only."""
    return filters.complete_rows(feature_rows(dataset, series, **columns), [*FEATURES, TARGET])


def split_name(
    train_until: int = settings.TRAIN_UNTIL,
    valid: int = settings.VALID_YEAR,
    test: int = settings.TEST_YEAR,
    demo: int = settings.DEMO_YEAR,
    split_on: str = "date",
) -> Column:
    """L2: the set a row belongs to, by the year of the day the forecast is made.

    `split_on="target_date"` uses the year of the day it is for.
    """
    day = F.col("date") if split_on == "date" else F.date_add("date", 1)
    year = F.year(day)
    return (
        F.when(year <= train_until, "train")
        .when(year == valid, "validation")
        .when(year == test, "test")
        .when(year == demo, "demo")
    )


def split_summary(rows: DataFrame, threshold: float = settings.GUIDELINE, **years) -> DataFrame:
    """L2: rows and share of exceedances per set."""
    named = rows.withColumn("split", split_name(**years)).filter(F.col("split").isNotNull())
    share = F.lit(100.0) * F.count_if(F.col(TARGET) > threshold) / F.count("*")
    return named.groupBy("split").agg(
        F.count("*").alias("n_rows"), portable_round(share, 1).alias("pct_days_above_who")
    )


def assembled(rows: DataFrame, inputs: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """The feature vector of each row."""
    return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(rows)


def fit_linear(train: DataFrame):
    """Ordinary least squares from one pass over the rows."""
    return LinearRegression(
        featuresCol="features", labelCol=TARGET, predictionCol="forecast", regParam=0.0, solver="normal"
    ).fit(train)


class Point(NamedTuple):
    """A forest of the grid; an unlimited depth is MLlib's greatest, 30."""

    max_depth: int | None = None
    min_leaf: int = 1
    max_features: float = 1.0

    def depth(self) -> int:
        return 30 if self.max_depth is None else self.max_depth


def fit_part(
    train: DataFrame, point: Point, trees: int, seed: int = settings.SEED, forecast: str = "forecast"
):
    """Some trees of a forest, with bootstrap samples and features drawn by the seed.

    The node of every row is kept between levels. Otherwise all trees so far, as objects of the driver, go to the tasks
    of every level through the scheduler's one thread, which the fits side by side then wait for. The trees are the same.
    """
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=TARGET,
        predictionCol=forecast,
        numTrees=trees,
        maxDepth=point.depth(),
        minInstancesPerNode=point.min_leaf,
        featureSubsetStrategy="all" if point.max_features >= 1.0 else str(point.max_features),
        maxBins=128,
        cacheNodeIds=True,
        seed=seed,
    ).fit(train)


def each_forest(
    train: DataFrame,
    points: Sequence[Point],
    trees: int = settings.TREES,
    seed: int = settings.SEED,
    at_once: int | None = None,
) -> Iterator[tuple[Point, PipelineModel]]:
    """A forest per distinct point, all from the same rows, one after another as they are done.

    A level of a small table is one task, so that a forest as a whole would keep one core busy for as long as all its
    trees take. Its trees are independent: parts of PART_TREES trees, each with a seed of its own, are jobs side by
    side, those of the deepest trees first, and the forecast is the mean over the trees of all parts. The parts follow from
    the number of trees, not from the cluster, and all forests draw the same samples. Between two levels a part waits
    for the driver, so there are more parts side by side than cores; a core still works on one of them at a time.
    """
    spark = train.sparkSession
    sizes = [min(PART_TREES, trees - first) for first in range(0, trees, PART_TREES)]
    names = [f"_forecast_{i}" for i in range(len(sizes))]

    def fitted(point, i):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"forest-{points.index(point)}-{i}")
        return fit_part(train, point, sizes[i], seed + i, names[i])

    def cost(point):
        return point.max_depth is not None, -(point.max_depth or 0), point.min_leaf, -point.max_features

    total = " + ".join(f"{size} * {name}" for size, name in zip(sizes, names))
    mean = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}), ({total}) / {trees} AS forecast FROM __THIS__")
    at_once = at_once or max(FITS_AT_ONCE, FITS_PER_CORE * spark.sparkContext.defaultParallelism)
    fit = inheritable_thread_target(spark)(fitted)
    with ThreadPoolExecutor(min(at_once, len(points) * len(sizes))) as pool:
        waiting = deque((point, [pool.submit(fit, point, i) for i in range(len(sizes))]) for point in sorted(set(points), key=cost))
        try:
            while waiting:
                # Nothing here keeps a forest that was handed out.
                point, parts = waiting.popleft()
                yield point, PipelineModel(stages=[*[part.result() for part in parts], mean])
                del parts
        finally:
            pool.shutdown(wait=True, cancel_futures=True)


def fit_forests(train: DataFrame, points: Sequence[Point], trees: int = settings.TREES, **options) -> list[PipelineModel]:
    """A forest per point, see `each_forest`."""
    found = dict(each_forest(train, points, trees, **options))
    return [found[point] for point in points]


def fit_forest(
    train: DataFrame,
    trees: int = settings.TREES,
    max_depth: int | None = None,
    min_leaf: int = 1,
    max_features: float = 1.0,
    seed: int = settings.SEED,
) -> PipelineModel:
    """A random forest; an unlimited depth is MLlib's greatest, 30."""
    return fit_forests(train, [Point(max_depth, min_leaf, max_features)], trees, seed=seed)[0]


def leaf_values(nodes: pd.DataFrame, depths: Sequence[int]) -> pd.DataFrame:
    """What each leaf of one tree, whose nodes are numbered from the root to the left, says where the tree is cut off at a depth."""
    nodes = nodes.sort_values("id", ignore_index=True)
    left, right, own = (nodes[name].to_numpy() for name in ("left", "right", "prediction"))
    said = np.repeat(own[:, None], len(depths), axis=1)
    above, level = np.zeros(1, int), 0
    while (above := above[left[above] >= 0]).size:
        level += 1
        for below in (left[above], right[above]):
            said[below] = np.where(level <= np.array(depths), said[below], said[above])
        above = np.concatenate([left[above], right[above]])
    said = said[left < 0]
    part, tree = nodes.loc[0, ["part", "tree"]].astype(int)
    return pd.DataFrame({"part": part, "tree": tree, "leaf": np.arange(len(said)), "said": list(said)})


def errors_by_depth(model: PipelineModel, valid: DataFrame, depths: Sequence[int]) -> list[float | None]:
    """The mean absolute error of a forest from `each_forest`, cut off at each depth.

    A row's leaf of a tree follows from the model; what the node above it at a depth says, from the nodes as the model is
    saved. Trees and parts are added up in their order, as the model does, and rows in theirs, so that equal forests tie.
    """
    spark, (*parts, _) = valid.sparkSession, model.stages
    folder = scratch_path(spark, "forest")

    def save(i):
        parts[i].write().save(f"{folder}/{i}")

    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(inheritable_thread_target(spark)(save), range(len(parts))))
    sizes = [part.getNumTrees for part in parts]
    nodes = reduce(
        DataFrame.unionByName,
        [
            spark.read.parquet(f"{folder}/{i}/data").select(
                F.lit(i).alias("part"),
                (F.col("treeID") + sum(sizes[:i])).alias("tree"),
                "nodeData.id",
                "nodeData.prediction",
                F.col("nodeData.leftChild").alias("left"),
                F.col("nodeData.rightChild").alias("right"),
            )
            for i in range(len(parts))
        ],
    )
    leaves = nodes.groupBy("part", "tree").applyInPandas(
        lambda tree: leaf_values(tree, depths), "part int, tree int, leaf int, said array<double>"
    )
    names = [f"_leaf_{i}" for i in range(len(parts))]
    numbered = valid.select(F.monotonically_increasing_id().alias("row"), TARGET, "features")
    found = PipelineModel(stages=[part.copy({part.leafCol: name}) for part, name in zip(parts, names)]).transform(numbered)
    reached = found.select(
        "row",
        TARGET,
        F.posexplode(F.flatten(F.array(*[vector_to_array(name) for name in names]))).alias("tree", "leaf"),
    ).withColumn("leaf", F.col("leaf").cast("int"))
    # The leaves go to the rows, as the model does; a row's trees are added up before anything is shuffled.
    sums = F.array(*[F.sum(F.col("said")[d]) for d in range(len(depths))])
    by_part = reached.join(F.broadcast(leaves), ["tree", "leaf"]).groupBy("row", TARGET, "part").agg(sums.alias("sums"))
    by_row = by_part.groupBy("row", TARGET).agg(F.sort_array(F.collect_list(F.struct("part", "sums"))).alias("parts")).orderBy("row")

    def forecast(d):
        means = [size * (F.col("parts")[i]["sums"][d] / size) for i, size in enumerate(sizes)]
        return reduce(Column.__add__, means) / sum(sizes)

    return list(by_row.agg(*[F.avg(F.abs(F.col(TARGET) - forecast(d))) for d in range(len(depths))]).first())


class Tuned(NamedTuple):
    """The grid, best first, its best point and the forest that was fitted there."""

    grid: DataFrame
    best: dict[str, float | int | None]
    model: PipelineModel


def tune(
    train: DataFrame,
    valid: DataFrame,
    depths: Sequence[int | None] = tuple(settings.GRID_DEPTH),
    leaves: Sequence[int] = tuple(settings.GRID_LEAF),
    shares: Sequence[float] = tuple(settings.GRID_FEATURES),
    at_once: int | None = None,
    **options,
) -> Tuned:
    """Measure the forest of every combination on a fixed later year.

    Both sets are stored first. A forest is grown level by level, and no level asks for the greatest depth; so the forests
    of points that differ in depth only are the deepest of them, cut off, and just that one is fitted. (With a share of
    the features the draws are the same as long as a level fits in a group of nodes; otherwise they are others of the kind.)
    The fits are jobs side by side (see `each_forest`), each in a scheduler pool of its own. A forest is measured while
    others are fitted, and only the best so far is kept. The best point's own forest is fitted and measured itself.
    Ties go to an unlimited depth first, then to the smaller combination.
    """
    train, valid = stored(train, "train"), stored(valid, "validation")
    points = [Point(*point) for point in product(depths, leaves, shares)]
    kin = {point: sorted({p for p in points if p[1:] == point[1:]}, key=Point.depth) for point in points}
    deepest = [point for point in dict.fromkeys(points) if kin[point][-1] == point]
    errors, fitted, best = {}, set(), None

    def rank(point):
        return errors[point] is None, errors[point] or 0.0, point.max_depth is not None, point

    def measure(point, model):
        nonlocal best
        fitted.add(point)
        if errors.get(point) is None or len(kin[point]) == 1:
            errors[point] = model.transform(valid).agg(F.avg(F.abs(F.col(TARGET) - F.col("forecast")))).first()[0]
        if best is None or rank(point) < rank(best[0]):
            best = point, model

    for point, model in each_forest(train, deepest, at_once=at_once, **options):
        if len(kin[point]) > 1:
            errors.update(zip(kin[point], errors_by_depth(model, valid, [p.depth() for p in kin[point]])))
        measure(point, model)
        del model
    while (first := min(errors, key=rank)) not in fitted:
        del errors[first]
        for point, model in each_forest(train, [first], at_once=at_once, **options):
            measure(point, model)
    layout = "max_depth int, min_samples_leaf int, max_features double, valid_MAE double"
    found = [(*point, errors[point]) for point in sorted(points, key=rank)]
    return Tuned(train.sparkSession.createDataFrame(found, layout), best[0]._asdict(), best[1])


def grid_search(train: DataFrame, valid: DataFrame, **options) -> DataFrame:
    """Validation error of every combination, best first."""
    return tune(train, valid, **options).grid


def importance(
    model,
    rows: DataFrame,
    key: Sequence[str] = ("date",),
    inputs: Sequence[str] = tuple(FEATURES),
    repeats: int = settings.IMPORTANCE_REPEATS,
    seed: int = settings.SEED,
) -> DataFrame:
    """How much the mean absolute error grows when one feature is shuffled.

    The rows are numbered once, in a random order; in a repeat each row takes the feature's value from the
    row so many places on, another number per repeat. That is a permutation, found by one equi-join of the
    rows' repeats with the rows; the features multiply the rows only after it.
    """
    n = rows.count()
    vector = vector_to_array("features").alias("inputs")
    shuffled = rows.select(*key, TARGET, vector).withColumn("_at", F.xxhash64(*key, F.lit(seed)))
    placed = dense_ids(shuffled, ["_at", *key], "place").withColumn("place", F.col("place") - 1)
    repeat = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    # Shifts that differ while there are as many places as repeats.
    start = F.pmod(F.xxhash64(F.lit(seed)), F.lit(max(n - 1, 1)))
    step = F.pmod(start + F.col("repeat") * max(n // (repeats + 1), 1), F.lit(max(n - 1, 1))) + 1
    wanted = placed.withColumn("repeat", repeat).withColumn("from", F.pmod(F.col("place") + step, F.lit(n)))
    donors = placed.select(F.col("place").alias("from"), F.col("inputs").alias("donor"))
    given = wanted.join(donors, "from").withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(len(inputs) - 1))))
    swapped = F.transform(
        "inputs",
        lambda value, i: F.when(i == F.col("feature"), F.get(F.col("donor"), i)).otherwise(value),
    )
    tried = given.select("feature", TARGET, array_to_vector(swapped).alias("features"))
    error = F.avg(F.abs(F.col(TARGET) - F.col("forecast")))
    names = F.array(*[F.lit(name) for name in inputs])
    base = model.transform(rows).agg(error.alias("base"))
    by_feature = model.transform(tried).groupBy("feature").agg(error.alias("shuffled"))
    return by_feature.select(
        F.get(names, F.col("feature")).alias("feature"),
        (F.col("shuffled") - base.scalar()).alias("mae_increase"),
    )


def forecasts(rows: DataFrame, linear, forest) -> DataFrame:
    """The rows with the forecast of both models, without their vectors."""
    both = forest.transform(linear.transform(rows).withColumnRenamed("forecast", "linear"))
    return both.withColumnRenamed("forecast", "forest").drop("features")


def evaluate_models(
    predicted: DataFrame,
    alert_threshold: float,
    threshold: float = settings.GUIDELINE,
) -> DataFrame:
    """Baseline, linear model and forest, the forest also with its chosen threshold."""
    return concatenate(
        scoring.metrics(predicted, "persistence", TARGET, "pm25_d", threshold),
        scoring.metrics(predicted, "linear regression", TARGET, "linear", threshold),
        scoring.metrics(predicted, "random forest", TARGET, "forest", threshold),
        scoring.metrics(
            predicted, "random forest, chosen threshold", TARGET, "forest", threshold, alert_threshold
        ),
    )


def relative_gain(results: DataFrame, model: str = "random forest", baseline: str = "persistence") -> DataFrame:
    """The share of the baseline's error that a model saves."""

    def error(name):
        return F.max(F.when(F.col("model") == name, F.col("MAE")))

    return results.agg((F.lit(1.0) - F.try_divide(error(model), error(baseline))).alias("gain"))


def run(
    dataset: DataFrame,
    years: Mapping[str, int] | None = None,
    depths: Sequence[int | None] = tuple(settings.GRID_DEPTH),
    leaves: Sequence[int] = tuple(settings.GRID_LEAF),
    shares: Sequence[float] = tuple(settings.GRID_FEATURES),
    trees: int = settings.TREES,
    guideline: float = settings.GUIDELINE,
    thresholds: Sequence[float] = tuple(settings.THRESHOLDS),
    **columns: str,
) -> dict[str, object]:
    """Tune on the validation year, choose the threshold there, refit, test once, show a new year.

    The forecasts behind all tables are stored: on the validation year those of the models fitted before it, on
    the test and demo years those of the final ones. Runs the fits.
    """
    rows = stored(assembled(features(dataset, **columns)).withColumn("split", split_name(**(years or {}))), "features")
    train, valid = (rows.filter(F.col("split") == name) for name in ("train", "validation"))
    tuned = tune(train, valid, depths, leaves, shares, trees=trees)
    full = rows.filter(F.col("split").isin("train", "validation"))
    linear, forest = fit_linear(full), fit_forest(full, trees=trees, **tuned.best)
    before = forecasts(valid, fit_linear(train), tuned.model)
    after = forecasts(rows.filter(F.col("split").isin("test", "demo")), linear, forest)
    predicted = stored(before.unionByName(after), "forecasts")
    valid_, test, demo = (predicted.filter(F.col("split") == name) for name in ("validation", "test", "demo"))
    curve = scoring.threshold_curve(valid_, TARGET, "forest", thresholds, guideline)
    alert_threshold = scoring.choose_threshold(curve).first().alert_threshold
    alert_above = guideline if alert_threshold is None else alert_threshold
    compared = evaluate_models(test, alert_above, guideline)
    return {
        "grid": tuned.grid,
        "validation": evaluate_models(valid_, alert_above, guideline),
        "curve": curve,
        "alert_threshold": alert_threshold,
        "forecasts": predicted,
        "test": compared,
        "gain": relative_gain(compared),
        "confusion": scoring.confusion(test, TARGET, "forest", guideline, alert_above),
        "importance": importance(tuned.model, valid),
        "demo": scoring.published(demo, "pm25_d", TARGET, "forest", alert_above),
        "demo_metrics": evaluate_models(demo, alert_above, guideline).filter(
            F.col("model").isin("persistence", "random forest, chosen threshold")
        ),
        "model": PipelineModel(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]),
    }


def save_model(model: PipelineModel, path: str) -> None:
    """Keep a fitted pipeline."""
    model.write().overwrite().save(path)


def score(path: str, rows: DataFrame) -> DataFrame:
    """Apply a kept pipeline to rows it has not seen."""
    return PipelineModel.load(path).transform(rows)
