"""Regression of the log target with MLlib: selection, stacking, grid search, importance."""

from __future__ import annotations

import random
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folkmeter.functions import scalars as S
from folkmeter.operators.evaluation import metric_columns, metrics_back_transformed

FEATURES = [
    "followers",
    "following",
    "follower_ratio",
    "description_length",
    "post_count",
    "total_post_rating",
    "avg_post_rating",
    "max_post_rating",
    "avg_title_length",
    "avg_post_desc_length",
    "comment_count",
    "avg_comment_length",
    "total_activity",
    "total_rating",
]
TARGET = "log_karma"
SEED = 42
# The searched grid: depth, learning rate, trees, row sample.
GRID = {
    "maxDepth": [3, 5, 7, 10],
    "stepSize": [0.01, 0.05, 0.1],
    "maxIter": [50, 100, 200],
    "subsamplingRate": [0.7, 0.8, 1.0],
}
STACK_ALL, STACK_BEST = "stacked_all", "stacked_best_of_family"
BUCKET_ROWS = 100_000
# Rows of a task of a fit, if there are more than enough for all cores.
TASK_ROWS = 500_000
# When an ensemble stops: windows of so many scores, and the share by which they must get better.
ROUNDS, TOLERANCE = 5, 0.001


def available_features(df: DataFrame, features: list[str] = FEATURES) -> list[str]:
    found = [f for f in features if f in df.columns]
    if not found:
        raise ValueError("none of the feature columns is in the table")
    return found


def hash_bucket(key: str, seed: int, buckets: int = 100) -> Column:
    """Stable bucket of a row: independent of partitioning, of retries and of the engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def split(
    df: DataFrame, key: str = "id_user", train_percent: int = 80, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    bucket = hash_bucket(key, seed)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def candidates(max_models: int, seed: int = SEED) -> dict[str, object]:
    """Regressors in the order they are tried; no deep nets."""

    def gbt(**kw):
        return GBTRegressor(seed=seed, **kw)

    def forest(**kw):
        return RandomForestRegressor(seed=seed, **kw)

    named = {
        "ridge": LinearRegression(regParam=0.1, elasticNetParam=0.0),
        "gbt_5": gbt(maxDepth=5, maxIter=20, stepSize=0.1, subsamplingRate=0.8),
        "forest_5": forest(maxDepth=5, numTrees=20),
        "glm": GeneralizedLinearRegression(family="gaussian", regParam=0.01),
        "elastic": LinearRegression(regParam=0.05, elasticNetParam=0.5),
        "forest_10": forest(maxDepth=10, numTrees=50),
        "gbt_3": gbt(maxDepth=3, maxIter=50, stepSize=0.1, subsamplingRate=0.8),
        "gbt_7": gbt(maxDepth=7, maxIter=50, stepSize=0.05, subsamplingRate=0.8),
        "forest_7": forest(maxDepth=7, numTrees=50, featureSubsetStrategy="onethird"),
        "lasso": LinearRegression(regParam=0.05, elasticNetParam=1.0),
    }
    return dict(list(named.items())[:max_models])


def family(name: str) -> str:
    """Kind of a candidate, by its estimator."""
    return {"gbt": "boosted", "forest": "forest"}.get(name.split("_")[0], "linear")


def best_of_family(errors: dict[str, float]) -> list[str]:
    """The model of the least error of each family, in the order of ``errors``."""
    best: dict[str, str] = {}
    for name, error in errors.items():
        kind = family(name)
        if kind not in best or error < errors[best[kind]]:
            best[kind] = name
    return [n for n in errors if n in best.values()]


def moments(names: list[str], label: str = "label") -> list[Column]:
    """Sums of products of a leading one, the columns and the label: the upper triangle, row by row.

    All that least squares needs of rows of any number is these few numbers.
    """
    terms = [F.lit(1.0), *[F.col(n) for n in names], F.col(label)]
    return [
        F.sum(terms[i] * terms[j]).alias(f"m_{i}_{j}")
        for i in range(len(terms))
        for j in range(i, len(terms))
    ]


def moment_matrix(values: list[float], size: int) -> np.ndarray:
    """The symmetric matrix of ``moments``."""
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = values
    return out + np.triu(out, 1).T


def non_negative_weights(
    matrix: np.ndarray, chosen: list[int], rounds: int = 10_000, tolerance: float = 1e-10
) -> tuple[float, np.ndarray]:
    """(intercept, weights >= 0) of least squares on the ``chosen`` columns, from moments alone.

    Columns are centred, which takes the intercept out of the problem; then one weight after the
    other goes to its own optimum, cut at zero, until none moves.
    """
    n = matrix[0, 0]
    weights = np.zeros(len(chosen))
    if n == 0:
        return 0.0, weights
    means = matrix[0] / n
    centred = matrix - n * np.outer(means, means)
    at = np.array(chosen) + 1
    gram, cross = centred[np.ix_(at, at)], centred[at, -1]
    scale = max(float(np.abs(gram).max()), 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for i in range(len(weights)):
            if gram[i, i] <= 1e-12 * scale:  # a constant column says nothing
                continue
            rest = cross[i] - gram[i] @ weights + gram[i, i] * weights[i]
            new = max(0.0, rest / gram[i, i])
            moved = max(moved, abs(new - weights[i]))
            weights[i] = new
        if moved <= tolerance:
            break
    return float(means[-1] - weights @ means[at]), weights


def _combined(intercept: float, weights: dict[str, float]) -> Column:
    out = F.lit(intercept)
    for name, weight in weights.items():
        out = out + F.lit(float(weight)) * F.col(name)
    return out


def stack_stage(intercept: float, weights: dict[str, float], output: str = "prediction"):
    """A pipeline stage, saved with the model, for the weighted sum of the models' predictions."""
    terms = "".join(f" + ({weight!r}D) * `{name}`" for name, weight in weights.items())
    return SQLTransformer(statement=f"SELECT *, ({intercept!r}D){terms} AS {output} FROM __THIS__")


@dataclass
class TrainResult:
    model: PipelineModel
    model_id: str
    leaderboard: DataFrame
    metrics: dict[str, float]
    features: list[str]
    weights: DataFrame


def _metric_row(df: DataFrame, label: str, prediction: str) -> dict[str, float]:
    """Three numbers of one pass, whatever the size of ``df``."""
    columns = metric_columns(F.col(label), F.col(prediction))
    return df.agg(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def _score(model, df: DataFrame, name: str) -> DataFrame:
    return model.setPredictionCol(name).transform(df)


def persisted_in_few(rows: DataFrame) -> DataFrame:
    """``rows``, persisted in no more partitions than there are cores, or than hold ``TASK_ROWS``.

    A level of a tree is a job with tasks and a result for each partition, and a search runs
    thousands of them: their number follows the cores and not the files that the rows came in.
    """
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    most = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    if rows.rdd.getNumPartitions() <= most:
        return rows
    few = rows.repartition(most).persist(StorageLevel.MEMORY_AND_DISK)
    few.count()
    rows.unpersist()
    return few


def _over(started: float, limit: float | None) -> bool:
    return limit is not None and time.monotonic() - started > limit


def train_models(
    cleaned: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    key: str = "id_user",
    max_models: int = 10,
    max_runtime_secs: float | None = None,
    folds: int = 3,
    seed: int = SEED,
    parallelism: int = 8,
) -> TrainResult:
    """Fit the candidates and two stacks of them; the lowest fold RMSE leads.

    The stacks, of all candidates and of the best of each family, weigh predictions for rows that
    the models were not fitted on; the weights are not negative and come from the moments of each
    fold, one pass over the rows. Every ranking error, also of a stack, comes from rows that
    neither models nor weights have seen; the test rows are kept apart from the ranking and only
    measure the leader. Candidates that a given time limit leaves out stand in the leaderboard as
    ``skipped``. The fits run at the same time, ``parallelism`` of them.
    """
    started = time.monotonic()
    used = available_features(cleaned, features)
    assembler = VectorAssembler(inputCols=used, outputCol="features", handleInvalid="keep")
    rows = assembler.transform(cleaned.na.fill(0, used)).select(
        key, F.col(target).alias("label"), "features"
    )
    train, test = split(rows, key, seed=seed)
    train = persisted_in_few(train.withColumn("fold", hash_bucket(key, seed + 1, folds)))
    try:
        final, by_fold, skipped = {}, {}, []
        parts = [train.filter(F.col("fold") != k) for k in range(folds)] + [train]

        def fit(estimator):
            if final and _over(started, max_runtime_secs):
                return None
            with ThreadPoolExecutor(len(parts)) as pool:
                return list(pool.map(lambda part: estimator.copy().fit(part), parts))

        tried = candidates(max_models, seed)
        with ThreadPoolExecutor(max(1, parallelism // len(parts))) as pool:
            for name, fitted in zip(tried, pool.map(fit, tried.values())):
                if fitted is None:
                    skipped.append(name)
                else:
                    by_fold[name], final[name] = fitted[:-1], fitted[-1]

        def out_of_fold(k: int) -> DataFrame:
            part = train.filter(F.col("fold") == k)
            for name, models in by_fold.items():
                part = _score(models[k], part, name)
            return part.drop("features")

        scored = out_of_fold(0)
        for k in range(1, folds):
            scored = scored.unionByName(out_of_fold(k))
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        # One line of moments per fold leaves the cluster.
        names, size = list(final), len(final) + 2
        lines = scored.groupBy("fold").agg(*moments(names)).collect()
        by_part = {r["fold"]: moment_matrix(list(r)[1:], size) for r in lines}
        whole = sum(by_part.values(), np.zeros((size, size)))
        square = np.array([whole[i, i] - 2 * whole[i, -1] + whole[-1, -1] for i in range(1, size - 1)])
        errors = dict(zip(names, square))
        stacks = {STACK_ALL: names, STACK_BEST: best_of_family(errors)}
        ranked, weighed = scored, {}
        for stack, members in stacks.items():
            chosen = [names.index(m) for m in members]
            value = F.lit(None).cast("double")
            for k in range(folds):
                others = sum((m for f, m in by_part.items() if f != k), np.zeros((size, size)))
                intercept, found = non_negative_weights(others, chosen)
                value = F.when(F.col("fold") == k, _combined(intercept, dict(zip(members, found)))).otherwise(value)
            ranked = ranked.withColumn(stack, value)
            intercept, found = non_negative_weights(whole, chosen)
            weighed[stack] = intercept, {m: float(w) for m, w in zip(members, found)}
        measured = [
            F.struct(
                F.lit(n).alias("model"),
                *[c.alias(m) for m, c in metric_columns(F.col("label"), F.col(n)).items()],
            )
            for n in [*names, *stacks]
        ]
        # One line per model leaves the cluster.
        board = ranked.agg(F.array(*measured).alias("lines")).first()["lines"]
        board = sorted(board, key=lambda line: line["rmse"])
        model_id = board[0]["model"]
        spark = cleaned.sparkSession
        leaderboard = spark.createDataFrame(
            [(i + 1, r["model"], r["rmse"], r["mae"], r["r2"], "fitted") for i, r in enumerate(board)]
            + [(None, name, None, None, None, "skipped") for name in skipped],
            "place int, model string, rmse double, mae double, r2 double, status string",
        )
        weights = spark.createDataFrame(
            [(s, m, w) for s, (c, parts) in weighed.items() for m, w in [("intercept", c), *parts.items()]],
            "stack string, model string, weight double",
        )
        if model_id in weighed:
            intercept, own = weighed[model_id]
            own = {m: w for m, w in own.items() if w > 0}
            level_one = [final[n].setPredictionCol(n) for n in own]
            stages = [assembler, *level_one, stack_stage(intercept, own)]
        else:
            stages = [assembler, final[model_id].setPredictionCol("prediction")]
        model = PipelineModel(stages=stages)
        on_test = PipelineModel(stages=stages[1:]).transform(test)
        points = metrics_back_transformed(on_test, "label").first().asDict()
        metrics = _metric_row(on_test, "label", "prediction")
        metrics |= {f"karma_{n}": v for n, v in points.items()}
        metrics |= {"train_size": train.count(), "test_size": test.count()}
    finally:
        if "scored" in locals():
            scored.unpersist()
        train.unpersist()
    return TrainResult(model, model_id, leaderboard, metrics, used, weights)


def predict(model: PipelineModel, data: DataFrame, name: str = "karma_predicted") -> DataFrame:
    """``data`` with the prediction in points; never below zero."""
    used = model.stages[0].getInputCols()
    kept = {f"_raw_{c}": F.col(c) for c in used}
    scored = model.transform(data.withColumns(kept).na.fill(0, list(used)))
    return scored.select(
        *[F.col(f"_raw_{c}" if c in used else c).alias(c) for c in data.columns],
        S.back_transform(F.col("prediction")).alias(name),
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate_model(path: str, data: DataFrame) -> dict[str, float]:
    """MAE, RMSE and R2 in points of a saved model."""
    scored = predict(load_model(path), data).withColumn("karma", F.col("karma").cast("double"))
    return _metric_row(scored, "karma", "karma_predicted")


def stop_round(history: list[float], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> int:
    """How many scores are looked at before scoring stops.

    Scores are averaged over windows of ``rounds``. It stops when the best of the last ``rounds``
    windows is not better than the one before them by the share ``tolerance``.
    """
    for n in range(2 * rounds, len(history) + 1):
        windows = [sum(history[n - 2 * rounds + i : n - rounds + i]) / rounds for i in range(rounds + 1)]
        if min(windows[1:]) >= windows[0] * (1 - tolerance):
            return n
    return len(history)


def kept_trees(history: list[float], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> int:
    """Trees that an ensemble keeps: up to the best score that was seen before scoring stopped."""
    seen = history[: stop_round(history, rounds, tolerance)]
    return seen.index(min(seen)) + 1


@dataclass
class GridResult:
    results: DataFrame
    history: DataFrame
    model: PipelineModel


def grid_sample(grid: dict[str, list], size: int, seed: int) -> list[dict]:
    """``size`` different combinations of the grid in seeded random order."""
    combos = [dict(zip(grid, values)) for values in product(*grid.values())]
    return random.Random(seed).sample(combos, min(size, len(combos)))


def optimize_gbt(
    train: DataFrame,
    valid: DataFrame,
    features: list[str] = FEATURES,
    target: str = TARGET,
    grid: dict[str, list] = GRID,
    max_models: int = 15,
    max_runtime_secs: float | None = None,
    seed: int = SEED,
    parallelism: int = 8,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> GridResult:
    """Seeded random search over the grid: results by MAE, history of scores, best model.

    The validation MAE after each tree says where an ensemble stops (``stop_round``) and how many
    trees it keeps. Ensembles are fitted at a quarter of their trees, a half, and in full, and
    not further than where they stop; trees of one seed are the same in a shorter and a longer
    fit, so the leader is fitted again with the trees that it keeps.
    """
    started = time.monotonic()
    used = available_features(train, features)
    assembler = VectorAssembler(inputCols=used, outputCol="features", handleInvalid="keep")

    def ready(df: DataFrame) -> DataFrame:
        vectors = assembler.transform(df.na.fill(0, used))
        return persisted_in_few(vectors.select("features", F.col(target).alias("label")))

    fit_rows, score_rows = ready(train), ready(valid)
    chosen = grid_sample(grid, max_models, seed)

    def boosted(params: dict, trees: int):
        return GBTRegressor(seed=seed, **{**params, "maxIter": trees})

    def grown(params: dict) -> tuple[list[float], list[float]] | None:
        """MAE and mean squared error per tree, as far as scoring goes."""
        if done and _over(started, max_runtime_secs):
            return None
        most = params["maxIter"]
        for trees in sorted({max(1, most // 4), max(1, most // 2), most}):
            model = boosted(params, trees).fit(fit_rows)
            history = model.evaluateEachIteration(score_rows, "absolute")
            if trees == most or stop_round(history, rounds, tolerance) < trees:
                break
        done.append(params)
        return history, model.evaluateEachIteration(score_rows, "squared")

    done: list[dict] = []
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(grown, chosen))
        spread = score_rows.agg(F.var_pop("label")).first()[0] or 0.0
        lines, history = [], []
        for i, (params, score) in enumerate(zip(chosen, scores)):
            values = [params[n] for n in ("maxDepth", "stepSize", "maxIter", "subsamplingRate")]
            if score is None:
                lines.append((i, *values, None, None, None, None, None, "skipped"))
                continue
            mae, mse = score
            stop, kept = stop_round(mae, rounds, tolerance), kept_trees(mae, rounds, tolerance)
            error = mse[kept - 1]
            fit = 1.0 - error / spread if spread > 0 else 0.0
            lines.append((i, *values, stop, kept, mae[kept - 1], error**0.5, fit, "fitted"))
            history += [(i, n + 1, value, n + 1 <= stop) for n, value in enumerate(mae)]
        ranked = sorted((x for x in lines if x[-1] == "fitted"), key=lambda x: (x[7], x[0]))
        best = ranked[0]
        model = boosted(chosen[best[0]], best[6]).fit(fit_rows)
    finally:
        fit_rows.unpersist()
        score_rows.unpersist()
    spark = train.sparkSession
    placed = [(n + 1, *x) for n, x in enumerate(ranked)] + [(None, *x) for x in lines if x[-1] == "skipped"]
    results = spark.createDataFrame(
        placed,
        "place int, combination int, max_depth int, learn_rate double, trees int, sample_rate double,"
        " stop_round int, kept_trees int, mae double, rmse double, r2 double, status string",
    )
    scored = spark.createDataFrame(history, "combination int, trees int, mae double, seen boolean")
    return GridResult(results, scored, PipelineModel(stages=[assembler, model]))


def _shares(rows: DataFrame) -> DataFrame:
    total = rows.agg(F.sum("importance").alias("t")).scalar()
    top = rows.agg(F.max("importance").alias("t")).scalar()
    return rows.select(
        "variable",
        "importance",
        F.try_divide("importance", top).alias("scaled"),
        F.try_divide("importance", total).alias("share"),
    )


def tree_importance(model: PipelineModel) -> DataFrame | None:
    """Importance of a single tree model; None when the leader has none of its own."""
    own = getattr(model.stages[-1], "featureImportances", None)
    if own is None or len(model.stages) > 2:
        return None
    from folkmeter.session import get_session

    used = model.stages[0].getInputCols()
    rows = [(v, float(i)) for v, i in zip(used, own.toArray())]
    return _shares(get_session().createDataFrame(rows, "variable string, importance double"))


def permutation_importance(
    model: PipelineModel, data: DataFrame, target: str = TARGET, key: str = "id_user", seed: int = SEED
) -> DataFrame:
    """Rise of the RMSE when one feature is shuffled among the rows.

    Rows are dealt into random buckets of bounded size; inside a bucket every row
    takes the feature of the next row in random order. All features are scored in
    one pass, by all cores, however few the buckets are.
    """
    used = list(model.stages[0].getInputCols())
    rows = data.na.fill(0, used).select(
        key, F.col(target).alias("label"), F.array(*[F.col(c).cast("double") for c in used]).alias("x")
    )
    buckets = rows.count() // BUCKET_ROWS + 1
    bucket, order = hash_bucket(key, seed, buckets), [F.xxhash64(F.col(key), F.lit(seed + 1)), key]
    window = Window.partitionBy(bucket).orderBy(*order)
    first = F.first("x").over(window.rowsBetween(Window.unboundedPreceding, 0))
    shifted = rows.withColumn("y", F.coalesce(F.lead("x").over(window), first))
    turns = F.explode(F.sequence(F.lit(-1), F.lit(len(used) - 1))).alias("turn")
    dealt = shifted.select("label", "x", "y").repartition(data.sparkSession.sparkContext.defaultParallelism)
    mixed = dealt.select("label", "x", "y", turns).select(
        "label",
        "turn",
        *[
            F.when(F.col("turn") == i, F.col("y")[i]).otherwise(F.col("x")[i]).alias(c)
            for i, c in enumerate(used)
        ],
    )
    scored = model.transform(mixed)
    error = F.col("label") - F.col("prediction")
    by_turn = scored.groupBy("turn").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    base = F.max(F.when(F.col("turn") == -1, F.col("rmse")))
    # One line per feature from here on.
    named = F.array(*[F.lit(c) for c in used])
    gathered = by_turn.agg(base.alias("base"), F.collect_list(F.struct("turn", "rmse")).alias("l"))
    lines = gathered.select("base", F.inline("l")).filter("turn >= 0")
    rise = lines.select(
        F.element_at(named, F.col("turn") + 1).alias("variable"),
        (F.col("rmse") - F.col("base")).alias("importance"),
    )
    return _shares(rise)


def feature_importance(model: PipelineModel, data: DataFrame, **kwargs) -> DataFrame:
    own = tree_importance(model)
    return own if own is not None else permutation_importance(model, data, **kwargs)
