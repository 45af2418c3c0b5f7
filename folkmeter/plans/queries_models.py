"""Model queries; fitted models have no SQL counterpart, so most of these are row checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folkmeter.operators import modeling
from folkmeter.operators.evaluation import clean_training
from folkmeter.plans.registry import Tables, query
from folkmeter.session import cut_lineage

KEPT = ["id_user", "name", "karma", "log_karma", *modeling.FEATURES]


def _training(t: Tables):
    """Cleaned rows, written once: every fit and score reads them again."""
    return cut_lineage(clean_training(t.user_features).select(*KEPT))


_fitted: dict = {}


def _trained(t: Tables):
    """(rows, result) of the whole training job with its declared defaults: ten candidates, three
    folds, both stacks. The last one is kept, as a saved model serves many questions."""
    place = (t.spark.sparkContext.applicationId, t.sf_dir)
    if place not in _fitted:
        _fitted.clear()
        rows = _training(t)
        _fitted[place] = rows, modeling.train_models(rows)
    return _fitted[place]


@query("split_sizes", """
    SELECT CASE WHEN CAST('0x' || substr(md5('42:' || id_user), 1, 8) AS BIGINT) % 100 < 80
                THEN 'train' ELSE 'test' END AS part, count(*) AS row_count FROM users GROUP BY 1""")
def split_sizes(t: Tables):
    train, test = modeling.split(t.user_features)
    return train.select(F.lit("train").alias("part")).unionByName(
        test.select(F.lit("test").alias("part"))
    ).groupBy("part").agg(F.count("*").alias("row_count"))


@query("leaderboard")
def leaderboard(t: Tables):
    return _trained(t)[1].leaderboard


@query("stack_weights")
def stack_weights(t: Tables):
    return _trained(t)[1].weights


@query("predictions")
def predictions(t: Tables):
    rows, result = _trained(t)
    return modeling.predict(result.model, rows).select("id_user", "karma", "karma_predicted")


def _searched(t: Tables):
    """Fifteen of the declared combinations, drawn by the declared seed."""
    place = ("grid", t.spark.sparkContext.applicationId, t.sf_dir)
    if place not in _searches:
        _searches.clear()
        train, valid = modeling.split(_training(t))
        _searches[place] = modeling.optimize_gbt(train, valid)
    return _searches[place]


_searches: dict = {}


@query("grid_results")
def grid_results(t: Tables):
    return _searched(t).results


@query("grid_history")
def grid_history(t: Tables):
    return _searched(t).history


@query("feature_importance")
def feature_importance(t: Tables):
    rows, result = _trained(t)
    return modeling.feature_importance(result.model, rows)


@query("permutation_importance")
def permutation_importance(t: Tables):
    rows, result = _trained(t)
    return modeling.permutation_importance(result.model, rows)
