"""Profiling and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folkmeter.operators import evaluation, profiling
from folkmeter.operators.relational import top_rows
from folkmeter.plans.registry import Tables, query, r
from folkmeter.session import cut_lineage

NUMBERS = ("karma", "followers", "following")
TEXTS = ("id_user", "name", "description", "human_owner", "joined", "scraped_at")


def _describe_sql(source: str, numbers, texts) -> str:
    lines = [
        f"SELECT '{c}' AS column_name, count({c}) AS row_count, {r(f'avg(try_cast({c} AS DOUBLE))', 'mean')}, "
        f"{r(f'stddev_samp(try_cast({c} AS DOUBLE))', 'stddev')}, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {source}"
        for c in (*numbers, *texts)
    ]
    return " UNION ALL ".join(lines)


@query("users_describe", _describe_sql("users", NUMBERS, TEXTS))
def users_describe(t: Tables):
    return profiling.describe(t.users)


@query("posts_per_user", f"""
    SELECT id_user, count(*) AS post_count, {r('avg(rating)', 'avg_rating')},
           CAST(sum(rating) AS BIGINT) AS total_rating FROM posts GROUP BY id_user""")
def posts_per_user(t: Tables):
    return profiling.posts_per_user(t.posts)


@query(
    "posts_per_user_describe",
    _describe_sql("per_user", ("post_count", "total_rating"), ("id_user",)),
    """per_user AS (SELECT id_user, count(*) AS post_count, CAST(sum(rating) AS BIGINT) AS total_rating
                    FROM posts GROUP BY id_user)""",
)
def posts_per_user_describe(t: Tables):
    return profiling.describe(profiling.posts_per_user(t.posts).drop("avg_rating"))


@query("record_counts", """
    SELECT 'users' AS table_name, count(*) AS row_count FROM users
    UNION ALL SELECT 'posts', count(*) FROM posts
    UNION ALL SELECT 'comments', count(*) FROM comments""")
def record_counts(t: Tables):
    return profiling.record_counts({n: t.silver[n] for n in ("users", "posts", "comments")})


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM raw_users"
    for c in (*TEXTS, *NUMBERS)))
def null_counts(t: Tables):
    return profiling.null_counts(t.raw["users"])


def _null_sql(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 2) AS percent FROM raw_{table}"
        for c in columns.split()
    )


@query("null_pct", "SELECT * REPLACE (CAST(percent AS DOUBLE) AS percent) FROM ("
    + _null_sql("users", " ".join((*TEXTS, *NUMBERS)))
    + " UNION ALL "
    + _null_sql("posts", "id_post id_user id_community title description rating date scraped_at")
    + " UNION ALL "
    + _null_sql("comments", "id_comment id_user id_post description rating date scraped_at")
    + ") q WHERE nulls > 0")
def null_pct(t: Tables):
    return profiling.null_report({n: t.raw[n] for n in ("users", "posts", "comments")})


def nearest(source: str, column: str, prob: float) -> str:
    """Nearest-rank quantile as a scalar subquery."""
    return (
        f"(SELECT {column} FROM (SELECT {column}, row_number() OVER (ORDER BY {column}) - 1 AS rn, "
        f"count(*) OVER () AS n FROM {source}) q WHERE rn = CAST(floor((n - 1) * {prob} + 0.5) AS BIGINT))"
    )


@query("karma_stats", f"""
    SELECT {r('avg(karma)', 'mean')}, {r('quantile_cont(karma, 0.5)', 'median')},
           {r('stddev_samp(karma)', 'std')}, min(karma) AS min, max(karma) AS max,
           CAST({nearest('users', 'karma', 0.25)} AS DOUBLE) AS q25,
           CAST({nearest('users', 'karma', 0.75)} AS DOUBLE) AS q75 FROM users""")
def karma_stats(t: Tables):
    return profiling.target_stats(t.users)


@query("profile_stats", f"""
    SELECT {r('avg(followers)', 'avg_followers')}, {r('avg(following)', 'avg_following')},
           count(description) AS users_with_description, count(human_owner) AS users_with_owner
    FROM raw_users""")
def profile_stats(t: Tables):
    return profiling.profile_stats(t.raw["users"])


@query("karma_bins", """
    SELECT CASE WHEN karma = 0 THEN '0' WHEN karma <= 10 THEN '1-10' WHEN karma <= 100 THEN '11-100'
                WHEN karma <= 1000 THEN '101-1K' WHEN karma <= 10000 THEN '1K-10K' ELSE '>10K' END
           AS karma_bin, count(*) AS count FROM users GROUP BY 1""")
def karma_bins(t: Tables):
    return profiling.bin_distribution(t.users)


@query("karma_corr", """
    SELECT round(corr(karma, followers), 4) AS karma_vs_followers,
           round(corr(karma, following), 4) AS karma_vs_following FROM users""")
def karma_corr(t: Tables):
    return profiling.target_correlations(t.users)


def _corr_sql() -> str:
    names = profiling.CORRELATION_COLUMNS
    return " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {r(f'corr({x}, {y})', 'corr')} FROM ready"
        for x in names
        for y in names
    )


def _ready_sql() -> str:
    return ", ".join(
        f"ln(1 + greatest({c}, 0)) AS {c}" if c in profiling.LOG_COLUMNS else c
        for c in profiling.CORRELATION_COLUMNS
    )


@query("corr_matrix", _corr_sql(), f"ready AS MATERIALIZED (SELECT {_ready_sql()} FROM enriched)")
def corr_matrix(t: Tables):
    return profiling.correlation_matrix(t.enriched)


@query("box_stats", f"""
    SELECT variable, {r('q1')}, {r('median')}, {r('q3')},
           {r('min(value) FILTER (value >= lo AND value <= hi)', 'whisker_low')},
           {r('max(value) FILTER (value >= lo AND value <= hi)', 'whisker_high')},
           count(*) FILTER (value < lo OR value > hi) AS outliers
    FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
          FROM melted JOIN quartiles USING (variable)) b
    GROUP BY variable, q1, median, q3""",
    "melted AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM enriched"
        for c in profiling.BOX_COLUMNS) + """),
    quartiles AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                         quantile_cont(value, 0.75) AS q3 FROM melted GROUP BY 1)""")
def box_stats(t: Tables):
    return profiling.box_stats(t.enriched)


@query("histogram_50", f"""
    SELECT CAST(b AS INTEGER) AS bin, {r('lo + b * w', 'lower')}, {r('lo + (b + 1) * w', 'upper')},
           coalesce(n, 0) AS count
    FROM range(50) g(b), edges LEFT JOIN (
      SELECT least(CAST(floor((karma - lo) / w) AS INTEGER), 49) AS bin, count(*) AS n
      FROM users, edges WHERE karma > 0 GROUP BY 1) c ON c.bin = b""",
    """edges AS (SELECT CAST(min(karma) AS DOUBLE) AS lo,
                        (max(karma) - min(karma)) / 50.0 AS w FROM users WHERE karma > 0)""")
def histogram_50(t: Tables):
    return profiling.histogram(t.users.filter("karma > 0"), "karma")


@query("top10_users", """
    SELECT name, karma, followers, following FROM users ORDER BY karma DESC, id_user LIMIT 10""")
def top10_users(t: Tables):
    return profiling.top_users(t.users, 10)


@query("top15_users", "SELECT name, karma FROM users ORDER BY karma DESC, name LIMIT 15")
def top15_users(t: Tables):
    return top_rows(t.users, "karma", "name", 15, ["name", "karma"])


# --- training rows and evaluation ---------------------------------------------------


@query("clean_training", f"SELECT id_user, karma, total_activity, {r('log_karma')} FROM training")
def clean_training(t: Tables):
    cleaned = evaluation.clean_training(t.user_features)
    return cleaned.select("id_user", "karma", "total_activity", "log_karma")


@query("log_target_stats", f"""
    SELECT {r('avg(log_karma)', 'mean')}, {r('quantile_cont(log_karma, 0.5)', 'median')},
           {r('stddev_samp(log_karma)', 'std')}, {r('max(log_karma)', 'max')} FROM training""")
def log_target_stats(t: Tables):
    return evaluation.log_target_stats(cut_lineage(evaluation.clean_training(t.user_features)))


@query("top15_predictions", f"""
    SELECT name, karma, {r('karma_predicted')} FROM predictions ORDER BY karma DESC, name LIMIT 15""")
def top15_predictions(t: Tables):
    return evaluation.top_predictions(t.predictions)


PAIRS = """pairs AS (SELECT ln(1 + karma) AS a, ln(1 + karma_predicted) AS p,
                            CAST(karma AS DOUBLE) AS ka, karma_predicted AS kp FROM predictions)"""


def _metrics_sql(a: str, p: str) -> str:
    return (
        f"SELECT {r(f'avg(abs({a} - {p}))', 'mae')}, {r(f'sqrt(avg(({a} - {p}) * ({a} - {p})))', 'rmse')}, "
        f"{r(f'1 - sum(({a} - {p}) * ({a} - {p})) / (var_pop({a}) * count(*))', 'r2')} FROM pairs"
    )


@query("eval_log", _metrics_sql("a", "p"), PAIRS)
def eval_log(t: Tables):
    return evaluation.metrics_log(t.predictions)


@query("eval_raw", _metrics_sql("ka", "kp"), PAIRS)
def eval_raw(t: Tables):
    return evaluation.metrics_raw(t.predictions)


@query("eval_backtransformed", f"""
    SELECT {r('avg(e)', 'mae')}, {r('sqrt(avg(e * e))', 'rmse')}, {r('quantile_cont(e, 0.5)', 'medae')},
           {r('1 - sum(e * e) / (var_pop(x) * count(*))', 'r2')}
    FROM (SELECT x, abs(x - y) AS e FROM (
      SELECT exp(a) - 1 AS x, greatest(exp(p) - 1, 0) AS y FROM pairs) s) q""", PAIRS)
def eval_backtransformed(t: Tables):
    scored = evaluation.residuals(t.predictions)
    return evaluation.metrics_back_transformed(scored, "log_actual", "log_predicted")


@query("residuals", f"""
    SELECT id_user, {r('ln(1 + karma)', 'log_actual')}, {r('ln(1 + karma_predicted)', 'log_predicted')},
           {r('karma - karma_predicted', 'residual')},
           {r('ln(1 + karma) - ln(1 + karma_predicted)', 'log_residual')} FROM predictions""")
def residuals(t: Tables):
    columns = ["id_user", "log_actual", "log_predicted", "residual", "log_residual"]
    return evaluation.residuals(t.predictions).select(*columns)


@query("residual_stats", f"""
    SELECT {r('avg(a - p)', 'mean_residual')}, {r('stddev_samp(a - p)', 'std_residual')},
           {r('min(a - p)', 'min_residual')}, {r('max(a - p)', 'max_residual')},
           {r('avg(abs(a - p))', 'mean_abs_residual')} FROM pairs""", PAIRS)
def residual_stats(t: Tables):
    return evaluation.residual_stats(t.predictions)


@query("quartile_report", f"""
    SELECT CASE WHEN ka = 0 THEN 'Q0 (zero)' WHEN ka <= q25 THEN 'Q1' WHEN ka <= q50 THEN 'Q2'
                WHEN ka <= q75 THEN 'Q3' ELSE 'Q4 (top)' END AS karma_quartile,
           count(*) AS count, {r('avg(ka)', 'avg_actual')}, {r('avg(kp)', 'avg_predicted')},
           {r('avg(abs(ka - kp))', 'avg_error')}
    FROM pairs, (SELECT {nearest('pairs', 'ka', 0.25)} AS q25, {nearest('pairs', 'ka', 0.5)} AS q50,
                        {nearest('pairs', 'ka', 0.75)} AS q75) c GROUP BY 1""", PAIRS)
def quartile_report(t: Tables):
    return evaluation.quartile_report(t.predictions)


MODELS = PAIRS + """, scored AS (
    SELECT 'line' AS model, ka AS actual, kp AS predicted FROM pairs
    UNION ALL SELECT 'mean', ka, (SELECT avg(ka) FROM pairs) + kp * 0.0 FROM pairs),
  measured AS (SELECT model, avg(abs(actual - predicted)) AS mae,
      sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
      1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) AS r2
    FROM scored GROUP BY model),
  lines AS (SELECT 'mae' AS metric, round(b.mae, 4) AS base, round(o.mae, 4) AS optimized
    FROM measured b, measured o WHERE b.model = 'mean' AND o.model = 'line'
    UNION ALL SELECT 'rmse', round(b.rmse, 4), round(o.rmse, 4)
    FROM measured b, measured o WHERE b.model = 'mean' AND o.model = 'line'
    UNION ALL SELECT 'r2', round(b.r2, 4) + 0.0, round(o.r2, 4)
    FROM measured b, measured o WHERE b.model = 'mean' AND o.model = 'line')"""


@query("compare_models", """
    SELECT metric, base, optimized, round(CASE WHEN metric = 'r2' THEN optimized - base
           ELSE base - optimized END / nullif(abs(base), 0) * 100, 2) AS improvement_pct
    FROM lines""", MODELS)
def compare_models(t: Tables):
    line = t.predictions.select(
        F.lit("line").alias("model"),
        F.col("karma").cast("double").alias("actual"),
        F.col("karma_predicted").alias("predicted"),
    )
    mean = line.agg(F.avg("actual").alias("m")).scalar()
    constant = line.select(
        F.lit("mean").alias("model"), "actual", (mean + F.col("predicted") * 0.0).alias("predicted")
    )
    return evaluation.compare_models(line.unionByName(constant), "mean", "line")
