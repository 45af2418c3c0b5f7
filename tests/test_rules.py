"""Edges of ids, numbers, dates, trimming, ratios and quantiles on small tables."""

import pytest
from pyspark.sql import functions as F

from folkmeter.functions import keys as K
from folkmeter.functions import scalars as S
from folkmeter.operators import evaluation, profiling
from folkmeter.operators.quantiles import quantiles


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_numbers(spark):
    texts = ["123", "5.2K", "5.2k", "1.5M", "1234 karma", "500 followers", "", "abc", None]
    texts += ["1,234", "inf", "nan", "1_0", " 7 points ", "-3", "2.9", "k", "1e3", "\xa05\t"]
    want = [123, 5200, 5200, 1500000, 1234, 500, 0, 0, 0, 0, 0, 0, 10, 7, -3, 2, 0, 1000, 5]
    assert column(spark, texts, S.parse_human_number) == want


def test_whole_numbers(spark):
    texts = ["12", " 12 ", "+5", "-5", "1_000", "1.5", "", None, "x", "99999999999999999999"]
    assert column(spark, texts, S.safe_int) == [12, 12, 5, -5, 1000, 0, 0, 0, 0, 0]


def test_relative_dates(spark):
    now = F.lit("2024-03-10 01:00:00").cast("timestamp")
    texts = ["9d ago", "2h ago", "3w ago", "2mo ago", "9 d", "", "bot7x 3d ago", "5seconds ago", "30m", "99999999d"]
    want = ["2024-03-01", "2024-03-09", "2024-02-18", "2024-03-10", "2024-03-10", "2024-03-10"]
    want += ["2024-03-10", "2024-03-05", "2024-03-10", "2024-03-10"]
    assert column(spark, texts, lambda c: S.relative_date(c, now)) == want
    strict = ["2mo ago", "9 d", "5seconds ago", "30m ago"]
    want = ["2024-01-10", "2024-03-01", "2024-03-10", "2024-03-10"]
    assert column(spark, strict, lambda c: S.relative_date(c, now, strict=True)) == want


def test_trim(spark):
    texts = ["\t a b \n", "\xa0x　", "", None, "  "]
    assert column(spark, texts, S.trim_ws) == ["a b", "x", "", None, ""]


def test_word_count(spark):
    assert column(spark, ["", "a  b ", "one two", None], S.word_count) == [1, 4, 2, 0]


def test_cast_default(spark):
    lenient = column(spark, ["5", "x", None], lambda c: S.cast_default(c, lenient=True))
    assert lenient == [5, 0, 0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["x"], S.cast_default)


def test_iso_day(spark):
    assert column(spark, ["2024-05-06T07:08", "", None], S.iso_prefix_date) == ["2024-05-06", None, None]


def test_ids(spark):
    import hashlib

    def want(prefix, text):
        return f"{prefix}_" + hashlib.sha256(text.encode()).hexdigest()

    ids = column(spark, ["Ada", "ADA", "ada"], K.user_id)
    assert ids == [want("user", "ada")] * 3
    rows = spark.createDataFrame([("a", "", None, "d")], "a string, b string, c string, d string")
    made = rows.select(K.generate_id("x", *[F.col(c) for c in "abcd"])).first()[0]
    assert made == want("x", "a|d")
    text = "word " * 40
    texts = [text, text[:50] + "other"]
    made = column(spark, texts, lambda c: K.comment_id(F.lit("u"), F.lit("p"), c))
    assert made == [want("comment", "u|p|" + t) for t in texts]
    old = column(spark, texts, lambda c: K.comment_id(F.lit("u"), F.lit("p"), c, sample=50, length=12))
    assert old == [want("comment", "u|p|" + text[:50])[:20]] * 2


def test_post_id(spark):
    rows = spark.createDataFrame(
        [("p1", "/x", "t", "u"), ("", "/x", "t", "u"), (None, None, "t", "u"), (None, "", None, "u")],
        "id string, url string, title string, id_user string",
    )
    made = [r[0] for r in rows.select(K.post_id(*[F.col(c) for c in rows.columns])).collect()]
    sample = [F.lit("/x"), F.lit("t-u"), F.lit("-u")]
    want = rows.limit(1).select(*[K.generate_id("post", s) for s in sample]).first()
    assert made == ["p1", *want]


def test_urls(spark):
    urls = ["/u/test_user", "https://site.org/u/agent123", "/u/user?tab=posts", "/m/general"]
    assert column(spark, urls, K.username_from_url) == ["test_user", "agent123", "user", None]
    assert column(spark, urls, K.community_from_url) == [None, None, None, "general"]
    keys = column(spark, ["https://a.org/m/x/", "https://a.org", "/u/b?c=1"], K.page_cache_key)
    assert [k.rsplit("_", 1)[0] for k in keys] == ["m_x", "index", "u_b"]


def test_load_timestamp(spark):
    assert spark.range(1).select(K.load_timestamp("2024")).first()[0] == "2024"
    live = spark.range(1).select(K.load_timestamp()).first()[0]
    assert len(live) == 26 and live[10] == "T"


def test_follower_ratio(spark):
    rows = spark.createDataFrame([(10, 4), (3, -1), (None, 1)], "a bigint, b bigint")
    got = [r[0] for r in rows.select(S.follower_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [2.0, None, None]


def brute(values, prob, method):
    values = sorted(values)
    n = len(values)
    if method == "nearest":
        return values[int((n - 1) * prob + 0.5)]
    place = (n - 1) * prob
    low = int(place)
    high = min(low + 1, n - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("range_rows", [50, 100_000])
@pytest.mark.parametrize("method", ["nearest", "linear"])
@pytest.mark.parametrize("shape", ["plain", "hot", "single", "negative"])
def test_quantiles(spark, method, shape, range_rows):
    import random

    rng = random.Random(7)
    values = {
        "plain": [rng.random() * 100 for _ in range(2500)],
        "hot": [0.0] * 900 + [float(rng.randint(1, 400)) for _ in range(800)],
        "single": [4.0],
        "negative": [float(-i) for i in range(300)],
    }[shape]
    frame = spark.createDataFrame([("g", v) for v in values] + [("h", 1.0), ("h", None)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    rows = quantiles(frame, "v", probs, by="g", method=method, cuts=8, range_rows=range_rows).collect()
    got = {(r.g, r.prob): r.value for r in rows}
    for p in probs:
        assert got["g", p] == pytest.approx(brute(values, p, method))
        assert got["h", p] == 1.0
    assert len(got) == 12


def test_disc_and_approx(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(1, 5)], "v double")
    for method in ("disc", "approx"):
        rows = quantiles(frame, "v", [0.25, 0.5], method=method).orderBy("prob").collect()
        assert [r.value for r in rows] == [1.0, 2.0]


def test_constant_correlation(spark):
    frame = spark.createDataFrame([(1, 5), (1, 6)], "karma bigint, followers bigint")
    got = profiling.target_correlations(frame, others=("followers",)).first()
    assert got[0] is None
    matrix = profiling.correlation_matrix(frame, ["karma", "followers"], [])
    assert {(r.x, r.y): r.corr for r in matrix.collect()}["karma", "followers"] is None


def test_histogram(spark):
    flat = spark.createDataFrame([(3,)] * 4, "v bigint")
    rows = profiling.histogram(flat, "v", 4).collect()
    assert sum(r["count"] for r in rows) == 4 and len(rows) == 4
    spread = spark.range(0, 101)
    counts = [r["count"] for r in profiling.histogram(spread, "id", 50).orderBy("bin").collect()]
    assert counts[0] == 2 and counts[-1] == 3 and sum(counts) == 101


def test_bins_of_negative(spark):
    frame = spark.createDataFrame([(-5,), (0,), (10,), (20000,)], "karma bigint")
    got = {r["karma_bin"]: r["count"] for r in profiling.bin_distribution(frame).collect()}
    assert got == {"0": 1, "1-10": 2, ">10K": 1}


def test_constant_target_metrics(spark):
    frame = spark.createDataFrame([(5, 4.0), (5, 6.0)], "karma bigint, karma_predicted double")
    got = evaluation.metrics_raw(frame).first()
    assert (got.mae, got.rmse, got.r2) == (1.0, 1.0, 0.0)


def test_compare_models(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 1.0), ("b", 1.0, 1.0), ("b", 3.0, 2.0)]
    frame = spark.createDataFrame(rows, "model string, actual double, predicted double")
    got = {r.metric: r for r in evaluation.compare_models(frame, "a", "b").collect()}
    assert got["mae"].base == 1.5 and got["mae"].optimized == 0.5
    assert got["mae"].improvement_pct == pytest.approx(66.67)
    assert got["r2"].base == -1.5 and got["r2"].improvement_pct == pytest.approx(133.33)


def test_training_cap_removes(spark):
    rows = [(f"u{i}", i, 1, 0) for i in range(200)] + [("neg", -1, 1, 0), ("ghost", 5, 0, 0)]
    frame = spark.createDataFrame(rows, "id_user string, karma bigint, post_count bigint, comment_count bigint")
    kept = {r.id_user for r in evaluation.clean_training(frame).collect()}
    assert kept == {f"u{i}" for i in range(198)}


def test_report_keys(spark, sf_dir):
    from folkmeter.plans.registry import Tables

    t = Tables(spark, sf_dir)
    tables = {n: t.silver[n] for n in ("users", "posts", "comments")}
    for report in (profiling.eda_report(tables), evaluation.evaluation_report(t.predictions)):
        for name, frame in report.items():
            assert frame.count() > 0, name
