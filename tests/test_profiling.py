import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.operators import evaluation as ev
from tarnlake.operators import profiling as pr
from tarnlake.operators.quantiles import exact_quantiles, with_image
from tarnlake.operators.split import stratified_split

from .conftest import rows


def close(a, b):
    return all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b, strict=True))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("xy"), st.integers(-3, 40).map(lambda i: i / 4)), min_size=1, max_size=30))
def test_quantiles_match_numpy(spark, data):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(data, "g string, v double")
    for r in exact_quantiles(df, "v", probs, ["g"]).collect():
        assert close(r["q"], np.quantile([v for g, v in data if g == r["g"]], probs))
    assert close(exact_quantiles(df, "v", probs).first()["q"], np.quantile([v for _, v in data], probs))


def test_quantiles_with_a_hot_group(spark):
    """200,000 rows, most in one group."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"))
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    pdf = df.toPandas()
    for r in exact_quantiles(df, "v", probs, ["g"]).collect():
        assert close(r["q"], np.quantile(pdf[pdf.g == r["g"]].v, probs))


AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1e-310, -1e-310, 1.7976931348623157e308,
           -1.7976931348623157e308, float("inf"), -float("inf"), 1.0, -1.0, 0.9999999999999999, 1.0000000000000002, 2.0, 1.9999999999999998,
           8.0, 7.999999999999999, 1e300, -1e300, 3.141592653589793, 2.0**-1022, 2.0**1023, 2.0**52, 2.0**53, 0.1, 123456.789]


def test_the_image_has_the_bits_and_the_order_of_the_double(spark):
    import struct
    some = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.int64).view(np.float64).tolist()
    values = AWKWARD + [x for x in some if x == x] + [-x for x in some if x == x]
    got = with_image(spark.createDataFrame([(x,) for x in values], "v double"), "v", "i").collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["i"] == (-bits if r["v"] < 0 else bits), r


def test_quantiles_of_awkward_values_and_null_groups(spark):
    values = [x for x in AWKWARD if abs(x) < 1e300]
    df = spark.createDataFrame([(g, x) for g in ("a", None) for x in values], "g string, v double")
    probs = [0.0, 0.1, 0.3, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, "v", probs, ["g"]).collect()
    assert {r["g"] for r in got} == {"a", None}
    for r in got:
        assert r["n"] == len(values) and close(r["q"], np.quantile(values, probs))
    assert exact_quantiles(df.limit(0), "v", probs, ["g"]).count() == 0


def test_describe_needs_few_exchanges(spark):
    df = spark.range(5000).select((F.col("id") / 7).alias("a"), F.col("id").alias("b"))
    plan = pr.describe(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert sum(line.lstrip("+- :").startswith("Exchange") for line in plan.split("\n")) <= 8
    assert "percentile" not in plan and "approx" not in plan


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    r = exact_quantiles(df, "v", [0.5]).first()
    assert r["n"] == 2 and r["q"] == [2.0]


def test_describe_matches_pandas(spark):
    pdf = __import__("pandas").DataFrame({"a": [1.0, 2, 2, 9], "b": [5.0, None, 7, 8]})
    got = {r["column_name"]: r for r in pr.describe(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    want = pdf.describe()
    for c in "ab":
        assert close([got[c][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")], want[c])


def test_histogram_matches_numpy(spark):
    v = [0.0, 1.0, 1.0, 2.0, 3.0, 9.5, 10.0]
    h = sorted(pr.histogram(spark.createDataFrame([(x,) for x in v], "v double"), "v", 5).collect())
    counts, edges = np.histogram(v, 5)
    assert [r["n"] for r in h] == list(counts) and close([r["left_edge"] for r in h], edges[:-1])
    assert close([r["density"] for r in h], np.histogram(v, 5, density=True)[0])
    same = pr.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).collect()
    assert sum(r["n"] for r in same) == 2 and len(same) == 4


def test_frequencies(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("a", "x")], "a string, b string")
    assert rows(pr.relative_frequency(df, "a"), "a", "share") == [("a", 0.75), ("b", 0.25)]
    assert [tuple(r) for r in pr.top_values(df, "a", 1).collect()] == [("a", 3)]
    wide = pr.crosstab(df, "a", "b", sorted(r[0] for r in df.select("b").distinct().collect()))
    assert rows(wide) == [("a", 2, 1), ("b", 1, 0)]
    assert rows(pr.stack(wide, "a", "b")) == [("a", "x", 2), ("a", "y", 1), ("b", "x", 1), ("b", "y", 0)]


def test_box_stats(spark):
    v = [1.0, 2.0, 3.0, 4.0, 100.0]
    r = pr.box_stats(spark.createDataFrame([("g", x) for x in v], "g string, v double"), "v", "g").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"]) == (2, 3, 4, 1, 4, 1)


def test_observed_and_output_profile(spark):
    df, seen = pr.observed(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"row_count": 7}
    assert tuple(pr.output_profile(spark.range(7)).first()) == (7, 1, "id")


@pytest.mark.parametrize("n,size", [(399, 0.8), (5, 0.5), (1, 0.8), (100, 0.25)])
def test_split_quota_and_repeatability(spark, n, size):
    df = spark.range(n).selectExpr("id", "case when id % 7 = 0 then 'b' else 'a' end as label")
    out = stratified_split(df, "label", "id", size, digits=1)
    got = out.collect()
    assert len(got) == n and sum(r["split"] == "train" for r in got) == math.floor(n * size)
    for label in "ab":
        all_of = sum(r["label"] == label for r in got)
        train = sum(r["label"] == label and r["split"] == "train" for r in got)
        assert abs(train - all_of * size) <= 1
    assert rows(stratified_split(df.repartition(3), "label", "id", size, digits=2)) == rows(out)
    with pytest.raises(ValueError):
        stratified_split(df, "label", "id", 1.5)


def test_report_of_one_class_predictions(spark):
    df = spark.createDataFrame([("neg", "pos"), ("pos", "pos"), ("pos", "pos")], "l string, p string")
    got = {r["class"]: r for r in ev.class_report(df, "l", "p").collect()}
    assert (got["neg"]["precision"], got["neg"]["recall"], got["neg"]["f1"], got["neg"]["support"]) == (0, 0, 0, 1)
    assert math.isclose(got["pos"]["f1"], 0.8) and math.isclose(got["accuracy"]["f1"], 2 / 3)
    assert math.isclose(got["macro avg"]["f1"], 0.4) and math.isclose(got["weighted avg"]["recall"], 2 / 3)
    assert math.isclose(ev.accuracy(df, "l", "p").first()["accuracy"], 2 / 3)
    assert rows(ev.confusion(df, "l", "p", ["neg", "pos"])) == [("pos", 1, 2)]
