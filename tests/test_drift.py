import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourline.operators import drift
from hourline.plans import detect_drift
from hourline.session import stage
from tests.helpers import hours, series

RNG = np.random.default_rng(11)


def labelled(spark, ref, cur, ddl="period string, x double"):
    rows = [("ref", v) for v in ref] + [("cur", v) for v in cur]
    return spark.createDataFrame(rows, ddl)


def wasserstein(a, b):
    """Area between the two step functions, from the sorted union of all values."""
    xs = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), xs[:-1], side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs[:-1], side="right") / len(b)
    return float(np.sum(np.abs(fa - fb) * np.diff(xs)))


def ks(a, b):
    xs = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def test_exact_small_sample_p_value():
    """Equal to counting every order of two samples of up to eight values; far out equal to the asymptotic one."""
    for n in range(1, 9):
        for m in range(1, 9):
            seen = []
            for chosen in itertools.combinations(range(n + m), n):
                a = b = 0
                most, own = 0, set(chosen)
                for i in range(n + m):
                    a, b = a + (i in own), b + (i not in own)
                    most = max(most, abs(a * m - b * n))
                seen.append(most)
            for d in {0, *seen}:
                share = sum(x >= d for x in seen) / len(seen)
                assert drift.ks_exact(d / (n * m), n, m) == pytest.approx(share, abs=1e-9)
    assert drift.ks_exact(0.08, 900, 700) == pytest.approx(drift.ks_tail(0.08, 900, 700), rel=0.05)
    assert drift.ks_exact(1.0, 900, 5000) == pytest.approx(0.0, abs=1e-9) and drift.ks_exact(0.0, 3, 4) == 1.0


@pytest.mark.parametrize("splits", [1, 3, 20])
def test_numeric_distances(spark, splits):
    ref, cur = np.round(RNG.normal(10, 2, 400), 2), np.round(RNG.normal(11, 3, 150), 2)
    counts = drift.value_counts(labelled(spark, ref.tolist(), cur.tolist()), ["x"])
    got = drift.numeric_distances(counts, splits).first()
    assert got["wasserstein"] == pytest.approx(wasserstein(ref, cur))
    assert got["ks"] == pytest.approx(ks(ref, cur))
    assert got["stddev_ref"] == pytest.approx(ref.std())
    assert got["wasserstein_normed"] == pytest.approx(wasserstein(ref, cur) / ref.std())


def test_constant_reference_uses_the_smallest_scale(spark):
    counts = drift.value_counts(labelled(spark, [1.0] * 5, [1.5] * 5), ["x"])
    assert drift.numeric_distances(counts).first()["wasserstein_normed"] == pytest.approx(0.5 / 0.001)


def test_category_distances(spark):
    df = labelled(spark, ["a"] * 60 + ["b"] * 40, ["a"] * 10 + ["b"] * 30 + ["c"] * 10, "period string, x string")
    got = drift.category_distances(drift.value_counts(df, ["x"], "string")).first()
    p, q = np.array([0.6, 0.4, 0]), np.array([0.2, 0.6, 0.2])
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log(x / y) for x, y in zip(a, m) if x > 0)
    assert got["js_distance"] == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2))
    assert math.isinf(got["chi2"]) and got["categories"] == 3 and got["distinct_ref"] == 2


def test_missing_values_take_no_part(spark):
    df = labelled(spark, [1.0, 2.0, None, float("nan"), float("inf")], [2.0])
    assert sorted((r["x"], r["n_ref"], r["n_cur"]) for r in drift.value_counts(df, ["x"]).collect()) == [(1.0, 1, 0), (2.0, 1, 1)]


def test_tails():
    # Printed values of the chi-square, normal and Kolmogorov tables.
    for stat, dof, p in [(3.841, 1, 0.05), (5.991, 2, 0.05), (7.815, 3, 0.05), (18.307, 10, 0.05), (6.635, 1, 0.01), (23.209, 10, 0.01)]:
        assert drift.chi2_tail(stat, dof) == pytest.approx(p, abs=2e-4)
    assert drift.chi2_tail(math.inf, 3) == 0 and drift.chi2_tail(0, 3) == 1
    assert drift.z_tail(1.959964) == pytest.approx(0.05, abs=1e-5)
    assert drift.ks_tail(0.0, 100, 100) == 1
    assert drift.ks_tail(1.358 / math.sqrt(50_000_000), 10**8, 10**8) == pytest.approx(0.05, abs=1e-3)


def test_periods_are_closed_with_a_hole_between(spark):
    from datetime import timedelta

    last = hours("2025-12-31", 1)[0]
    days = [0, 29, 29.04, 29.96, 30, 365, 365.04]
    df = spark.createDataFrame([(last - timedelta(days=d), float(d)) for d in days], "date timestamp, demand double")
    got = {r["demand"]: r["period"] for r in drift.label_periods(df).collect()}
    assert got == {0.0: "cur", 29.0: "cur", 30.0: "ref", 365.0: "ref"}


@pytest.mark.parametrize(
    "n,values,method",
    [
        (1200, 100, "wasserstein"),
        (1200, 4, "jensenshannon"),
        (500, 100, "ks"),
        (500, 4, "chisquare"),
        (500, 2, "z"),
    ],
)
@pytest.mark.parametrize("shift", [0, 1])
def test_choice_of_the_test(spark, n, values, method, shift):
    ref = [float(i % values) for i in range(n)]
    cur = [float((i % values) // 2 if shift else i % values) for i in range(n)]
    got = drift.drift_report(labelled(spark, ref, cur), tests="by_size").first()
    assert got["method"] == method and got["drifted"] is bool(shift)


def test_text_columns(spark):
    df = labelled(spark, ["a", "b", "c"] * 400, ["a"] * 300, "period string, x string")
    got = drift.drift_report(df).first()
    assert (got["method"], got["drifted"]) == ("jensenshannon", True)


def test_dataset_verdict(spark):
    make = lambda flags: spark.createDataFrame([(str(i), f) for i, f in enumerate(flags)], "column string, drifted boolean")
    verdict = lambda flags: drift.dataset_drift(make(flags)).first()["dataset_drift"]
    assert verdict([True, False]) is True and verdict([True, False, False]) is False and verdict([]) is False


def test_summary(spark):
    ref = np.round(RNG.gamma(2, 3, 301), 1)
    df = labelled(spark, [*ref.tolist(), None], [1.0, 1.0, 2.0, 2.0])
    got = {r["period"]: r for r in drift.column_summary(df, "x").collect()}
    r = got["ref"]
    assert (r["n_values"], r["n_missing"], r["n_distinct"]) == (301, 1, len(set(ref)))
    assert [r[c] for c in ("min", "p25", "p50", "p75", "max")] == pytest.approx(np.quantile(ref, [0, 0.25, 0.5, 0.75, 1]).tolist())
    assert r["mean"] == pytest.approx(ref.mean()) and r["stddev"] == pytest.approx(ref.std(ddof=1))
    assert (got["cur"]["most_common"], got["cur"]["most_common_count"]) == (1.0, 2)


def test_whole_run(spark):
    df = series(spark, 24 * 90, 2, start="2025-01-01")
    last = F.col("date") >= F.lit("2025-03-25").cast("timestamp")
    moved = df.withColumn("temperature_2m", F.when(last, F.col("temperature_2m") + 40).otherwise(F.col("temperature_2m")))
    verdict, report, document = detect_drift(stage(moved, "moved"), reference_days=60, gap_days=10, current_days=5)
    flags = {r["column"]: r["drifted"] for r in report.collect()}
    assert flags["temperature_2m"] is True and flags["sub_region_code"] is False
    doc = document.first()
    assert doc["number_of_columns"] == len(flags) and len(doc["columns"]) == len(flags) and len(doc["summary"]) == 2
    assert verdict is doc["dataset_drift"]
