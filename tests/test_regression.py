import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import ivw, numpy_effects, small_cohorts
from metassoc.operators.meta import inverse_variance, pool_pd
from metassoc.operators.moments import partial_derivatives
from metassoc.operators.regression import associate_pd, invert_cov, variant_terms


def _frames(spark):
    s, g, p = small_cohorts()
    return (spark.createDataFrame(s, "cohort string, sample_id long, x array<double>"),
            spark.createDataFrame(g, "cohort string, sample_id long, variant string, dosage double"),
            spark.createDataFrame(p, "cohort string, sample_id long, phenotype string, y double"), (s, g, p))


def test_schur_matches_full_inverse_ols(spark):
    S, G, P, raw = _frames(spark)
    eff = associate_pd(partial_derivatives(S, G, P, 1)).collect()
    ref = numpy_effects(*raw)
    got = {(r.cohort, r.variant, r.phenotype): (r.beta, r.standard_error) for r in eff}
    assert set(got) == set(ref)                      # singular v2 dropped, absent pairs absent
    for k, (b, se) in ref.items():
        assert got[k][0] == pytest.approx(b, rel=1e-9, abs=1e-12)
        assert got[k][1] == pytest.approx(se, rel=1e-9, abs=1e-12)


def test_singular_variant_reported_in_diagnostics(spark):
    S, G, P, _ = _frames(spark)
    pd_ = partial_derivatives(S, G, P, 1)
    vt = variant_terms(pd_["pd_test"], invert_cov(pd_["pd_cov"]), keep_singular=True)
    sing = {(r.cohort, r.variant) for r in vt.where("singular").collect()}
    assert sing == {("A", "v2"), ("B", "v2")}


def test_ivw_matches_numpy(spark):
    S, G, P, raw = _frames(spark)
    eff = associate_pd(partial_derivatives(S, G, P, 1))
    meta = {(r.variant, r.phenotype): r for r in inverse_variance(eff).collect()}
    ref = numpy_effects(*raw)
    for (v, ph), r in meta.items():
        cs = [ref[(c, v, ph)] for c in ("A", "B") if (c, v, ph) in ref]
        b, se, i2 = ivw([x[0] for x in cs], [x[1] for x in cs])
        assert r.beta == pytest.approx(b, rel=1e-9)
        assert r.standard_error == pytest.approx(se, rel=1e-9)
        if len(cs) < 2:
            assert r.i_squared is None
        else:
            assert r.i_squared == pytest.approx(i2, rel=1e-7)
        assert r.sample_size == 6.0 * len(cs)


def test_ivw_identical_cohorts_and_order_invariance(spark):
    rows = [("c%d" % k, "v", "p", 0.7, 0.2, 10.0) for k in range(4)]
    df = spark.createDataFrame(rows, "cohort string, variant string, phenotype string, beta double, standard_error double, sample_size double")
    r = inverse_variance(df).first()
    assert r.beta == pytest.approx(0.7)
    assert r.standard_error == pytest.approx(0.2 / 2)
    assert r.sample_size == 40.0
    assert r.i_squared is None                       # Q == 0
    rev = inverse_variance(df.orderBy(F.desc("cohort"))).first()
    assert rev.beta == pytest.approx(r.beta) and rev.standard_error == pytest.approx(r.standard_error)


def test_ivw_drops_nan_and_zero_se(spark):
    rows = [("a", "v", "p", 1.0, 0.5, 5.0), ("b", "v", "p", float("nan"), 0.5, 5.0), ("c", "v", "p", 2.0, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "cohort string, variant string, phenotype string, beta double, standard_error double, sample_size double")
    r = inverse_variance(df).first()
    assert r.beta == 1.0 and r.sample_size == 5.0 and r.i_squared is None


def test_mega_equals_pooled_regression(spark):
    S, G, P, (s, g, p) = _frames(spark)
    # make cohort B's ids distinct and treat everything as one cohort
    mega = {(r.variant, r.phenotype): r for r in associate_pd(pool_pd(partial_derivatives(S, G, P, 1))).collect()}
    s2, g2, p2 = s.copy(), g.copy(), p.copy()
    for d in (s2, g2, p2):
        d["sample_id"] = d["sample_id"] + np.where(d["cohort"] == "B", 100, 0)
        d["cohort"] = "ALL"
    ref = numpy_effects(s2, g2[g2.variant != "v3"], p2[p2.phenotype != "p2"])
    assert set(mega) == {(v, ph) for (_, v, ph) in ref}
    for (_, v, ph), (b, se) in ref.items():
        assert mega[(v, ph)].beta == pytest.approx(b, rel=1e-9)
        assert mega[(v, ph)].standard_error == pytest.approx(se, rel=1e-9)


def test_pd_additivity(spark):
    """PD of a split dataset sums to the PD of the whole."""
    S, G, P, _ = _frames(spark)
    whole = partial_derivatives(S, G, P, 1)
    half = lambda df: df.withColumn("cohort", F.concat("cohort", F.lit("_"), (F.col("sample_id") % 2).cast("string")))
    parts = partial_derivatives(half(S), half(G), half(P), 1)
    a = {r.cohort: r.gg for r in whole["pd_test"].where("variant = 'v0'").collect()}
    b = parts["pd_test"].where("variant = 'v0'").withColumn("c0", F.substring("cohort", 1, 1)).groupBy("c0").agg(F.sum("gg").alias("gg"))
    assert {r.c0: r.gg for r in b.collect()} == pytest.approx(a)


def test_spd_inverse(spark):
    from metassoc.functions.linalg import spd_inverse
    rng = np.random.default_rng(1)
    mats = []
    for p in (1, 2, 3, 5):
        a = rng.normal(size=(10, p))
        mats.append((a.T @ a).tolist())
    df = spark.createDataFrame([(m,) for m in mats] + [([[1.0, 2.0], [2.0, 4.0]],)], "m array<array<double>>")
    got = [r.inv for r in df.select(spd_inverse("m").alias("inv")).collect()]
    for m, inv in zip(mats, got[:-1]):
        assert np.allclose(np.array(inv), np.linalg.inv(np.array(m)), rtol=1e-9, atol=1e-12)
    assert got[-1] is None                               # singular


def test_salted_fallback_beyond_the_broadcast_bound(spark):
    """Over the measured bound the cohort grid is a shuffle join on (cohort, salt): same results."""
    S, G, P, _ = _frames(spark)
    pd_ = partial_derivatives(S, G, P, 1)
    small = {(r.cohort, r.variant, r.phenotype): (r.beta, r.standard_error) for r in associate_pd(pd_).collect()}
    salted_df = associate_pd(pd_, max_broadcast_rows=0)
    salted = {(r.cohort, r.variant, r.phenotype): (r.beta, r.standard_error) for r in salted_df.collect()}
    assert salted.keys() == small.keys()
    for k, v in small.items():
        assert salted[k] == pytest.approx(v, rel=1e-12)
    plan = salted_df._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
