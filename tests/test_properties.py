"""Property tests (random inputs via hypothesis; few examples each, every one runs Spark jobs)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import ivw, ols_full_inverse
from metassoc.operators.meta import inverse_variance
from metassoc.operators.moments import partial_derivatives
from metassoc.operators.regression import associate_pd

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.floats(-3, 3), st.floats(0.05, 2.0)), min_size=1, max_size=6), st.randoms())
def test_ivw_matches_numpy_in_any_order(spark, cohorts, rnd):
    rows = [(f"c{i}", "v", "p", b, s, 10.0) for i, (b, s) in enumerate(cohorts)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "cohort string, variant string, phenotype string, beta double, "
                                     "standard_error double, sample_size double")
    r = inverse_variance(df).first()
    b, se, i2 = ivw([c[0] for c in cohorts], [c[1] for c in cohorts])
    assert r.beta == pytest.approx(b, rel=1e-9, abs=1e-12)
    assert r.standard_error == pytest.approx(se, rel=1e-9)
    assert r.sample_size == 10.0 * len(cohorts)
    if len(cohorts) < 2 or r.i_squared is None:
        assert len(cohorts) < 2 or not np.isfinite(i2) or abs(i2) > 1e12
    else:
        assert r.i_squared == pytest.approx(i2, rel=1e-6, abs=1e-9)


@SETTINGS
@given(st.integers(8, 30), st.integers(0, 3), st.integers(0, 2**31 - 1))
def test_sufficient_statistics_equal_full_ols(spark, n, q, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, q))
    g = rng.integers(0, 3, size=n).astype(float)
    y = rng.normal(size=n) + 0.5 * g
    smp = spark.createDataFrame([("A", i, [float(v) for v in x[i]]) for i in range(n)],
                                "cohort string, sample_id long, x array<double>")
    geno = spark.createDataFrame([("A", i, "v", float(g[i])) for i in range(n) if g[i] != 0],
                                 "cohort string, sample_id long, variant string, dosage double")
    phen = spark.createDataFrame([("A", i, "p", float(y[i])) for i in range(n)],
                                 "cohort string, sample_id long, phenotype string, y double")
    rows = associate_pd(partial_derivatives(smp, geno, phen, q)).collect()
    b, se = ols_full_inverse(g, y, np.column_stack([np.ones(n), x]))
    if not np.isfinite(b) or n - q - 2 <= 0:
        assert rows == [] or rows[0].standard_error is not None
        return
    assert len(rows) == 1
    assert rows[0].beta == pytest.approx(b, rel=1e-7, abs=1e-9)
    assert rows[0].standard_error == pytest.approx(se, rel=1e-7, abs=1e-9)


@SETTINGS
@given(st.lists(st.sampled_from([0.0, 1.0, 2.0, 9.0, 0.5]), min_size=1, max_size=20))
def test_flip_twice_is_identity(spark, dos):
    from metassoc.functions.columns import flip_dosage
    df = spark.createDataFrame([(dos, -1)], "d array<double>, f int")
    twice = df.select(flip_dosage(flip_dosage("d", "f"), "f").alias("t")).first().t
    assert twice == pytest.approx(dos)
