import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import ols_full_inverse, small_cohorts
from metassoc.operators.moments import cross_moments, flip_moments, partial_derivatives
from metassoc.operators.regression import associate_pd


def _frames(spark, seed=7):
    s, g, p = small_cohorts(seed)
    return (spark.createDataFrame(s, "cohort string, sample_id long, x array<double>"),
            spark.createDataFrame(g, "cohort string, sample_id long, variant string, dosage double"),
            spark.createDataFrame(p, "cohort string, sample_id long, phenotype string, y double"), (s, g, p))


def _dense(s, g, c, v):
    sc = s[s.cohort == c].sort_values("sample_id")
    return g[(g.cohort == c) & (g.variant == v)].set_index("sample_id").dosage.reindex(sc.sample_id, fill_value=0).to_numpy()


def test_encoding_preserves_products(spark):
    from metassoc.operators.encode import encode, encoded_cross_moments
    S, G, P, _ = _frames(spark)
    enc = encode(S, G, P, seed=3, block=4)
    got = {(r.cohort, r.variant, r.phenotype): r.gy for r in encoded_cross_moments(enc["genotype"], enc["phenotype"]).collect()}
    ref = {(r.cohort, r.variant, r.phenotype): r.gy for r in cross_moments(G, P).collect()}
    for k, v in got.items():
        assert v == pytest.approx(ref.get(k, 0.0), abs=1e-8)
    # the encoded genotype is mixed: not equal to the raw dosages
    raw = {(r.cohort, r.variant): r.dosage for r in G.where("sample_id = 0").collect()}
    e0 = {(r.cohort, r.variant): r.dosage for r in enc["genotype"].where("pos = 0").collect()}
    assert any(abs(e0[k] - raw.get(k, 0.0)) > 1e-9 for k in e0)


def test_interaction_matches_numpy(spark):
    from metassoc.operators.interaction import interaction_effects
    S, G, P, (s, g, p) = _frames(spark, seed=11)
    s = s.copy()
    got = {(r.cohort, r.variant, r.phenotype): r for r in interaction_effects(S, G, P, 1).collect()}
    checked = 0
    assert not any(v == "v2" for (_, v, _) in got)      # constant g: g·x ≡ x, singular design dropped
    for (c, v, ph), r in got.items():
        sc = s[s.cohort == c].sort_values("sample_id")
        x = np.vstack(sc.x.to_numpy())[:, 0]
        gv = _dense(s, g, c, v)
        yv = p[(p.cohort == c) & (p.phenotype == ph)].set_index("sample_id").y.reindex(sc.sample_id, fill_value=0).to_numpy()
        D = np.column_stack([np.ones(len(x)), x, gv * x, gv])
        coef, *_ = np.linalg.lstsq(D, yv, rcond=None)
        Ai = np.linalg.inv(D.T @ D)
        rss = ((yv - D @ coef) ** 2).sum()
        assert r.beta == pytest.approx(coef[-1], rel=1e-7, abs=1e-9)
        assert r.beta_interaction == pytest.approx(coef[-2], rel=1e-7, abs=1e-9)
        assert r.standard_error == pytest.approx(math.sqrt(rss / (len(x) - 4) * Ai[-1, -1]), rel=1e-6)
        checked += 1
    assert checked > 0


def test_study_intercepts_match_numpy(spark):
    from metassoc.operators.blocks import associate_shared
    S, G, P, (s, g, p) = _frames(spark, seed=5)
    pd_ = partial_derivatives(S, G, P, 1)          # sparse sums: what a cohort lacks is zero
    got = {(r.variant, r.phenotype): r for r in associate_shared(
        {k: pd_[k] for k in ("pd_cov", "pd_test", "pd_pheno", "pd_b4")}, output="mega", intercepts=True).collect()}
    for (v, ph), r in got.items():
        xs, gs, ys, ds = [], [], [], []
        for c in ("A", "B"):
            sc = s[s.cohort == c].sort_values("sample_id")
            xs.append(np.vstack(sc.x.to_numpy())[:, 0]); ds.append(np.full(len(sc), 1.0 if c == "B" else 0.0))
            gs.append(_dense(s, g, c, v))
            ys.append(p[(p.cohort == c) & (p.phenotype == ph)].set_index("sample_id").y.reindex(sc.sample_id, fill_value=0).to_numpy())
        b, se = ols_full_inverse(np.concatenate(gs), np.concatenate(ys),
                                 np.column_stack([np.ones(12), np.concatenate(xs), np.concatenate(ds)]))
        assert r.beta == pytest.approx(b, rel=1e-8, abs=1e-10)
        assert r.standard_error == pytest.approx(se, rel=1e-8)


def test_flip_changes_sign_of_beta(spark):
    S, G, P, _ = _frames(spark)
    pd_ = partial_derivatives(S, G, P, 1)
    base = {(r.cohort, r.variant, r.phenotype): r for r in associate_pd(pd_).collect()}
    flips = spark.createDataFrame([("A", "v0", -1), ("B", "v0", -1)], "cohort string, variant string, flip int")
    pd2 = dict(pd_, pd_test=flip_moments(pd_["pd_test"], pd_["pd_cov"], flips))
    flipped = {(r.cohort, r.variant, r.phenotype): r for r in associate_pd(pd2).collect()}
    from metassoc.operators.regression import flip_effects
    on_effects = {(r.cohort, r.variant, r.phenotype): r for r in flip_effects(associate_pd(pd_), flips).collect()}
    for k, r in base.items():
        sign = -1 if k[1] == "v0" else 1
        assert flipped[k].beta == pytest.approx(sign * r.beta, rel=1e-9, abs=1e-12)
        assert flipped[k].standard_error == pytest.approx(r.standard_error, rel=1e-9)
        assert on_effects[k].beta == pytest.approx(flipped[k].beta, rel=1e-9, abs=1e-12)
        assert on_effects[k].maf == pytest.approx(flipped[k].maf, rel=1e-12)


def test_dense_block_path_equals_long_path(spark):
    from metassoc.operators.blocks import dense_associate
    from metassoc.operators.meta import inverse_variance
    S, G, P, (s, g, p) = _frames(spark)
    rows_g, rows_p, rows_c = [], [], []
    for c in ("A", "B"):
        sc = s[s.cohort == c].sort_values("sample_id")
        rows_c.append((c, "x", [float(v[0]) for v in sc.x]))
        for v in g[g.cohort == c].variant.unique():
            rows_g.append((c, v, [float(d) for d in _dense(s, g, c, v)]))
        for ph in p[p.cohort == c].phenotype.unique():
            yv = p[(p.cohort == c) & (p.phenotype == ph)].set_index("sample_id").y.reindex(sc.sample_id, fill_value=0)
            rows_p.append((c, ph, [float(y) for y in yv]))
    DG = spark.createDataFrame(rows_g, "cohort string, variant string, dosage array<double>")
    DP = spark.createDataFrame(rows_p, "cohort string, phenotype string, values array<double>")
    DC = spark.createDataFrame(rows_c, "cohort string, covariate string, values array<double>")
    long_meta = {(r.variant, r.phenotype): r for r in inverse_variance(associate_pd(partial_derivatives(S, G, P, 1))).collect()}
    for vpb in (1, 2, 512):          # several block sizes, one result
        blk = {(r.variant, r.phenotype): r for r in dense_associate(DG, DP, DC, variants_per_block=vpb).collect()}
        assert set(blk) == set(long_meta)
        for k, r in blk.items():
            assert r.beta == pytest.approx(long_meta[k].beta, rel=1e-9, abs=1e-12)
            assert r.standard_error == pytest.approx(long_meta[k].standard_error, rel=1e-9)
            assert r.sample_size == long_meta[k].sample_size
    # several phenotype blocks and sample blocks, same answer
    for how in ({"phenotypes_per_block": 1}, {"sample_block": 4}, {"variants_per_block": 1, "phenotypes_per_block": 2, "sample_block": 2}):
        blk = {(r.variant, r.phenotype): r.beta for r in dense_associate(DG, DP, DC, **how).collect()}
        assert blk == pytest.approx({k: v.beta for k, v in long_meta.items()})


def test_permutation_is_a_bijection_per_cohort(spark):
    from metassoc.operators.permute import permute_samples
    S, _, _, _ = _frames(spark)
    perm = permute_samples(S, seed=42).toPandas()
    for c, grp in perm.groupby("cohort"):
        assert sorted(grp.sample_id) == sorted(grp.source_id)
    assert (perm.sample_id != perm.source_id).any()


def test_p_values():
    from helpers import normal_sf2, student_sf2
    assert normal_sf2(np.array([1.959963984540054]))[0] == pytest.approx(0.05, rel=1e-12)
    assert student_sf2(np.array([2.2281388519649385]), np.array([10.0]))[0] == pytest.approx(0.05, rel=1e-9)
    assert student_sf2(np.array([0.0]), np.array([5.0]))[0] == pytest.approx(1.0)
    assert student_sf2(np.array([12.706204736174698]), np.array([1.0]))[0] == pytest.approx(0.05, rel=1e-9)
    big = student_sf2(np.array([3.0]), np.array([1e6]))[0]
    assert big == pytest.approx(normal_sf2(np.array([3.0]))[0], rel=1e-4)
    assert np.isnan(student_sf2(np.array([np.nan]), np.array([3.0]))[0])


def test_p_value_columns(spark):
    from metassoc.functions.pvalues import p_value
    df = spark.createDataFrame([(2.2281388519649385, 10.0), (None, 3.0)], "t double, df double")
    r = df.select(p_value("t", "df").alias("p"), p_value("t").alias("pn")).collect()
    assert r[0].p == pytest.approx(0.05, rel=1e-9) and r[1].p is None or math.isnan(r[1].p)


def test_harmonise_by_id_and_positions_from_ids(spark):
    from metassoc.operators.harmonise import harmonise, map_counts, unmatched
    ref = spark.createDataFrame([(0, "rs0", 1, 100, "A", "C"), (1, "rs1", 1, 200, "G", "T"), (2, "rs2", 2, 300, "A", "G")],
                                "ref_idx long, ref_id string, chr int, bp long, allele1 string, allele2 string")
    probes = spark.createDataFrame(
        [("c", 10, "1:100", "A", "C"), ("c", 11, "1:200", "T", "G"), ("c", 12, "2:300", "A", "T"), ("c", 13, "x:1", "A", "C")],
        "cohort string, variant_idx long, id string, allele1 string, allele2 string")
    m = {r.ref_idx: (r.variant_idx, r.flip) for r in harmonise(probes, ref).collect()}
    assert m == {0: (10, 1), 1: (11, -1)}
    assert sorted(r.variant_idx for r in unmatched(probes, harmonise(probes, ref)).collect()) == [12, 13]
    c = map_counts(probes, ref, harmonise(probes, ref)).first()
    assert (c.common, c.ref_not_in_probes, c.probes_not_in_ref) == (2, 1, 2)
    byid = spark.createDataFrame([("c", 5, "rs2", "G", "A")], "cohort string, variant_idx long, id string, allele1 string, allele2 string")
    assert [(r.ref_idx, r.flip) for r in harmonise(byid, ref, by="id").collect()] == [(2, -1)]


def test_column_functions(spark):
    from metassoc.functions import columns as C
    df = spark.createDataFrame([("0/1", "GT", "AA: 10, AB: 5, BB: 2", "3:12345"), ("1|2", "GT", "AA: 0, AB: 1, BB: 20", "rs7"),
                                ("./.", "GT", "AA: 3, AB: 0, BB: 0", "23:5"), ("0.25", "DS", "AA: 1, AB: 1, BB: 1", "22:1:A:G")],
                               "call string, fmt string, counts string, id string")
    h1, het, h2 = C.parse_genotype_counts(F.col("counts"))
    ch, bp = C.chr_bp_from_id(F.col("id"))
    r = df.select(C.call_to_dosage("call", "fmt").alias("d"), h1.alias("h1"), het.alias("het"), h2.alias("h2"),
                  ch.alias("chr"), bp.alias("bp")).collect()
    assert [x.d for x in r] == [1.0, 0.0, 9.0, 1.75]
    assert [(x.h1, x.het, x.h2) for x in r] == [(10, 5, 2), (0, 1, 20), (3, 0, 0), (1, 1, 1)]
    assert [(x.chr, x.bp) for x in r] == [("3", 12345), (None, None), (None, None), ("22", 1)]
    arr = spark.createDataFrame([([0.0, 1.0, 9.0, 2.0], -1)], "d array<double>, f int")
    a = arr.select(C.impute_mean_array("d").alias("i"), C.flip_dosage("d", "f").alias("fl"), C.maf_from_array("d").alias("m")).first()
    assert a.i == [0.0, 1.0, 1.0, 2.0] and a.fl == [2.0, 1.0, 9.0, 0.0] and a.m == pytest.approx(0.5)


def test_plans_tiles_in_one_exchange_and_long_path_broadcasts(spark):
    """The tile rows are exchanged once, to their tasks; the long path broadcasts the measured phenotype side of the cohort grid."""
    from metassoc.operators.blocks import dense_associate
    rows_g = [("A", f"v{i}", [float((i * j) % 3) for j in range(8)]) for i in range(6)]
    rows_p = [("A", f"p{k}", [float((k + j) % 5) for j in range(8)]) for k in range(4)]
    DG = spark.createDataFrame(rows_g, "cohort string, variant string, dosage array<double>")
    DP = spark.createDataFrame(rows_p, "cohort string, phenotype string, values array<double>")
    plan = dense_associate(DG, DP, variants_per_block=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 1 and "Broadcast" not in plan
    S, G, P, _ = _frames(spark)
    eff = associate_pd(partial_derivatives(S, G, P, 1))
    assert "BroadcastHashJoin" in eff._jdf.queryExecution().executedPlan().toString()


def test_row_index_and_rank_within(spark):
    from metassoc.operators.ranks import rank_within, row_index
    df = spark.range(0, 1000, 1, numPartitions=7).withColumn("g", (F.col("id") % 3).cast("string"))
    idx = row_index(df, "i").collect()
    assert sorted(r.i for r in idx) == list(range(1000))
    assert all(r.i == r.id for r in idx)                     # file/partition order preserved
    rk = rank_within(df, "g", "id", "r").collect()
    for g in "012":
        ids = sorted(r.id for r in rk if r.g == g)
        assert {r.id: r.r for r in rk if r.g == g} == {v: k for k, v in enumerate(ids)}


def test_pd_store_roundtrip_and_schema_check(spark, tmp_path):
    from metassoc.sources.pd_store import merge_pd_shards, read_pd, write_pd
    S, G, P, _ = _frames(spark)
    whole = partial_derivatives(S, G, P, 1)
    paths = []
    for part in (0, 1):
        keep = (F.col("sample_id") % 2) == part
        p = str(tmp_path / f"s{part}")
        write_pd(partial_derivatives(S.where(keep), G.where(keep), P.where(keep), 1), p)
        paths.append(p)
    merged = merge_pd_shards([read_pd(spark, p) for p in paths])
    a = {(r.cohort, r.variant): r.gg for r in whole["pd_test"].collect()}
    b = {(r.cohort, r.variant): r.gg for r in merged["pd_test"].collect()}
    assert b == pytest.approx(a)
    base = {(r.cohort, r.variant, r.phenotype): r.beta for r in associate_pd(whole).collect()}
    again = {(r.cohort, r.variant, r.phenotype): r.beta for r in associate_pd(merged).collect()}
    assert again == pytest.approx(base)
    bad = str(tmp_path / "bad")
    whole["pd_cov"].drop("a_cov").write.parquet(bad + "/pd_cov")
    with pytest.raises(ValueError):
        read_pd(spark, bad)


def test_covariate_projection_equals_smaller_design(spark):
    from metassoc.operators.align import select_covariates
    S, G, P, (s, g, p) = _frames(spark)
    S2 = S.withColumn("x", F.array(F.col("x")[0], F.col("x")[0] * 0.5 + F.col("sample_id")))
    idx = spark.createDataFrame([("A", 1), ("B", 1)], "cohort string, idx int")
    proj = {(r.cohort, r.variant, r.phenotype): r.beta
            for r in associate_pd(select_covariates(partial_derivatives(S2, G, P, 2), idx)).collect()}
    small = {(r.cohort, r.variant, r.phenotype): r.beta for r in associate_pd(partial_derivatives(S, G, P, 1)).collect()}
    assert proj == pytest.approx(small)


def test_gather_and_variant_map(spark):
    from metassoc.operators.align import apply_variant_map, common_covariates, gather_samples, require_rows
    dense = spark.createDataFrame([("A", 7, [0.0, 1.0, 2.0]), ("A", 8, [1.0, 1.0, 0.0])],
                                  "cohort string, variant_idx long, dosage array<double>")
    order = spark.createDataFrame([("A", 0, 2), ("A", 1, 0)], "cohort string, idx int, pos int")
    assert {r.variant_idx: r.dosage for r in gather_samples(dense, order).collect()} == {7: [2.0, 0.0], 8: [0.0, 1.0]}
    vmap = spark.createDataFrame([("A", 0, "rs7", 7, -1)], "cohort string, ref_idx long, ref_id string, variant_idx long, flip int")
    m = apply_variant_map(dense, vmap).collect()
    assert [(r.variant, r.dosage) for r in m] == [("rs7", [2.0, 1.0, 0.0])]
    long = spark.createDataFrame([("A", "s1", 7, 1.0)], "cohort string, sample_id string, variant_idx long, dosage double")
    assert apply_variant_map(long, vmap).first().flip == -1          # sparse rows: flip kept for the PD step
    names = spark.createDataFrame([("A", "A_age"), ("A", "A_pc1"), ("B", "B_age")], "cohort string, name string")
    assert [r.name for r in common_covariates(names).collect()] == ["age"]
    with pytest.raises(ValueError):
        require_rows(names.where("cohort = 'C'"), "phenotype")


def test_pd_sample_coverage(spark):
    from metassoc.operators.align import assert_pd_samples_covered, sample_intersection
    ph = spark.createDataFrame([("A", "s1"), ("A", "s2")], "cohort string, sample_id string")
    ge = spark.createDataFrame([("A", "s1"), ("A", "s2"), ("A", "s3")], "cohort string, sample_id string")
    inter = sample_intersection(ph, ge)
    assert_pd_samples_covered(inter, ph)
    with pytest.raises(ValueError):
        assert_pd_samples_covered(inter, ge)


def test_dense_partial_derivatives_feed_the_sparse_solver(spark):
    from metassoc.operators.blocks import dense_associate, dense_partial_derivatives
    rng = np.random.default_rng(9)
    rows_g = [(c, f"v{i}", rng.integers(0, 3, 15).astype(float).tolist()) for c in ("A", "B") for i in range(6)]
    rows_p = [(c, f"p{k}", rng.normal(size=15).tolist()) for c in ("A", "B") for k in range(3)]
    rows_c = [(c, "x", rng.normal(size=15).tolist()) for c in ("A", "B")]
    DG = spark.createDataFrame(rows_g, "cohort string, variant string, dosage array<double>")
    DP = spark.createDataFrame(rows_p, "cohort string, phenotype string, values array<double>")
    DC = spark.createDataFrame(rows_c, "cohort string, covariate string, values array<double>")
    via_pd = {(r.cohort, r.variant, r.phenotype): r for r in associate_pd(dense_partial_derivatives(DG, DP, DC)).collect()}
    direct = {(r.cohort, r.variant, r.phenotype): r for r in dense_associate(DG, DP, DC, pooled=False).collect()}
    assert set(via_pd) == set(direct)
    for k, r in direct.items():
        assert via_pd[k].beta == pytest.approx(r.beta, rel=1e-9, abs=1e-12)
        assert via_pd[k].standard_error == pytest.approx(r.standard_error, rel=1e-9)


def test_dense_encoding_matches_long_encoding_and_preserves_products(spark):
    from metassoc.operators.encode import encode, encode_dense
    S, G, P, (s, g, p) = _frames(spark)
    rows_g, rows_p = [], []
    for c in ("A", "B"):
        sc = s[s.cohort == c].sort_values("sample_id")
        for v in g[g.cohort == c].variant.unique():
            rows_g.append((c, v, [float(d) for d in _dense(s, g, c, v)]))
        for ph in p[p.cohort == c].phenotype.unique():
            yv = p[(p.cohort == c) & (p.phenotype == ph)].set_index("sample_id").y.reindex(sc.sample_id, fill_value=0)
            rows_p.append((c, ph, [float(y) for y in yv]))
    DG = spark.createDataFrame(rows_g, "cohort string, variant string, dosage array<double>")
    DP = spark.createDataFrame(rows_p, "cohort string, phenotype string, values array<double>")
    enc = encode_dense(DG, DP, seed=3, block=4)
    eg = {(r.cohort, r.variant): np.array(r.dosage) for r in enc["genotype"].collect()}
    ep = {(r.cohort, r.phenotype): np.array(r.values) for r in enc["phenotype"].collect()}
    for (c, v, vec) in rows_g:
        for (c2, ph, yv) in rows_p:
            if c2 == c:
                assert eg[(c, v)] @ ep[(c, ph)] == pytest.approx(np.dot(vec, yv), rel=1e-8, abs=1e-8)
    long = encode(S, G, P, seed=3, block=4)["genotype"].toPandas()      # samples 0..5 are in id order
    for (c, v), e in eg.items():
        sub = long[(long.cohort == c) & (long.variant == v)].set_index("pos").dosage
        assert e == pytest.approx(sub.reindex(range(len(e)), fill_value=0.0).to_numpy(), abs=1e-9)


def test_two_interaction_factors_match_numpy(spark):
    from metassoc.operators.interaction import interaction_effects
    rng = np.random.default_rng(21)
    n = 25
    x = rng.normal(size=(n, 2))
    g = rng.integers(0, 3, size=n).astype(float)
    y = rng.normal(size=n) + 0.4 * g * x[:, 0]
    S = spark.createDataFrame([("A", i, [float(v) for v in x[i]]) for i in range(n)], "cohort string, sample_id long, x array<double>")
    G = spark.createDataFrame([("A", i, "v", float(g[i])) for i in range(n) if g[i]], "cohort string, sample_id long, variant string, dosage double")
    P = spark.createDataFrame([("A", i, "p", float(y[i])) for i in range(n)], "cohort string, sample_id long, phenotype string, y double")
    r = interaction_effects(S, G, P, 2, factor=[0, 1]).first()
    D = np.column_stack([np.ones(n), x, g * x[:, 0], g * x[:, 1], g])
    coef, *_ = np.linalg.lstsq(D, y, rcond=None)
    Ai = np.linalg.inv(D.T @ D)
    s2 = ((y - D @ coef) ** 2).sum() / (n - D.shape[1])
    assert r.beta == pytest.approx(coef[-1], rel=1e-7)
    assert r.betas_interaction == pytest.approx(coef[3:5], rel=1e-7)
    assert r.ses_interaction == pytest.approx(np.sqrt(s2 * np.diag(Ai)[3:5]), rel=1e-6)
    assert r.standard_error == pytest.approx(np.sqrt(s2 * Ai[-1, -1]), rel=1e-6)


def test_encoded_interaction_products(spark):
    """R3: the centre gets Σ g·f·y from G·F and F⁻¹·(y∘f)."""
    from metassoc.operators.encode import encode, encode_interaction_phenotype, encoded_cross_moments
    S, G, P, (s, g, p) = _frames(spark)
    enc = encode(S, G, P, seed=5, block=3)
    eg = enc["genotype"]
    ep = encode_interaction_phenotype(P, S, enc["positions"], seed=5, block=3, factor=0)
    got = {(r.cohort, r.variant, r.phenotype): r.gy for r in encoded_cross_moments(eg, ep).collect()}
    xs = {(r.cohort, r.sample_id): r.x[0] for r in S.collect()}
    gyf = (G.join(P, ["cohort", "sample_id"]).rdd
           .map(lambda r: ((r.cohort, r.variant, r.phenotype), r.dosage * r.y * xs[(r.cohort, r.sample_id)]))
           .reduceByKey(lambda a, b: a + b).collectAsMap())
    for k, v in got.items():
        assert v == pytest.approx(gyf.get(k, 0.0), abs=1e-8)


def test_meta_with_log_and_guard(spark):
    from metassoc.plans.jobs import meta_analyse_with_log
    S, G, P, _ = _frames(spark)
    genes = spark.createDataFrame([("p0",)], "phenotype string")
    meta, log = meta_analyse_with_log(S, G, P, 1, log_phenotypes=genes)
    assert {r.phenotype for r in log.collect()} == {"p0"} and meta.count() > 0
    assert log.columns == ["cohort", "variant", "phenotype", "beta", "standard_error", "sample_size"]
    with pytest.raises(ValueError):
        meta_analyse_with_log(S, G, P, 1, log_phenotypes=genes, max_effects=1)
    _, nolog = meta_analyse_with_log(S, G, P, 1)
    assert nolog.count() == 0                      # no lists -> nothing logged


def test_small_column_helpers(spark):
    from metassoc.functions import columns as C
    from metassoc.operators.align import mark_removed_ids
    from metassoc.operators.report import beta_from_t
    df = spark.createDataFrame([("s1", True, 2.0, 0.5, 1.0, -1), ("s2", False, -1.0, 0.25, 9.0, -1)],
                               "sid string, rm boolean, t double, se double, d double, f int")
    r = df.select(C.mark_removed("sid", "rm").alias("m"), beta_from_t("t", "se").alias("b"),
                  C.flip_value("d", "f").alias("fv")).collect()
    assert [(x.m, x.b, x.fv) for x in r] == [("remove_s1", 1.0, 1.0), ("s2", -0.25, 9.0)]
    ids = spark.createDataFrame([("s1",), ("s3",)], "sample_id string")
    out = mark_removed_ids(ids, spark.createDataFrame([("s1",)], "sample_id string"))
    assert sorted(x.sample_id for x in out.collect()) == ["remove_s1", "s3"]
