"""Steps whose work must grow with their input, held against plain results."""

import random

import pytest

from metassoc.operators.encode import encode, encoded_cross_moments


def _long_rows(n, seed):
    r = random.Random(seed)
    samples = [("A", i, [1.0]) for i in range(n)] + [("B", i, [1.0]) for i in range(70)]
    geno = [(c, s, v, float(r.randint(1, 2))) for c, s, _ in samples for v in ("v1", "v2") if r.random() < 0.3]
    geno += [("A", n - 1, "last", 2.0)]                       # all chunks but one are empty
    phen = [(c, s, "p", r.uniform(-1, 1)) for c, s, _ in samples if r.random() < 0.5]
    return samples, geno, phen


def test_encoded_products_over_many_chunks(spark):
    """2500 samples lie in three chunks; rows are gathered chunk by chunk, not by looking each place up in a map of the whole row."""
    samples, geno, phen = _long_rows(2500, 3)
    s = spark.createDataFrame(samples, "cohort string, sample_id long, x array<double>")
    g = spark.createDataFrame(geno, "cohort string, sample_id long, variant string, dosage double")
    p = spark.createDataFrame(phen, "cohort string, sample_id long, phenotype string, y double")
    enc = encode(s, g, p, seed=5)
    plan = enc["genotype"]._jdf.queryExecution().analyzed().toString()
    assert "map_from_entries" not in plan
    assert enc["genotype"].where("cohort = 'A'").groupBy("variant").count().collect() and \
        {r["count"] for r in enc["genotype"].where("cohort = 'A'").groupBy("variant").count().collect()} == {2500}
    got = {(r.cohort, r.variant): r.gy for r in encoded_cross_moments(enc["genotype"], enc["phenotype"]).collect()}
    y = {(c, i): v for c, i, _, v in phen}
    want = {}
    for c, i, v, d in geno:
        want[(c, v)] = want.get((c, v), 0.0) + d * y.get((c, i), 0.0)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-8) for k in want)


def test_a_sample_met_twice_is_an_error(spark):
    s = spark.createDataFrame([("A", i, [1.0]) for i in range(3)], "cohort string, sample_id long, x array<double>")
    g = spark.createDataFrame([("A", 1, "v", 1.0), ("A", 1, "v", 2.0)], "cohort string, sample_id long, variant string, dosage double")
    p = spark.createDataFrame([("A", 1, "p", 1.0)], "cohort string, sample_id long, phenotype string, y double")
    with pytest.raises(Exception, match="twice"):
        encode(s, g, p, seed=5)["genotype"].collect()


@pytest.mark.parametrize("name", ["meta_ivw_parts", "mega_missingness"])
def test_pairs_of_many_variants_are_not_sent_again(spark, name):
    """Rows meet once by variant; neither the pairs with their products nor the pooling over cohorts send them by more keys."""
    import re

    import __spark_entry__ as E
    from conftest import SF001
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any(s.startswith("variant#") for s in sent)
    assert not [s for s in sent if "phenotype#" in s and "variant#" in s]


def test_effects_of_mapped_variants_stay_where_they_are(spark):
    """The flip comes with the rows of its cohort and variant: no effect is sent to meet the map again, nor to be pooled."""
    import re

    import __spark_entry__ as E
    from conftest import SF001
    plan = E.queries()["meta_harmonised"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any(s.startswith("variant#") for s in sent)
    assert not [s for s in sent if re.match(r"cohort#\d+, variant#|variant#\d+, phenotype#", s)]


def test_carried_flips_orient_effects_as_the_map_does(spark):
    """Effects that bring their flip equal those that meet it by a join, by cohort and variant; two flips of one variant are an error."""
    from metassoc.operators.moments import partial_derivatives
    from metassoc.operators.regression import associate_pd, flip_effects
    samples, geno, phen = _long_rows(40, 4)
    r = random.Random(6)
    s = spark.createDataFrame([(c, i, [r.random()]) for c, i, _ in samples], "cohort string, sample_id long, x array<double>")
    g = spark.createDataFrame(geno, "cohort string, sample_id long, variant string, dosage double")
    p = spark.createDataFrame(phen, "cohort string, sample_id long, phenotype string, y double")
    flips = spark.createDataFrame([("A", "v1", -1), ("A", "v2", 1), ("A", "last", 1), ("B", "v1", 1), ("B", "v2", -1)],
                                  "cohort string, variant string, flip int")
    carried = g.join(flips.withColumnRenamed("flip", "orientation"), ["cohort", "variant"])
    for by_variant in (False, True):
        want = flip_effects(associate_pd(partial_derivatives(s, g, p, 1, by_variant=by_variant)), flips)
        got = flip_effects(associate_pd(partial_derivatives(s, carried, p, 1, by_variant=by_variant)))
        assert got.columns == want.columns
        want, got = ({(e.cohort, e.variant, e.phenotype): (e.beta, e.t_stat, e.standard_error, e.maf) for e in d.collect()} for d in (want, got))
        assert set(got) == set(want) and len(want) >= 4
        assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    two = carried.unionByName(carried.where("variant = 'v1'").withColumn("orientation", -carried["orientation"]))
    with pytest.raises(Exception, match="two values of orientation in cohort"):
        partial_derivatives(s, two, p, 1)["pd_test"].collect()


def test_dose_lines_are_cut_once(spark, tmp_path):
    """A dose line is as long as there are variants: nothing may split it again for each of its entries, and samples get their
    places line by line."""
    import re

    from metassoc.plans.ingest import ingest_minimac
    (tmp_path / "m.info").write_text("SNP Al1 Al2 Freq1 MAF AvgCall Rsq\n" + "".join(f"rs{i} A G 0.5 0.5 0.9 0.8\n" for i in range(3)))
    (tmp_path / "m.dose").write_text("F->B DOSE 1.5 x 2\nF->A DOSE 0.5 0 1\nF->none DOSE\n\nC DOSE 1 1\n")
    t = ingest_minimac(spark, str(tmp_path / "m.info"), str(tmp_path / "m.dose"), "M")
    assert [r.sample_id for r in t["samples"].orderBy("sample_pos").collect()] == ["A", "B", "C"]
    assert {r.variant_idx: r.dosage for r in t["genotype"].collect()} == {0: [0.5, 1.5, 1.0], 1: [0.0, -1.0, 1.0], 2: [1.0, 2.0, 0.0]}
    plan = t["genotype"]._jdf.queryExecution().optimizedPlan().toString()
    above, below = re.split(r"Generate posexplode", plan, maxsplit=1)
    assert "split(" not in above and "Join" not in above and "split(" in below


def test_numbering_of_variants_is_no_row_number_over_all_rows(spark):
    from conftest import SF001
    from metassoc.plans.queries import _numbered_calls
    rows = _numbered_calls(spark, SF001)
    assert "row_number" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.variant_idx, int(r.variant)) for r in rows.where("cohort = 'A'").select("variant_idx", "variant").collect())
    assert [i for i, _ in got] == list(range(len(got))) and [v for _, v in got] == sorted(v for _, v in got)


def test_cohort_log_of_few_pairs_computes_no_tile_and_sends_no_effect(spark):
    """Within the limit by its variants × phenotypes, the log is not computed to be counted; the list of genes goes to the effects,
    even where its size is unknown to the planner."""
    from pyspark.sql import functions as F

    from metassoc.plans import jobs

    def broken(batches):
        for _ in batches:
            raise ValueError("effects were computed")
        yield from ()
    names = spark.createDataFrame([("A", f"{i}") for i in range(9)] + [("B", "1")], "cohort string, name string")
    geno, phen = names.withColumnRenamed("name", "variant"), names.withColumnRenamed("name", "phenotype")
    eff = geno.join(phen, "cohort").mapInArrow(broken, "cohort string, variant string, phenotype string, beta double, "
                                                       "standard_error double, sample_size double")
    genes = phen.select("phenotype").where(F.col("phenotype") < "3")
    pairs = jobs.pairs_per_cohort(geno, phen, phenotypes=genes)
    assert {r.cohort: r.pairs for r in pairs.collect()} == {"A": 27, "B": 1}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jobs.per_cohort_effects(eff, phenotypes=genes, max_effects=27, pairs=pairs)
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(Exception, match="effects were computed"):         # above it they are counted, as before
        jobs.per_cohort_effects(eff, phenotypes=genes, max_effects=26, pairs=pairs)


def test_rounding_of_every_pair_needs_no_decimals(spark):
    from pyspark.sql import functions as F

    import __spark_entry__ as E
    from conftest import SF001
    from metassoc.functions.columns import rounded_half_up
    x = [0.0, -0.0, 1.25, -1.25, 0.1234565, -0.1234565, 4.9e-7, 5.1e-7, -5.1e-7, 1e12 + 0.5, -3e15, float("inf"), None]
    x += [random.Random(1).uniform(-3, 3) for _ in range(1000)]
    d = spark.createDataFrame([(v,) for v in x], "x double")
    assert d.where(~F.round("x", 6).eqNullSafe(rounded_half_up("x", 6))).count() == 0
    shown = E.queries()["encode_full_key"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"FLOOR|floor", shown) and re.search(r"abs\(dot#\d+\) < 1\.0E9", shown)


@pytest.mark.parametrize("case", ["pooled", "cohort", "factors", "mega", "dots"])
def test_strips_of_tiles_equal_single_tiles(spark, monkeypatch, case):
    """Tiles made from rows sent once for a strip of blocks give the rows of tiles sent one by one, bit for bit, with variants and
    phenotypes that some cohort lacks and several sample blocks; and fewer rows are sent."""
    from metassoc.operators import blocks, tiles
    r = random.Random(8)
    def rows(n, lack, name, values):
        data = [(c, f"{i}", [float(r.randint(0, 2)) + 0.1 * r.random() for _ in range(w)])
                for c, w in (("A", 11), ("B", 9), ("C", 14)) for i in range(n) if (i + len(lack)) % 5 or c not in lack]
        return spark.createDataFrame(data, f"cohort string, {name} string, {values} array<double>").cache()
    geno, phen, cov = rows(40, "B", "variant", "dosage"), rows(30, "CA", "phenotype", "values"), rows(2, "", "covariate", "values")
    size = dict(variants_per_block=4, phenotypes_per_block=3, sample_block=5)
    grids, sent = [], []
    send, made = tiles.run, tiles.grid_for
    monkeypatch.setattr(tiles, "grid_for", lambda *a, **k: grids.append(made(*a, **k)) or grids[-1])
    monkeypatch.setattr(tiles, "run", lambda d, *a: sent.append(d.count()) or send(d, *a))

    def result():
        if case == "dots":
            d = blocks.dot_products(geno.withColumnRenamed("dosage", "vec"), phen.withColumnRenamed("values", "vec"), **size)
        elif case == "mega":
            d = blocks.dense_mega(geno, phen, cov, intercepts=True, **size)
        else:
            d = blocks.dense_associate(geno, phen, cov, pooled=case == "pooled", factors=("0",) if case == "factors" else (), **size)
        return sorted(map(repr, d.collect()))
    monkeypatch.setattr(tiles, "STRIP_BYTES", 0)
    one = result()
    monkeypatch.setattr(tiles, "STRIP_BYTES", 1 << 20)
    monkeypatch.setattr(tiles, "TASKS_PER_CORE", 0.5)
    monkeypatch.setattr(tiles.math, "isqrt", lambda x: 3)
    strips = result()
    assert [g.strip for g in grids] == [1, 3] and sent[1] < sent[0] / 2
    assert one and one == strips


@pytest.mark.parametrize("name", ["dense_association", "dense_interactions", "dense_mega_intercepts", "dense_meta", "encode_full_key"])
def test_rows_of_all_pairs_are_written_by_an_entropy_coder(spark, name, tmp_path):
    """Where no codec is named, their doubles are not left to Snappy, which finds no runs in them; a codec that is named stays."""
    import pyarrow.parquet as pq

    import __spark_entry__ as E
    from conftest import SF001
    from metassoc.session import CODEC
    old = spark.conf.get(CODEC)

    def written(at):
        E.queries()[name](spark, SF001).limit(1000).write.parquet(str(tmp_path / at))
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in (tmp_path / at).glob("*.parquet")}
    try:
        spark.conf.unset(CODEC)
        assert written("unnamed") == {"ZSTD"}
        if name == "dense_meta":
            spark.conf.set(CODEC, "gzip")
            assert written("named") == {"GZIP"}
    finally:
        spark.conf.set(CODEC, old)


@pytest.mark.parametrize("case", ["cohort", "factors", "pooled", "mega"])
def test_only_wanted_columns_leave_a_task(spark, case):
    from metassoc.operators import blocks
    r = random.Random(9)
    rows = lambda n, name, values: spark.createDataFrame(
        [(c, f"{i}", [r.random() for _ in range(12)]) for c in "AB" for i in range(n)], f"cohort string, {name} string, {values} array<double>").cache()
    geno, phen, cov = rows(7, "variant", "dosage"), rows(5, "phenotype", "values"), rows(1, "covariate", "values")
    names = ("phenotype", "variant", "beta") + (("ses_interaction",) if case == "factors" else ())

    def result(**kw):
        if case == "mega":
            return blocks.dense_mega(geno, phen, cov, intercepts=True, **kw)
        return blocks.dense_associate(geno, phen, cov, pooled=case == "pooled", factors=("0",) if case == "factors" else (), **kw)
    some, every = result(columns=names), result()
    assert some.columns == list(names) and len(every.columns) > len(names)
    assert sorted(map(repr, some.collect())) == sorted(map(repr, every.select(*names).collect())) != []


@pytest.mark.parametrize("output", ["pooled", "cohort", "mega"])
def test_strips_of_shared_statistics_equal_single_tiles(spark, monkeypatch, output):
    """Partial derivatives and encoded rows sent once for a strip of blocks give the rows of tiles sent one by one, bit for bit, and
    encoded rows that have no statistics left after a filter are not sent."""
    from metassoc.operators import blocks, tiles
    from metassoc.operators.encode import encode_dense
    r = random.Random(11)
    def rows(n, lack, name, values):
        data = [(c, f"{i}", [float(r.randint(0, 2)) + 0.1 * r.random() for _ in range(w)])
                for c, w in (("A", 11), ("B", 9), ("C", 14)) for i in range(n) if (i + len(lack)) % 5 or c not in lack]
        return spark.createDataFrame(data, f"cohort string, {name} string, {values} array<double>").cache()
    geno, phen, cov = rows(40, "B", "variant", "dosage"), rows(30, "CA", "phenotype", "values"), rows(1, "", "covariate", "values")
    pd = blocks.dense_partial_derivatives(geno, phen, cov, with_b4=False)
    pd = {k: d.cache() for k, d in dict(pd, pd_test=pd["pd_test"].where("variant % 3 != 0 or cohort = 'C'")).items() if k != "p"}
    enc = {k: d.cache() for k, d in encode_dense(geno, phen, seed=3, block=4).items()}
    grids, sent = [], []
    send, made = tiles.run, tiles.grid_for
    monkeypatch.setattr(tiles, "grid_for", lambda *a, **k: grids.append(made(*a, **k)) or grids[-1])
    monkeypatch.setattr(tiles, "run", lambda d, *a: sent.append(d.groupBy("kind").count().collect()) or send(d, *a))

    def result():
        d = blocks.associate_shared(pd, enc["genotype"], enc["phenotype"], output=output, variants_per_block=4, phenotypes_per_block=3,
                                    sample_block=5, need=3 if output == "mega" else 0)
        return sorted(map(repr, d.collect()))
    monkeypatch.setattr(tiles, "STRIP_BYTES", 0)
    one = result()
    monkeypatch.setattr(tiles, "STRIP_BYTES", 1 << 20)
    monkeypatch.setattr(tiles, "TASKS_PER_CORE", 0.5)
    monkeypatch.setattr(tiles.math, "isqrt", lambda x: 3)
    strips = result()
    few, many = ({r["kind"]: r["count"] for r in s} for s in reversed(sent))
    assert [g.strip for g in grids] == [1, 3]
    assert all(few[k] < many[k] / 2 for k in (tiles.VARIANT_TERMS, tiles.PHENOTYPE_TERMS, tiles.G, tiles.Y))
    blocks_of_a_row = {"A": 3, "B": 2, "C": 3}        # sample blocks of 5
    left = {r.cohort: r["count"] for r in pd["pd_test"].groupBy("cohort").count().collect()}
    assert many[tiles.G] == sum(left[c] * blocks_of_a_row[c] for c in left) * grids[0].gblocks
    assert one and one == strips
