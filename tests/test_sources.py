import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from metassoc.sources import readers as rd
from metassoc.sources import sinks


@pytest.fixture(scope="module")
def tmp():
    return tempfile.mkdtemp(prefix="metassoc-src-")


def _w(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_master_table(spark, tmp):
    p = _w(tmp, "master.tsv", "cohort\tgenotype\texpression\tpartial_derivatives\tsnp_inclusion\tgene_inclusion\tencoded\n"
                              " c1 \t/g1\t/e1\t/pd1\t/s1\t/gi1\t1\nc2\t/g2\t/e2\t/pd2\t/s2\t/gi2\t0\n")
    df = rd.read_master_table(spark, p)
    assert [r.cohort for r in df.collect()] == ["c1", "c2"] and df.first().encoded == 1
    empty = _w(tmp, "empty.tsv", "cohort\tgenotype\texpression\tpartial_derivatives\tsnp_inclusion\tgene_inclusion\tencoded\n")
    with pytest.raises(ValueError):
        rd.read_master_table(spark, empty)


def test_matrix_tab_and_space(spark, tmp):
    a = _w(tmp, "ph_tab.txt", "id\tg1\tg2\ns1\t1.5\t2\ns2\t3\t4\n")
    b = _w(tmp, "ph_space.txt", "id g1 g2\ns1 1.5 2\ns2 3 4\n")
    for p in (a, b):
        got = {(r.sample_id, r.name): r.value for r in rd.read_matrix(spark, p).collect()}
        assert got == {("s1", "g1"): 1.5, ("s1", "g2"): 2.0, ("s2", "g1"): 3.0, ("s2", "g2"): 4.0}
    c = _w(tmp, "ph_other.txt", "id g3\ns1 1\ns3 2\n")
    rd.check_identical_ids(spark, [a, b])
    with pytest.raises(ValueError):
        rd.check_identical_ids(spark, [a, c])


def test_variant_filters_and_cov_index(spark, tmp):
    f1 = _w(tmp, "inc1.csv", "ID\nrs1\nrs2\n")
    f2 = _w(tmp, "inc2.csv", "ID\nrs3\n")
    df = rd.read_variant_filter(spark, [f1, f2], cohorts=["A", "B"])
    assert sorted((r.cohort, r.ID) for r in df.collect()) == [("A", "rs1"), ("A", "rs2"), ("B", "rs3")]
    assert "cohort" not in rd.read_variant_filter(spark, [f1]).columns
    bad = _w(tmp, "bad.csv", "X\n1\n")
    with pytest.raises(ValueError):
        rd.read_variant_filter(spark, [bad])
    ci = _w(tmp, "cov.txt", "A\t1\t2\t5\nB\t3\n")
    assert sorted((r.cohort, r.idx) for r in rd.read_covariate_index(spark, ci).collect()) == [("A", 1), ("A", 2), ("A", 5), ("B", 3)]
    with pytest.raises(ValueError):
        rd.read_covariate_index(spark, _w(tmp, "cov0.txt", "A\t0\t2\n"))


def test_reference_panel(spark, tmp):
    p = _w(tmp, "ref.txt", "ID allele1 allele2 CHR bp\nrs1 A C 1 100\nrs2 G T 2 200\n")
    r = rd.read_reference_panel(spark, p).orderBy("ref_idx").collect()
    assert [(x.ref_idx, x.ref_id, x.chr, x.bp) for x in r] == [(0, "rs1", "1", 100), (1, "rs2", "2", 200)]
    with pytest.raises(ValueError):
        rd.read_reference_panel(spark, _w(tmp, "ref_bad.txt", "ID a1 a2\nrs1 A C\n"))


def _pack_bed(calls):
    """calls: V × n matrix of codes {0,1,2,9} -> bed bytes (first sample in the low bits)."""
    code = {0: 0b00, 9: 0b01, 1: 0b10, 2: 0b11}
    out = bytearray([0x6C, 0x1B, 0x01])
    for row in calls:
        padded = list(row) + [0] * (-len(row) % 4)
        for k in range(0, len(padded), 4):
            b = 0
            for j in range(4):
                b |= code[padded[k + j]] << (2 * j)
            out.append(b)
    return bytes(out)


def test_plink(spark, tmp):
    calls = [[0, 1, 2, 9, 2], [2, 2, 0, 0, 1], [9, 0, 1, 1, 0]]
    prefix = os.path.join(tmp, "study")
    with open(prefix + ".bed", "wb") as fh:
        fh.write(_pack_bed(calls))
    _w(tmp, "study.fam", "".join(f"f{i} i{i} 0 0 1 -9\n" for i in range(5)))
    _w(tmp, "study.bim", "".join(f"1\trs{v}\t0\t{100 + v}\tA\tG\n" for v in range(3)))
    got = {r.variant_idx: r.dosage for r in rd.read_bed(spark, prefix, variants_per_task=2).collect()}
    assert got == {v: [float(c) for c in calls[v]] for v in range(3)}
    assert [r.individual for r in rd.read_fam(spark, prefix + ".fam").orderBy("sample_pos").collect()] == [f"i{i}" for i in range(5)]
    assert rd.read_bim(spark, prefix + ".bim").where("variant_idx = 2").first().ID == "rs2"


def test_vcf(spark, tmp):
    text = ("##fileformat=VCFv4.2\n##FORMAT=<ID=GT,Number=1,Type=String>\n##FORMAT=<ID=DS,Number=1,Type=Float>\n"
            "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3\n"
            "1\t100\trs1\tA\tG\t.\tPASS\t.\tGT:DS\t0/0:0.1\t0/1:1.2\t1/1:1.9\n"
            "2\t200\trs2\tC\tT\t.\tPASS\t.\tGT:DS\t./.:.\t1|0:0.8\t0|0:0\n")
    p = _w(tmp, "x.vcf", text)
    v = rd.read_vcf(spark, p)
    assert v["format"] == "DS"                       # DS is found after GT: the last key present wins
    got = {r.ID: r.dosage for r in v["genotype"].collect()}
    assert got["rs1"] == pytest.approx([1.9, 0.8, 0.1]) and got["rs2"] == pytest.approx([9.0, 1.2, 2.0])
    assert [r.sample_id for r in v["samples"].orderBy("sample_pos").collect()] == ["S1", "S2", "S3"]
    assert v["probes"].where("ID = 'rs2'").first().bp == 200
    gt_only = _w(tmp, "gt.vcf", text.replace("##FORMAT=<ID=DS,Number=1,Type=Float>\n", ""))
    g2 = {r.ID: r.dosage for r in rd.read_vcf(spark, gt_only)["genotype"].collect()}
    assert g2["rs1"] == [2.0, 1.0, 0.0] and g2["rs2"] == [9.0, 1.0, 2.0]


def test_minimac(spark, tmp):
    info = _w(tmp, "m.info", "SNP Al1 Al2 Freq1 MAF AvgCall Rsq\nrs1 A G 0.7 0.3 0.9 0.95\nrs2 C T 0.6 0.4 0.9 0.5\n")
    dose = _w(tmp, "m.dose", "F1->I1 DOSE 0.5 1.0\nF2->I2 DOSE x 2.0\n")
    i = rd.read_minimac_info(spark, info).orderBy("variant_idx").collect()
    assert [(r.variant_idx, r.ID, r.MAF, r.Rsq) for r in i] == [(0, "rs1", 0.3, 0.95), (1, "rs2", 0.4, 0.5)]
    d = {(r.sample_id, r.variant_idx): r.dosage for r in rd.read_minimac_dose(spark, dose).collect()}
    assert d == {("I1", 0): 0.5, ("I1", 1): 1.0, ("I2", 0): -1.0, ("I2", 1): 2.0}
    smp = spark.createDataFrame([("I1", 0), ("I2", 1)], "sample_id string, sample_pos long")
    dense = {r.variant_idx: r.dosage for r in rd.to_dense(rd.read_minimac_dose(spark, dose), smp).collect()}
    assert dense == {0: [0.5, -1.0], 1: [1.0, 2.0]}


def test_sinks_roundtrip(spark, tmp):
    rows = [("v1", "p1", 0.1, 0.2, None, 10.0), ("v2", "p2", 0.3, 0.4, 12.5, 20.0), ("v3", "p1", 0.5, 0.6, -3.0, 30.0)]
    df = spark.createDataFrame(rows, "variant string, phenotype string, beta double, standard_error double, i_squared double, sample_size double")
    out = os.path.join(tmp, "by_ph")
    sinks.write_by_phenotype(df, out)
    assert {d for d in os.listdir(out) if d.startswith("phenotype=")} == {"phenotype=p1", "phenotype=p2"}
    ext = sinks.read_phenotypes(spark, out, "p1")
    plan = ext._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "p1" in plan
    assert sorted(r.variant for r in ext.collect()) == ["v1", "v3"]
    m = os.path.join(tmp, "meta")
    sinks.write_meta(df, m)
    assert spark.read.parquet(m).schema == sinks.META_SCHEMA


def test_csv_sinks(spark, tmp):
    rows = [("rs1", 0.01, 2.5, "p1", 0.1, 0.3, 0.25), ("rs2", 0.5, -0.7, "p2", 0.2, 0.4, -0.14)]
    df = spark.createDataFrame(rows, "RSID string, p_value double, t_stat double, phenotype string, SE double, MAF double, BETA double")
    out = os.path.join(tmp, "summary")
    sinks.write_summary_csv(df, out)
    back = spark.read.option("sep", " ").option("header", True).csv(out)
    assert back.count() == 2 and back.columns[0] == "RSID"
    split = os.path.join(tmp, "split")
    sinks.write_split_by_phenotype_csv(df, split)
    assert {d for d in os.listdir(split) if d.startswith("phenotype=")} == {"phenotype=p1", "phenotype=p2"}


def test_qc_lists_from_files(spark, tmp):
    from metassoc.plans.jobs import qc_lists
    snp = _w(tmp, "snpqc.tsv", "cohort\tID\tMAF\tHWE\tMACH_R2\tCALL\tTYPED\tGenotype_Counts\n"
                               "A\trs1\t0.2\t0.5\t0.9\t1\t1\tAA: 50, AB: 30, BB: 20\n"
                               "A\trs2\t0.005\t0.5\t0.9\t1\t1\tAA: 99, AB: 1, BB: 0\n"
                               "A\trs3\t0.3\t1e-9\t0.9\t1\t0\tAA: 40, AB: 40, BB: 20\n"
                               "A\trs4\t0.1\t0.5\t0.9\t1\t0\tAA: 90, AB: 8, BB: 2\n")
    gene = _w(tmp, "geneqc.tsv", "cohort\tgene\tnr_values\tnr_unique_values\nA\tg1\t100\t95\nA\tg2\t100\t50\n")
    reg = _w(tmp, "reg.tsv", "cohort\tPhenotype\tP-value\nA\tExpPC10\t1e-9\nA\tExpPC2\t1e-8\nA\tExpPC3\t0.5\n")
    cast = lambda df, cols: df.select(*[df[c].cast("double").alias(c) if c in cols else df[c] for c in df.columns])
    s = cast(rd.read_qc_table(spark, snp), ["MAF", "HWE", "MACH_R2", "CALL", "TYPED"])
    g = cast(rd.read_qc_table(spark, gene), ["nr_values", "nr_unique_values"])
    r = cast(rd.read_qc_table(spark, reg), ["P-value"])
    out = qc_lists(s, g, r)
    assert sorted(x.ID for x in out["snps"].collect()) == ["rs1", "rs4"]      # rs4: MAC = 2·2 + 8 = 12 > 10
    assert [x.gene for x in out["genes"].collect()] == ["g1"]
    log = out["log"].first()
    assert (log.N, log.nr_snps, log.filtered_snps, log.typed_snps) == (100, 3, 2, 1)
    assert log.regulated_pcs == "ExpPC2, ExpPC10"
    assert out["covariate_index"].first().line.split("\t")[:3] == ["A", "1", "2"]


def test_ingest_plink_then_dense_association(spark, tmp):
    """Files -> ingest -> Parquet -> converter check -> dense association, compared with NumPy OLS."""
    from helpers import ols_full_inverse
    from metassoc.operators.blocks import dense_associate
    from metassoc.operators.checks import converter_check
    from metassoc.plans.ingest import ingest_plink, read_cohorts, write_cohort
    rng = np.random.default_rng(5)
    n, v = 9, 4
    calls = rng.integers(0, 3, size=(v, n)).tolist()
    prefix = os.path.join(tmp, "ing")
    with open(prefix + ".bed", "wb") as fh:
        fh.write(_pack_bed(calls))
    _w(tmp, "ing.fam", "".join(f"f{i} s{i} 0 0 1 -9\n" for i in range(n)))
    _w(tmp, "ing.bim", "".join(f"1\trs{k}\t0\t{100 + k}\tA\tG\n" for k in range(v)))
    out = os.path.join(tmp, "cohorts")
    write_cohort(ingest_plink(spark, prefix, "A", variants_per_task=3), out)
    t = read_cohorts(spark, out, ["A"])
    assert converter_check(t["samples"], t["probes"], t["genotype"]).first().consistent
    y = rng.normal(size=n)
    ph = spark.createDataFrame([("A", "p", y.tolist())], "cohort string, phenotype string, values array<double>")
    geno = t["genotype"].join(t["probes"], ["cohort", "variant_idx"]).select("cohort", F.col("id").alias("variant"), "dosage")
    res = {r.variant: r for r in dense_associate(geno, ph, pooled=False).collect()}
    for k in range(v):
        b, se = ols_full_inverse(np.array(calls[k], float), y, np.ones((n, 1)))
        if np.isfinite(b):
            assert res[f"rs{k}"].beta == pytest.approx(b, rel=1e-9, abs=1e-12)
            assert res[f"rs{k}"].standard_error == pytest.approx(se, rel=1e-9)


def test_ingest_vcf_and_minimac(spark, tmp):
    from metassoc.plans.ingest import ingest_minimac, ingest_vcf
    vcf = _w(tmp, "i.vcf", "##fileformat=VCFv4.2\n##FORMAT=<ID=GT>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\n"
                           "1\t100\trs1\tA\tG\t.\tPASS\t.\tGT\t0/0\t0/1\n2\t200\trs2\tC\tT\t.\tPASS\t.\tGT\t1/1\t./.\n")
    t = ingest_vcf(spark, vcf, "V")
    assert {r.variant_idx: r.dosage for r in t["genotype"].collect()} == {0: [2.0, 1.0], 1: [0.0, 9.0]}
    assert [r.sample_id for r in t["samples"].orderBy("sample_pos").collect()] == ["S1", "S2"]
    info = _w(tmp, "i.info", "SNP Al1 Al2 Freq1 MAF AvgCall Rsq\nrs1 A G 0.7 0.3 0.9 0.95\n")
    dose = _w(tmp, "i.dose", "F->B DOSE 1.5\nF->A DOSE 0.5\n")
    m = ingest_minimac(spark, info, dose, "M")
    assert m["genotype"].first().dosage == [0.5, 1.5]          # samples in id order: A, B


def test_vcf_gzip(spark, tmp):
    import gzip
    text = ("##fileformat=VCFv4.2\n##FORMAT=<ID=GT>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\n"
            "1\t100\trs1\tA\tG\t.\tPASS\t.\tGT\t0/0\t1/1\n")
    p = os.path.join(tmp, "z.vcf.gz")
    with gzip.open(p, "wt") as fh:
        fh.write(text)
    v = rd.read_vcf(spark, p)
    assert v["format"] == "GT" and v["genotype"].first().dosage == [2.0, 0.0]


def test_per_cohort_sink_schema(spark, tmp):
    rows = [("A", "v1", "p1", 0.1, 0.2, 5.0, 1.5)]
    df = spark.createDataFrame(rows, "cohort string, variant string, phenotype string, beta double, "
                                     "standard_error double, sample_size double, t_stat double")
    out = os.path.join(tmp, "per_cohort")
    sinks.write_per_cohort(df, out)
    back = spark.read.parquet(out)
    assert back.schema == sinks.PER_COHORT_SCHEMA and back.count() == 1       # extra columns dropped


def test_bed_ranges_and_errors(spark, tmp):
    from metassoc.sources import bed
    rng = np.random.default_rng(1)
    calls = rng.choice([0, 1, 2, 9], size=(50, 7)).tolist()
    prefix = os.path.join(tmp, "ranges")
    with open(prefix + ".bed", "wb") as fh:
        fh.write(_pack_bed(calls))
    read = lambda **how: {r.variant_idx: r.dosage for r in bed.read_bed_rows(spark, prefix + ".bed", 7, 50, 8, **how).collect()}
    want = {v: [float(c) for c in calls[v]] for v in range(50)}
    assert read() == want
    assert read(first=13, last=30) == {v: want[v] for v in range(13, 30)}
    for on in ("false", "true"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", on)
        some = bed.read_bed_rows(spark, prefix + ".bed", 7, 50, 8).where("variant_idx between 9 and 20")
        assert {r.variant_idx: r.dosage for r in some.collect()} == {v: want[v] for v in range(9, 21)}
        assert some.rdd.getNumPartitions() == (2 if on == "true" else 7)
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = bed.FilteringBedReader({"path": "x", "samples": "7", "variants": "50", "variants_per_partition": "8"})
    list(reader.pushFilters([bed.GreaterThanOrEqual(("variant_idx",), 20), bed.LessThan(("variant_idx",), 37)]))
    assert [(r.first, r.last) for r in reader.partitions()] == [(20, 28), (28, 36), (36, 37)]
    list(reader.pushFilters([bed.In(("variant_idx",), (21, 36))]))
    assert [(r.first, r.last) for r in reader.partitions()] == [(20, 28), (36, 37)]
    with pytest.raises(OSError):
        bed.read_bed_rows(spark, prefix + ".bed", 7, 51)
    for name, head in (("bad", b"\x00\x1b\x01"), ("rows", b"\x6c\x1b\x00")):
        with open(os.path.join(tmp, name + ".bed"), "wb") as fh:
            fh.write(head + _pack_bed(calls)[3:])
        with pytest.raises(Exception, match="BED file|rows"):
            bed.read_bed_rows(spark, os.path.join(tmp, name + ".bed"), 7, 50).collect()


def test_bed_written_and_read_back_through_a_mount(spark, tmp):
    """A path that only Spark's file systems know is resolved before Arrow opens it."""
    from metassoc.sources import bed
    rows = [("A", v, [float((v + s) % 3) for s in range(5)]) for v in range(20)] + [("B", v, [9.0, 0.0, float(v % 3)]) for v in range(3)]
    df = spark.createDataFrame(rows, "cohort string, variant_idx long, dosage array<double>").repartition(4)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.beds.link./in", f"file://{tmp}")
    conf.set("fs.viewfs.impl", "org.apache.hadoop.fs.viewfs.ViewFileSystem")
    done = {r.cohort: (r.path, r.variants) for r in bed.write_bed(df, "viewfs://beds/in/beds").collect()}
    assert {c: n for c, (_, n) in done.items()} == {"A": 20, "B": 3}
    for c, n in (("A", 5), ("B", 3)):
        got = {r.variant_idx: r.dosage for r in bed.read_bed_rows(spark, f"viewfs://beds/in/beds/{c}.bed", n, done[c][1], 7).collect()}
        assert got == {v: d for k, v, d in rows if k == c}
