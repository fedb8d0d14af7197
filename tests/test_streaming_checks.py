import os
import tempfile

import pytest

from metassoc.operators import checks


def test_shard_stream_layout(spark):
    from metassoc.streaming.result_shards import layout_by_phenotype
    base = tempfile.mkdtemp(prefix="metassoc-stream-")
    shards, out, ck = (os.path.join(base, d) for d in ("shards", "out", "ck"))
    cols = "variant string, phenotype string, beta double, standard_error double, i_squared double, sample_size double"
    spark.createDataFrame([("v1", "p1", 0.1, 0.2, None, 5.0), ("v2", "p2", 0.3, 0.1, 1.0, 6.0)], cols) \
        .write.mode("append").parquet(shards)
    layout_by_phenotype(spark, shards, out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([("v3", "p1", 0.5, 0.3, 2.0, 7.0)], cols).write.mode("append").parquet(shards)
    layout_by_phenotype(spark, shards, out, checkpoint=ck)     # only the new shard is added
    df = spark.read.parquet(out)
    assert df.count() == 3 and sorted(r.variant for r in df.where("phenotype = 'p1'").collect()) == ["v1", "v3"]


def test_checks(spark):
    s = spark.createDataFrame([("A", "s1"), ("A", "s2"), ("B", "s1")], "cohort string, sample_id string")
    checks.assert_unique(s, ["cohort", "sample_id"])
    with pytest.raises(ValueError):
        checks.assert_unique(s, ["sample_id"])
    probes = spark.createDataFrame([("A", "rs1"), ("B", "rs1")], "cohort string, id string")
    geno = spark.createDataFrame([("A", "rs1", [0.0, 1.0]), ("B", "rs1", [2.0, 2.0])], "cohort string, id string, dosage array<double>")
    r = {x.cohort: x.consistent for x in checks.converter_check(s, probes, geno).collect()}
    assert r == {"A": True, "B": False}


def test_package_is_shipped_to_python_workers(spark):
    """UDF stages must import metassoc on executors whatever the driver's working directory."""
    import zipfile

    from pyspark import SparkFiles
    inc = [f for f in spark.sparkContext._python_includes if f.startswith("metassoc-")]
    assert inc
    names = zipfile.ZipFile(SparkFiles.get(inc[0])).namelist()
    assert "metassoc/__init__.py" in names and "metassoc/operators/blocks.py" in names
