"""DuckDB SQL for the fixture views and the closed-form (p = 2) statistics.

Used only as the independent oracle in the correctness check; the Spark side never runs it.
"""

from __future__ import annotations


def R(expr: str) -> str:
    """Comparison form of a double, as ``catalog.snap``: 24 significant bits, -0.0 -> 0.0."""
    x = f"CAST({expr} AS DOUBLE)"
    big = f"({x} * CAST(536870913 AS DOUBLE))"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) > 1e290 THEN {x} "
            f"ELSE {big} - ({big} - {x}) END + 0.0)")


S = R


def samples_cte(level: str = "region", name: str = "samples", where: str = "TRUE") -> str:
    cohort = "r.r_name" if level == "region" else "n.n_name"
    return f"""{name} AS (
  SELECT {cohort} AS cohort, c.c_custkey AS sample_id, c.c_acctbal / 1000.0 AS x
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey WHERE {where})"""


def calls_cte(n_variants: int | None = 20) -> str:
    vkey = "l.l_partkey" if n_variants is None else f"l.l_partkey % {n_variants}"
    return f"""calls AS (
  SELECT o.o_custkey AS sample_id, {vkey} AS vkey, count(*) AS cnt,
         bool_and(l.l_returnflag = 'R') AS all_returned
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""


def geno_cte(with_missing: bool = False) -> str:
    dos = "CAST(least(2, c.cnt) AS DOUBLE)"
    if with_missing:
        dos = f"CASE WHEN c.all_returned THEN 9.0 ELSE {dos} END"
    return f"""geno AS (
  SELECT s.cohort, s.sample_id, s.x, 'v' || CAST(c.vkey AS VARCHAR) AS variant, {dos} AS g
  FROM calls c JOIN samples s ON c.sample_id = s.sample_id)"""


PHENO_CTE = """pheno AS (
  SELECT s.cohort, s.sample_id, s.x, o.o_orderpriority AS phenotype, sum(o.o_totalprice) / 1e5 AS y
  FROM orders o JOIN samples s ON o.o_custkey = s.sample_id
  GROUP BY s.cohort, s.sample_id, s.x, o.o_orderpriority)"""

MOMENTS_CTES = """cm AS (SELECT cohort, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx FROM samples GROUP BY cohort),
vm AS (SELECT cohort, variant, sum(g) AS sg, sum(g * g) AS sgg, sum(g * x) AS sgx FROM geno GROUP BY cohort, variant),
pm AS (SELECT cohort, phenotype, sum(y) AS sy, sum(y * y) AS syy, sum(x * y) AS sxy FROM pheno GROUP BY cohort, phenotype),
gy AS (SELECT g.cohort, g.variant, p.phenotype, sum(g.g * p.y) AS sgy
       FROM geno g JOIN pheno p ON g.cohort = p.cohort AND g.sample_id = p.sample_id
       GROUP BY g.cohort, g.variant, p.phenotype)"""

# Closed form for p = 2: M = [[sxx, -sx], [-sx, n]] / det, u = M·[sg, sgx], s = sgg - u·[sg, sgx].
def effect_ctes(cm: str = "cm", vm: str = "vm", pm: str = "pm", gy: str = "gy", tol: str = "1e-12") -> str:
    return f"""cmi AS (SELECT *, n * sxx - sx * sx AS det FROM {cm}),
vt0 AS (SELECT vm.cohort, vm.variant, cmi.n, vm.sg / (2.0 * cmi.n) AS maf, vm.sg, vm.sgx, vm.sgg,
               (cmi.sxx * vm.sg - cmi.sx * vm.sgx) / cmi.det AS u0,
               (cmi.n * vm.sgx - cmi.sx * vm.sg) / cmi.det AS u1
        FROM {vm} vm JOIN cmi ON vm.cohort = cmi.cohort WHERE cmi.det <> 0),
vt AS (SELECT *, sgg - (u0 * sg + u1 * sgx) AS s FROM vt0),
pt AS (SELECT pm.cohort, pm.phenotype, pm.sy, pm.sxy,
              pm.syy - (cmi.sxx * pm.sy * pm.sy - 2 * cmi.sx * pm.sy * pm.sxy + cmi.n * pm.sxy * pm.sxy) / cmi.det AS rss0
       FROM {pm} pm JOIN cmi ON pm.cohort = cmi.cohort WHERE cmi.det <> 0),
eff0 AS (SELECT vt.cohort, vt.variant, pt.phenotype, vt.n, vt.maf, vt.s, pt.rss0,
                (coalesce(gy.sgy, 0.0) - (vt.u0 * pt.sy + vt.u1 * pt.sxy)) / vt.s AS beta
         FROM vt JOIN pt ON vt.cohort = pt.cohort
         LEFT JOIN {gy} gy ON gy.cohort = vt.cohort AND gy.variant = vt.variant AND gy.phenotype = pt.phenotype
         WHERE vt.s > {tol} * vt.sgg AND vt.n - 3 > 0),
eff AS (SELECT *, sqrt(abs(rss0 - beta * beta * s) / (s * (n - 3))) AS se, n - 3 AS df FROM eff0)"""


EFFECT_CTES = effect_ctes()

META_CTES = """ctb AS (SELECT *, 1.0 / (se * se) AS w FROM eff WHERE se > 0 AND beta IS NOT NULL AND NOT isnan(beta)),
m1 AS (SELECT variant, phenotype, sum(w * beta) / sum(w) AS beta, sqrt(1.0 / sum(w)) AS standard_error,
              sum(CAST(n AS DOUBLE)) AS sample_size, count(*) AS k
       FROM ctb GROUP BY variant, phenotype),
mq AS (SELECT ctb.variant, ctb.phenotype, sum(ctb.w * (ctb.beta - m1.beta) * (ctb.beta - m1.beta)) AS q
       FROM ctb JOIN m1 ON ctb.variant = m1.variant AND ctb.phenotype = m1.phenotype
       GROUP BY ctb.variant, ctb.phenotype),
meta AS (SELECT m1.*, mq.q, CASE WHEN m1.k < 2 OR mq.q = 0 THEN NULL ELSE (mq.q - (m1.k - 1)) / mq.q * 100 END AS i_squared
         FROM m1 JOIN mq ON m1.variant = mq.variant AND m1.phenotype = mq.phenotype)"""


def fixture_ctes(level: str = "region", n_variants: int | None = 20, with_missing: bool = False, where: str = "TRUE") -> str:
    return ",\n".join([samples_cte(level, where=where), calls_cte(n_variants), geno_cte(with_missing), PHENO_CTE])


# Embeddings as dense rows: label < 5 -> variants, others -> phenotypes; vector positions = samples.
def embed_ctes(split: bool = False) -> str:
    if not split:
        src = """SELECT 'all' AS cohort, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"""
    else:
        src = """SELECT 'A' AS cohort, vec_id, label, list_slice(CAST(embedding AS DOUBLE[]), 1, 32) AS v FROM embeddings
        UNION ALL
        SELECT 'B' AS cohort, vec_id, label, list_slice(CAST(embedding AS DOUBLE[]), 33, 64) AS v FROM embeddings"""
    return f"""ev AS ({src}),
eg AS (SELECT cohort, CAST(vec_id AS VARCHAR) AS variant, v AS g, len(v) AS n, list_sum(v) AS sg,
              list_dot_product(v, v) AS sgg FROM ev WHERE label < 5),
ep AS (SELECT cohort, CAST(vec_id AS VARCHAR) AS phenotype, v AS y, list_sum(v) AS sy,
              list_dot_product(v, v) AS syy FROM ev WHERE label >= 5),
eff0 AS (SELECT eg.cohort, eg.variant, ep.phenotype, eg.n, eg.sgg - eg.sg * eg.sg / eg.n AS s,
                ep.syy - ep.sy * ep.sy / eg.n AS rss0, eg.sgg,
                (list_dot_product(eg.g, ep.y) - eg.sg * ep.sy / eg.n) / (eg.sgg - eg.sg * eg.sg / eg.n) AS beta
         FROM eg JOIN ep ON eg.cohort = ep.cohort
         WHERE eg.sgg - eg.sg * eg.sg / eg.n > 1e-12 * eg.sgg),
eff AS (SELECT *, sqrt(abs(rss0 - beta * beta * s) / (s * (n - 2))) AS se FROM eff0)"""


def call_ctes(variants: str = "TRUE", phenotypes: str = "TRUE", maf: float = 0.0, cohorts: int = 0) -> str:
    """The dense fixture as calls: eg (g imputed, maf of the observed calls) and ep, cut to rows that meet the conditions and,
    with ``cohorts``, to names that so many cohorts have left."""
    window = f"maf >= {maf} AND maf <= 1 - {maf} AND maf <> 0.5" if maf else "TRUE"
    def common(key, table):
        return f"{key} IN (SELECT {key} FROM {table} GROUP BY {key} HAVING count(DISTINCT cohort) >= {cohorts})"
    return f"""ev AS (SELECT 'A' AS cohort, vec_id, label, list_slice(CAST(embedding AS DOUBLE[]), 1, 32) AS v FROM embeddings
  UNION ALL SELECT 'B' AS cohort, vec_id, label, list_slice(CAST(embedding AS DOUBLE[]), 33, 64) AS v FROM embeddings),
ec AS (SELECT cohort, vec_id, list_transform(v, lambda x: CASE WHEN abs(x) < 0.01 THEN 9.0 WHEN x < -0.08 THEN 0.0
              WHEN x > 0.08 THEN 2.0 ELSE 1.0 END) AS c FROM ev WHERE label < 5),
eo AS (SELECT *, list_filter(c, lambda x: x <> 9.0) AS o FROM ec),
em AS (SELECT *, CAST(list_sum(o) AS DOUBLE) / len(o) AS mean FROM eo),
eg0 AS (SELECT cohort, vec_id, CAST(vec_id AS VARCHAR) AS variant, mean / 2 AS maf, len(c) AS n,
               list_transform(c, lambda x: CAST(CASE WHEN x = 9.0 THEN mean ELSE x END AS DOUBLE)) AS g FROM em WHERE len(o) > 0),
eg1 AS (SELECT * FROM eg0 WHERE ({variants}) AND {window}),
ep1 AS (SELECT cohort, vec_id, CAST(vec_id AS VARCHAR) AS phenotype, v AS y FROM ev WHERE label >= 5 AND ({phenotypes})),
eg AS (SELECT * FROM eg1 WHERE {common('variant', 'eg1')}),
ep AS (SELECT * FROM ep1 WHERE {common('phenotype', 'ep1')})"""


def call_covariate(expression: str) -> str:
    """A covariate of the dense fixture as a list over the sample positions s."""
    return f"list_transform(range(0, 32), lambda s: CAST({expression} AS DOUBLE))"


def call_moments(covariate: str) -> str:
    """Moments of eg and ep with one covariate, whose list over samples is the SQL ``covariate`` of (cohort)."""
    return f"""ex AS (SELECT cohort, {covariate} AS x FROM (SELECT DISTINCT cohort FROM ev)),
cm AS (SELECT cohort, len(x) AS n, list_sum(x) AS sx, list_dot_product(x, x) AS sxx FROM ex),
vm AS (SELECT eg.cohort, variant, list_sum(g) AS sg, list_dot_product(g, g) AS sgg, list_dot_product(g, x) AS sgx
       FROM eg JOIN ex ON eg.cohort = ex.cohort),
pm AS (SELECT ep.cohort, phenotype, list_sum(y) AS sy, list_dot_product(y, y) AS syy, list_dot_product(x, y) AS sxy
       FROM ep JOIN ex ON ep.cohort = ex.cohort),
gy AS (SELECT eg.cohort, variant, phenotype, list_dot_product(g, y) AS sgy FROM eg JOIN ep ON eg.cohort = ep.cohort)"""


def p_student_sql(t: str, df: str, source: str, keep: str) -> str:
    """SELECT of ``keep`` and p_value, two-sided Student t of the column ``t`` with ``df`` degrees of freedom: the incomplete beta function by
    its continued fraction and lgamma."""
    steps = "list_transform(range(150, 0, -1), lambda k: CAST(k AS DOUBLE))"
    term = """1 + CASE WHEN k % 2 = 0 THEN (k / 2) * (q - k / 2) * v / ((p + k - 1) * (p + k))
              ELSE -(p + (k - 1) / 2) * (p + q + (k - 1) / 2) * v / ((p + k - 1) * (p + k)) END / f"""
    return f"""SELECT {keep}, CASE WHEN t = 0 THEN 1.0 WHEN mid THEN 1 - part ELSE part END AS p_value FROM (
  SELECT *, exp(-a * ln(1 + t * t / d) + ln(y) / 2 + lgamma(a + 0.5) - lgamma(a) - lgamma(0.5)) / p
            * list_reduce({steps}, lambda f, k: {term}, CAST(1.0 AS DOUBLE)) ** -1 AS part FROM (
    SELECT *, CASE WHEN mid THEN 0.5 ELSE a END AS p, CASE WHEN mid THEN a ELSE 0.5 END AS q, CASE WHEN mid THEN y ELSE x END AS v FROM (
      SELECT *, x > (a + 1) / (a + 2.5) AS mid FROM (
        SELECT *, d / 2 AS a, d / (d + t * t) AS x, t * t / (d + t * t) AS y FROM (
          SELECT *, CAST({t} AS DOUBLE) AS t, CAST({df} AS DOUBLE) AS d FROM {source})))))"""


def p_normal_sql(t: str) -> str:
    """Two-sided normal p: a series near zero, the continued fraction of erfc beyond."""
    v = f"(abs({t}) / sqrt(2.0))"
    near = f"""1 - 2 / sqrt(pi()) * exp(-{v} * {v}) * {v} * list_reduce(list_transform(range(60, 0, -1), lambda k: CAST(k AS DOUBLE)),
      lambda s, k: 1 + s * 2 * {v} * {v} / (2 * k + 1), CAST(1.0 AS DOUBLE))"""
    far = f"""exp(-{v} * {v}) / (sqrt(pi()) * list_reduce(list_transform(range(120, 0, -1), lambda k: CAST(k AS DOUBLE)),
      lambda s, k: {v} + k / 2 / s, CAST({v} AS DOUBLE)))"""
    return f"CASE WHEN {v} < 2 THEN {near} ELSE {far} END"


def with_all(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


META_SELECT = f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('standard_error')} AS standard_error,
       {S('i_squared')} AS i_squared, {R('sample_size')} AS sample_size FROM meta"""
