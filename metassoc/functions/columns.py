"""Column-level helpers.  Everything here is a native Catalyst expression (codegen'd, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the genotype formats.
MISSING_DOSAGE = 9.0          # missing hard call / unreadable dosage
REMOVED_PREFIX = "remove_"    # marker so a removed sample id never matches again


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num/den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col_(num), col_(den))


def array_dot(a, b) -> Column:
    """Σ a[i]*b[i] over two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def array_sum(a) -> Column:
    return F.aggregate(col_(a), F.lit(0.0), lambda acc, v: acc + v)


def mat_vec(m, v) -> Column:
    """Matrix (array<array<double>>, row-major) times vector."""
    return F.transform(col_(m), lambda row: array_dot(row, col_(v)))


def quad_form(m, v) -> Column:
    """vᵀ M v."""
    return array_dot(col_(v), mat_vec(m, v))


def _dot_sql(a: str, b: str, p: int) -> str:
    return " + ".join(f"`{a}`[{i}] * `{b}`[{i}]" for i in range(p))


def dot_n(a, b, p: int) -> Column:
    """Σ_{i<p} a[i]*b[i] unrolled for a length p known when the plan is built (codegen-friendly).
    With column names the expression is parsed once on the JVM side (one call, any p)."""
    if isinstance(a, str) and isinstance(b, str):
        return F.expr(_dot_sql(a, b, p))
    a, b = col_(a), col_(b)
    out = a[0] * b[0]
    for i in range(1, p):
        out = out + a[i] * b[i]
    return out


def mat_vec_n(m, v, p: int) -> Column:
    """M·v unrolled for a p×p matrix."""
    if isinstance(m, str) and isinstance(v, str):
        rows = ", ".join(" + ".join(f"`{m}`[{i}][{j}] * `{v}`[{j}]" for j in range(p)) for i in range(p))
        return F.expr(f"array({rows})")
    m, v = col_(m), col_(v)
    return F.array(*[dot_n(m[i], v, p) for i in range(p)])


def quad_form_n(m, v, p: int) -> Column:
    """vᵀMv unrolled."""
    if isinstance(m, str) and isinstance(v, str):
        return F.expr(" + ".join(f"`{v}`[{i}] * `{m}`[{i}][{j}] * `{v}`[{j}]" for i in range(p) for j in range(p)))
    m, v = col_(m), col_(v)
    out = None
    for i in range(p):
        for j in range(p):
            t = v[i] * m[i][j] * v[j]
            out = t if out is None else out + t
    return out


def flip_dosage(dosage, flip) -> Column:
    """Allele flip on a dense dosage array: x -> 2 - x where flip == -1 (missing code kept)."""
    d, f = col_(dosage), col_(flip)
    return F.when(f == -1, F.transform(d, lambda x: F.when(x == MISSING_DOSAGE, x).otherwise(2.0 - x))).otherwise(d)


def flip_value(dosage, flip) -> Column:
    """Allele flip of one scalar dosage.  Only valid when every sample has a row (dense long form):
    sparse long data leaves out zeros, which a flip would turn into 2 — flip its statistics or its
    effects instead (``moments.flip_moments``, ``regression.flip_effects``)."""
    d, f = col_(dosage), col_(flip)
    return F.when((f == -1) & (d != MISSING_DOSAGE), 2.0 - d).otherwise(d)


def is_missing(x) -> Column:
    x = col_(x)
    return x.isNull() | F.isnan(x) | (x == MISSING_DOSAGE) | (x < 0)


def impute_mean_array(dosage) -> Column:
    """Replace missing entries (9, NaN, <0) of a dense dosage array by the mean of the observed ones."""
    d = col_(dosage)
    ok = F.filter(d, lambda x: ~is_missing(x))
    mean = safe_div(array_sum(ok), F.size(ok))
    return F.transform(d, lambda x: F.when(is_missing(x), mean).otherwise(x))


def maf_from_array(dosage) -> Column:
    """Allele frequency mean(g)/2 over observed entries (not folded)."""
    d = col_(dosage)
    ok = F.filter(d, lambda x: ~is_missing(x))
    return safe_div(array_sum(ok), 2.0 * F.size(ok))


def call_to_dosage(call, fmt) -> Column:
    """VCF FORMAT value -> dosage of the second allele coded as 2 - alt count.

    GT "a/b" or "a|b": 2 - (min(a,1) + min(b,1)); a haploid "a": 2 - min(a,1); DS/EC: 2 - x; null, '.' or
    unparsable -> 9.
    """
    c, f = col_(call), col_(fmt)
    alleles = F.split(F.regexp_replace(c, r"\|", "/"), "/")
    a = F.get(alleles, 0).try_cast("int")
    b = F.get(alleles, 1).try_cast("int")
    second = F.when(F.size(alleles) == 1, F.lit(0)).otherwise(F.least(b, F.lit(1)))
    gt = F.when(a.isNull() | second.isNull(), F.lit(MISSING_DOSAGE)).otherwise(
        2.0 - (F.least(a, F.lit(1)) + second).cast("double"))
    num = c.try_cast("double")
    ds = F.when(num.isNull(), F.lit(MISSING_DOSAGE)).otherwise(2.0 - num)
    return F.when(f == "GT", gt).otherwise(ds)


def parse_genotype_counts(text):
    """'AA: 10, AB: 5, BB: 2' -> (hom1, het, hom2) as doubles."""
    t = col_(text)
    hom1 = F.regexp_extract(t, r"^\s*[^:,]*:\s*([0-9.]+)", 1).cast("double")
    het = F.regexp_extract(t, r"^[^,]*,\s*[^:,]*:\s*([0-9.]+)", 1).cast("double")
    hom2 = F.regexp_extract(t, r":\s*([0-9.]+)\s*$", 1).cast("double")
    return hom1, het, hom2


def chromosome(c) -> Column:
    """Chromosome name as text without a 'chr' prefix, upper case (1..22, X, Y, MT and others)."""
    return F.upper(F.regexp_replace(F.trim(col_(c).cast("string")), "^(?i:chr)", ""))


def chr_bp_from_id(vid):
    """'chr:bp[:...]' -> (chr string, bp long); NULL when not of that form or chr not in 1..22, X, Y, MT."""
    parts = F.split(col_(vid), ":")
    chrom = chromosome(F.get(parts, F.lit(0)))
    bp = F.get(parts, F.lit(1)).try_cast("long")
    known = chrom.rlike("^([1-9]|1[0-9]|2[0-2]|X|Y|MT)$")
    ok = (F.size(parts) >= 2) & known & bp.isNotNull()
    return F.when(ok, chrom), F.when(ok, bp)


def mark_removed(sample_id, removed) -> Column:
    """Prefix an id so it can no longer match (used for excluded subjects)."""
    return F.when(col_(removed), F.concat(F.lit(REMOVED_PREFIX), col_(sample_id))).otherwise(col_(sample_id))


def strip_study_prefix(name, study) -> Column:
    """Covariate name = text after '<study>_'."""
    n, s = col_(name), col_(study)
    return F.when(F.startswith(n, F.concat(s, F.lit("_"))),
                  F.substring(n, F.length(s) + 2, F.length(n))).otherwise(n)


def natural_sort_key(name):
    """(prefix, integer suffix) for natural ordering like PC1, PC2, ..., PC10."""
    c = col_(name)
    return F.regexp_extract(c, r"^(.*?)(\d*)$", 1), F.regexp_extract(c, r"(\d+)$", 1).try_cast("long")


def rounded_half_up(c, digits: int):
    """A double to ``digits`` decimals, halves away from zero, by plain arithmetic: ``F.round`` makes a decimal of every value, about a
    microsecond each.  Values from 1e9 on (and NaN) are left to it, as their products would not fit."""
    c, scale = (F.col(c) if isinstance(c, str) else c), float(10 ** digits)
    return F.when(F.abs(c) < 1e9, F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale).otherwise(F.round(c, digits))
