"""Hand-made fixtures and NumPy reference implementations (independent of the Spark code)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd


def ols_full_inverse(g, y, X):
    """β, SE of the last column of [X̃, g] by explicit (XᵀX)⁻¹ (X̃ includes the intercept)."""
    D = np.column_stack([X, g])
    A = D.T @ D
    if abs(np.linalg.det(A)) < 1e-10:
        return np.nan, np.nan
    Ai = np.linalg.inv(A)
    coef = Ai @ D.T @ y
    rss = float(((y - D @ coef) ** 2).sum())
    df = len(y) - D.shape[1]
    return coef[-1], np.sqrt(rss / df * Ai[-1, -1])


def ivw(betas, ses):
    b, s = np.asarray(betas, float), np.asarray(ses, float)
    w = 1 / s ** 2
    beta = (w * b).sum() / w.sum()
    q = (w * (b - beta) ** 2).sum()
    k = len(b)
    i2 = np.nan if k < 2 or q == 0 else (q - (k - 1)) / q * 100
    return beta, np.sqrt(1 / w.sum()), i2


def small_cohorts(seed: int = 7):
    """2 cohorts × 4 variants × 3 phenotypes × 6 samples, with the edge cases of FIXTURES.md §C:
    v3 absent in cohort B, v2 constant (singular), p2 absent in cohort A, equal sample ids."""
    rng = np.random.default_rng(seed)
    rows_s, rows_g, rows_p = [], [], []
    for c in ["A", "B"]:
        n = 6
        x = rng.normal(size=n)
        for i in range(n):
            rows_s.append((c, i, [float(x[i])]))
        for v in ["v0", "v1", "v2", "v3"]:
            if c == "B" and v == "v3":
                continue
            g = np.full(n, 1.0) if v == "v2" else rng.integers(0, 3, size=n).astype(float)
            for i in range(n):
                rows_g.append((c, i, v, float(g[i])))
        for p in ["p0", "p1", "p2"]:
            if c == "A" and p == "p2":
                continue
            y = rng.normal(size=n) + 0.3 * x
            for i in range(n):
                rows_p.append((c, i, p, float(y[i])))
    s = pd.DataFrame(rows_s, columns=["cohort", "sample_id", "x"])
    g = pd.DataFrame(rows_g, columns=["cohort", "sample_id", "variant", "dosage"])
    p = pd.DataFrame(rows_p, columns=["cohort", "sample_id", "phenotype", "y"])
    return s, g, p


def numpy_effects(s, g, p):
    out = {}
    for c in s.cohort.unique():
        sc = s[s.cohort == c].sort_values("sample_id")
        X = np.column_stack([np.ones(len(sc)), np.vstack(sc.x.to_numpy())])
        for v in g[g.cohort == c].variant.unique():
            gv = g[(g.cohort == c) & (g.variant == v)].set_index("sample_id").dosage.reindex(sc.sample_id, fill_value=0).to_numpy()
            for ph in p[p.cohort == c].phenotype.unique():
                yv = p[(p.cohort == c) & (p.phenotype == ph)].set_index("sample_id").y.reindex(sc.sample_id, fill_value=0).to_numpy()
                b, se = ols_full_inverse(gv, yv, X)
                if np.isfinite(b):
                    out[(c, v, ph)] = (b, se)
    return out


# ---------------------------------------------------------------- p-values in NumPy, the yardstick of the column expressions

def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of x >= 0, with full relative precision also far out.

    Below 2: one minus exp(-x^2) times a series of positive terms; from 2 on Laplace's continued fraction."""
    x = np.asarray(x, float)
    out = np.full(x.shape, np.nan)
    near, far = x < 2.0, x >= 2.0
    if near.any():
        v = x[near]
        term = total = v.copy()
        for n in range(1, 60):
            term = term * (2.0 * v * v / (2 * n + 1))
            total = total + term
        out[near] = 1.0 - 2.0 / math.sqrt(math.pi) * np.exp(-v * v) * total
    if far.any():
        v = x[far]
        tail = v.copy()
        for n in range(120, 0, -1):
            tail = v + (n / 2.0) / tail
        out[far] = np.exp(-v * v) / (math.sqrt(math.pi) * tail)
    return out


def normal_sf2(t: np.ndarray) -> np.ndarray:
    """2·P(Z > |t|) = erfc(|t|/√2)."""
    return erfc(np.abs(np.asarray(t, dtype=float)) / math.sqrt(2.0))


def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 600) -> np.ndarray:
    """1 / (1 + d1 / (1 + d2 / (1 + ...))), the continued fraction of the incomplete beta function:

        d(2m) = m (b - m) x / ((a + 2m - 1)(a + 2m)),   d(2m + 1) = -(a + m)(a + b + m) x / ((a + 2m)(a + 2m + 1)).

    Numerators and denominators of the convergents are carried along as ratios of neighbours."""
    def guard(v):
        return np.where(np.abs(v) < 1e-300, 1e-300, v)
    value = up = np.ones_like(x)
    down = np.zeros_like(x)
    for k in range(1, steps):
        m = k // 2
        d = m * (b - m) * x / ((a + k - 1) * (a + k)) if k % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + k - 1) * (a + k))
        down = 1.0 / guard(1.0 + d * down)
        up = guard(1.0 + d / up)
        value = value * up * down
        if np.all(np.abs(up * down - 1.0) < 4e-16):
            break
    return 1.0 / value


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log B(a, b); the parameters take few different values (degrees of freedom), each computed once."""
    pairs, at = np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)
    return np.array([math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q) for p, q in pairs.tolist()])[at.ravel()]


def betainc_reg(a, b, x):
    """Regularised incomplete beta I_x(a, b) for arrays."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    ok = (x >= 0) & (x <= 1) & (a > 0) & (b > 0)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        p, q, v = a[mid], b[mid], x[mid]
        high = v >= (p + 1.0) / (p + q + 2.0)          # the fraction converges fast below the mean
        scale = np.exp(p * np.log(v) + q * np.log1p(-v) - _log_beta(p, q))
        low_p, low_q, low_v = np.where(high, q, p), np.where(high, p, q), np.where(high, 1.0 - v, v)
        part = scale * _fraction(low_p, low_q, low_v) / low_p
        out[mid] = np.where(high, 1.0 - part, part)
    return out


def student_sf2(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """2·P(T_df > |t|) = I_{df/(df+t²)}(df/2, 1/2)."""
    t = np.asarray(t, float)
    df = np.asarray(df, float)
    x = df / (df + t * t)
    out = betainc_reg(df / 2.0, 0.5, x)
    out[np.isnan(t) | np.isnan(df) | (df <= 0)] = np.nan
    return out
