"""Distribution tails and their logarithms against closed forms."""
import math

import pytest

from riskweave.functions.pvalues import chi2_log_sf, chi2_sf, corr_log_pvalue, corr_pvalue


@pytest.mark.parametrize("x", [1e-3, 0.5, 2.0, 10.0, 267.0, 3000.0, 1e5])
def test_chi2_tails(x):
    assert chi2_log_sf(x, 2) == pytest.approx(-x / 2, rel=1e-12)
    assert chi2_log_sf(x, 4) == pytest.approx(-x / 2 + math.log1p(x / 2), rel=1e-9, abs=1e-13)
    # one degree of freedom: erfc, as far as a double holds it
    if x < 1400:
        assert chi2_sf(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)


def test_far_tails_keep_their_logarithm():
    assert chi2_sf(3000.0, 2) == 0.0 and chi2_log_sf(3000.0, 2) / math.log(10) == pytest.approx(-651.4417228548778)
    # 3.75e-58, the smallest p of the published tables, and beyond
    assert chi2_log_sf(-2 * math.log(3.75e-58), 2) / math.log(10) == pytest.approx(math.log10(3.75e-58), rel=1e-12)
    assert corr_log_pvalue(0.5, 100_000) / math.log(10) < -6000 and corr_pvalue(0.5, 100_000) == 0.0


@pytest.mark.parametrize("r", [-0.999999, -0.5, -1e-6, 0.1, 0.9, 0.99999])
def test_correlation_tails(r):
    a = abs(r)
    assert corr_pvalue(r, 4) == pytest.approx(1 - a, rel=1e-9)
    assert corr_log_pvalue(r, 6) == pytest.approx(math.log((1 - a) ** 2 * (2 + a) / 2), rel=1e-8, abs=1e-9)
    assert corr_pvalue(r, 3) == pytest.approx(1 - 2 / math.pi * math.asin(a), rel=1e-8)


def test_edges():
    assert chi2_sf(5.0, 0) == 1.0 and chi2_sf(0.0, 3) == 1.0 and chi2_log_sf(None, 3) == 0.0
    assert math.isnan(corr_pvalue(None, 10)) and math.isnan(corr_pvalue(0.5, 2)) and math.isnan(corr_pvalue(float("nan"), 9))
    assert corr_log_pvalue(1.0, 10) == -math.inf and corr_pvalue(-1.0, 10) == 0.0 and corr_pvalue(0.0, 10) == 1.0
