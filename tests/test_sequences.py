"""Segmented sequence scan equals the unsegmented one for any segment width."""
import pytest

from conftest import SF001, make_tx
from riskweave.operators.sequences import user_sequences
from riskweave.sources.fixtures import load_fixture


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("seg_us", [1_000_000, 600_000_000, 86_400_000_000])
def test_segment_width_invariance(spark, seg_us):
    fx = load_fixture(spark, SF001)
    cols = ["id_user", "status_changes", "fails_before_first_success", "first_tx_failed", "max_consecutive_fails",
            "min_time_between_tx", "avg_time_between_tx", "std_time_between_tx", "unique_cards_first_5",
            "is_cvv_error"]
    ref = user_sequences(fx.transactions, segment_us=10**16).select(*cols)   # one segment per user
    got = user_sequences(fx.transactions, segment_us=seg_us).select(*cols)
    assert _rows(ref) == _rows(got)


def test_first_cards_and_last_errors_across_segments(spark):
    # ten rows ten minutes apart, in two clock hours: the first five rows and the last ten of a user span segments
    cards = ["a", None, "b", "a", "c", "d", "e", "f", "g", "h"]
    rows = [{"id_user": 1, "card_mask_hash": c} for c in cards]
    rows += [{"id_user": 2, "card_mask_hash": "z", "error_group": "cvv error" if k == 0 else None} for k in range(11)]
    rows += [{"id_user": 3, "card_mask_hash": None, "error_group": "cvv error"}]
    for width in (1_000_000, 3_600_000_000, 10**16):
        got = {r["id_user"]: (r["unique_cards_first_5"], r["is_cvv_error"])
               for r in user_sequences(make_tx(spark, rows), segment_us=width).collect()}
        assert got == {1: (3, 0), 2: (1, 0), 3: (0, 1)}, width


def test_plan_has_no_growing_frames_or_hashed_lists(spark):
    """A frame up to the partition's last row is added up anew for each row; lists make Spark hash and sort sorted rows again."""
    plan = user_sequences(make_tx(spark, [{}]))._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing$()), 1" not in plan and "1, unboundedfollowing" not in plan.lower()
    assert "ObjectHashAggregate" not in plan
