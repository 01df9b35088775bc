"""Ordered queries with every key treated as hot: results must not change."""

import pytest

from casework import plans
from casework.functions import ordered
from tests.conftest import SF
from tools.check import compare, connect

ORDERED = """p16_reference_no w3_history w4_transcript w5_turn_context w6_clarify_limit w8_first_ack r16_owner_as_of c3_chunk_by_key
a7_latency_stats a21_profile m1_label_encode m3_impute m22_roc_points""".split()


@pytest.mark.parametrize("name", ORDERED)
def test_same_rows_with_cuts(spark, monkeypatch, name):
    cuts = []
    found = ordered.cut_points

    def few_segments(df, keys, order, segments, samples):
        out = found(df, keys, order, 16, 1)
        cuts.append(out[0])
        return out

    monkeypatch.setattr(ordered, "SPLIT_BYTES", 0)
    monkeypatch.setattr(ordered, "SPLIT_BYTES_WITHOUT_KEY", 0)
    monkeypatch.setattr(ordered, "cut_points", few_segments)
    _, problems = compare(plans.queries()[name](spark, SF), connect(SF), plans.oracle_sql()[name])
    assert not problems and cuts
