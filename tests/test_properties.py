"""Property-based checks (hypothesis): each example is a whole batch in one DataFrame."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from costmart.operators.fact import build_fact, fact_lines
from costmart.operators.normalize import normalize
from costmart.plans.reports import spend_by_provider
from costmart.sources.layouts import AWS, GCP
from tests import fixtures as fx

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

region_text = st.text(alphabet="abcdefghijklmnopqrstuvwxyzAB0123456789-", min_size=0, max_size=18)


def _python_rule(layout, value):
    pattern = layout.region_pattern
    repl = layout.region_replacement.replace("$1", r"\1")
    return re.sub(pattern, repl, value, count=1)


@SETTINGS
@given(st.lists(region_text, min_size=1, max_size=60))
def test_zone_rules_match_a_regex_model(spark, regions):
    for layout, row in ((AWS, lambda r: fx.aws_row(region=r)), (GCP, lambda r: fx.gcp_row(location_region=r))):
        raw = (fx.aws_raw if layout is AWS else fx.gcp_raw)(spark, [row(r) for r in regions])
        got = [r.region_code for r in normalize(raw, layout).collect()]
        # an empty string is a value here (only the CSV reader turns it into NULL -> "global")
        assert got == [_python_rule(layout, r) for r in regions]


cost = st.decimals(min_value=Decimal("-5000"), max_value=Decimal("5000"), places=6, allow_nan=False)


@SETTINGS
@given(st.lists(cost, min_size=1, max_size=80))
def test_sums_are_exact_decimals(spark, costs):
    rows = [fx.canon_row(cost_usd=float(c), resource_id=str(i)) for i, c in enumerate(costs)]
    got = spend_by_provider(fact_lines(fx.combined(spark, rows).repartition(7))).first()
    exact = sum(Decimal(repr(float(c))) for c in costs)
    assert got.total_cost_usd == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert got.num_line_items == len(costs)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["2024-01-01", "2024-02-29", "2025-03-03"]),
                          st.sampled_from(["a", "b", None]), st.integers(1, 4)), min_size=1, max_size=25))
def test_ids_unique_and_partition_independent(spark, specs):
    rows = []
    for day, name, copies in specs:
        rows += [fx.canon_row(date_key=day, account_name=name)] * copies
    c = fx.combined(spark, rows)
    one = sorted(r.cost_id for r in build_fact(c.repartition(1), chunk=2).collect())
    many = sorted(r.cost_id for r in build_fact(c.repartition(5)).collect())
    assert one == many and len(set(one)) == len(rows)
