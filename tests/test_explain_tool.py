"""The plan summary tool (explain_plans.py) still reads Spark 4 plans."""

from explain_plans import summarise

from costmart.operators.fact import fact_lines
from costmart.plans import reports as R
from tests import fixtures as fx


def test_summary_of_a_projection_and_a_report(spark):
    c = fx.combined(spark)
    row = summarise("projection", fact_lines(c))
    assert row.startswith("| projection | 0 | 0 | - | no |")
    row = summarise("r1", R.spend_by_provider(fact_lines(c)))
    cells = [x.strip() for x in row.strip("|").split("|")]
    assert cells[0] == "r1" and int(cells[1]) >= 1 and cells[4] == "no"
