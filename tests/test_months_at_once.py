"""All report months in one plan equal the union of one-month runs (the original
runs one query per month)."""
import datetime as dt

import pytest

from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import delayed as dl
from shelterlens.plans import incidence as inc
from shelterlens.plans import stay as sy
from shelterlens.plans import surgery as sx
from shelterlens.plans.roles import model_from_driver

SF = "/root/testdata/sf0.001"
MONTHS = [dt.date(1996, 3, 1), dt.date(1996, 4, 1), dt.date(1996, 5, 1)]
OPS = {
    "numerator": lambda m, s: inc.incidence_numerator(m, s, inc.DISEASES["diarrhea"]),
    "stock": lambda m, s: inc.stock_population(m, s, inc.DISEASES["diarrhea"]),
    "flow": lambda m, s: inc.flow_population(m, s, inc.DISEASES["diarrhea"]),
    "complications": lambda m, s: sx.surgical_complications(m, s, sx.GENERAL),
    "dental_surgeries": lambda m, s: sx.surgeries(m, s, sx.DENTAL),
    "delayed": lambda m, s: dl.delayed_outcome(m, s),
    "open_stay": lambda m, s: sy.los_not_outcomed(m, s),
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_all_months_equals_single_months(spark, name):
    m = model_from_driver(spark, SF, line_locations=(name == "open_stay"))
    together = sorted(map(tuple, OPS[name](m, MonthSpine(MONTHS)).collect()), key=str)
    single = []
    for month in MONTHS:
        single.extend(map(tuple, OPS[name](m, MonthSpine([month])).collect()))
    assert together == sorted(single, key=str)
    assert len(together) > 0
