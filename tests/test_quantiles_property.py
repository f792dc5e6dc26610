"""Property test: for any grouping, value column, fractions, number of cuts and
finishing threshold, exact_quantiles equals numpy's linear quantile.

Inputs are the driver's lineitem table (sf0.001); Hypothesis only varies the
parameters, which drives the narrowing through many different paths.
"""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF0001
from heldout.operators.quantiles import exact_quantiles

GROUPS = [(), ("l_returnflag",), ("l_linestatus", "l_returnflag"), ("l_linenumber",)]
VALUES = ["l_quantity", "l_discount", "l_extendedprice", "l_tax"]


@pytest.fixture(scope="module")
def lineitem(spark):
    df = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    return df, df.toPandas()


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    groups=st.sampled_from(GROUPS),
    value=st.sampled_from(VALUES),
    probs=st.lists(st.floats(min_value=0.0, max_value=1.0), min_size=1, max_size=4, unique=True),
    steps=st.integers(min_value=4, max_value=64),
    finish=st.integers(min_value=1, max_value=3000),
)
def test_matches_numpy(lineitem, groups, value, probs, steps, finish):
    df, pdf = lineitem
    got = exact_quantiles(df, value, probs, list(groups), steps=steps, finish_rows=finish).collect()
    parts = pdf.groupby(list(groups)) if groups else [((), pdf)]
    expected = {}
    for key, part in parts:
        key = key if isinstance(key, tuple) else (key,)
        vals = part[value].to_numpy(dtype=float)
        for p in probs:
            expected[(*key, float(p))] = float(np.quantile(vals, p))
    assert len(got) == len(expected)
    for r in got:
        key = (*[r[g] for g in groups], r["prob"])
        assert r["value"] == pytest.approx(expected[key], rel=1e-12, abs=1e-9)
