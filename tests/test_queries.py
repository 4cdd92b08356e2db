"""Every query of the core against its SQL on the smallest test data."""

from pathlib import Path

import pytest
from oracle import compare

from skeinwork.plans import pipeline, problems, review

DATA = Path("/root/testdata/sf0.001")
CASES = [(m, n) for m in (pipeline, problems, review) for n in m.QUERIES]


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize(("module", "name"), CASES, ids=[n for _, n in CASES])
def test_query_equals_sql(spark, module, name):
    here, there, differing = compare(spark, module.QUERIES[name], module.SQL[name], str(DATA))
    assert here == there and not differing


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
