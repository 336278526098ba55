"""The share of a sample at every size of a table."""

import pytest
from pyspark.sql import functions as F

from riskbook.llm.common import in_sample


@pytest.mark.parametrize("total", [10, 20_000, 10**9, 10**10, 10**12, 10**15])
def test_a_sample_never_rounds_to_nothing(spark, total):
    """The threshold is the share of the hashes, to one in 2**63."""
    condition = in_sample(["id"], 3, 10_000, total)
    if total <= 10_000:
        assert spark.range(5).filter(condition).count() == 5
        return
    rows = spark.range(0, 2_000_000, 1, 8).filter(condition).count()
    wanted = 2_000_000 * 10_000 / total
    assert abs(rows - wanted) <= 6 * wanted**0.5 + 1
    least = spark.range(1).select((F.lit(1) * ((2**63 * 10_000) // total)).alias("t")).first().t
    assert least > 0 and abs(least / 2**63 * total / 10_000 - 1) < 1e-6
