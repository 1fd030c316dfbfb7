import os

import pytest
from pyspark.sql import functions as F

from snaptide.functions.text import blank_to_null
from snaptide.scratch import materialize, temporary, work_area


def test_intermediates_go_when_the_result_is_written(spark, area):
    before = materialize(spark.range(3), "kept")
    with temporary(spark) as areas:
        made = materialize(spark.range(10), "gone")
        with temporary(spark) as inner:
            materialize(spark.range(2), "inner")
        assert len(inner) == 1 and not os.path.exists(inner[0])
        made.write.parquet(f"{area}/result")
        assert len(areas) == 1 and os.path.exists(areas[0])
    assert not os.path.exists(areas[0])
    assert spark.read.parquet(f"{area}/result").count() == 10 and before.count() == 3
    assert work_area(spark, "later") not in areas


def test_intermediates_go_after_a_failure(spark):
    with pytest.raises(RuntimeError), temporary(spark) as areas:
        materialize(spark.range(10), "gone")
        raise RuntimeError
    assert areas and not os.path.exists(areas[0])


def test_blank_text(spark):
    values = ["", " ", "\t\r\n \x0b\f", "x", " x ", " ", "0", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(blank_to_null(F.col("v"))).collect()]
    assert got == [None, None, None, "x", " x ", " ", "0", None]
