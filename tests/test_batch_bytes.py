"""The size of what a Python worker is given at once."""

import pyarrow as pa
from pyspark.sql import functions as F


def test_batches_for_python_are_bounded_in_bytes(spark):
    """3,000 rows of 10,000 bytes are more than one batch."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    found = [r["bytes"] for r in rows.mapInArrow(sizes, "bytes bigint").collect()]
    assert sum(found) >= 30_000_000 and max(found) < 10_000_000
