from __future__ import annotations

import pytest

from tallyline.sources.tables import SCHEMAS, Tables


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_declared_schemas_equal_the_files(spark, sf):
    d = f"/root/testdata/sf{sf}"
    t = Tables(spark, d)
    for name in SCHEMAS:
        inferred = spark.read.parquet(f"{d}/{name}.parquet").schema
        declared = t.read(name).schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred], name
        assert t.read(name).limit(5).count() == 5
