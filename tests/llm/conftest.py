import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.exists(SF):
        pytest.skip("test tables not present")
    return SF


def write_tables(spark, folder, **tables):
    """Write {name: (rows, schema)} as the Parquet tables of a data folder."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
