import os

os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()
