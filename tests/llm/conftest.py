import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from conftest_helpers import DOCS, awkward, prose  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return awkward(random.Random(5))


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Small tables as files: documents with the awkward rows, labels, benchmark, conversations."""
    rng = random.Random(5)
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(awkward(rng), DOCS).withColumnRenamed("lang", "lang").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 3 > 0, 0) for i in range(60)], "doc_id bigint, q boolean, toxic int").selectExpr(
        "doc_id", "cast(q as int) quality", "toxic").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, prose(rng, 30)), (1, None), (2, "")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path
