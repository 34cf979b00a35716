import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import DOCS, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Further columns, called as those that the operators make."""
    names = ["size", "taken", "score", "predicted", "lang_pred", "bits", "row", "sequence_id", "rank", "_doc_0", "ring"]
    return odd.select("*", *[F.lit(f"x {n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def labels_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (2, 1, 0), (999, 0, 1)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder
