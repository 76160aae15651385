import os
import re

import pytest

#: Executors import the package from here.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")]
)

SF = "/root/testdata/sf0.001"
TEXTS = "doc_id long, text string"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def words(text):
    """Words as the operators take them, by plain Python."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def clashing(df):
    """The same rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("k", "gid", "n", "_text", "_id", "key", "bucket", "kept", "digest", "spans", "a b")
    return df.select("*", *(F.lit(7).alias(n) for n in names))
