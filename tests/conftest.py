import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from greenledger.plans.pipeline import Book  # noqa: E402
from greenledger.plans.specs import SOURCES  # noqa: E402
from greenledger.session import DEFAULT_CONF  # noqa: E402
from greenledger.sources.extracts import ingest_extract  # noqa: E402

from tests.book_fixture import AS_OF, LOAN_BOOK, write_csv  # noqa: E402

FIXTURE_AS_OF = AS_OF
FIXTURE_LOAN_PORTFOLIO = LOAN_BOOK


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="greenledger-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def fixture_extracts(spark, tmp_path_factory):
    """The planted-defect fixture ingested from CSV (bronze, with audit columns)."""
    folder = str(tmp_path_factory.mktemp("extracts"))
    write_csv(folder)
    return {
        spec.name: ingest_extract(spark, os.path.join(folder, f"{spec.name}.csv"), spec.columns, FIXTURE_AS_OF)
        for spec in SOURCES
    }


@pytest.fixture(scope="session")
def book(spark, fixture_extracts):
    return Book(spark, fixture_extracts, FIXTURE_AS_OF, FIXTURE_LOAN_PORTFOLIO)


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}
