import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewire.session import builder

    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no driver tables")
    return path
