import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from knotwork.session import local_session

    session = local_session(4, "tests", "4g")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from knotwork.plans.property_store import PropertyStore

    return PropertyStore(spark, str(tmp_path / "graph"), embedding_dimension=4)


@pytest.fixture
def triples(spark, tmp_path):
    from knotwork.plans.triple_store import TripleStore

    return TripleStore(spark, str(tmp_path / "triples"))


def column(df, name):
    return sorted(r[name] for r in df.select(name).collect())
