import pytest
from samples import CISCO_LOG, CLOUDTRAIL_LOG, LINUX_LOG

from logwarden import analyze
from logwarden.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("logwarden-tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    paths = {}
    for name, text in [("cisco", CISCO_LOG), ("linux", LINUX_LOG), ("cloudtrail", CLOUDTRAIL_LOG)]:
        path = folder / f"{name}.log"
        path.write_text(text, encoding="utf-8")
        paths[name] = str(path)
    return paths


@pytest.fixture(scope="session")
def result(spark, sample_paths):
    return analyze(spark, **sample_paths)


@pytest.fixture
def lines_of(spark):
    """Lines as the readers give them, from a list of texts."""

    def build(texts, path="/logs/test.log"):
        rows = [(text, path, number) for number, text in enumerate(texts, 1)]
        return spark.createDataFrame(rows, "value string, path string, line_number bigint")

    return build
