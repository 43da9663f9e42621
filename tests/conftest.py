import pytest

from roomledger.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        **{
            "spark.checkpoint.dir": str(shared),
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    yield session
    session.stop()
