import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    # Tables here are tiny: compiling code for them would take longer than running it.
    for key, value in (("spark.sql.shuffle.partitions", "2"), ("spark.sql.codegen.wholeStage", "false")):
        session.conf.set(key, value)
    return session
