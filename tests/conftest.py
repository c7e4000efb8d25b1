import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("shared")
    session = local_session(
        "8",
        **{
            "spark.sql.shuffle.partitions": "2",
            # Compiling code costs more than running it on a handful of rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.checkpoint.dir": str(work / "checkpoints"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
        },
    )
    yield session
    session.stop()
