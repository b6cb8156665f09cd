import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corpusqa.session import get_spark

    s = get_spark(
        "local[4]",
        app="corpusqa-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="corpusqa-test-ckpt-"),
        },
    )
    yield s
    s.stop()
