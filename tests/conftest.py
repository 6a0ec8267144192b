import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from covtab.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .appName("covtab-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their session, so they set a scratch checkpoint folder.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="covtab-test-ckpt-"))
    yield s
