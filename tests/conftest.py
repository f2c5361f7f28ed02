import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridspark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session("tests", **{
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the named columns or by all of them."""
    got = df.collect()
    key = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted((tuple(r) for r in got), key=lambda r: [(r[k] is not None, r[k]) for k in key])
