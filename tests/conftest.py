import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapstar.session import ensure_checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session(
        "local[4]",
        app_name="snapstar-tests",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # One JVM serves the whole suite: a heap beyond Spark's default of
            # 1 GB (set before it starts), and few plans of finished queries.
            "spark.driver.memory": "4g",
            "spark.sql.ui.retainedExecutions": "5",
            "spark.ui.retainedJobs": "20",
            "spark.ui.retainedStages": "20",
            "spark.ui.retainedTasks": "1000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests are the one place that sets a checkpoint folder of its own.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
