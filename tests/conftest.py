import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from traceops.session import session

    spark = session("traceops-tests", master="local[8]", shuffle_partitions=8,
                    **{"spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
