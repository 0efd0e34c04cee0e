import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
sys.path.insert(0, str(Path(__file__).parent / "llm"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("shared")
    settings = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{folder}", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from tidemark.session import ship

    ship(session)
    yield session
    session.stop()
