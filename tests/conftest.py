import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from formweave.functions.crypto import EnvelopeCipher  # noqa: E402
from formweave.session import build_session  # noqa: E402

KEK = "projects/p/locations/global/keyRings/r/cryptoKeys/k"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cipher(spark):
    return EnvelopeCipher(spark, {KEK: bytes(range(32))}, KEK, 8)


@pytest.fixture
def message_of(spark, cipher):
    """Seal (message_id, body) pairs into messages."""
    from pyspark.sql import functions as F

    def make(*pairs, time="2024-03-05 07:08:09"):
        rows = spark.createDataFrame(list(pairs), "message_id string, body string")
        keyed = cipher.with_data_key(rows, "message_id")
        return keyed.select("message_id", F.lit(time).cast("timestamp").alias("publish_time"),
                            F.create_map(F.lit("a"), F.lit("b")).alias("attributes"),
                            cipher.seal(F.encode("body", "UTF-8")).alias("payload"))

    return make
