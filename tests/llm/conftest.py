import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("llm-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


DOCS = "doc_id BIGINT, text STRING, score STRING, n BIGINT, `key` STRING"


@pytest.fixture(scope="session")
def docs(spark):
    """Odd rows: null and empty texts, null ids, repeated rows and ids, a very long text, clashing columns."""
    line = "the quick brown fox jumps over the lazy dog again and again"
    texts = [(1, f"{line}\nanother line of plain words here today\nx"), (2, f"{line}\nits own words follow this one line"),
             (2, f"{line}\nits own words follow this one line"), (3, None), (4, ""), (5, " \n "), (None, line),
             (6, line + "\n" + " ".join(f"w{i}" for i in range(60_000))), (7, "Ünïcödé  wörds\tand\r\nblanks 中文 <|endoftext|> don't!!"),
             (8, "short text"), (9, "short  TEXT"), (2, "the same id with another text of its own")]
    return spark.createDataFrame([(i, t, "s", 0, "k") for i, t in texts], DOCS)
