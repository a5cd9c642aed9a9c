import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet consectetur " * 3000


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def table(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType())]
    extra = [(c, T.StringType()) for c in ("row", "doc", "key", "label", "n", "drops", "at", "item", "hash", "size")]
    schema = T.StructType([T.StructField(n, t) for n, t in fields + extra])
    return spark.createDataFrame([(i, t, *["x"] * len(extra)) for i, t in rows], schema)


ODD_ROWS = [
    (7, "One two three four five six seven.\nA line that is shared by some\nend of seven"),
    (3, "Another text\n  a LINE that is shared by some \nand more"),
    (3, "Another text\n  a LINE that is shared by some \nand more"),
    (None, "A line that is shared by some\nwithout an id"),
    (None, None),
    (5, None),
    (6, ""),
    (8, "\n\n"),
    (9, "!!! ???"),
    (10, LONG),
    (11, "one two three four five six seven\na line that is shared by some\nEnd of seven!"),
    (12, "tiny"),
    (2**53 + 1, "Ünïcode ﬁ ▁ 漢字 🙂\ttab <s> </s> <|endoftext|>"),
]


@pytest.fixture
def odd(spark):
    return table(spark, ODD_ROWS)


@pytest.fixture
def nothing(spark):
    return table(spark, [])
