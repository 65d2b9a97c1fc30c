import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000)) + "."
BASE = " ".join(f"word{k} and thing{k * 7 % 50}," for k in range(60)) + " end."


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text or ""))


EDGES = [
    doc(1, BASE), doc(2, BASE), doc(2, BASE), doc(3, BASE.replace("word7 ", "other ")),
    doc(4, None), doc(5, ""), doc(6, " \n\t\n "), doc(7, LONG, "de", "b"), doc(8, LONG + " more", "de", "b"),
    doc(9, "é漢字 <|endoftext|> don't <|endoftext|>", None, None), doc(None, "no id here", "fr", "b"),
    doc(None, BASE, "en", None), doc(10, "x", "", ""), doc(11, "12 34 ... !!", "en", "b"), doc(12, "a" * 5000),
    doc(13, "tail  \n\n  spaces   "), doc(14, " line　sep\x85 and \x1c control"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, DOC).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


