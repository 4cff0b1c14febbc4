import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of the smallest table with awkward rows beside them: nulls, empty and very long texts, repeated rows, clashing names."""
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    long_text = " ".join(f"word{i % 3000} of a very long text" for i in range(20_000))
    odd = [(10_001, None, "en", "src1", None), (10_002, "", None, None, 0), (10_003, " \t\n\x0b\x0c\r ", "de", None, 6), (10_004, long_text, "en", "src1", len(long_text)), (10_005, "ünï — 日本語 \U0001f600 <|endoftext|>", None, "src2", 5), (10_006, "a", "fr", "src2", 1)]
    first = [tuple(r) for r in base.orderBy("doc_id").limit(2).collect()]
    repeated = [first[0], (10_007, *first[1][1:]), (10_007, *first[1][1:])]
    return base.unionByName(spark.createDataFrame([tuple(r) for r in odd + repeated], base.schema)).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
