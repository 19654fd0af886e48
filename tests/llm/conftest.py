import pytest
from llm_corpus import DOCUMENTS, corpus, frame


@pytest.fixture(scope="session")
def texts():
    """{doc_id: text} with distinct ids, larger texts not in the order of ids."""
    every = corpus()
    return {(i * 7) % len(every) if len(every) % 7 else i: text for i, text in enumerate(every)}


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(d, t, "en" if d % 3 else None, f"src{d % 4}" if d % 5 else None, len(t or "")) for d, t in texts.items()]
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
