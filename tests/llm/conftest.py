import pytest
from pyspark import cloudpickle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from texts (or (id, text) pairs); ids count up."""

    def make(texts, **extra):
        rows = []
        for i, t in enumerate(texts):
            doc_id, text = t if isinstance(t, tuple) else (i, t)
            rows.append((doc_id, text, "en" if i % 3 else "fr", "a" if i % 2 else None, None if text is None else len(text)))
        df = spark.createDataFrame(rows, SCHEMA)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


@pytest.fixture(scope="session")
def clashing():
    """Extra columns named like columns the operators use inside."""
    return {
        "n": 1, "h": "x", "row": 2, "start": 3, "end": 4, "key": 5, "count": 6, "piece": 7, "length": 8, "check": 9, "rank": 1,
        "kept": True, "n_words": 5, "n_lines": 6, "spans": "s", "items": "i", "size": 3, "segment": 1, "place": "p",
        "lang_pred": "zz", "score": 2.0, "p_toxic": 3.0, "component_id": 4, "signature": "s", "cid": 1, "block": 2,
    }


@pytest.fixture
def by_value():
    """Send a module's functions to the workers with the values they have now."""
    sent = []

    def register(module):
        cloudpickle.register_pickle_by_value(module)
        sent.append(module)

    yield register
    for module in sent:
        cloudpickle.unregister_pickle_by_value(module)
