import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang, source); more columns that clash may follow."""

    def make(rows, *clashing):
        whole = [(*row, *("en", "s")[len(row) - 2 :], len(row[1]) if row[1] is not None else None) for row in rows]
        frame = spark.createDataFrame(whole, DOCUMENTS)
        for name in clashing:
            frame = frame.selectExpr("*", f"'clash' as {name}")
        return frame.repartition(3)

    return make
