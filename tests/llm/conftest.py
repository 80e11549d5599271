import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from skylane.llm.common import ship_code
    ship_code(spark)


def documents(spark, rows, schema="doc_id long, text string"):
    """Documents with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, schema)
    extra = ("version", "start", "spans", "text_hash", "n_words", "_doc", "component", "id", "perplexity", "part", "code")
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in extra if c not in df.columns])
