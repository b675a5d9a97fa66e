"""Small helpers of these tests."""


def docs_frame(spark, rows, schema="doc_id bigint, text string"):
    """Documents of (doc_id, text) with columns whose names clash with what operators use inside."""
    frame = spark.createDataFrame(rows, schema)
    clash = ["fp", "key", "host", "copies", "c", "l", "word", "length", "start", "a", "b", "score", "n", "url", "digest"]
    return frame.selectExpr("*", *[f"'x' AS {c}" for c in clash if c not in frame.columns])


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]
