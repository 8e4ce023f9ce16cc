"""Small document tables with every awkward case."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta " * 20_000


def documents(spark, texts, extra=()):
    """Rows 0, 1, ... of ``texts``, plus a row without an id, a repeated row
    and columns whose names operators use inside."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "no id here, only text", None, None, None), rows[0], *extra]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    names = ("score", "predicted", "label", "id", "fp", "h", "pii_text", "pii_m", "at", "part", "length")
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


AWKWARD = [None, "", "   \n\t ", "one", "one two three", "tie tie tie tie tie", "tie tie tie tie tie", LONG,
           "ünïcödé 😀 text", "!!! ??? ..."]
