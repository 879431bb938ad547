"""A folder with a ``documents`` table of awkward rows, as the registered queries read it."""

from . import cases

# Beside those of cases: names that the operators here use themselves.
CLASHING = ("row", "links", "a", "b", "n", "best", "ids", "runs", "collapsed", "n_a", "count_sum", "start", "period", "n_tokens")


def folder(spark, path, rows):
    docs = cases.table(spark, rows)
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)
