"""Trained operators on tables whose extra columns have the names that the operators use."""

import random

from tallyloom.llm import byte_cnn, licenses

from . import cases

NAMES = (
    "label", "draw", "row", "family", "families", "grams", "tokens", "features", "copies", "trust", "paragraph", "held_out",
    "predicted", "probability", "rawPrediction", "prediction", "quality", "__most", "spans", "line", "best",
)


def clashing(spark, rows):
    docs = cases.table(spark, rows)
    for name in NAMES:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def plainly(df):
    return sorted(map(repr, df.collect()))


def test_quality_classifier(spark):
    random.seed(4)
    words = ["good", "clean", "prose", "about", "rivers", "and", "hills"]
    rows = [(i, " ".join(random.choices(words, k=30)) if i % 2 else "#$% " * 20 + str(i), "a") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    weights = byte_cnn.train(clashing(spark, rows), labels)
    assert byte_cnn.training_rows(clashing(spark, rows), labels).count() == byte_cnn.training_rows(cases.table(spark, rows), labels).count()
    assert plainly(byte_cnn.score(clashing(spark, rows), weights)) == plainly(byte_cnn.score(cases.table(spark, rows), weights))


def test_license_scans(spark):
    text = "Some words.\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software.\nMore words."
    rows = [*cases.TEXTS[:6], (30, text, "a"), (31, cases.SENTENCE, "b")]
    assert plainly(licenses.scan(clashing(spark, rows)).select("doc_id", "families")) == plainly(
        licenses.scan(cases.table(spark, rows)).select("doc_id", "families")
    )
