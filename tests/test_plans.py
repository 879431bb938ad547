"""The three jobs end to end, each on the output of the one before."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tallyloom.operators.cleaning import flatten_one_level, step_report
from tallyloom.operators.evaluation import Configuration
from tallyloom.operators.ngrams import NGramModel
from tallyloom.plans.experiment import run_experiment
from tallyloom.plans.mining import mine
from tallyloom.plans.preparation import prepare, prepare_dataset, prepare_methods
from tallyloom.schema import DATASET, NODES
from tallyloom.sources.records import read_dataset, read_records_jsonl

T0 = datetime(2024, 3, 1)
METHODS = 12


def files(spark):
    """Four files in two repositories; each file has twelve methods of one shape."""
    changes, file_nodes, method_nodes = [], [], []
    for f in range(4):
        record, repo = f"f{f}", f"https://example.org/o/r{f % 2}.git"
        changes.append((record, repo, f"r{f % 2}", f"sha{f}00000", T0, f"src/F{f}.java", "class"))
        file_nodes.append((record, 0, None, 0, 1, "program", True, "class", 0, 99))
        for m in range(METHODS):
            code, node = f"int m{m}(int a) {{\n  if (a && b) {{ c(); }}\n  return a;\n}}", 10 + m * 10
            file_nodes += [
                (record, node, 0, m, 2, "method_declaration", True, code, m * 5, m * 5 + 3),
                (record, node + 1, node, 0, 3, "identifier", True, f"m{m}", m * 5, m * 5),
                (record, node + 2, node, 1, 3, "formal_parameters", True, "(int  a)", m * 5, m * 5),
            ]
            method = f"{record}/{node}"
            method_nodes.append((method, 0, None, 0, 1, "program", True, code, 0, 3))
            for i, token in enumerate(["int", f"m{m}", "(", "a", ")", "if", "&&", "c", ";", "return", "a", ";", "}"]):
                kind = "if_statement" if token == "if" else "identifier"
                method_nodes.append((method, i + 1, 0, i, 2, kind, True, token, 0, 0))
    return (
        spark.createDataFrame(changes, "record_id string, repo_url string, project_name string, commit_sha string, "
                              "committed_ts timestamp, new_path string, source_code string"),
        spark.createDataFrame(file_nodes, NODES),
        spark.createDataFrame(method_nodes, NODES),
    )


def test_mine_prepare_experiment(spark, tmp_path):
    repos = spark.createDataFrame(
        [(f"https://example.org/o/r{i}.git", "java", 6000 + i, False, date(2024, 3, 2)) for i in range(2)],
        "clone_url string, language string, stars bigint, fork boolean, pushed_at date")
    licenses = spark.createDataFrame([("o/r0", "mit")], "owner_repo string, license_key string")
    records, dataset = str(tmp_path / "records"), str(tmp_path / "dataset")
    changes, file_nodes, method_nodes = files(spark)
    # One file has no tree at all.
    lost = changes.limit(1).withColumn("record_id", F.lit("f9")).withColumn("new_path", F.lit("src/Lost.java"))
    changes = changes.unionByName(lost)
    # One method of the repository with more stars was never parsed: it does not count.
    parsed = method_nodes.where("record_id <> 'f1/10'")
    report = mine(repos, changes, file_nodes, parsed, licenses, datetime(2024, 2, 1), datetime(2024, 4, 1), records,
                  methods_to_mine=40, chunk_size=10, quarantine=str(tmp_path / "failed"))
    failed = spark.read.json(str(tmp_path / "failed")).collect()
    assert sorted((r.record_id, r.node_id or 0, r.bad_reason) for r in failed) == [
        ("f1", 10, "missing n_ast_nodes"), ("f9", 0, "missing tree")]
    got = {r.repo_url and r.repo_url[-6:-4]: (r.methods, r.chunks) for r in report.collect()}
    assert got == {"r1": (23, 3), "r0": (17, 2), None: (40, None)}

    read = read_records_jsonl(spark, records, "partitions").cache()
    assert read.count() == 40
    row = read.where("method.name = 'm3'").orderBy("id").first()
    assert row.metrics.cyclomatic_complexity == 2 and row.method.signature == "m3(int  a)"
    assert {r.repo.name: r.repo.license for r in read.collect()} == {"r0": "mit", "r1": None}

    methods = prepare_methods(read)
    assert methods.where("method_signature = 'm3(int a)'").count() == methods.where("method_name = 'm3'").count() > 0
    # The last line of one file is cut off, and one record has no id.
    chunk = next((tmp_path / "records").glob("repo_dir=*/chunk=1"))
    (chunk / "cut.json").write_text('{"dataset_split": "train", "id": null}\n\n{"dataset_split": "tr')
    prepared = prepare(spark, records, dataset, 24, 6, layout="partitions", quarantine=str(tmp_path / "unusable"))
    unusable = spark.read.json(str(tmp_path / "unusable")).collect()
    assert {(r.bad_reason, r.source_file[-7:], r.line[-6:]) for r in unusable} == {
        ("missing id", "ut.json", " null}"), ("unparseable", "ut.json", '": "tr')}
    assert (prepared.lines_read, prepared.lines_quarantined) == (42, 2)
    want = step_report(flatten_one_level(read))
    assert sorted(map(tuple, prepared.step_report.collect())) == sorted(map(tuple, want.collect()))
    (chunk / "cut.json").unlink()
    split = prepare_dataset(spark, records, dataset, 24, 6, layout="partitions")
    totals = split.agg(F.sum("train_rows"), F.sum("test_rows")).first()
    # Shares of 30 rows are rounded down: 17 of 23 and 12 of 17.
    assert tuple(totals) == (23, 6)
    table = read_dataset(spark, dataset)
    assert set(DATASET.fieldNames()) <= set(table.columns)

    outcome = run_experiment(
        table, [Configuration(2, "none"), Configuration(3, "add-k", 0.1)], NGramModel(3),
        results_path=str(tmp_path / "results"), predictions_path=str(tmp_path / "predictions"))
    assert outcome.results.count() == 2
    assert outcome.best.count() == 2
    assert outcome.by_complexity.first().complexity == "Low (1-2)"
    assert outcome.large_scale.first().total_predictions > 0
    assert outcome.predictions.count() == 6
    assert spark.read.csv(str(tmp_path / "results"), header=True).count() == 2
