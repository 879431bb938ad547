"""Every operator as a query over the given tables; ``oracles`` has the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bands, naming
from ..functions import text as X
from ..operators import cleaning as C
from ..operators import evaluation as E
from ..operators import generation as G
from ..operators import incremental as I
from ..operators import mining as M
from ..operators import ngrams as N
from ..operators import sampling as S
from ..operators import trees
from ..operators.dedupe import dedupe_keep_last, duplicate_report
from ..schema import RECORD
from ..session import scratch_path, stored
from ..sources import records as R
from ..sources import sinks as K
from . import standins as D
from .mining import without_tree
from .preparation import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters the SQL shares.
SINCE, TO = datetime(2024, 1, 5), datetime(2024, 1, 20)
PUSHED_SINCE, PUSHED_TO = date(2024, 2, 1), date(2024, 12, 31)
LANGUAGE = "automobile"
SAMPLE_SIZE, SAMPLE_TRAIN, SAMPLE_TEST = 200, 160, 40
CHUNK, CAP = 100, 5000
PAGE_BRANCHES = ("li", "p", "h1")
# Records that are cut off, or lack an id, by the remainder of their first line.
CUT_OFF, NO_ID, CUT_LENGTH = (17, 5), (19, 7), 40
ROW_RANGE = (40, 800)
BATCHES = 3
# Small limits for the queries that show what a limit does, and the grid with a size of one.
FIRST_ROWS, FIRST_POSITIONS, FIRST_PER_BAND = 20, 10, 5
GRID_CONFIGURATIONS = (*E.CONFIGURATIONS, E.Configuration(1, "laplace"), E.Configuration(1, "none"))


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        return build

    return register


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Types every engine prints alike: long integers, rounded doubles, joined arrays."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 4 if field.name == "perplexity" else digits)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, " ")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- sources, sinks -----------------------------------------------------------------------


@query("s1_search_repos")
def _(spark, sf):
    return M.search_repos(D.repos(spark, sf), PUSHED_SINCE, PUSHED_TO, LANGUAGE)


@query("s2_scan_changes")
def _(spark, sf):
    return M.scan_changes(D.file_changes(spark, sf), SINCE, TO).select("event_id", "commit_sha", "new_path")


@query("s2_scan_changes_strict")
def _(spark, sf):
    return M.scan_changes(D.file_changes(spark, sf), SINCE, TO, strict_ext=True).select("event_id", "new_path")


@query("j4_commit_qualification")
def _(spark, sf):
    changes = M.scan_changes(D.file_changes(spark, sf), datetime(2000, 1, 1), datetime(2100, 1, 1))
    return changes.groupBy("repo_url", "commit_sha").agg(F.count(F.lit(1)).alias("files"))


@query("s5_decode_tokens")
def _(spark, sf):
    stored = D.token_rows(spark, sf).withColumn("stored", X.encode_tokens(F.col("code_tokens")))
    decoded = stored.select("row_ord", X.decode_tokens(F.col("stored")).alias("tokens"))
    return decoded.select("row_ord", F.size("tokens").alias("n_tokens"), "tokens")


@query("s6_metric_columns")
def _(spark, sf):
    methods = D.methods(spark, sf)
    metrics = R.metric_columns(methods)
    return methods.select(metrics).unpivot([], metrics, "metric", "value").groupBy("metric").agg(
        F.sum("value").alias("total")
    )


@query("k1_s3_records_round_trip")
def _(spark, sf):
    path = scratch_path(spark)
    K.write_chunked_jsonl(records(spark, sf), path, [F.col("id")], CHUNK)
    back = R.read_records_jsonl(spark, path, "partitions")
    return C.flatten_one_level(back).select(
        "id", "repo_dir", F.col("chunk").cast("bigint"), "repo_url", "method_original_code",
        F.size("code_tokens").alias("n_tokens"), "metrics_nloc", "repo_license",
    )


def record_folders(spark: SparkSession, sf: str) -> str:
    """Record files one folder below a root: some lines are cut off, some records have no id."""
    start, url = F.col("method.start_line"), F.col("repo.url")
    line = F.to_json(
        F.struct(*[F.when(start % NO_ID[0] != NO_ID[1], F.col(c)).alias(c) if c == "id" else F.col(c) for c in RECORD.fieldNames()])
    )
    lines = records(spark, sf).select(
        F.concat_ws("--", naming.repo_owner(url), naming.repo_short_name(url)).alias("folder"),
        F.when(start % CUT_OFF[0] == CUT_OFF[1], F.substring(line, 1, CUT_LENGTH)).otherwise(line).alias("value"),
    )
    path = scratch_path(spark)
    lines.write.partitionBy("folder").text(path)
    return path


@query("s3_f9_read_folders")
def _(spark, sf):
    lines = R.read_record_lines(spark, record_folders(spark, sf), "folders", "part-*")
    judged = C.with_bad_reason(lines, ["id"])
    cut = F.col("bad_reason") == "unparseable"
    return judged.select(
        F.coalesce("bad_reason", F.lit("ok")).alias("reason"),
        F.regexp_extract("source_file", "folder=([^/]+)/", 1).alias("folder"),
        F.when(F.col("bad_reason").isNull(), F.col("id")).alias("id"),
        F.when(F.coalesce(~cut, F.lit(True)), F.col("method.start_line")).alias("start_line"),
        F.when(cut, F.length("line")).alias("n_cut"),
    )


@query("s3_f9_a4_prepare_reports")
def _(spark, sf):
    done = prepare(
        spark, record_folders(spark, sf), scratch_path(spark), SAMPLE_TRAIN, SAMPLE_TEST,
        quarantine=scratch_path(spark), pattern="part-*",
    )
    lines = [(-2, "lines read", done.lines_read), (-1, "lines quarantined", done.lines_quarantined)]
    return done.step_report.unionByName(spark.createDataFrame(lines, done.step_report.schema))


@query("f9_files_without_tree")
def _(spark, sf):
    changes = D.documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("record_id"), F.when(F.col("lang") != "de", F.col("text")).alias("source_code")
    )
    roots = F.col("depth") == 1
    nodes = D.document_nodes(spark, sf).where(~roots | (F.col("record_id").cast("bigint") % 7 > 0))
    return without_tree(changes, nodes).select("record_id")


@query("s4_f7_read_split")
def _(spark, sf):
    path = scratch_path(spark)
    K.write_dataset(C.standardize(D.methods(spark, sf)).withColumn("dataset_split", D.split_of(F.col("row_ord"))), path)
    return split_rows(R.read_dataset(spark, path))


def split_rows(dataset: DataFrame) -> DataFrame:
    rows = E.select_split(dataset, "test").where(F.col("row_ord").between(*ROW_RANGE))
    return rows.select("id", "repo_name", "method_name", "row_ord")


@query("k2_s4_dataset_round_trip")
def _(spark, sf):
    path = scratch_path(spark)
    K.write_dataset(C.standardize(D.methods(spark, sf)), path, "csv")
    return R.read_dataset(spark, path, "csv").select(
        "id", "repo_name", "method_name", "method_original_code", "method_doc_comment",
        F.size("code_tokens").alias("n_tokens"), "metrics_nloc", "row_ord",
    )


@query("k3_write_results")
def _(spark, sf):
    path = scratch_path(spark)
    K.write_results(grid(spark, sf), path)
    back = spark.read.options(**R.CSV_OPTIONS).csv(path)
    return back.select(
        F.col("n").cast("bigint"), "smoothing", "k",
        *[F.col(c).cast("double").alias(c) for c in ("perplexity", "top1_acc", "top3_acc", "top5_acc")],
    )


@query("k4_write_predictions")
def _(spark, sf):
    path = scratch_path(spark)
    K.write_predictions(predictions(spark, sf), path)
    return spark.read.options(**R.CSV_OPTIONS).csv(path)


# --- record shaping -----------------------------------------------------------------------


@query("p1_split_repo_url")
def _(spark, sf):
    return M.parse_repo_urls(D.repos(spark, sf).select("clone_url"))


@query("p2_clean_repo_url")
def _(spark, sf):
    return D.repos(spark, sf).select("clone_url", naming.clean_repo_url(F.col("clone_url")).alias("url"))


@query("p3_qualified_class_name")
def _(spark, sf):
    return D.methods(spark, sf).select("id", naming.qualified_class_name(F.col("file_path")).alias("class_name"))


@query("p4_record_id")
def _(spark, sf):
    return D.methods(spark, sf).select(
        "id",
        naming.record_id(
            F.col("repo_name"), F.col("repo_commit_sha"), F.col("file_path"),
            F.col("method_start_line"), F.col("method_end_line"),
        ).alias("record_id"),
    )


@query("p5_method_qualified_name")
def _(spark, sf):
    return D.methods(spark, sf).select(
        "id", naming.method_qualified_name(F.col("file_path"), F.col("method_name")).alias("qualified_name")
    )


def measured(spark: SparkSession, sf: str) -> DataFrame:
    """Methods with the metrics nested as a measuring job delivers them."""
    m = D.methods(spark, sf)
    even = F.length("method_name") % 2 == 0
    text = F.struct(
        F.col("metrics_n_whitespaces").alias("n_whitespaces"),
        F.col("metrics_n_words").alias("n_words"),
        F.col("metrics_nloc").alias("nloc"),
    )
    one = F.lit(1).cast("bigint")
    tree = F.struct(
        F.col("metrics_n_ast_nodes").alias("n_ast_nodes"),
        (one + 2).alias("ast_depth"),
        F.col("metrics_n_words").alias("n_identifiers"),
        F.size(F.array_distinct("code_tokens")).cast("bigint").alias("vocab_size"),
        F.col("code_tokens").alias("code_tokens"),
        F.size("code_tokens").cast("bigint").alias("token_counts"),
    )
    return m.select(
        F.col("repo_name").alias("project_name"),
        "repo_url",
        F.col("repo_commit_sha").alias("commit_sha"),
        F.lit(None).cast("string").alias("license_key"),
        F.col("file_path").alias("new_path"),
        F.col("method_name").alias("name"),
        F.col("method_signature").alias("signature"),
        F.col("method_start_line").alias("start_line"),
        F.col("method_end_line").alias("end_line"),
        F.col("method_original_code").alias("source_code"),
        F.col("method_doc_comment").alias("doc_comment"),
        F.when(even, text).alias("text_metrics"),
        tree.alias("ast_metrics"),
        F.col("metrics_cyclomatic_complexity").alias("cyclomatic_complexity"),
        F.when(~even, F.col("metrics_nloc")).alias("nloc"),
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    return M.build_record(M.coalesce_metric_shape(measured(spark, sf)))


@query("p6_build_record")
def _(spark, sf):
    return records(spark, sf).select(
        "id", "dataset_split", F.col("repo.url").alias("repo_url"), F.col("file.language").alias("language"),
        F.col("method.qualified_name").alias("qualified_name"), F.col("method.signature").alias("signature"),
        F.col("metrics.token_counts").alias("token_counts"), F.col("metrics.nloc").alias("nloc"),
        F.size("code_tokens").alias("n_tokens"),
    )


@query("p7_coalesce_metric_shape")
def _(spark, sf):
    return M.coalesce_metric_shape(measured(spark, sf)).select(
        "commit_sha", "n_whitespaces", "n_words", "nloc", "token_counts", "vocab_size"
    )


@query("p8_flatten_one_level")
def _(spark, sf):
    return C.flatten_one_level(records(spark, sf)).drop("method_original_code")


@query("p9_drop_license")
def _(spark, sf):
    return C.drop_license(D.methods(spark, sf).select("id", "repo_license", "repo_url"))


@query("p10_p12_standardize")
def _(spark, sf):
    return C.standardize(D.methods(spark, sf)).select("id", "repo_name", "file_path", "method_signature")


@query("p13_complexity_band")
def _(spark, sf):
    band = bands.complexity_band(F.col("metrics_cyclomatic_complexity"))
    return D.methods(spark, sf).select("id", band.alias("complexity"))


# --- filters ------------------------------------------------------------------------------


@query("f1_has_source")
def _(spark, sf):
    return M.has_source(D.file_changes(spark, sf)).select("event_id", "source_code")


@query("f2_valid_method_name")
def _(spark, sf):
    return D.methods(spark, sf).where(C.valid_method_name()).select("id", "method_name")


@query("f3_valid_line_span")
def _(spark, sf):
    return D.methods(spark, sf).where(C.valid_line_span()).select("id", "method_start_line", "method_end_line")


@query("f4_nloc_between")
def _(spark, sf):
    return D.methods(spark, sf).where(C.nloc_between()).select("id", "metrics_nloc")


@query("f5_parsed_ok")
def _(spark, sf):
    return D.methods(spark, sf).where(C.parsed_ok()).select("id", "metrics_cyclomatic_complexity")


@query("f6_quality_filter")
def _(spark, sf):
    return C.quality_filter(D.methods(spark, sf)).select("id", "metrics_cyclomatic_complexity", "metrics_n_ast_nodes")


@query("f7_select_split")
def _(spark, sf):
    return E.select_split(D.token_rows(spark, sf), "test").select("row_ord", "dataset_split")


@query("f8_min_prompt_length")
def _(spark, sf):
    rows = D.token_rows(spark, sf).where(G.min_prompt_length())
    return rows.select("row_ord", F.size("code_tokens").alias("n_tokens"))


@query("f9_isolate_bad_rows")
def _(spark, sf):
    changes = D.file_changes(spark, sf).withColumn(
        "parsed", F.from_json("source_code", "k bigint", {"mode": "PERMISSIVE"})["k"]
    )
    good, bad = C.isolate_bad_rows(changes, ["source_code", "parsed"])
    ok = good.select("event_id", F.lit("ok").alias("bad_reason"))
    return ok.unionByName(bad.select("event_id", "bad_reason"))


@query("clean_methods")
def _(spark, sf):
    return C.clean_methods(D.methods(spark, sf)).select("id", "repo_name", "file_path", "method_signature")


# --- joins --------------------------------------------------------------------------------


@query("j1_attach_license")
def _(spark, sf):
    repos = D.repos(spark, sf).select(F.col("clone_url").alias("repo_url"))
    return M.attach_license(repos, D.licenses(spark, sf))


# --- aggregations over trees and methods --------------------------------------------------


@query("a1_tree_metrics")
def _(spark, sf):
    return trees.tree_metrics(D.document_nodes(spark, sf))


@query("a2_leaf_tokens")
def _(spark, sf):
    return trees.leaf_tokens(D.document_nodes(spark, sf))


@query("a3_branch_complexity")
def _(spark, sf):
    return trees.branch_complexity(D.document_nodes(spark, sf, branching=True))


@query("a1_tree_metrics_pages")
def _(spark, sf):
    return trees.tree_metrics(D.page_nodes(spark, sf))


@query("a2_leaf_tokens_pages")
def _(spark, sf):
    return trees.leaf_tokens(D.page_nodes(spark, sf))


@query("a3_branch_complexity_pages")
def _(spark, sf):
    return trees.branch_complexity(D.page_nodes(spark, sf), PAGE_BRANCHES)


@query("x5_all_metrics")
def _(spark, sf):
    texts = D.documents(spark, sf).select(F.col("doc_id").cast("string").alias("record_id"), "text")
    return trees.all_metrics(D.document_nodes(spark, sf, branching=True), texts)


@query("d1_extract_declarations")
def _(spark, sf):
    return trees.extract_declarations(D.document_nodes(spark, sf))


@query("d2_leading_comment")
def _(spark, sf):
    return trees.leading_comment(D.document_nodes(spark, sf))


@query("x1_x4_text_metrics")
def _(spark, sf):
    return D.documents(spark, sf).select("doc_id", *X.text_metrics(F.col("text")))


@query("a4_step_report")
def _(spark, sf):
    return C.step_report(D.methods(spark, sf))


def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_keep_last(C.clean_methods(D.methods(spark, sf)))


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a table, for operators that read it more than once."""
    return stored(deduplicated(spark, sf))


@query("w1_duplicate_report")
def _(spark, sf):
    return duplicate_report(C.clean_methods(D.methods(spark, sf))).select(
        "id", "repo_name", "file_path", "method_signature"
    )


@query("w2_dedupe_keep_last")
def _(spark, sf):
    return deduplicated(spark, sf).select("id", "repo_name", "file_path", "method_signature", "repo_commit_sha")


@query("a5_distinct_repos")
def _(spark, sf):
    return S.distinct_repos(deduplicated(spark, sf))


@query("a6_repo_distribution")
def _(spark, sf):
    return S.repo_distribution(deduplicated(spark, sf))


@query("a8_mining_report")
def _(spark, sf):
    return M.mining_report(D.file_changes(spark, sf), chunk_size=CHUNK)


TRAVERSAL = ("committed_ts", "event_id")


@query("w3_chunk_number")
def _(spark, sf):
    changes = D.file_changes(spark, sf).select("repo_url", *TRAVERSAL)
    return M.chunk_number(changes, ["repo_url"], [F.col(c) for c in TRAVERSAL], CHUNK).select(
        "event_id", "repo_url", "chunk"
    )


@query("w4_mining_cap")
def _(spark, sf):
    changes = M.has_source(D.file_changes(spark, sf)).select("repo_url", *TRAVERSAL)
    return M.mining_cap(changes, CAP, order=[F.col(c) for c in TRAVERSAL]).select("event_id", "repo_url")


# --- sampling and splitting ---------------------------------------------------------------


@query("w5_u1_proportional_sample")
def _(spark, sf):
    sample = S.proportional_sample(C.quality_filter(prepared(spark, sf)), SAMPLE_SIZE)
    return sample.select("id", "repo_name")


@query("w5_shortfall_all")
def _(spark, sf):
    sample = S.proportional_sample(C.quality_filter(prepared(spark, sf)), 100_000_000, on_shortfall="all")
    return sample.select("id", "repo_name")


@query("t4_shuffle")
def _(spark, sf):
    return S.shuffle(D.methods(spark, sf).select("id", "repo_name"))


def narrow_methods(spark: SparkSession, sf: str) -> DataFrame:
    return C.standardize(D.methods(spark, sf)).select("id", "repo_name")


@query("r1_stratified_split")
def _(spark, sf):
    return S.stratified_split(narrow_methods(spark, sf), 0.2)


@query("u2_union_splits")
def _(spark, sf):
    rows = D.token_rows(spark, sf).select(F.col("row_ord").cast("string").alias("id"), "dataset_split")
    return S.union_splits(E.select_split(rows, "train"), E.select_split(rows, "test"))


@query("r2_sample_from_large_repos")
def _(spark, sf):
    sample = S.sample_from_large_repos(prepared(spark, sf), SAMPLE_TRAIN, SAMPLE_TEST)
    return sample.select("id", "repo_name", "dataset_split", "row_ord")


@query("a7_split_report")
def _(spark, sf):
    return S.split_report(S.stratified_split(narrow_methods(spark, sf), 0.2))


# --- n-gram model -------------------------------------------------------------------------


@query("n2_pad")
def _(spark, sf):
    rows = D.token_rows(spark, sf)
    return rows.select("row_ord", N.pad(F.col("code_tokens"), 3).alias("padded"))


@query("n1_extract_ngrams")
def _(spark, sf):
    return N.extract_ngrams(D.token_rows(spark, sf), 3, keep=["row_ord"])


@query("a9_ngram_counts_n3")
def _(spark, sf):
    return N.ngram_counts(D.train_rows(spark, sf), 3).withColumn("first_seen", F.col("first_seen").cast("bigint"))


@query("a9_ngram_counts_n1")
def _(spark, sf):
    return N.ngram_counts(D.train_rows(spark, sf), 1).withColumn("first_seen", F.col("first_seen").cast("bigint"))


@query("a10_context_totals_n5")
def _(spark, sf):
    return N.unpacked(N.context_totals(N.packed_counts(D.train_rows(spark, sf), 5)))


@query("a11_vocabulary_size")
def _(spark, sf):
    return N.vocabulary_size(D.train_rows(spark, sf), 3)


@query("t3_next_token_topk")
def _(spark, sf):
    # Ungathered, so that the rank limit applies in every task before the second shuffle.
    counts = N.packed_counts(D.train_rows(spark, sf), 3, gather=False)
    return N.unpacked(N.next_token_topk(counts)).select("n", "ctx", "rank", "nxt", "c")


@query("n4_fit_context")
def _(spark, sf):
    return D.token_rows(spark, sf).select("row_ord", N.fit_context(F.col("code_tokens"), 11).alias("ctx"))


def model_for_test(spark: SparkSession, sf: str, settings: N.NGramModel) -> N.FittedNGramModel:
    return E.fit_for(settings, D.train_rows(spark, sf), D.test_rows(spark, sf))


@query("n10_train")
def _(spark, sf):
    model = N.NGramModel(3).fit(D.train_rows(spark, sf))
    return model.counts.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("ctx").alias("contexts"),
        F.sum("c").alias("occurrences"), F.lit(model.vocab_size).cast("bigint").alias("v"),
    )


@query("n10_a11_train_in_batches")
def _(spark, sf):
    rows, model = D.train_rows(spark, sf), None
    for batch in range(BATCHES):
        trained = I.train_batch(N.NGramModel(3), rows.where(F.col("row_ord") % BATCHES == batch))
        model = I.merge(model, trained) if model else trained
    fitted = model.fitted()
    v = fitted.vocab_size
    summed = stored(
        fitted.counts.agg(
            F.count(F.lit(1)).alias("pairs"), F.sum("c").alias("occurrences"),
            F.sum("first_seen").cast("string").alias("first_seen_sum"), F.lit(v).cast("bigint").alias("v"),
        )
    )
    # Four standard errors.
    close = F.abs(model.estimated_vocabulary().scalar() - v) <= 4 * 1.04 / 2 ** (I.SKETCH_BITS / 2) * v
    summed = stored(summed.withColumn("sketch_is_close", close))
    model.forget()
    return summed


@query("j2_n3_score")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(3))
    found = model.look_up(D.test_rows(spark, sf), context=True)
    return found.select(
        "ctx", "nxt", "c", "ct",
        *[
            model.with_smoothing(smoothing, k).probability(F.col("c"), F.col("ct")).alias(f"p_{name}")
            for name, smoothing, k in (("none", "none", 1.0), ("laplace", "laplace", 1.0), ("add_k", "add-k", 0.1))
        ],
    )


@query("j3_lookup_topk")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(5))
    contexts = N.extract_ngrams(D.test_rows(spark, sf), 5).select("n", "ctx").distinct()
    found = N.lookup_topk(contexts, N.candidate_lists(model.counts))
    return found.select("ctx", F.col("candidates.nxt").alias("tokens"))


@query("a12_perplexity_n3")
def _(spark, sf):
    return E.perplexity(model_for_test(spark, sf, N.NGramModel(3)), D.test_rows(spark, sf))


@query("a12_perplexity_n5_none")
def _(spark, sf):
    return E.perplexity(model_for_test(spark, sf, N.NGramModel(5, "none")), D.test_rows(spark, sf))


@query("a13_topk_accuracy_n3")
def _(spark, sf):
    return E.topk_accuracy(model_for_test(spark, sf, N.NGramModel(3)), D.test_rows(spark, sf))


@query("a13_topk_accuracy_n5")
def _(spark, sf):
    return E.topk_accuracy(model_for_test(spark, sf, N.NGramModel(5)), D.test_rows(spark, sf))


@query("a13_topk_accuracy_first")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(5))
    return E.topk_accuracy(model, D.test_rows(spark, sf), FIRST_ROWS, max_positions=FIRST_POSITIONS)


@query("a14_accuracy_first")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(5))
    return E.accuracy_by_complexity(model, D.test_rows(spark, sf), FIRST_PER_BAND, max_positions=FIRST_POSITIONS)


@query("a14_accuracy_by_complexity")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(5))
    return E.accuracy_by_complexity(model, D.test_rows(spark, sf))


def grid(spark: SparkSession, sf: str) -> DataFrame:
    return E.score_grid(D.train_rows(spark, sf), D.test_rows(spark, sf), GRID_CONFIGURATIONS)


@query("a15_score_grid")
def _(spark, sf):
    return grid(spark, sf)


@query("a15_score_grid_first")
def _(spark, sf):
    train, test = D.train_rows(spark, sf), D.test_rows(spark, sf)
    return E.score_grid(train, test, GRID_CONFIGURATIONS, FIRST_ROWS, FIRST_ROWS, max_positions=FIRST_POSITIONS)


@query("a16_best_configs")
def _(spark, sf):
    return E.best_configs(grid(spark, sf))


@query("a17_large_scale_eval")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(11))
    return E.large_scale_eval(model, D.test_rows(spark, sf))


@query("a17_large_scale_first")
def _(spark, sf):
    model = model_for_test(spark, sf, N.NGramModel(11))
    return E.large_scale_eval(model, D.test_rows(spark, sf), FIRST_ROWS, FIRST_POSITIONS)


@query("t2_head_n")
def _(spark, sf):
    return E.head_n(D.test_rows(spark, sf).select("row_ord"), FIRST_ROWS)


@query("w6_head_per_group")
def _(spark, sf):
    rows = D.test_rows(spark, sf).select(
        "row_ord", bands.complexity_band(F.col("metrics_cyclomatic_complexity")).alias("complexity")
    )
    return E.head_per_group(rows, "complexity", FIRST_PER_BAND)


# --- generation ---------------------------------------------------------------------------


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of all test rows."""
    return G.make_prompts(D.test_rows(spark, sf)).select("row_ord", "context")


def final_model(spark: SparkSession, sf: str, tries: DataFrame | None = None) -> N.FittedNGramModel:
    """The model that predicts; ``tries`` (level, ctx), where known, are all the contexts it will be asked about."""
    settings = N.NGramModel(5, "laplace")
    contexts = None if tries is None else tries.select(F.lit(settings.n).alias("n"), "ctx")
    return settings.fit(D.train_rows(spark, sf), contexts=contexts)


def prompt_tries(spark: SparkSession, sf: str) -> DataFrame:
    """What backing off may look up for any prompt; without backing off it is the first try."""
    return prompts(spark, sf).select(F.inline(G.backoff_tries(F.col("context"), 5)))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return G.prediction_rows(final_model(spark, sf), D.test_rows(spark, sf))


@query("n6_make_prompts")
def _(spark, sf):
    return prompts(spark, sf)


@query("n5_p14_predict_next")
def _(spark, sf):
    predicted = final_model(spark, sf, prompt_tries(spark, sf).where("level = 0")).predict(prompts(spark, sf))
    return predicted.select(
        "row_ord", "context", F.size("predictions").alias("n_candidates"),
        bands.format_predictions(F.col("predictions")).alias("formatted"),
    )


@query("n7_backoff_candidates")
def _(spark, sf):
    model = final_model(spark, sf, prompt_tries(spark, sf))
    found = G.backoff_candidates(prompts(spark, sf), model.candidates(), model.n)
    return found.select("row_ord", "level", F.col("candidates.token").alias("tokens"))


@query("n8_sample_next")
def _(spark, sf):
    from ..functions.randomness import uniform

    model = final_model(spark, sf, prompt_tries(spark, sf))
    found = G.backoff_candidates(prompts(spark, sf), model.candidates(), model.n)
    draw = uniform("42:step:0", F.col("row_ord"))
    return found.select("row_ord", G.sample_next(F.col("candidates"), draw).alias("token"))


@query("n9_complete")
def _(spark, sf):
    completed = final_model(spark, sf).complete(prompts(spark, sf), G.MAX_COMPLETION)
    return completed.select("row_ord", "context", "completion", F.size("steps").alias("n_steps"))


@query("p15_prediction_rows")
def _(spark, sf):
    return predictions(spark, sf)
