"""The operators' input tables, derived from the general-purpose tables at hand.

``documents`` stand in for methods and syntax trees, ``events`` for file changes,
``customer`` for repositories and ``nation`` for licences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import patterns as P
from ..functions import text as X
from ..functions.randomness import seeded_hash

# Node ids of a line: more than a string can hold tokens.
LINE_IDS = 1 << 32
# Whether a document is a test row: the first hex digit of its seeded hash.
TEST_DIGITS = ("0", "1", "2")
# Rows whose number these divide lack a commit hash, end before they start, were not analysed,
# or are repositories with a short URL.
NO_COMMIT, BACKWARDS, UNPARSED, SHORT_URL = 31, 29, 23, 37


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat method rows before cleaning, one per document; some fail each of the filters."""
    text, doc = F.col("text"), F.col("doc_id")
    first_word = F.regexp_extract(text, f"({P.WORD})", 1)
    lines = F.regexp_count(text, F.lit("\n")).cast("bigint") + 1
    return documents(spark, sf_dir).select(
        F.lit("train").alias("dataset_split"),
        doc.cast("string").alias("id"),
        F.concat(F.lit(" "), F.upper("source"), F.lit(" ")).alias("repo_name"),
        F.concat(F.lit("https://example.org/"), F.col("source"), F.lit(".git")).alias("repo_url"),
        F.when(doc % NO_COMMIT > 0, F.md5(doc.cast("string"))).alias("repo_commit_sha"),
        F.lit(None).cast("string").alias("repo_license"),
        F.concat(
            F.when(doc % 3 == 0, "/src/").when(doc % 3 == 1, "/src/java/").otherwise("/src/main/java/"),
            F.col("lang"), F.lit("\\D.java/"),
        ).alias("file_path"),
        F.lit("Java").alias("file_language"),
        first_word.alias("method_name"),
        F.concat(F.lit("D#"), first_word).alias("method_qualified_name"),
        (doc % 50).alias("method_start_line"),
        (doc % 50 + F.when(doc % BACKWARDS > 0, lines - 1).otherwise(F.lit(-1))).alias("method_end_line"),
        F.concat(first_word, F.lit("(  args )")).alias("method_signature"),
        text.alias("method_original_code"),
        F.lit("").alias("method_doc_comment"),
        X.split_words_and_symbols(text).alias("code_tokens"),
        F.when(doc % UNPARSED > 0, F.regexp_count(text, F.lit(",")) + 1).otherwise(F.lit(0)).cast("bigint").alias(
            "metrics_cyclomatic_complexity"
        ),
        (1 + X.nloc(text) + X.n_words(text)).alias("metrics_n_ast_nodes"),
        X.nloc(text).alias("metrics_nloc"),
        X.n_words(text).alias("metrics_n_words"),
        X.n_whitespaces(text).alias("metrics_n_whitespaces"),
        doc.alias("row_ord"),
    )


def split_of(row: Column) -> Column:
    """The split of a row, by its seeded hash."""
    return F.when(F.substring(seeded_hash(42, row), 1, 1).isin(*TEST_DIGITS), "test").otherwise("train")


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token sequences with a split: (row_ord, code_tokens, complexity, dataset_split)."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_ord"),
        X.split_words_and_symbols(F.col("text")).alias("code_tokens"),
        (F.regexp_count("text", F.lit(",")) + 1).cast("bigint").alias("metrics_cyclomatic_complexity"),
        split_of(F.col("doc_id")).alias("dataset_split"),
    )


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, sf_dir).where("dataset_split = 'train'")


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, sf_dir).where("dataset_split = 'test'")


def file_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changed files; a user's events of one day are one commit."""
    kind = F.col("event_type")
    extension = F.when(kind == "purchase", ".java").otherwise(".md")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("https://example.org/o/r"), F.col("user_id") % 10, F.lit(".git")).alias("repo_url"),
        F.concat(F.lit("r"), F.col("user_id") % 10).alias("project_name"),
        F.md5(F.concat_ws(":", "user_id", F.to_date("ts"))).alias("commit_sha"),
        F.col("ts").alias("committed_ts"),
        F.concat(kind, extension).alias("new_path"),
        F.when(kind != "error", F.col("props")).alias("source_code"),
        "event_id",
        "user_id",
    )


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as repositories of nations; market segments are languages."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(
            key % SHORT_URL > 0,
            F.concat(F.lit("https://example.org/n"), F.col("c_nationkey"), F.lit("/r"), key, F.lit(".git")),
        ).otherwise(F.concat(F.lit("r"), key)).alias("clone_url"),
        F.lower("c_mktsegment").alias("language"),
        F.floor("c_acctbal").alias("stars"),
        (key % 7 == 0).alias("fork"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 400).cast("int")).alias("pushed_at"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("owner"),
        key.alias("c_custkey"),
    )


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One licence per repository of the nations in three regions."""
    licensed = table(spark, sf_dir, "nation").where("n_regionkey < 3")
    owners = licensed.select("n_nationkey", F.lower("n_name").alias("license_key"))
    customers = table(spark, sf_dir, "customer")
    return customers.join(owners, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("n"), F.col("c_nationkey"), F.lit("/r"), F.col("c_custkey")).alias("owner_repo"),
        "license_key",
    )


def document_nodes(spark: SparkSession, sf_dir: str, branching: bool = False) -> DataFrame:
    """Trees of depth 3: document, its lines with any text, their tokens.

    A short line is a comment, any other a declaration, and a comma stands for its
    parameter list.  With ``branching``, a line whose second token is a comma or a full
    stop is an expression with the operator ``&&`` or ``||``, and any other line with a
    comma is an ``if``.  Ids are made of positions, so they grow from left to right.
    """
    record = F.col("doc_id").cast("string").alias("record_id")
    docs = documents(spark, sf_dir)
    root = docs.select(
        record,
        F.lit(0).cast("bigint").alias("node_id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(0).alias("sibling_ord"),
        F.lit(1).alias("depth"),
        F.lit("program").alias("node_type"),
        F.lit(True).alias("is_named"),
        "text",
        F.lit(0).alias("start_row"),
        F.regexp_count("text", F.lit("\n")).alias("end_row"),
        (~F.col("text").rlike(P.NOT_WS)).alias("is_leaf"),
    )
    lines = (
        docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("row", "line"))
        .where(F.col("line").rlike(P.NOT_WS))
        .withColumn("line_id", (F.col("row").cast("bigint") + 1) * LINE_IDS)
    )
    kind = F.when(X.n_words(F.col("line")) < 5, "comment").otherwise("method_declaration")
    operator = F.lit(None).cast("string")
    if branching:
        second = F.try_element_at(X.split_words_and_symbols(F.col("line")), F.lit(2))
        kind = (
            F.when(second.isin(",", "."), "binary_expression")
            .when(F.col("line").contains(","), "if_statement")
            .otherwise(kind)
        )
        operator = F.when(F.col("token") == ",", "&&").when(F.col("token") == ".", "||")
    line_nodes = lines.select(
        record,
        F.col("line_id").alias("node_id"),
        F.lit(0).cast("bigint").alias("parent_id"),
        F.col("row").alias("sibling_ord"),
        F.lit(2).alias("depth"),
        kind.alias("node_type"),
        F.lit(True).alias("is_named"),
        F.col("line").alias("text"),
        F.col("row").alias("start_row"),
        F.col("row").alias("end_row"),
        F.lit(False).alias("is_leaf"),
    )
    is_word = F.col("token").rlike(P.WORD)
    token_nodes = lines.select(
        "doc_id", "line_id", "row", F.posexplode(X.split_words_and_symbols(F.col("line"))).alias("pos", "token")
    ).select(
        record,
        (F.col("line_id") + F.col("pos") + 1).alias("node_id"),
        F.col("line_id").alias("parent_id"),
        F.col("pos").alias("sibling_ord"),
        F.lit(3).alias("depth"),
        F.when(is_word, "identifier").when(F.col("token") == ",", "formal_parameters")
        .otherwise("punctuation").alias("node_type"),
        is_word.alias("is_named"),
        F.coalesce(operator, "token").alias("text"),
        F.col("row").alias("start_row"),
        F.col("row").alias("end_row"),
        F.lit(True).alias("is_leaf"),
    )
    return root.unionByName(line_nodes).unionByName(token_nodes)


# What separates a page into tags and text, and elements that stay open.  A script
# or style with its body is one part: markup inside it is not the page's.
SCRIPT_OR_STYLE = r"<(?:script|style)\b[^>]*>.*?</(?:script|style)>"
TAG_OR_TEXT = rf"(?s){SCRIPT_OR_STYLE}|<[^>]+>|[^<]+"
CLOSED = "</(script|style)>$"
NEVER_CLOSED = ("br", "meta", "b")


def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of varying depth from the tags of web pages.

    An opening tag holds what follows until a closing tag; which one is not looked at, since
    pages leave tags open.  Text is an identifier, a markup comment a comment, a whole script
    or style a leaf.  Windows cover one page each.
    """
    parts = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("record_id"),
        F.posexplode(F.regexp_extract_all("html", F.lit(TAG_OR_TEXT), F.lit(0))).alias("pos", "part"),
    )
    tag = F.regexp_extract("part", "^<([a-zA-Z0-9]+)", 1)
    opens = (tag != "") & ~tag.isin(*NEVER_CLOSED) & ~F.col("part").rlike(CLOSED)
    change = F.when(opens, 1).when(F.col("part").startswith("</"), -1).otherwise(0)
    earlier = W.partitionBy("record_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    level = F.greatest(F.coalesce(F.sum(change).over(earlier), F.lit(0)), F.lit(0)).cast("int") + 2
    kind = (
        F.when(tag != "", tag).when(F.col("part").startswith("<!"), "comment").otherwise("identifier")
    )
    nodes = parts.select("*", level.alias("depth"), kind.alias("node_type")).where(
        ~F.col("part").startswith("</")
    )
    # A node's parent is the last node before it one level up: both meet at that level.
    meeting = nodes.select("*", F.inline(F.array(
        F.struct(F.col("depth").alias("at"), F.lit(True).alias("as_parent")),
        F.struct((F.col("depth") - 1).alias("at"), F.lit(False).alias("as_parent")),
    )))
    before = W.partitionBy("record_id", "at").orderBy("pos")
    above = F.last(F.when(F.col("as_parent"), F.col("pos") + 1), ignorenulls=True).over(before)
    children = meeting.withColumn("above", above).where(~F.col("as_parent"))
    siblings = W.partitionBy("record_id", "parent_id").orderBy("node_id")
    below = children.select(
        "record_id",
        (F.col("pos") + 1).cast("bigint").alias("node_id"),
        F.when(F.col("depth") == 2, 0).otherwise(F.col("above")).cast("bigint").alias("parent_id"),
        "depth",
        "node_type",
        F.lit(True).alias("is_named"),
        F.col("part").alias("text"),
        F.col("pos").alias("start_row"),
        F.col("pos").alias("end_row"),
    ).withColumn("sibling_ord", F.row_number().over(siblings) - 1)
    root = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("record_id"),
        F.lit(0).cast("bigint").alias("node_id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(1).alias("depth"),
        F.lit("program").alias("node_type"),
        F.lit(True).alias("is_named"),
        F.col("html").alias("text"),
        F.lit(0).alias("start_row"),
        F.lit(0).alias("end_row"),
        F.lit(0).alias("sibling_ord"),
    )
    return root.unionByName(below)
