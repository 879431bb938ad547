"""Metrics and declarations from syntax-tree node tables.

A node table is an adjacency list (``schema.NODES``).  No operator rebuilds a tree: each
is a join between nodes and their direct children, or an aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions import patterns as P
from ..functions.text import text_metrics

# Node types that add one path through the code.
BRANCH_TYPES = (
    "if_statement",
    "for_statement",
    "enhanced_for_statement",
    "while_statement",
    "do_statement",
    "catch_clause",
    "switch_label",
    "conditional_expression",
)
SHORT_CIRCUIT = ("&&", "||")
IDENTIFIER = "identifier"
DECLARATION = "method_declaration"
PARAMETERS = "formal_parameters"
UNKNOWN = "unknown"
TREE_METRICS = ("n_ast_nodes", "ast_depth", "n_identifiers", "vocab_size", "token_counts")


def with_leaf_flag(nodes: DataFrame) -> DataFrame:
    """Add ``is_leaf``: no node names this one as its parent.

    A table that has the column keeps it.  Elsewhere each node calls its parent, and what meets
    is a node and its children's calls; the shuffle is by record, so that aggregations by
    record need no other.
    """
    if "is_leaf" in nodes.columns:
        return nodes
    others = [f for f in nodes.schema if f.name not in ("record_id", "node_id")]
    kind = T.StructType(others)
    own = F.struct(F.col("node_id").alias("id"), F.struct(*[f.name for f in others]).alias("own"))
    call = F.struct(F.col("parent_id").alias("id"), F.lit(None).cast(kind).alias("own"))
    met = (
        nodes.select("record_id", F.inline(F.array_compact(F.array(own, F.when(F.col("parent_id").isNotNull(), call)))))
        .repartition("record_id")
        .groupBy("record_id", "id")
        .agg(F.any_value("own", ignoreNulls=True).alias("own"), F.count_if(F.col("own").isNull()).alias("calls"))
    )
    return met.where(F.col("own").isNotNull()).select(
        "record_id", F.col("id").alias("node_id"), "own.*", (F.col("calls") == 0).alias("is_leaf")
    )


def record_facts(
    nodes: DataFrame, branch_types: Sequence[str] = BRANCH_TYPES, order: str = "level", leaves: bool = True
) -> DataFrame:
    """All facts of each record's tree in one aggregation; what is not selected is not computed.

    Texts of leaves and identifiers are gathered as sets, and children report to their
    parents by id: an expression is a short circuit if it is binary, its second child is such
    an operator and it has a third.  Sets and lists are as large as one record's tree.
    """
    if order not in ("level", "source"):
        raise ValueError(f"unknown token order {order!r}")
    kind, text, nth = F.col("node_type"), F.col("text"), F.col("sibling_ord")
    columns = ["record_id", "node_id", "parent_id", "sibling_ord", "depth", "node_type", "text"]
    table = nodes.select(*columns, *(["is_leaf"] if leaves and "is_leaf" in nodes.columns else []))
    identifier = kind == IDENTIFIER
    if leaves:
        table = with_leaf_flag(table)
        identifier_or_leaf = F.col("is_leaf") | identifier
    else:
        identifier_or_leaf = identifier
    # Of all texts only those that are counted or listed go on.
    table = table.select(
        "record_id", "node_id", "parent_id", "depth", identifier.alias("identifier"),
        kind.isin(*branch_types).alias("branch"), (kind == "binary_expression").alias("binary"),
        ((nth == 1) & text.isin(*SHORT_CIRCUIT)).alias("operator"), (nth == 2).alias("third"),
        F.when(F.col("parent_id").isNull(), text.rlike(P.NOT_WS)).alias("has_code"),
        F.when(identifier_or_leaf, text).alias("text"), *(["is_leaf"] if leaves else []),
    )

    def ids(condition: str, name: str) -> Column:
        return F.collect_set(F.when(F.col(condition), F.col(name)))

    facts = [
        F.count(F.lit(1)).alias("n_ast_nodes"),
        F.max("depth").cast("bigint").alias("ast_depth"),
        F.size(ids("identifier", "text")).cast("bigint").alias("n_identifiers"),
        F.count_if("branch").alias("branches"),
        F.size(
            F.array_intersect(F.array_intersect(ids("binary", "node_id"), ids("third", "parent_id")), ids("operator", "parent_id"))
        ).cast("bigint").alias("short_circuits"),
        F.max("has_code").alias("has_code"),
    ]
    if leaves:
        place = ["depth", "node_id"] if order == "level" else ["node_id"]
        facts += [
            F.size(ids("is_leaf", "text")).cast("bigint").alias("vocab_size"),
            F.count_if("is_leaf").alias("token_counts"),
            F.transform(
                F.sort_array(F.collect_list(F.when(F.col("is_leaf"), F.struct(*place, "text")))), lambda x: x["text"]
            ).alias("code_tokens"),
        ]
    # Nodes move before they are gathered: a task that gathers many records first sorts and spills its nodes.
    return table.repartition("record_id").groupBy("record_id").agg(*facts).withColumn(
        "cyclomatic_complexity",
        F.when(F.col("has_code"), 1 + F.col("branches") + F.col("short_circuits")).otherwise(F.lit(0)),
    )


def tree_metrics(nodes: DataFrame) -> DataFrame:
    """A1: size, depth, distinct identifiers, leaves and distinct leaf texts per record."""
    return record_facts(nodes).select("record_id", *TREE_METRICS)


def leaf_tokens(nodes: DataFrame, order: str = "level") -> DataFrame:
    """A2: the leaf texts of each record as one array; a record without leaves has none.

    ``level``: level by level, left to right.  ``source``: as they stand in the code,
    for tables whose ``node_id`` follows the source.
    """
    return record_facts(nodes, order=order).select("record_id", "code_tokens")


def branch_complexity(nodes: DataFrame, branch_types: Sequence[str] = BRANCH_TYPES) -> DataFrame:
    """A3: 1 + branching nodes + short-circuit operators; 0 for blank source.

    The root's text is the source.
    """
    return record_facts(nodes, branch_types, leaves=False).select("record_id", "cyclomatic_complexity")


def all_metrics(nodes: DataFrame, texts: DataFrame, with_tokens: bool = False) -> DataFrame:
    """Every metric of each record; ``texts`` has ``record_id`` and ``text``.

    Nodes are read and shuffled once, for all tree metrics and the tokens together.
    """
    tokens = ["code_tokens"] if with_tokens else []
    facts = record_facts(nodes).select("record_id", *TREE_METRICS, "cyclomatic_complexity", *tokens)
    return texts.select("record_id", *text_metrics(F.col("text"))).join(facts, "record_id", "left")


def extract_declarations(nodes: DataFrame) -> DataFrame:
    """Name, signature, code and 1-based lines of every method declaration.

    The name is the last identifier among the direct children.  The signature joins the
    last parameter list to the last identifier before it.

    One aggregation: a declaration comes under its own id, an identifier or parameter list
    under its parent's, and groups without a declaration are dropped.
    """
    kind = F.col("node_type")
    own = kind == DECLARATION
    code = F.struct(
        F.col("text").alias("source_code"),
        (F.col("start_row") + 1).cast("bigint").alias("start_line"),
        (F.col("end_row") + 1).cast("bigint").alias("end_line"),
    )
    child = F.struct("sibling_ord", "text")
    gathered = (
        nodes.where(kind.isin(DECLARATION, IDENTIFIER, PARAMETERS))
        .select(
            "record_id", F.when(own, F.col("node_id")).otherwise(F.col("parent_id")).alias("node_id"),
            F.when(own, code).alias("__code"), F.when(kind == PARAMETERS, child).alias("__parameters"),
            F.when(kind == IDENTIFIER, child).alias("__name"),
        )
        # As in record_facts: what a task would gather first it would sort and spill.
        .repartition("record_id", "node_id")
        .groupBy("record_id", "node_id")
        .agg(
            F.any_value("__code", True).alias("__code"), F.max("__parameters").alias("__parameters"),
            F.collect_list("__name").alias("__names"),
        )
        .where(F.col("__code").isNotNull())
    )
    before = F.array_max(F.filter("__names", lambda x: x["sibling_ord"] < F.col("__parameters.sibling_ord")))
    unknown = F.lit(UNKNOWN)
    return gathered.select(
        "record_id", "node_id",
        F.coalesce(F.array_max("__names")["text"], unknown).alias("name"),
        F.coalesce(F.concat(F.coalesce(before["text"], unknown), F.col("__parameters.text")), unknown).alias("signature"),
        "__code.source_code", "__code.start_line", "__code.end_line",
    )


def leading_comment(nodes: DataFrame) -> DataFrame:
    """The comment directly before each declaration among named siblings, or ``''``.

    A window covers the children of one node of one file; only comment text travels.
    """
    siblings = W.partitionBy("record_id", "parent_id").orderBy("sibling_ord")
    comment = F.when(
        F.col("node_type").contains("comment"), F.regexp_replace("text", P.EDGE_WS, "")
    )
    return (
        nodes.where("is_named")
        .select("record_id", "parent_id", "node_id", "sibling_ord", "node_type", comment.alias("__comment"))
        .withColumn("doc_comment", F.coalesce(F.lag("__comment").over(siblings), F.lit("")))
        .where(F.col("node_type") == DECLARATION)
        .select("record_id", "node_id", "doc_comment")
    )
