"""From repositories and file changes to method records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import naming
from ..schema import METRIC_NAMES
from .ordinals import first_in_order, join_on, with_block

# Defaults of a mining run.
LANGUAGE = "java"
MIN_STARS = 5000
CHUNK_SIZE = 5000
RECORD_LANGUAGE = "Java"


def search_repos(
    repos: DataFrame, since: date, to: date, language: str = LANGUAGE, min_stars: int = MIN_STARS
) -> DataFrame:
    """Clone URLs of popular, recently pushed, original repositories, most stars first."""
    wanted = repos.where(
        (F.lower("language") == language.lower())
        & (F.col("stars") > min_stars)
        & ~F.col("fork")
        & F.col("pushed_at").between(F.lit(since).cast("date"), F.lit(to).cast("date"))
    )
    return wanted.orderBy(F.col("stars").desc(), F.col("clone_url")).select("clone_url", "stars")


def scan_changes(
    file_changes: DataFrame,
    since: datetime,
    to: datetime,
    ext: str = ".java",
    strict_ext: bool = False,
) -> DataFrame:
    """File changes of the commits in a period that touch a file of the type.

    All files of such a commit are returned, whatever their type, unless ``strict_ext``.
    """
    in_period = file_changes.where(F.col("committed_ts").between(F.lit(since), F.lit(to)))
    of_type = in_period.where(F.col("new_path").endswith(ext))
    if strict_ext:
        return of_type
    commits = of_type.select("repo_url", "commit_sha").distinct()
    return join_on(in_period, commits, ["repo_url", "commit_sha"], "left_semi")


def has_source(file_changes: DataFrame, source: str = "source_code") -> DataFrame:
    """changes that leave a file with content."""
    return file_changes.where(F.col(source).isNotNull() & (F.col(source) != ""))


def parse_repo_urls(repos: DataFrame, url: str = "clone_url") -> DataFrame:
    """Owner, repository name and output folder; URLs without both parts are dropped."""
    return (
        repos.withColumn("owner", naming.repo_owner(F.col(url)))
        .withColumn("repo", naming.repo_short_name(F.col(url)))
        .where(F.col("owner").isNotNull() & F.col("repo").isNotNull())
        .withColumn("repo_dir", F.concat_ws("--", "owner", "repo"))
    )


def attach_license(records: DataFrame, licenses: DataFrame, url: str = "repo_url") -> DataFrame:
    """Licence key of each record's repository; null where unknown.

    No broadcast hint: Spark broadcasts the licence table when its measured size allows
    and otherwise joins by key, splitting a repository that dominates.
    """
    known = licenses.groupBy("owner_repo").agg(F.min("license_key").alias("license_key"))
    return (
        records.withColumn("__owner_repo", naming.owner_slash_repo(F.col(url)))
        .join(known.withColumnRenamed("owner_repo", "__owner_repo"), "__owner_repo", "left")
        .drop("__owner_repo")
    )


def coalesce_metric_shape(df: DataFrame) -> DataFrame:
    """The nine metrics as flat columns, from nested metric structs or flat counters.

    ``ast_metrics`` is always nested.  Text counters come from ``text_metrics`` where that
    is present; otherwise from flat columns, 0 when missing, and the token count falls
    back to the number of tokens.
    """
    nested = "text_metrics" in df.columns
    use_nested = F.col("text_metrics").isNotNull() if nested else F.lit(False)

    def flat(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    def pick(name: str, struct: str, default: Column) -> Column:
        if not nested:
            return flat(name, default)
        return F.when(use_nested, F.col(f"{struct}.{name}")).otherwise(flat(name, default))

    n_tokens = F.size("ast_metrics.code_tokens").cast("bigint")
    zero = F.lit(0).cast("bigint")
    text = {m: pick(m, "text_metrics", zero) for m in ("n_whitespaces", "n_words", "nloc")}
    tree = {m: F.col(f"ast_metrics.{m}") for m in ("n_ast_nodes", "ast_depth", "n_identifiers", "vocab_size")}
    metrics = {
        "cyclomatic_complexity": F.col("cyclomatic_complexity"),
        **tree,
        **text,
        "token_counts": pick("token_counts", "ast_metrics", n_tokens),
    }
    dropped = {"text_metrics", "ast_metrics", *METRIC_NAMES}
    return df.select(
        *[c for c in df.columns if c not in dropped],
        F.col("ast_metrics.code_tokens").alias("code_tokens"),
        *[metrics[m].alias(m) for m in METRIC_NAMES],
    )


def build_record(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The nested record of each method, and the columns to ``keep`` beside it.

    Input columns: ``project_name, repo_url, commit_sha, license_key, new_path, name,
    signature, start_line, end_line, source_code, doc_comment, code_tokens`` and the metrics.
    """
    path = F.col("new_path")
    return df.select(
        F.lit("train").alias("dataset_split"),
        naming.record_id(
            F.col("project_name"), F.col("commit_sha"), path, F.col("start_line"), F.col("end_line")
        ).alias("id"),
        F.struct(
            F.col("project_name").alias("name"),
            naming.clean_repo_url(F.col("repo_url")).alias("url"),
            F.col("commit_sha").alias("commit_sha"),
            F.col("license_key").alias("license"),
        ).alias("repo"),
        F.struct(path.alias("path"), F.lit(RECORD_LANGUAGE).alias("language")).alias("file"),
        F.struct(
            F.col("name"),
            naming.method_qualified_name(path, F.col("name")).alias("qualified_name"),
            F.col("start_line"),
            F.col("end_line"),
            F.col("signature"),
            F.col("source_code").alias("original_code"),
            F.col("doc_comment"),
        ).alias("method"),
        "code_tokens",
        F.struct(*METRIC_NAMES).alias("metrics"),
        *keep,
    )


def mining_cap(
    df: DataFrame,
    n: int | None,
    repo_order: Sequence[Column] = (),
    repo: Sequence[str] = ("repo_url",),
    order: Sequence[Column] = (),
) -> DataFrame:
    """The first ``n`` methods in traversal order, repository by repository; all for ``None``.

    ``repo`` names the columns ``repo_order`` sorts by; ``order`` sorts inside a repository,
    ascending.
    """
    if n is None:
        return df
    return first_in_order(df, n, repo, repo_order or [F.col(r).asc() for r in repo], order)


def chunk_number(
    df: DataFrame, repo: Sequence[str], order: Sequence[Column], chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """The output chunk of each method, from its place inside its repository, in ascending ``order``."""
    return with_block(df, order, repo, chunk_size, "chunk")


def mining_report(df: DataFrame, repo: str = "repo_url", chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Methods and chunks per repository, and the grand total (``is_total``)."""
    counted = df.rollup(repo).agg(
        F.count(F.lit(1)).alias("methods"), F.grouping(repo).cast("int").alias("is_total")
    )
    chunks = F.when(F.col("is_total") == 0, F.floor((F.col("methods") - 1) / chunk_size) + 1)
    return counted.select(repo, "methods", chunks.alias("chunks"), "is_total")
