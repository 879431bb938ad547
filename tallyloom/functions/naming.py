"""Column functions that derive names from URLs, paths and commits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source roots that end the directory part of a path, tried in this order.
SOURCE_ROOTS = ("src/main/java/", "src/java/", "src/")
COMMIT_PREFIX = 7


def _without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def repo_owner(url: Column) -> Column:
    """Second-last part of a clone URL; null when there are too few parts."""
    return F.try_element_at(F.split(url, "/"), F.lit(-2))


def repo_short_name(url: Column) -> Column:
    """Last part without any ``.git``; null when there is no owner part."""
    parts = F.split(url, "/")
    return F.when(F.size(parts) >= 2, _without(F.try_element_at(parts, F.lit(-1)), ".git"))


def clean_repo_url(url: Column, suffix_only: bool = False) -> Column:
    """The URL without ``.git``, everywhere or only at its end."""
    if suffix_only:
        return F.regexp_replace(url, F.lit(r"\.git\z"), F.lit(""))
    return _without(url, ".git")


def owner_slash_repo(url: Column) -> Column:
    """Key of the licence table: the last two parts of the cleaned URL."""
    parts = F.split(F.rtrim(_without(url, ".git"), F.lit("/")), "/")
    return F.when(
        F.size(parts) >= 2,
        F.concat_ws("/", F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))),
    )


def qualified_class_name(path: Column) -> Column:
    """Dotted class name of a file; empty for a missing path."""
    below_root = F.coalesce(
        *[
            F.when(path.contains(root), F.substr(path, F.instr(path, root) + F.lit(len(root))))
            for root in SOURCE_ROOTS
        ],
        path,
    )
    return F.coalesce(F.replace(_without(below_root, ".java"), F.lit("/"), F.lit(".")), F.lit(""))


def record_id(repo: Column, sha: Column, path: Column, start: Column, end: Column) -> Column:
    """``repo@sha7:path#start-end``."""
    return F.concat(
        repo, F.lit("@"), F.substring(sha, 1, COMMIT_PREFIX), F.lit(":"), path,
        F.lit("#"), start.cast("string"), F.lit("-"), end.cast("string"),
    )


def method_qualified_name(path: Column, method: Column) -> Column:
    """P5: ``class#method``."""
    return F.concat(qualified_class_name(path), F.lit("#"), method)
