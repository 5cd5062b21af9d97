"""Expressions over repository and file links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from notelake.functions.text import strip_blanks

# The link forms that are understood.
FILE_LINK = r"(?d)^https?://github\.com/([^/]+)/([^/]+)/blob/([^/]+)/(.+)$"
REPO_LINK = r"(?d)^https?://github\.com/([^/]+)/([^/]+?)(?:\.git)?/?$"
HOST = "https://github.com"
API_HOST = "https://api.github.com/repos"


def _groups(text: Column, pattern: str, names: tuple[str, ...]) -> Column:
    fields = [F.regexp_extract(text, pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return F.when(text.rlike(pattern), F.struct(*fields))


def file_link_parts(url: Column) -> Column:
    """struct(owner, repo, ref, path) of a file link without its fragment and query, or NULL."""
    bare = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    return _groups(bare, FILE_LINK, ("owner", "repo", "ref", "path"))


def repo_link_parts(url: Column) -> Column:
    """struct(owner, repo, repo_name) of a repository link, or NULL."""
    parts = _groups(strip_blanks(url), REPO_LINK, ("owner", "repo"))
    return F.when(
        parts.isNotNull(),
        F.struct(
            parts["owner"].alias("owner"),
            parts["repo"].alias("repo"),
            F.concat_ws("/", parts["owner"], parts["repo"]).alias("repo_name"),
        ),
    )


def repo_url(owner: Column, repo: Column) -> Column:
    """Repository link; empty when either part is missing."""
    known = (F.coalesce(owner, F.lit("")) != "") & (F.coalesce(repo, F.lit("")) != "")
    return F.when(known, F.concat_ws("/", F.lit(HOST), owner, repo)).otherwise("")


def contents_url(owner: Column, repo: Column, ref: Column, path: Column) -> Column:
    return F.concat(F.concat_ws("/", F.lit(API_HOST), owner, repo, F.lit("contents"), path),
                    F.lit("?ref="), ref)


def blob_url(repo_name: Column, ref: Column, path: Column) -> Column:
    return F.concat_ws("/", F.lit(HOST), repo_name, F.lit("blob"), ref, path)


def link_key(file_url: Column) -> Column:
    """Lower-case hexadecimal sha1 of the link."""
    return F.sha1(file_url)
