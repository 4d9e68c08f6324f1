"""File paths, extensions, languages, line counts and repository addresses."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from repoquarry.functions.text import strip

# Source-code suffixes and their languages.
LANGUAGE_BY_EXTENSION = {
    ".py": "Python",
    ".pyx": "Cython",
    ".pxd": "Cython",
    ".pxi": "Cython",
    ".c": "C",
    ".h": "C/C++",
    ".cpp": "C++",
    ".hpp": "C++",
    ".java": "Java",
    ".js": "JavaScript",
    ".ts": "TypeScript",
    ".rs": "Rust",
    ".go": "Go",
    ".f90": "Fortran",
    ".f": "Fortran",
}
NO_EXTENSION = "[no extension]"


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def extension(path: Column) -> Column:
    """Lower-case suffix of the last path part, '' for none; dot files and a final dot have none."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def extension_label(path: Column) -> Column:
    suffix = extension(path)
    return F.when(suffix == "", NO_EXTENSION).otherwise(suffix)


def language(suffix: Column) -> Column:
    """Language of a lower-case suffix, null for anything that is not source code."""
    table = F.create_map(*map(F.lit, chain.from_iterable(LANGUAGE_BY_EXTENSION.items())))
    return F.try_element_at(table, suffix)


def line_count(text: Column) -> Column:
    """Physical lines: line feeds, plus one for a last line that has none."""
    feeds = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    open_line = (text != "") & ~F.endswith(text, F.lit("\n"))
    return (feeds + F.when(open_line, 1).otherwise(0)).cast("bigint")


def parent_folders(path: Column) -> Column:
    """Every folder above a relative path: a/b/c.py -> [a, a/b]."""
    parts = F.split(path, "/")
    depth = F.size(parts)
    return F.when(
        depth > 1,
        F.transform(F.sequence(F.lit(1), depth - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/")),
    ).otherwise(F.array().cast("array<string>"))


def repository_from_url(url: Column) -> Column:
    """Name in a GitHub address, null where the address is not one (other host, no owner/name)."""
    address = strip(url)
    host = F.lower(F.try_parse_url(address, F.lit("AUTHORITY")))
    path = F.regexp_replace(F.try_parse_url(address, F.lit("PATH")), r"^/+|/+\z", "")
    last = F.element_at(F.split(path, "/"), -1)
    ok = host.isin("github.com", "www.github.com") & path.contains("/")
    return F.when(ok, F.regexp_replace(last, r"\.git\z", ""))
