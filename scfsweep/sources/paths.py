"""Where a row came from, read off the file source's own metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unescaped(text: Column) -> Column:
    """Undoes the URL escapes of metadata paths, where a plus sign stands for itself."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def file_path(column: str = "_metadata.file_path") -> Column:
    """Path of the row's file."""
    return unescaped(F.col(column))


def roots_of(root: str | list[str]) -> list[str]:
    return [root] if isinstance(root, str) else list(root)


def _fixed(path: str) -> bool:
    return not any(c in path for c in "*?[{")


def one_folder(root: str | list[str]) -> bool:
    """Whether folders directly below ``root`` are told apart by their names alone."""
    roots = roots_of(root)
    return len(roots) == 1 and _fixed(roots[0])


def named_apart(path: str | list[str]) -> bool:
    """Whether the folders of the files at ``path`` are: one path, of which only the last folder varies."""
    folder = roots_of(path)[0].rstrip("/")
    if "." in folder.rpartition("/")[2]:
        folder = folder.rpartition("/")[0]
    return len(roots_of(path)) == 1 and _fixed(folder.rpartition("/")[0])


def run_key(by_name: bool, levels: int = 1, column: str = "_metadata.file_path") -> Column:
    """Key of the folder ``levels`` above the row's file: its name, or where names may repeat its path."""
    if by_name:
        return folder_above(levels, column)
    path = F.regexp_replace(F.col(column), f"(/[^/]*){{{levels}}}$", "")
    return F.coalesce(unescaped(path), F.lit(""))


def folder_above(levels: int = 1, column: str = "_metadata.file_path") -> Column:
    """Name of the folder ``levels`` above the row's file.

    Never NULL, so a join on it adds no per-row test to the scan.
    """
    tail = F.substring_index(F.col(column), "/", -(levels + 1))
    return F.coalesce(unescaped(F.substring_index(tail, "/", 1)), F.lit(""))
