"""Column functions over file paths, and glob translation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_key(path: Column) -> Column:
    """Sort key that compares path components, so ``a/b`` precedes ``a-b/c``."""
    return F.split(path, "/")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Last ``.xxx`` of the base name; empty for ``.name`` and ``name.``."""
    return F.regexp_extract(base_name(path), r"(?s).(\.[^.]+)\z", 1)


def depth(relative_path: Column) -> Column:
    """Folders between the root and the file."""
    return F.size(F.split(relative_path, "/")) - 1


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``; scheme and authority written by Spark are dropped."""
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?(?=/)", "")
    head = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?(?=/)", "", root).rstrip("/") + "/"
    return F.when(
        F.startswith(plain, F.lit(head)), F.substr(plain, F.lit(len(head) + 1))
    ).otherwise(plain)


def glob_regex(glob: str) -> str:
    """Anchored regex of a shell glob: ``*``, ``?``, ``[seq]`` and ``[!seq]``."""
    out, i = [], 0
    while i < len(glob):
        char = glob[i]
        close = glob.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif close > 0:
            body = glob[i + 1 : close]
            negated = body.startswith("!")
            body = re.sub(r"([\\\[\]&^~|])", r"\\\1", body[1:] if negated else body)
            out.append(f"[{'^' if negated else ''}{body}]")
            i = close
        else:
            out.append(re.escape(char))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def any_glob_regex(globs: list[str]) -> str:
    """One regex that matches a name fitting any of the globs."""
    return "|".join(f"(?:{glob_regex(g)})" for g in globs) or r"(?!)"
