"""Paths: globs as regular expressions, types of members, names of archives."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCHIVE_SUFFIX = "transportrsm.fpkg.e2d.zip"
ARCHIVE_NAME = r"(?i)^((\d+)_(\d{8}_\d{6})(?:_\d+)?)_TransportRSM"


def normal(path: str) -> str:
    """Forward slashes, without empty or dot parts."""
    slashed = path.replace("\\", "/")
    kept = "/".join(p for p in slashed.split("/") if p not in ("", "."))
    return "/" + kept if slashed.startswith("/") else kept


def normal_path(path: Column) -> Column:
    p = F.regexp_replace(F.regexp_replace(path, r"\\", "/"), "/+", "/")
    return F.regexp_replace(F.regexp_replace(p, r"(^|/)(?:\./)+", "$1"), r"(.)/\.?$", "$1")


def glob_regex(pattern: str) -> str:
    """A glob that is anchored at the right, whose * and ? stay within a part, as a regular expression."""
    body = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in pattern)
    return f"(^|/){body}$"


def matches(path: str, pattern: str) -> bool:
    return re.search(glob_regex(pattern), normal(path)) is not None


def first_match(path: Column, named: list[tuple[str, tuple[str, ...]]], otherwise: str) -> Column:
    """The name of the first entry one of whose globs matches, as one CASE that needs no join."""
    def one(p: Column) -> Column:
        out = None
        for name, patterns in named:
            # most paths are told from a pattern by how it ends, without a regular expression
            test = None
            for x in patterns:
                own = p.endswith(re.split(r"[*?]", x)[-1]) & p.rlike(glob_regex(x))
                test = own if test is None else test | own
            out = F.when(test, name) if out is None else out.when(test, name)
        return F.lit(otherwise) if out is None else out.otherwise(otherwise)

    # a bound variable, so that the path is made normal once
    return F.get(F.transform(F.array(normal_path(path)), one), F.lit(0))


def locator_key(path: Column) -> Column:
    """Paths that differ in case only are one locator."""
    return F.lower(path)


def archive_key(path: Column) -> Column:
    return F.nullif(F.regexp_extract(base_name(path), ARCHIVE_NAME, 1), F.lit(""))


def buno(path: Column) -> Column:
    return F.nullif(F.regexp_extract(base_name(path), ARCHIVE_NAME, 2), F.lit(""))


def archive_datetime(path: Column) -> Column:
    return F.try_to_timestamp(F.nullif(F.regexp_extract(base_name(path), ARCHIVE_NAME, 3), F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def base_name(path: Column) -> Column:
    return F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)


def schema_class(name: Column, protected: tuple[str, ...], disposable: tuple[str, ...]) -> Column:
    """PROTECTED_SHARED, DISPOSABLE or CUSTOM, without regard to case; null for a name that isn't a plain identifier."""
    low = F.lower(name)
    globs = "|".join(glob_regex(p.lower()).replace("(^|/)", "^") for p in disposable) or "(?!)"
    return F.when(~name.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), None).when(low.isin([p.lower() for p in protected]), "PROTECTED_SHARED").when(low.rlike(globs), "DISPOSABLE").otherwise("CUSTOM")
