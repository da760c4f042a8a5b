"""Domain normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (raw strings: the backslash reaches the regex engine, so
# ``\.`` is a literal dot, which is the stated intent of the rules).
SCHEME_AND_WWW = r"^(https?://)?(www\.)?"
PATH_SUFFIX = r"/.*$"
FIRST_LABEL = r"^[^.]*\."
FIRST_OF_THREE_LABELS = r"^[^.]*\.(?=[^.]+\.[^.]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_domain(c, fold_case_first: bool = False) -> Column:
    """NULL/blank -> NULL; else trim, drop scheme and ``www.``, drop the path, lower-case.

    By default lower-casing happens last (the source rules), so an upper-case
    scheme is not stripped; ``fold_case_first=True`` lower-cases first.
    """
    c = _col(c)
    trimmed = F.trim(c)
    src = F.lower(trimmed) if fold_case_first else trimmed
    stripped = F.regexp_replace(F.regexp_replace(src, SCHEME_AND_WWW, ""), PATH_SUFFIX, "")
    return F.when(c.isNull() | (trimmed == ""), F.lit(None).cast("string")).otherwise(F.lower(stripped))


def root_domain(c, fold_case_first: bool = False, keep_two_labels: bool = False) -> Column:
    """Standardized domain without its first label (``blog.ex.com`` -> ``ex.com``).

    By default ``ex.com`` becomes ``com`` (the source rules);
    ``keep_two_labels=True`` only strips when at least three labels remain."""
    pattern = FIRST_OF_THREE_LABELS if keep_two_labels else FIRST_LABEL
    return F.regexp_replace(standardize_domain(c, fold_case_first), pattern, "")
