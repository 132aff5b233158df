"""Identifiers, years and hygiene of bibliography entries as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import collapse

# Patterns of identifiers.
DOI = r"(10\.\d{4,9}/[^\s\"'<>\[\]]+)"
ARXIV_NEW = r"(?i)arXiv:\s*(\d{4}\.\d{4,5})(?:v\d+)?"
ARXIV_OLD = r"(?i)arXiv:\s*([a-z\-]+(?:\.[A-Z]{2})?/\d{7})(?:v\d+)?"
_TAIL = ".,;:"


def _none(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def doi(raw: Column) -> Column:
    """The DOI in a text: tail punctuation off, closing brackets only as far as they are opened."""
    found = F.rtrim(F.regexp_extract(raw, DOI, 1), F.lit(_TAIL))
    closing = F.length(F.regexp_extract(found, r"(\)*)$", 1))
    extra = F.regexp_count(found, F.lit(r"\)")) - F.regexp_count(found, F.lit(r"\("))
    drop = F.greatest(F.lit(0), F.least(closing, extra))
    return _none(F.substring(found, F.lit(1), F.length(found) - drop))


def arxiv(raw: Column) -> Column:
    """arXiv identifier of the new form, else of the old; no version."""
    return F.coalesce(_none(F.regexp_extract(raw, ARXIV_NEW, 1)), _none(F.regexp_extract(raw, ARXIV_OLD, 1)))


def year(raw: Column) -> Column:
    """First year 1900 to 2099 that is part of no longer number, DOI or path."""
    return F.regexp_extract(raw, r"(?:^|[^\d./])((?:19|20)\d{2})(?:[^\d]|$)", 1).try_cast("int")


def entry_number(content: Column) -> Column:
    """Number of an entry: ``[N]``, ``N.``, ``N)`` or ``N Capital``."""
    forms = (r"^\s*\[(\d{1,4})\]", r"^\s*(\d{1,4})[.\)]\s", r"^\s*(\d{1,4})\s+[A-Z]")
    return F.coalesce(*[_none(F.regexp_extract(content, p, 1)) for p in forms])


def _bare(col: Column) -> Column:
    t = F.regexp_replace(collapse(col), r"^\s*(\[\d{1,4}\]|\d{1,4}[.\)])\s+", "")
    t = F.regexp_replace(t, r"(?is)\[\s*arXiv\s*:.*$", "")
    return F.rtrim(F.btrim(F.trim(t), F.lit('" ')), F.lit(".,;:[]() \t\"'"))


def title(parsed: Column, raw: Column) -> Column:
    """A parsed title without entry number and arXiv tail; null if too short or the raw entry again."""
    t = _bare(parsed)
    return F.when((F.length(t) >= 4) & ~t.eqNullSafe(_bare(raw)), t)


def sane_year(col: Column) -> Column:
    y = col.try_cast("int")
    return F.when(y.between(1900, 2099), y)


def sane_authors(col: Column) -> Column:
    """Trimmed, without empties, at most 30."""
    return F.slice(F.filter(F.transform(col, lambda a: F.trim(a)), lambda a: a != ""), 1, 30)
