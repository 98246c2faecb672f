"""Column expressions for the notations in which bibliographic fields arrive. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand where an abstract is missing (compared in lower case without outer punctuation).
ABSTRACT_PLACEHOLDERS = (
    "abstract", "abstract not available", "abstract unavailable", "kein abstract verfügbar", "n/a", "na", "no abstract",
    "no abstract available", "none", "null", "tba", "tbd", "not available", "unknown", "nil",
    "pas de résumé", "résumé non disponible", "sin resumen", "nessun abstract", "geen samenvatting",
)


def plain_text(col: Column) -> Column:
    """Text without markup: tags become blanks, common entities are resolved, white space runs become one blank."""
    x = F.regexp_replace(col, r"(?s)<!--.*?-->|</?[A-Za-z][^<>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(x, r"[\s  -​ 　]+", " "))


def is_placeholder(plain: Column) -> Column:
    """True where a text (already plain) says nothing: null, empty, punctuation only, or a stock phrase."""
    core = F.lower(F.regexp_replace(plain, r"^[\s\p{P}]+|[\s\p{P}]+$", ""))
    return plain.isNull() | (core == "") | core.isin(*ABSTRACT_PLACEHOLDERS)


def doi_key(col: Column) -> Column:
    """One spelling for a DOI in any notation; null for placeholders and texts that hold none."""
    decoded = F.regexp_replace(F.regexp_replace(F.lower(F.trim(col)), "%2f", "/"), "%28|%29", "")
    found = F.regexp_extract(decoded, r"(10\.[0-9]{4,9}/[^\s\"<>]+)", 1)
    cut = F.regexp_replace(found, r"[.,;:)\]}'?!]+$", "")
    return F.when(F.length(cut) > 8, cut)


def moment(col: Column) -> Column:
    """A date text as a moment (UTC where no offset is written); null when missing or a placeholder."""
    x = F.trim(col)
    epoch = F.when(x.rlike(r"^[0-9]{9,10}$"), F.timestamp_seconds(x.try_cast("bigint")))
    millis = F.when(x.rlike(r"^[0-9]{12,13}$"), F.timestamp_millis(x.try_cast("bigint")))
    iso = F.when(x.rlike(r"^[1-9][0-9]{3}(-[0-9]{2}(-[0-9]{2}([T ][0-9:.]+ ?(Z|[+-][0-9]{2}:?[0-9]{2})?)?)?)?$"), x.try_cast("timestamp"))
    return F.coalesce(epoch, millis, iso)


def title_key(col: Column) -> Column:
    """A title for comparison: plain, lower case, without edition marks in brackets, words joined by one blank."""
    x = F.lower(plain_text(col))
    x = F.regexp_replace(x, r"[\(\[](preprint|postprint|version\s*[0-9.]+|v[0-9.]+|revised|online first)[\)\]]", " ")
    return F.trim(F.regexp_replace(x, r"[^\p{L}\p{M}\p{N}]+", " "))


def live(deleted: Column) -> Column:
    """Not trashed; null counts as live. In this form it is pushed to the scan."""
    return deleted.isNull() | ~deleted
