from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an empty text, and an element of a list literal. What is stripped from the ends of a list
# element, where the kind and the key stand in a resource identifier, and the platforms told apart (the leftmost one in a
# text wins).
EMPTY_PATTERN = r"^\s*(nan|null)?\s*$"
LIST_ELEMENT_PATTERN = r"""(\s*(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^,'"]+)\s*)(?:,|$)"""
LIST_END_PATTERN = r"^\['|'\]$|^'|'$|^\[|\]$"
URI_TYPE_PATTERN = r"\w*:(\w*):"
URI_ID_PATTERN = r"\w*:\w*:(\w*)"
PLATFORMS = ["android", "windows", "ios", "web"]


def trimmed(c: Column) -> Column:
    return F.trim(c)


def folded(c: Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(c))


def scrubbed(c: Column) -> Column:
    """Blank text and the null tokens ``nan`` and ``null`` become the empty string."""
    return F.regexp_replace(c, EMPTY_PATTERN, "")


def to_boolean(c: Column) -> Column:
    """Booleans written as text; null tokens and anything else unreadable give NULL."""
    return folded(c.cast("string")).try_cast("boolean")


def blank_if_token(c: Column, tokens: list[str]) -> Column:
    """NULL when the whole text is one of ``tokens``."""
    return F.when(~c.isin(tokens), c)


# --- list-valued text such as ['A', 'B'] ---


def list_items(c: Column, mode: str = "split") -> Column:
    """Elements of a list written as text.

    ``split`` cuts at every comma and strips brackets and single quotes, so a name holding a comma becomes two
    elements and an empty list becomes one empty string. ``literal`` honours quotes and escapes instead: it is the inverse
    of :func:`list_text`. There an unquoted None is NULL, any other unquoted element is its trimmed text, and a list
    without elements is empty.
    """
    if mode == "split":
        return F.transform(F.split(c, ",", -1), lambda x: F.regexp_replace(F.trim(x), LIST_END_PATTERN, ""))
    if mode == "literal":
        inner = F.regexp_replace(F.regexp_replace(F.trim(c), r"^\[", ""), r"\]$", "")
        found = F.regexp_extract_all(inner, F.lit(LIST_ELEMENT_PATTERN), F.lit(1))
        return F.transform(F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != ""), _element)
    raise ValueError(f"unknown list mode {mode!r}")


def _element(x: Column) -> Column:
    bare = F.regexp_replace(F.substr(x, F.lit(2), F.length(x) - 2), r"(?s)\\(.)", "$1")
    return F.when(F.substr(x, F.lit(1), F.lit(1)).isin("'", '"'), bare).when(x != "None", x)


def list_text(c: Column) -> Column:
    """An array of strings as list text: elements in single quotes, quotes and backslashes escaped, NULL as None."""
    escaped = lambda x: F.concat(F.lit("'"), F.regexp_replace(x, r"(['\\\\])", r"\\$1"), F.lit("'"))
    inner = F.array_join(F.transform(c, lambda x: F.coalesce(escaped(x), F.lit("None"))), ", ")
    return F.when(c.isNotNull(), F.concat(F.lit("["), inner, F.lit("]")))


# --- resource identifiers such as service:kind:key ---


def uri_type(c: Column) -> Column:
    return F.regexp_extract(c, URI_TYPE_PATTERN, 1)


def uri_id(c: Column) -> Column:
    return F.regexp_extract(c, URI_ID_PATTERN, 1)


def build_uri(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), c)


def platform(c: Column) -> Column:
    """The platform named in free text, or the empty string."""
    return F.regexp_extract(folded(c), "(" + "|".join(PLATFORMS) + ")", 1)
