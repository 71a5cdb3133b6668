"""Small builders and readers of tables that tests share."""

from __future__ import annotations


def uri(value):
    return (value, "uri", None, None)


def lit(value, lang=None):
    return (value, "literal", lang, None)


def rows(df, *names):
    """Sorted tuples of a small result."""
    picked = df.select(*names) if names else df
    return sorted(map(tuple, picked.collect()), key=repr)
