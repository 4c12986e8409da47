"""String functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator controls. The look-behind keeps the
# trailing branch linear on long runs of blanks inside a text.
_BLANK = r"[\s\x1c-\x1f]"
_EDGE_BLANKS = rf"(?U)\A{_BLANK}+|(?<!{_BLANK}){_BLANK}+\z"

# Event-name clean-up, in the order it is applied.
EVENT_NAME_REPLACEMENTS = (
    ("Release", "Call"),
    ("(Projected)", ""),
    ("Pre-market", ""),
)


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(c, _EDGE_BLANKS, "")


def drop_space_pairs(c: Column) -> Column:
    """Remove each pair of spaces, left to right; an odd space stays."""
    return F.replace(c, F.lit("  "), F.lit(""))


def clean_cell_text(c: Column) -> Column:
    return drop_space_pairs(strip(c))


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def escape_lines(c: Column) -> Column:
    """Line breaks as backslash escapes, so that a value stays on one line."""
    return replace_chain(c, (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")))


def unescape_lines(c: Column) -> Column:
    """What `escape_lines` was given; doubled backslashes are read first, from the left."""
    parts = F.split(c, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: replace_chain(p, (("\\n", "\n"), ("\\r", "\r")))), "\\")


def text_block(c: Column, index: int) -> Column:
    """The block at `index` between blank lines; null when there is none."""
    return F.get(F.split(c, "\n\n", -1), F.lit(index))


def replace_chain(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal, case-sensitive replacements in the given order."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def tidy_event_name(c: Column, pairs: Sequence[tuple[str, str]] = EVENT_NAME_REPLACEMENTS) -> Column:
    return strip(replace_chain(c, pairs))


def clean_bullets(c: Column) -> Column:
    """One bullet per line, without empty lines or a blank after the bullet."""
    c = strip(F.replace(c, F.lit("•"), F.lit("\n•")))
    c = replace_chain(c, (("\n\n", "\n"), ("\n\n", "\n"), ("• ", "•")))
    return F.regexp_replace(c, r"\A\n", "")


def equals_ignore_case(c: Column, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.lower(c) == F.lower(value)


def contains_term(text: Column, term: Column) -> Column:
    """Case-sensitive substring test; a null or empty term never matches."""
    return F.coalesce(F.contains(text, term) & (term != F.lit("")), F.lit(False))


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    """Case-sensitive; no prefixes means no match."""
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.startswith(c, F.lit(prefix))
    return hit


def short_article_id(published: Column, url: Column) -> Column:
    """Ten hex digits over publication time and url.

    40 bits collide from about a million rows on: a display id, never a key.
    """
    text = F.concat(F.coalesce(published, F.lit("")), F.lit("_"), F.coalesce(url, F.lit("")))
    return F.substring(F.sha1(text), 1, 10)


def stable_id(*parts: Column) -> Column:
    """A repeatable row id: the digest of the parts, nulls kept apart from blanks."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("!")) for p in parts]
    return F.sha2(F.concat_ws("\x1f", *marked), 256)


def render(template: Column, values: Sequence[tuple[str, Column]]) -> Column:
    """Fill `{name}` placeholders one after the other.

    Put free text last: placeholders inside it are then left as they are.
    """
    for name, value in values:
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template
