"""Column functions over text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that Java leaves out of it.
_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# Letters, numbers and underscore; Java's own \w would add combining marks.
WORD = r"[\p{L}\p{N}_]"


def _text(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def norm_ws(col: Column | str) -> Column:
    """Every run of white space becomes one space; none is left at the ends."""
    return F.trim(F.regexp_replace(_text(col), _WHITESPACE, " "))


def pub_year(date: Column | str, entered: Column | str) -> Column:
    """First four characters of the publication date, else of the entry date."""
    return F.substring(F.coalesce(F.nullif(_text(date), F.lit("")), _text(entered)), 1, 4)


def field_default(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing text becomes "", a missing number 0, a missing list the empty list."""
    fills = {}
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        kind = field.dataType.typeName()
        if kind == "array":
            fills[field.name] = F.coalesce(field.name, F.array().cast(field.dataType))
        elif kind == "string":
            fills[field.name] = F.coalesce(field.name, F.lit(""))
        elif kind in ("integer", "long", "double", "float", "short", "byte"):
            fills[field.name] = F.coalesce(field.name, F.lit(0).cast(field.dataType))
    return df.withColumns(fills)


def join_list(items: Column | str, separator: str = " | ") -> Column:
    return F.concat_ws(separator, items)


def build_text(title: Column | str = "title", abstract: Column | str = "abstract") -> Column:
    """Text the classifier reads."""
    return F.concat(_text(title), F.lit(" \n "), _text(abstract))


def build_flag_text(title: Column | str = "title", abstract: Column | str = "abstract") -> Column:
    """Lower-cased text the pattern flags read."""
    return F.lower(F.concat(_text(title), F.lit("\n"), _text(abstract)))


def length_flag(abstract: Column | str = "abstract", limit: int = 250) -> Column:
    """1 where the abstract has more than ``limit`` characters."""
    return (F.char_length(_text(abstract)) > limit).cast("int")


def unicode_regex(pattern: str) -> str:
    r"""Give ``\b``, ``\w`` and ``\W`` one Unicode meaning on every Java version."""
    before, after = f"(?<!{WORD})", f"(?!{WORD})"
    either = f"(?:{before}(?={WORD})|(?<={WORD}){after})"

    def translated(match: re.Match) -> str:
        if match.group(1) == "w":
            return WORD
        if match.group(1) == "W":
            return r"[^\p{L}\p{N}_]"
        if match.group(1) != "b":
            return match.group(0)
        # Beside a plain letter or digit only the other side has to be looked at.
        if re.match(r"[A-Za-z0-9](?![?*{])", pattern[match.end() :]):
            return before
        if re.search(r"(?<!\\)[A-Za-z0-9]\Z", pattern[: match.start()]):
            return after
        return either

    return re.sub(r"\\(.)", translated, pattern)


def text_flags(
    df: DataFrame,
    patterns: Mapping[str, str],
    literals: Mapping[str, Sequence[str]] | None = None,
    title: str = "title",
    abstract: str = "abstract",
    fold_case: bool = False,
) -> DataFrame:
    """Add one 0/1 column per pattern, searched in the flag text.

    ``literals[name]`` lists strings of which every match holds at least one. They
    are a cheap test before the regex; a pattern without an entry goes straight to
    the regex. Text is lower-cased, so an upper-case alternative never matches
    unless ``fold_case`` is set.
    """
    literals = literals or {}
    source = F.col("_flag_text")
    flags = {}
    for name, pattern in patterns.items():
        hit = source.rlike(("(?iu)" if fold_case else "") + unicode_regex(pattern))
        likely = None
        for literal in literals.get(name, ()):
            found = source.contains(literal.lower() if fold_case else literal)
            likely = found if likely is None else likely | found
        flags[name] = (hit if likely is None else likely & hit).cast("int")
    kept = df.columns
    return df.withColumn("_flag_text", build_flag_text(title, abstract)).select(
        *kept, *(flag.alias(name) for name, flag in flags.items())
    )
