"""Text cleaning as native column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelake.fixed_values import NULL_LITERALS, WORD_DELIMITERS

_MARK = "\x01"


def title_case(text: Column, punctuation: bool = True, source: Column | None = None) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    With ``punctuation`` a word also starts after any of the fixed delimiters;
    otherwise only white space separates words. ASCII text is cased without being cut into
    words: a mark and a blank after a delimiter make ``initcap`` start a word there. ``source`` is a
    column that holds all characters of ``text``, where that one is computed from it.
    """
    source = text if source is None else source
    delimiters = re.escape(WORD_DELIMITERS) if punctuation else ""
    marked = F.regexp_replace(text, rf"([\t\n\x0B\f\r{delimiters}])(?=[A-Za-z])", f"$1{_MARK} ")
    ascii_only = (F.octet_length(source) == F.length(source)) & ~F.contains(source, F.lit(_MARK))
    pieces = F.split(F.lower(text), rf"(?<=[\s{delimiters}])")
    capital = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p))))
    return F.when(ascii_only, F.replace(F.initcap(marked), F.lit(f"{_MARK} "), F.lit(""))).otherwise(F.array_join(capital, ""))


def squeeze(text: Column) -> Column:
    """Replace each run of white space by one blank."""
    return F.regexp_replace(text, r"\s+", " ")


def clean_text(
    text: Column,
    default: str,
    collapse: bool = True,
    test_raw: bool = False,
    punctuation: bool = True,
) -> Column:
    """Trimmed, title-cased text, or ``default`` when nothing is left.

    ``collapse``  squeeze runs of white space before casing.
    ``test_raw``  look for emptiness before squeezing, so that a lone tab counts as
                  text and cleans to an empty string instead of ``default``.
    """
    body = squeeze(text) if collapse else text
    tested = text if test_raw else body
    return F.when(F.trim(F.coalesce(tested, F.lit(""))) == "", F.lit(default)).otherwise(
        title_case(F.trim(body), punctuation, text)
    )


def is_blank(text: Column, collapse: bool = True) -> Column:
    """True for NULL, empty or blank text."""
    body = squeeze(text) if collapse else text
    return F.trim(F.coalesce(body, F.lit(""))) == ""


def drop_null_literals(text: Column) -> Column:
    """NULL for the texts that stand for a missing value."""
    return F.when(~text.isin(NULL_LITERALS), text)


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def register_clean_text(spark, name: str = "clean_text") -> None:
    """Make ``clean_text(input, default_val)`` callable from SQL as a temporary SQL function."""
    squeezed = r"regexp_replace(input, '\\s+', ' ')"
    delimiters = re.escape(WORD_DELIMITERS).replace("\\", "\\\\").replace("'", "\\'")
    cased = (
        f"array_join(transform(split(lower(trim({squeezed})), '(?<=[\\\\s{delimiters}])'), "
        "p -> concat(upper(substr(p, 1, 1)), substr(p, 2))), '')"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(input STRING, default_val STRING) RETURNS STRING RETURN "
        f"CASE WHEN trim(coalesce({squeezed}, '')) = '' THEN default_val ELSE {cased} END"
    )
