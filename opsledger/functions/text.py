"""Text expressions used by contracts and retrieval."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space (as a pattern, and as the characters themselves), and
# what ends a line.
SPACE = r"[\s\x1C-\x1F]"
# The same set spelled out, which a pattern without Unicode classes matches several times faster.
SPACE_SET = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SPACES = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_END = r"\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}"


def strip(text: Column) -> Column:
    """Remove white space at both ends (all Unicode white space, not just blanks)."""
    return F.btrim(text, F.lit(SPACES))


def heading(text: Column, marks: str) -> Column:
    """The text of a markdown heading with these marks, if the first line is one; else NULL."""
    found = F.regexp_extract(text, f"(?U)^{marks}[{SPACE}&&[^{LINE_END}]]++(.+)", 1)
    # The dot stops at most line ends; what it runs over are these few.
    line = F.split(found, r"[\x0B\f\x1C-\x1E]", 2)[0]
    return F.nullif(strip(line), F.lit(""))


def tokenize(text: Column) -> Column:
    """Lower-case words separated by white space."""
    return F.filter(F.split(F.lower(text), f"{SPACE_SET}+"), lambda word: word != "")


def extract_first(text: Column, pattern: str) -> Column:
    """First capture of `pattern`, NULL when it does not occur."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def citation(doc_title: Column, section_title: Column) -> Column:
    return F.concat_ws(" > ", doc_title, section_title)


def excerpt(text: Column, length: int = 200) -> Column:
    """The first `length` characters, with an ellipsis when something was left out."""
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def word_overlap(query: Column, text: Column) -> Column:
    """Share of the query's distinct words that occur in the text."""
    words = F.array_distinct(tokenize(query))
    found = F.size(F.array_intersect(words, tokenize(text)))
    return F.when(F.size(words) > 0, found / F.size(words)).otherwise(F.lit(0.0))
