"""String expressions; all of them run in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Typographic characters and their ASCII forms.
TYPOGRAPHIC, ASCII = "‘’“”–— ", "''\"\"-- "
ORDINAL = r"^([0-9]+)(?:st|nd|rd|th)\)?$"


def to_ascii(c: Column) -> Column:
    return F.translate(c, TYPOGRAPHIC, ASCII)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"\s+", " "))


def strip_html(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " ")


def quote_pattern(s: str) -> str:
    """A regular expression for exactly this text, in Java and in RE2."""
    return re.sub(r"([^\w\s])", r"\\\1", s)


def replace_ignoring_case(c: Column, old: str, new: str) -> Column:
    """Every occurrence of a literal, whatever its case."""
    return F.regexp_replace(c, f"(?i){quote_pattern(old)}", new.replace("\\", "\\\\").replace("$", "\\$")) if old else c


def ordinal_level(c: Column) -> Column:
    """'1st' to 1, '9th)' to 9; null if it is no ordinal."""
    return F.when(F.lower(strip(c)).rlike(ORDINAL), F.regexp_extract(F.lower(strip(c)), ORDINAL, 1).try_cast("int"))


def toc_line(c: Column) -> Column:
    """struct<title, page> of a line 'Title ..... 12', null if it is none.

    The page is the number at the end, not 0; page lists and dot leaders before
    it go; the line has five characters at least.
    """
    line = strip(c)
    page = F.regexp_extract(line, r"([0-9]+)$", 1).try_cast("int")
    rest = F.rtrim(F.regexp_replace(line, r"[0-9]+$", ""))
    rest = F.when(rest.rlike(r",(\s*[0-9]+)?$"), F.regexp_replace(rest, r"[\s,0-9]+$", "")).otherwise(rest)
    title = strip(F.regexp_replace(rest, r"[\s.…]+$", ""))
    return F.when((F.length(line) >= 5) & (page > 0) & (F.length(title) > 0), F.struct(title.alias("title"), page.alias("page")))


def clean_for_matching(c: Column) -> Column:
    """A heading without marks, a parenthesis at its end, and a final 'reversible'."""
    bare = F.regexp_replace(F.regexp_replace(strip(c), r"^#+\s*", ""), r"\*", "")
    bare = F.regexp_replace(bare, r"\s*\([^)]*\)\s*$", "")
    return strip(F.regexp_replace(bare, r"(?i)\s*reversible\s*$", ""))


def without_leading_title(content: Column, title: Column) -> Column:
    """Content behind its own title, whatever the case and spacing, and a colon."""
    squeezed = squeeze(F.lower(title))
    pattern = F.concat(F.lit(r"(?i)^\s*"), F.regexp_replace(F.regexp_replace(squeezed, r"([^\p{L}\p{N}\s])", r"\\$1"), r"\s+", r"\\s+"), F.lit(r"\s*:?\s*"))
    return F.when(F.length(squeezed) > 0, F.regexp_replace(content, pattern, F.lit(""))).otherwise(content)


def field_line(content: Column, field: str) -> Column:
    """The rest of the first line that begins with 'field:'; null if there is none or it is empty."""
    found = F.regexp_extract(content, rf"(?im)^[ \t]*{quote_pattern(field)}:[ \t]*([^\n]*)$", 1)
    return F.nullif(strip(found), F.lit(""))


def field_anywhere(content: Column, field: str) -> Column:
    """What follows the first 'field:' in its line; '' if there is none."""
    return F.coalesce(strip(F.regexp_extract(content, rf"(?i){quote_pattern(field)}:([^\n]*)", 1)), F.lit(""))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.translate(F.lower(c), " ", "_"), "[^a-z0-9_]", "")


def slugs(c: Column) -> Column:
    """A comma list as slugs."""
    return F.filter(F.transform(F.split(c, ","), lambda x: slug(F.trim(x))), lambda x: x != "")


def occurrences(c: Column, needle: Column) -> Column:
    """How often a text holds another, without overlaps, both squeezed and lower-cased; 9999 for an empty one."""
    hay, pin = squeeze(F.lower(c)), squeeze(F.lower(needle))
    count = (F.length(hay) - F.length(F.replace(hay, pin, F.lit("")))) / F.length(pin)
    return F.when(F.length(pin) == 0, 9999).otherwise(count.cast("int"))


def whole_word_position(c: Column, word: str) -> Column:
    """1-based place of the first occurrence with no letter or digit beside it; 0 if there is none."""
    pattern = rf"(?i)(?<![\p{{L}}\p{{N}}]){quote_pattern(word)}(?![\p{{L}}\p{{N}}])"
    before = F.get(F.split(c, pattern, 2), F.lit(0))
    return F.when(c.rlike(pattern), F.length(before) + 1).otherwise(0)


def word_context(c: Column, word: str, before: int = 40, behind: int = 80) -> Column:
    """What surrounds the first whole occurrence of a word, out to the next spaces; null if there is none.

    White space is folded to single spaces first, and the word's case counts.
    """
    w = " ".join(word.split())
    folded = squeeze(c)
    pattern = rf"(?<![\p{{L}}\p{{N}}]){quote_pattern(w)}(?![\p{{L}}\p{{N}}])"
    at = F.length(F.get(F.split(folded, pattern, 2), F.lit(0))) + 1  # 1-based
    begin = F.greatest(F.lit(1), at - before)
    left = F.substring(folded, F.lit(1), begin - 1)
    start = F.length(left) - F.length(F.substring_index(left, " ", -1)) + 1
    rest = F.substring(folded, at + len(w) + behind, F.length(folded))
    end = at + len(w) - 1 + behind + F.length(F.substring_index(rest, " ", 1))
    return F.when(folded.rlike(pattern) & F.lit(bool(w)), F.trim(F.substring(folded, start, end - start + 1)))


def line_at(c: Column, pos: Column) -> Column:
    """The line that holds the 1-based place ``pos``."""
    before = F.substring(c, F.lit(1), pos - 1)
    start = F.length(before) - F.length(F.substring_index(before, "\n", -1)) + 1
    return F.substring_index(F.substring(c, start, F.length(c)), "\n", 1)


def begins_paragraph(c: Column, pos: Column) -> Column:
    """Whether a blank line, or nothing, stands within five characters before the 1-based place."""
    return (pos <= 1) | F.substring(c, F.greatest(F.lit(1), pos - 5), F.least(F.lit(5), pos - 1)).contains("\n\n")


def begins_line(c: Column, pos: Column) -> Column:
    return F.substring(c, F.lit(1), pos - 1).rlike(r"(^|\n)[ \t]*$")


def heading_score(c: Column, pos: Column, title: Column) -> Column:
    """3: a line begins with the title there; 2: in a short line; 1: a line begins there; 0: none of that."""
    line = line_at(c, pos)
    return (
        F.when(begins_line(c, pos) & F.startswith(F.lower(strip(line)), F.lower(title)), 3)
        .when(F.length(strip(line)) <= F.length(title) + 20, 2)
        .when(begins_line(c, pos), 1)
        .otherwise(0)
    )


def rejoin_hyphens(c: Column) -> Column:
    """Words that a line break cut are whole again if they go on in lower case."""
    return F.regexp_replace(to_ascii(c), r"-[ \t]*\n[ \t]*(?=\p{Ll})", "")


def rejoin_hyphens_loose(c: Column) -> Column:
    """The older rule: no images, and every hyphen at a line's end goes."""
    return F.regexp_replace(F.regexp_replace(c, r"!\[[^\]]*\]\([^)]*\)", ""), r"(\w)-\s*\n\s*(\w)", "$1$2")


def matches_any(c: Column, patterns: list[str]) -> Column:
    """Whether one of the patterns matches at the beginning, whatever the case."""
    return c.rlike("(?i)^(?:" + "|".join(patterns) + ")") if patterns else F.lit(False)


def contains_any(c: Column, words: list[str]) -> Column:
    """Whether the lower-cased text holds one of the words."""
    out = F.lit(False)
    for w in words:
        out = out | F.lower(c).contains(w.lower())
    return out


def contains_all(c: Column, words: list[str]) -> Column:
    out = F.lit(bool(words))
    for w in words:
        out = out & F.lower(c).contains(w.lower())
    return out


def search_words(query: str, least: int = 3) -> list[str]:
    """The words of a search that count: lower-cased, of three letters at least."""
    return [w for w in query.lower().split() if len(w) >= least]


def link_table_references(c: Column, prefix: str = "#table-") -> Column:
    """'Table 12' as a link to its anchor."""
    return F.regexp_replace(c, r"\bTable\s+([0-9]+)\b", f"[Table $1]({prefix}$1)")


def duration_text(seconds: Column) -> Column:
    """Seconds as '5s', '2m 5s' or '1h 2m'."""
    s = F.floor(seconds).cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh %dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))


def unknown_words(c: Column) -> Column:
    """Lower-cased words of three letters or more, without punctuation at their ends."""
    words = F.transform(F.split(c, r"\s+"), lambda w: F.lower(F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    return F.array_distinct(F.filter(words, lambda w: w.rlike(r"^\p{L}{3,}$")))
