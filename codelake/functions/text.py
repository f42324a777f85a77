"""Text normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python strips that Java's Unicode \s leaves alone
# are the separators 0x1c-0x1f.
BLANK = r"[\s\x1c-\x1f]"

# Everything on a line before the first '#' that is outside a quote; quote state
# starts afresh on each line and a quote is escaped only by the character before it.
_BEFORE_COMMENT = (
    r"""^((?:[^'"#]++|'(?:[^'\\]|\\'?+)*+(?:'|\z)|"(?:[^"\\]|\\"?+)*+(?:"|\z))*+)#[\s\S]*\z"""
)


def trim_right(text: Column) -> Column:
    # tried only where a run of blanks begins
    return F.regexp_replace(text, rf"(?U)(?<!{BLANK}){BLANK}++\z", "")


def trim(text: Column) -> Column:
    return F.regexp_replace(trim_right(text), rf"(?U)\A{BLANK}+", "")


def is_blank(text: Column) -> Column:
    return ~F.regexp_like(text, F.lit(rf"(?U)(?!{BLANK})[\s\S]"))


def strip_comments_scan(code: Column) -> Column:
    """TXT-1: cut each line at its first unquoted ``#`` and trim it on the right."""
    def cut(line):
        marked = F.contains(line, F.lit("#"))
        return trim_right(F.when(marked, F.regexp_replace(line, _BEFORE_COMMENT, "$1")).otherwise(line))

    return F.array_join(F.transform(F.split(code, "\n", -1), cut), "\n")


def strip_comments_fallback(code: Column) -> Column:
    """TXT-2, unreadable code: cut at the first ``#`` when both quote counts before it are even."""
    def quotes(text, mark):
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    def cut(line):
        before = F.substring_index(line, "#", 1)
        even = (quotes(before, '"') % 2 == 0) & (quotes(before, "'") % 2 == 0)
        return F.when(F.contains(line, F.lit("#")) & even, trim_right(before)).otherwise(line)

    return F.array_join(F.transform(split_lines(code), cut), "\n")


def split_lines(text: Column) -> Column:
    """Lines at every boundary Python knows; a closing boundary opens no further line."""
    boundary = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
    body = F.regexp_replace(text, rf"(?:{boundary})\z", "")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(body, boundary, -1))


def expand_tabs(line: Column, width: int = 4) -> Column:
    """Pad every tab to the next column stop; a carriage return starts a new column count."""
    cells = F.split(line, "\t", -1)

    def step(done, cell):
        column = F.length(F.substring_index(done, "\r", -1)) % width
        return F.concat(done, F.repeat(F.lit(" "), width - column), cell)

    return F.aggregate(F.slice(cells, 2, F.size(cells)), cells[0], step)


def normalize_whitespace(code: Column) -> Column:
    """TXT-4: four-column tab stops, no trailing blanks, no blank lines."""
    lines = F.transform(F.split(code, "\n", -1), lambda line: trim_right(
        F.when(F.contains(line, F.lit("\t")), expand_tabs(line)).otherwise(line)))
    return F.array_join(F.filter(lines, lambda line: F.length(line) > 0), "\n")


def collapse_blank_lines(code: Column) -> Column:
    """TXT-5: any run of blank lines becomes one."""
    return F.regexp_replace(code, rf"(?U)\n{BLANK}*\n+", "\n\n")


def tidy_layout(code: Column) -> Column:
    """TXT-5 variant: tab to four spaces, trim each line, at most one blank line in a row."""
    lines = split_lines(F.replace(code, F.lit("\t"), F.lit("    ")))
    return F.regexp_replace(F.array_join(F.transform(lines, trim_right), "\n"), r"\n{3,}", "\n\n")


def mark_newlines(code: Column, fold_returns: bool = True) -> Column:
    """TXT-8, unreadable code: newline markers only."""
    text = F.regexp_replace(code, r"\r\n?", "\n") if fold_returns else code
    return squeeze(F.replace(text, F.lit("\n"), F.lit(" <newline> ")))


def squeeze(text: Column) -> Column:
    """Runs of blanks to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"(?U){BLANK}+", " "))


def one_line(text: Column, newlines: str = "space") -> Column:
    """SRC-7: the three newline policies for one-document-per-line files."""
    if newlines == "space":
        return F.replace(text, F.lit("\n"), F.lit(" "))
    if newlines == "strip":
        return trim(text)
    return text


def n_lines(text: Column) -> Column:
    """TXT-11: newlines plus one, zero for the empty text."""
    newlines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(newlines + 1).cast("long")


def n_chars(text: Column) -> Column:
    return F.length(text).cast("long")


def words(text: Column) -> Column:
    """TXT-12: word runs and punctuation runs."""
    return F.regexp_extract_all(text, F.lit(r"(?U)(\w+|[^\w\s]+)"), 1)


def words_by_space(text: Column) -> Column:
    return F.filter(F.split(text, rf"(?U){BLANK}+"), lambda w: F.length(w) > 0)


# Punctuation: the Unicode class and every ASCII mark, symbols included.
PUNCTUATION = r"\p{P}!-/:-@\[-`{-~"


def split_punct_digits(text: Column) -> Column:
    """Each punctuation mark and each numeral on its own, other runs whole; blanks stay inside runs."""
    return F.regexp_extract_all(text, F.lit(rf"(\p{{N}}|[{PUNCTUATION}]|[^\p{{N}}{PUNCTUATION}]+)"), 1)


def words_punct_digits(text: Column) -> Column:
    """As ``split_punct_digits`` on the blank-separated words."""
    return F.regexp_extract_all(text, F.lit(rf"(?U)(\p{{N}}|[{PUNCTUATION}]|[^\s\p{{N}}{PUNCTUATION}]+)"), 1)


def lines_with_ends(text: Column) -> Column:
    """Lines with their newline, the last one closed by a newline too."""
    return F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(r"([^\n]*\n)"), 1)


def words_with_space(text: Column) -> Column:
    """Byte-level splitting: contractions, then letter, digit and other runs with one leading space."""
    pattern = r"('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), 1)


# Role ids.
ROLES = {"PAD": 0, "UNK": 1, "KEYWORD": 2, "IDENTIFIER": 3, "OP": 4, "LITERAL": 5, "SEP": 6}
SPECIALS = ("[PAD]", "[CLS]", "[SEP]", "[MASK]", "[UNK]")
KEYWORDS = [
    "def", "class", "return", "if", "elif", "else", "for", "while", "try", "except", "finally", "with", "as",
    "import", "from", "pass", "break", "continue", "lambda", "yield", "global", "nonlocal", "assert", "raise", "del",
    "in", "is", "not", "and", "or", "true", "false", "none",
]
# Fixed value: characters of operators.
OPERATOR = r"[-()\[\]{},:.;+*/%=!<>&|^~@]"


def role_of(token: Column) -> Column:
    return (
        F.when(token.isin(*SPECIALS), ROLES["SEP"])
        .when(F.lower(token).isin(*KEYWORDS), ROLES["KEYWORD"])
        .when(F.regexp_like(token, F.lit(r"(?U)\A\d+(\.\d+)?\z")), ROLES["LITERAL"])
        .when(F.regexp_like(token, F.lit(r"""\A['"][\s\S]""")), ROLES["LITERAL"])
        .when(F.regexp_like(token, F.lit(rf"\A{OPERATOR}+\z")), ROLES["OP"])
        .otherwise(ROLES["IDENTIFIER"])
        .cast("int")
    )


def role_tags(tokens: Column) -> Column:
    """TXT-9: one role id per token."""
    return F.transform(tokens, role_of)
