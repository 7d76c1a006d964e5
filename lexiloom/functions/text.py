"""Text expressions with Unicode rules stated explicitly.

Java's default ``\\s``, ``\\w`` and ``\\b`` are ASCII only, and its Unicode
switches count combining marks as word characters, so the classes below spell
out what a blank and a word character are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters treated as blanks, once as a character list and
# once as a regular-expression class.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"a-zA-Z0-9_\p{L}\p{N}"
# The same class behind a coarse range: letters outside it are ruled out by one
# or two comparisons instead of one per listed range.
ONE_BLANK = rf"[\t-\x20\x85\xa0\x{{1680}}-\x{{3000}}&&[{BLANK}]]"
# The other characters, spelt out: a negated class with ranges beyond Latin-1 is tested slowly.
NO_BLANK = (
    r"!-\x84\x86-\x9f\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}"
    r"\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}\x00-\x08\x0e-\x1b"
)
# The ranges that hold all blanks but the space, and some characters more.
_RARE = r"[\t-\x1f\x85\xa0\x{1680}-\x{3000}]"

# Vietnamese letters that carry a diacritic.
DIACRITICS = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
# The same as a class behind a coarse range, as above.
_DIACRITIC = f"[à-ỹ&&[{DIACRITICS}]]"
# The plain vowels that the looser letter test accepts as well.
PLAIN_VOWELS = "aeiouy"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Split at blanks. Most texts have no blank but the space, at which they are split without a regular expression."""
    pieces = F.when(text.rlike(_RARE), F.split(text, f"{ONE_BLANK}+")).otherwise(F.split(text, " "))
    return F.array_remove(pieces, "")


def has_text(text: Column) -> Column:
    """True unless the text is NULL or blank; never NULL."""
    return F.coalesce(strip(text) != "", F.lit(False))


def replace_first(text: Column, old: Column, new: Column) -> Column:
    """The first occurrence of ``old`` replaced, as plain text."""
    at = F.position(old, text)
    return F.when(
        at > 0,
        F.concat(F.substring(text, F.lit(1), at - 1), new, F.substr(text, at + F.char_length(old))),
    ).otherwise(text)


def replace_first_match(text: Column, pattern: Column, new: Column) -> Column:
    """The first match of the regular expression ``pattern`` replaced by plain text."""
    literal = F.replace(F.replace(new, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.regexp_replace(text, F.concat(F.lit("(?s)^(.*?)"), pattern), F.concat(F.lit("$1"), literal))


def whole_term_pattern(term: str) -> str:
    """A case-blind pattern for ``term`` that starts and ends on a word boundary."""
    def word_like(ch: str) -> bool:
        return ch.isalnum() or ch == "_"
    before = f"(?<![{WORD}])" if word_like(term[0]) else f"(?<=[{WORD}])"
    after = f"(?![{WORD}])" if word_like(term[-1]) else f"(?=[{WORD}])"
    return f"{before}(?iu:\\Q{term}\\E){after}"


def clean_text(text: Column) -> Column:
    """Blanks collapsed; everything but word characters, blanks and ``-.,!?`` removed."""
    collapsed = F.regexp_replace(strip(text), f"{ONE_BLANK}+", " ")
    return F.coalesce(strip(F.regexp_replace(collapsed, rf"[^{WORD}{BLANK}\-.,!?]", "")), F.lit(""))


def cleans_to_text(text: Column) -> Column:
    """Whether ``clean_text`` leaves anything, without cleaning; never NULL."""
    return F.coalesce(text.rlike(rf"[{WORD}\-.,!?]"), F.lit(False))


def has_diacritics(text: Column) -> Column:
    return F.lower(text).rlike(_DIACRITIC)


def has_vietnamese_letters(text: Column) -> Column:
    """The loose test: plain vowels count too."""
    return F.lower(text).rlike(f"[[{PLAIN_VOWELS}]{_DIACRITIC}]")


def two_decimals(part: Column, whole: Column) -> Column:
    """The double ``part / whole`` printed with two decimals, from exact arithmetic.

    ``format_string`` rounds the shortest decimal form half up, which differs
    from printing the stored double where that form ends in 5. ``part`` and
    ``whole`` are integers, so the hundredths come from integer division; on a
    tie the double is compared with it exactly, through a split in two halves
    whose products with 25 need no rounding.
    """
    a, b = part.cast("bigint"), whole.cast("bigint")
    scaled = a * 100
    rest = (scaled % b) * 2
    down = F.floor(scaled / b)

    def on_tie(h: Column) -> Column:
        ratio = a.cast("double") / b.cast("double")
        high = F.floor(ratio * F.lit(2.0 ** 26)).cast("double") / F.lit(2.0 ** 26)
        side = (ratio - high) * 25 - ((h * 2 + 1).cast("double") / 8 - high * 25)
        return F.when(side > 0, 1).when(side < 0, 0).otherwise(h % 2)

    def text(h: Column) -> Column:
        return F.concat(F.floor(h / 100).cast("string"), F.lit("."), F.lpad((h % 100).cast("string"), 2, "0"))

    return let(down, lambda h: let(
        h + F.when(rest > b, 1).when(rest < b, 0).otherwise(on_tie(h)), text))
