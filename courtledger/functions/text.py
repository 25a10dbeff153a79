"""Names, slugs, links and codes."""

from functools import reduce

from pyspark.sql import Column, functions as F

from courtledger import fixed_values as fv


def as_column(c):
    return c if isinstance(c, Column) else F.col(c)


def contains_any(c, tokens) -> Column:
    """True if the text holds one of the tokens, case-sensitive."""
    c = as_column(c)
    return reduce(Column.__or__, [c.contains(t) for t in tokens])


def count_char(c, char) -> Column:
    c = as_column(c)
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def normalize_name(c) -> Column:
    """Drop spaces, hyphens, dots and apostrophes, lower-case the rest; accents stay."""
    return F.lower(F.translate(as_column(c), " -.'", ""))


# White space other than the space itself, no-break spaces included.
_ODD_SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def single_spaced(c) -> Column:
    """Words parted by one space each, whatever white space parted them."""
    plain = F.translate(as_column(c), _ODD_SPACES, " " * len(_ODD_SPACES))
    return F.trim(F.when(plain.contains("  "), F.regexp_replace(plain, " +", " ")).otherwise(plain))


def last_words(spaced, n) -> Column:
    return F.substring_index(spaced, " ", -n)


def word(spaced, i) -> Column:
    """Word i of a single-spaced text, from 0; null if there are fewer."""
    return F.when(count_char(spaced, " ") >= i,
                  F.substring_index(F.substring_index(spaced, " ", i + 1), " ", -1))


def has_suffix(spaced) -> Column:
    return F.lower(last_words(spaced, 1)).isin(fv.NAME_SUFFIXES)


def name_tail(c) -> Column:
    """The last two words, or three when the name has a suffix or more than four spaces."""
    c, spaced = as_column(c), single_spaced(c)
    short = (count_char(c, " ") <= 4) & ~has_suffix(spaced)
    return F.nullif(F.when(short, last_words(spaced, 2)).otherwise(last_words(spaced, 3)), F.lit(""))


def undouble_name(c) -> Column:
    """Cut the two characters a page repeats after the last name; null if words are missing."""
    c, spaced = as_column(c), single_spaced(c)
    first, second, third = (word(spaced, i) for i in range(3))

    def cut(w):
        return F.substring(w, F.lit(1), F.length(w) - 2)

    short = (count_char(c, " ") <= 2) & ~has_suffix(spaced)
    return (F.when(short, F.concat(first, F.lit(" "), cut(second)))
             .otherwise(F.concat(first, F.lit(" "), second, F.lit(" "), cut(third))))


def slug_team(c, side) -> Column:
    """Three-letter code before ("away") or after ("home") the separator of a game slug."""
    parts = F.split(as_column(c), fv.SLUG_SEPARATOR)
    if side == "away":
        return F.upper(F.right(F.get(parts, 0), F.lit(3)))
    return F.upper(F.left(F.get(parts, 1), F.lit(3)))


def url_path(c) -> Column:
    return F.try_parse_url(as_column(c), F.lit("PATH"))


def url_basename(c) -> Column:
    """What follows the last slash of the path; empty if the path ends with a slash."""
    return F.element_at(F.split(url_path(c), "/"), -1)


def url_parent(c) -> Column:
    """The last but one part of the path, a trailing slash not counted; null if there is none."""
    parts = F.split(F.regexp_replace(url_path(c), "/+$", ""), "/")
    return F.nullif(F.try_element_at(parts, F.lit(-2)), F.lit(""))


def dated_url(base, date) -> Column:
    return F.concat(F.lit(base), F.lit("?date="), F.date_format(as_column(date), "yyyy-MM-dd"))


def height_m(c) -> Column:
    """2.06 out of 6'9" (2.06m)."""
    return F.nullif(
        F.regexp_extract(as_column(c), r"\(([12]\.[0-9]{2})m\)", 1), F.lit("")).try_cast("double")


def weight_kg(c) -> Column:
    """113 out of 250lb (113kg)."""
    return F.nullif(
        F.regexp_extract(as_column(c), r"\(([0-9]{1,3})kg\)", 1), F.lit("")).try_cast("double")


def position_code(c) -> Column:
    """G-F out of "Team | #4 | Guard-Forward"; words that are no position become NC."""
    words = F.split(F.element_at(F.split(as_column(c), r" \| "), -1), "-")
    return F.array_join(F.transform(
        words, lambda w: F.when(w.isin(fv.FULL_POSITIONS), F.left(w, F.lit(1)))
                          .otherwise(F.lit(fv.OTHER_POSITION))), "-")


def join_slice(array, start, length) -> Column:
    """Join part of an array with spaces; start counts from 0."""
    return F.array_join(F.slice(as_column(array), start + 1, length), " ")


def pad_left(c, width, char="0") -> Column:
    """Pad, but never cut a longer text."""
    c = as_column(c).cast("string")
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit(char))
