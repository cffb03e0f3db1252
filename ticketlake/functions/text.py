"""Text normalisation as built-in column expressions (no Python in the row path)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# How exports spell a missing cell, the separator of hierarchical labels, and the
# account prefixes of the two territory blocks.
BLANK_MARKS = ("", "<NA>", "nan", "None")
KEY_BLANK_MARKS = ("NAN", "NONE", "NULL", "")
LEVEL_SEPARATOR = "::"
TERRITORY_PREFIXES = (("40", "Bloco 4"), ("10", "Bloco 1"))

# Code points beyond ASCII, all planes.
BEYOND_ASCII = range(0x80, 0x110000)
# Runs of ASCII white space, or a single one that is not a blank.
ODD_SPACES = r"[\t-\r\x1c-\x20]{2,}|[\t-\r\x1c-\x1f]"

# All characters that count as white space when text is stripped.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


@cache
def _decompositions() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters whose compatibility decomposition leaves one ASCII character, and it; those that leave several, with them."""
    source, target, longer = [], [], []
    for code in BEYOND_ASCII:
        char = chr(code)
        if unicodedata.decomposition(char) == "":
            continue
        ascii_form = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(ascii_form) == 1:
            source.append(char)
            target.append(ascii_form)
        elif ascii_form:
            longer.append((char, ascii_form))
    return "".join(source), "".join(target), tuple(longer)


@cache
def _compositions() -> tuple[str, str, tuple[tuple[str, str], ...], tuple[tuple[str, str], ...]]:
    """Compatibility forms (one-to-one, one-to-many) and base + mark pairs with their composed letter."""
    single: list[tuple[str, str]] = []
    longer: list[tuple[str, str]] = []
    pairs: list[tuple[int, str, str]] = []
    for code in BEYOND_ASCII:
        char = chr(code)
        parts = unicodedata.decomposition(char)
        if parts == "":
            continue
        form = unicodedata.normalize("NFKC", char)
        if form != char:
            (single if len(form) == 1 else longer).append((char, form))
        elif not parts.startswith("<"):
            pair = "".join(chr(int(part, 16)) for part in parts.split())
            pairs.append((len(unicodedata.normalize("NFD", char)), pair, char))
    pairs.sort(key=lambda item: item[0])
    return (
        "".join(c for c, _ in single), "".join(f for _, f in single), tuple(longer),
        tuple((pair, char) for _, pair, char in pairs),
    )


def _replace_all(c: Column, pairs: tuple[tuple[str, str], ...], only_if: str) -> Column:
    """Replace each pair in turn, in the rows that match `only_if`.

    The pairs travel as one text literal, so that a plan does not carry hundreds of expressions.
    """
    size = len(pairs[0][0])
    listed = F.split(F.lit("\x01".join(key + value for key, value in pairs)), "\x01")
    replaced = F.aggregate(
        listed, c, lambda acc, pair: F.replace(acc, F.substring(pair, 1, size), F.substring(pair, size + 1, 99))
    )
    return F.when(c.rlike(only_if), replaced).otherwise(c)


def _ranges(codes: Iterable[int], gap: int = 1) -> str:
    """Character class of the codes as ranges; codes above U+024F join over gaps up to `gap`."""
    ranges: list[list[int]] = []
    for code in sorted(codes):
        if ranges and code - ranges[-1][1] <= (gap if code > 0x24F else 1):
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


@cache
def _near_any_of(pairs: tuple[tuple[str, str], ...]) -> str:
    """Few code ranges that cover the pairs' characters.

    A quick test for rows that need no replacing; one that names every character is a hundred times slower.
    """
    return _ranges((ord(char) for char, _ in pairs), gap=256)


@cache
def _perhaps_any_of(pairs: tuple[tuple[str, str], ...]) -> str:
    """Character class of the pairs' characters up to U+00FF and of all beyond it.

    Western text passes it at a few comparisons a character; one with a range for every script costs dozens.
    """
    return _ranges([*(code for char, _ in pairs if (code := ord(char)) <= 0xFF), 0x100, BEYOND_ASCII[-1]], gap=BEYOND_ASCII.stop)


def nfkc(c: Column) -> Column:
    """Compatibility forms folded and marks joined to their letters; ASCII text passes untouched."""
    source, target, longer, pairs = _compositions()
    folded = F.translate(_replace_all(c, longer, _near_any_of(longer)), source, target)
    return F.when(is_ascii(c), c).otherwise(_replace_all(folded, pairs, r"[\u0300-\u036f]"))


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_ascii(c: Column) -> Column:
    """Whether every character takes one byte; far cheaper than a pattern."""
    return F.octet_length(c) == F.char_length(c)


def to_ascii(c: Column) -> Column:
    """Compatibility-decompose every character and keep the ASCII part."""
    source, target, longer = _decompositions()
    # Two text literals of one map, so that a plan does not carry an expression for every character.
    known = F.map_from_arrays(*(F.split(F.lit("\x01".join(part)), "\x01") for part in zip(*longer, strict=True)))
    near = _near_any_of(longer)
    met = F.array_distinct(F.regexp_extract_all(c, F.lit(near), F.lit(0)))  # the few such characters of a text
    replaced = F.aggregate(met, c, lambda acc, x: F.replace(acc, x, F.coalesce(F.element_at(known, x), x)))
    expanded = F.when(c.rlike(_perhaps_any_of(longer)), replaced).otherwise(c)
    plain = F.regexp_replace(F.translate(expanded, source, target), r"[^\x00-\x7F]", "")
    # Text that is ASCII already needs none of this.
    return F.when(is_ascii(c), c).otherwise(plain)


def norm_text(c: Column) -> Column:
    """Upper-case ASCII text with single blanks; blank becomes null."""
    return F.nullif(F.upper(F.trim(F.regexp_replace(to_ascii(c), ODD_SPACES, " "))), F.lit(""))


def norm_identifier(c: Column) -> Column:
    """Normalised text without the `.0` tail that spreadsheets add to whole numbers."""
    return F.regexp_replace(norm_text(c), r"\.0+$", "")


def norm_subject(c: Column) -> Column:
    """Normalised text reduced to letters, digits and single blanks."""
    return F.nullif(F.trim(F.regexp_replace(norm_text(c), "[^A-Z0-9]+", " ")), F.lit(""))


def token_set(c: Column) -> Column:
    """Distinct words of more than two letters, sorted; null text gives an empty set."""
    return words_of(norm_subject(c))


def words_of(subject: Column) -> Column:
    """As `token_set`, of text that `norm_subject` gave."""
    words = F.split(F.coalesce(subject, F.lit("")), " ")
    return F.sort_array(F.array_distinct(F.filter(words, lambda w: F.length(w) > 2)))


def shared_tokens(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column, shared: Column | None = None) -> Column:
    """Shared tokens over all tokens; 0 when either side has none.

    `shared`: their number, from a caller who has it. It is read twice and costs more than all the rest.
    """
    shared = shared_tokens(a, b) if shared is None else shared
    total = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / total)


def territory(account: Column) -> Column:
    """Territory block from the prefix of a normalised account."""
    block = F.lit(None).cast("string")
    for prefix, name in reversed(TERRITORY_PREFIXES):
        block = F.when(account.startswith(prefix), F.lit(name)).otherwise(block)
    return block


def last_segment(c: Column, empty_tail: str = "text", missing: str | None = None) -> Column:
    """Last level of a `a::b::c` label.

    `empty_tail`: what an empty last level gives, the whole text ("text") or "" ("empty").
    `missing`: label for null or blank input; by default both are kept.
    """
    text = strip(c)
    tail = strip(F.substring_index(text, LEVEL_SEPARATOR, -1))
    if empty_tail == "text":
        tail = F.when(tail == "", text).otherwise(tail)
    if missing is not None:
        return F.when(text.isNull() | (text == ""), F.lit(missing)).otherwise(tail)
    return F.when(text == "", c if empty_tail == "text" else text).otherwise(tail)


def norm_class(c: Column) -> Column:
    """Normalised last level without a leading `[tag]`."""
    tail = F.trim(F.substring_index(norm_text(c), LEVEL_SEPARATOR, -1))
    return F.nullif(F.trim(F.regexp_replace(tail, r"^\[[^\]]+\]\s*", "")), F.lit(""))


def collapse_spaces(c: Column) -> Column:
    """Single blanks between words for text of any script; ends trimmed."""
    spaces = _ranges(map(ord, WHITESPACE))
    return F.trim(F.regexp_replace(c, f"{spaces}+", " "))


def clean_ws(c: Column) -> Column:
    """Collapsed white space (hard blanks included); blank becomes null."""
    # ASCII text with lone blanks, as most is, needs no pattern over every kind of white space.
    plain = is_ascii(c) & ~c.contains("  ") & ~c.rlike(r"[\t-\r\x1c-\x1f]")
    return F.nullif(F.when(plain, F.trim(c)).otherwise(collapse_spaces(c)), F.lit(""))


def clean_subject(c: Column) -> Column:
    """Collapsed, upper-cased last level of a subject label."""
    tail = nfkc(F.substring_index(F.nullif(collapse_spaces(c), F.lit("")), LEVEL_SEPARATOR, -1))
    return F.nullif(F.upper(collapse_spaces(tail)), F.lit(""))


def join_key_text(c: Column) -> Column:
    """Key text for loose joins: no `.0`, trimmed, upper-case, null marks dropped."""
    key = F.upper(strip(F.regexp_replace(c.cast("string"), r"\.0$", "")))
    return F.when(~key.isin(*KEY_BLANK_MARKS), key)


def blank_to_null(c: Column) -> Column:
    """Trimmed text, with every spelling of a missing cell as null."""
    text = strip(c.cast("string"))
    return F.when(~text.isin(*BLANK_MARKS), text)


def first_nonblank(*cols: Column) -> Column:
    """First value that is neither null nor blank, trimmed."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cols])


def label_or(c: Column, default: str) -> Column:
    """Trimmed label, or `default` when null or blank."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def upper_trim(c: Column) -> Column:
    """Upper-case trimmed text; null counts as empty."""
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def exact_units(c: Column, digits: int) -> Column:
    """A value in [0, 1] as a whole number of 10**-digits, rounded on its exact binary value, ties to even.

    Scaling by a power of two is exact, so no decimal text of the double gets in between.
    """
    # value * 2**60 * 10**digits passes 64 bits, so it is kept in two parts of 30 bits and the rest.
    low_bits = F.lit(2**30 - 1)
    scaled = (c * F.lit(float(2**60))).cast("bigint")
    low = scaled.bitwiseAND(low_bits) * F.lit(10**digits)
    high = F.shiftright(scaled, 30) * F.lit(10**digits) + F.shiftright(low, 30)
    down, half = F.shiftright(high, 30), F.lit(2**29)
    rest, tail = high.bitwiseAND(low_bits), low.bitwiseAND(low_bits)
    up = (rest > half) | ((rest == half) & ((tail > 0) | (down % 2 == 1)))
    return down + F.when(up, 1).otherwise(0)


def fixed2(c: Column) -> Column:
    """Text of a value in [0, 1] with two decimals."""
    return F.format_string("%d.%02d", F.floor(exact_units(c, 2) / 100), exact_units(c, 2) % 100)


def round4(c: Column) -> Column:
    """A value in [0, 1] rounded to four decimals."""
    return exact_units(c, 4) / F.lit(10000.0)
