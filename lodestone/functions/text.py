"""String helpers: whitespace, first non-empty value, words, entities."""

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WS_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])
) + "".join(map(chr, [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Looked up from the front, so the everyday names come first.
_COMMON = ["amp", "nbsp", "copy", "middot", "quot", "lt", "gt", "hellip", "mdash", "ndash"]
_ENTITIES = {n: chr(name2codepoint[n]) for n in _COMMON} | {
    n: chr(c) for n, c in name2codepoint.items() if n not in _COMMON
} | {"apos": "'"}


def trim_ws(text: Column) -> Column:
    """Cut white space of any kind at both ends (``trim`` alone cuts blanks only)."""
    return F.trim(text, F.lit(WS_CHARS))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unfold(arr: Column) -> Column:
    """The array itself, fit for ``explode``.

    Exploding a bare column makes Catalyst push ``size(column) > 0`` below the projections that made the column and
    so work it out twice. It does not do that to an expression.
    """
    return F.transform(arr, lambda x: x)


def is_blank(text: Column) -> Column:
    return text.isNull() | (trim_ws(text) == "")


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_non_empty(*cols: Column) -> Column:
    """First value that is neither null nor ``""``, else ``""``."""
    return F.coalesce(*[non_empty(c) for c in cols], F.lit(""))


def cut(text: Column, size: int, tail: str = "...") -> Column:
    """Text of at most ``size`` characters; a longer one is cut and marked with ``tail``."""
    return F.when(F.length(text) > size, F.concat(F.left(text, F.lit(size)), F.lit(tail))).otherwise(text)


def words(text: Column) -> Column:
    """White-space separated words. Every kind of white space becomes a blank first: splitting at one character needs
    no regular expression."""
    blanks = F.translate(text, WS_CHARS, " " * len(WS_CHARS))
    return F.filter(F.split(blanks, " "), lambda w: w != "")


def _code_point(ref: Column) -> Column:
    digits = F.ltrim(F.regexp_replace(ref, "^#[xX]?", ""), F.lit("0"))
    short = F.when(F.length(digits) <= 7, digits)  # longer ones are past the last character
    number = F.when(F.lower(F.substr(ref, F.lit(2), F.lit(1))) == "x", F.conv(short, 16, 10)).otherwise(short)
    number = number.try_cast("int")
    usable = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    as_char = F.decode(F.unhex(F.lpad(F.hex(F.when(usable, number)), 8, "0")), "UTF-32")
    return F.coalesce(as_char, F.lit(chr(0xFFFD)))


def decode_entities(text: Column) -> Column:
    """Replace named and numeric character references, once and in one pass."""
    # One literal that is folded to a map when planning; built pair by pair it would dominate the planning time.
    names = F.str_to_map(F.lit("\x02".join("\x01".join(e) for e in _ENTITIES.items())), F.lit("\x02"), F.lit("\x01"))

    def piece(p: Column, i: Column) -> Column:
        # A number may go without its semicolon.
        ref = F.regexp_extract(p, r"^(#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]++(?=;))", 1)
        rest = F.regexp_replace(F.substr(p, F.length(ref) + 1), "^;", "")
        char = F.when(ref.startswith("#"), _code_point(ref)).otherwise(F.try_element_at(names, ref))
        decoded = F.when(ref != "", F.concat(char, rest))
        return F.when(i == 0, p).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), p)))

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)
