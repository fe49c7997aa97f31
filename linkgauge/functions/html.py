"""Reading of tags, attributes and entities in markup, as native columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: names of the characters from U+00A0 on, further names with their characters, and what numbers that no character has stand for
LATIN = (
    "nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr deg plusmn sup2 sup3 acute micro para middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest "
    "Agrave Aacute Acirc Atilde Auml Aring AElig Ccedil Egrave Eacute Ecirc Euml Igrave Iacute Icirc Iuml ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash Ugrave Uacute Ucirc Uuml Yacute THORN szlig "
    "agrave aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml igrave iacute icirc iuml eth ntilde ograve oacute ocirc otilde ouml divide oslash ugrave uacute ucirc uuml yacute thorn yuml"
).split()
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "sbquo": "‚", "ldquo": "“", "rdquo": "”", "bdquo": "„", "dagger": "†", "bull": "•", "hellip": "…", "permil": "‰", "lsaquo": "‹", "rsaquo": "›", "euro": "€", "trade": "™", "larr": "←", "rarr": "→", "minus": "−"}
NAMED |= {name: chr(160 + i) for i, name in enumerate(LATIN)}
WINDOWS = dict(zip(range(128, 160), "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ", strict=True))
#: What stands between a tag's name and its end: quoted parts may hold `>`. Possessive, so no tag is long enough to exhaust the stack.
INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: An attribute's value: in either kind of quotes, or bare.
VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value standing in the expression, and computed, once however often use names it."""
    return F.transform(F.array(value), use)[0]


def _character(reference: Column) -> Column:
    """What an entity stands for; itself if its name is unknown."""
    named = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
    odd = F.create_map(*[F.lit(x) for pair in WINDOWS.items() for x in pair])
    digits = F.regexp_extract(reference, "^&#([0-9]{1,7});$", 1)
    hexes = F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]{1,6});$", 1)
    number = F.when(digits != "", digits.cast("int")).when(hexes != "", F.conv(hexes, 16, 10).cast("int"))
    plain = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    char = lambda n: F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").otherwise(F.coalesce(F.try_element_at(odd, n), plain(n)))
    numbered = bound(number, lambda n: F.when(n.isNotNull(), char(n)))
    return F.coalesce(numbered, F.try_element_at(named, F.substr(reference, F.lit(2), F.length(reference) - 2)), reference)


def _decoded(text: Column) -> Column:
    """Piece by piece, so that nothing is decoded twice."""
    pieces = F.regexp_extract_all(text, F.lit(r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-zA-Z][a-zA-Z0-9]*;|[^&]+|&"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("&") & p.endswith(";"), _character(p)).otherwise(p)), "")


def unescape(text: Column) -> Column:
    """Text with its entities decoded: the names in NAMED, and decimal and hexadecimal numbers."""
    return bound(text, lambda t: F.when(t.contains("&"), _decoded(t)).otherwise(t))


def attribute(tag: Column, name: str) -> Column:
    """An attribute of a tag, its entities decoded; blank if the tag has none of that name."""
    value = F.regexp_extract(tag, rf"""(?is)^<(?:[^>"']|"[^"]*+"|'[^']*+')*?\s{name}\s*=\s*{VALUE}""", 1)
    bare = lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return unescape(bound(value, bare))
