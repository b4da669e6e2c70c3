"""What a page holds: text, links, images, script links, sitemap entries (EXT-1..5).

The expressions stay inside the JVM. ``operators.extract.tokenize_pages`` is the
exact form with an HTML tokenizer for markup the patterns cannot read, such as
``>`` inside a quoted attribute.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from webgraph_spark.functions.binding import bind

# Fixed value: URLs inside scripts; the host needs a dot. (?U) makes \w Unicode.
SCRIPT_URL = r"(?U)(http://|https://)([\w_-]+(?:(?:\.[\w_-]+)+))([\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])?"

# One pattern, so that what opens first also hides what stands inside it; the group is a script's body.
_CODE = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>(.*?)(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
)
_TAG = r"<[A-Za-z/!?][^>]*>"
_VALUE = r"""("[^"]*"|'[^']*'|[^\s>"']+)"""
_HREF = rf"(?i)<a\s(?:[^>]*?\s)?href\s*=\s*{_VALUE}"
_SRC = rf"(?i)<img\s(?:[^>]*?\s)?src\s*=\s*{_VALUE}"
_LOC = r"(?is)<loc\b[^>]*>(.*?)</loc\s*>"
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)"

# Names that older pages write without the semicolon, even in front of a letter.
_BARE_NAMES = {name: char for name, char in html5.items() if not name.endswith(";")}
_BARE = "^(" + "|".join(sorted(_BARE_NAMES, key=lambda name: (-len(name), name))) + ")"
# In an attribute such a name is plain text if it goes on, as in "?a=1&section=2".
_ENDS = "(?![=A-Za-z0-9])"

# Fixed value: what numbers 128 to 159 stand for, the characters of code page 1252 where it has one.
_OLD_NUMBERS = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]

# Replaced text by text; a page with any other reference takes the full table.
_FREQUENT = ["lt", "gt", "quot", "apos", "nbsp", "copy", "middot", "ndash", "mdash", "hellip", "laquo", "raquo"]
_ANOTHER = "&(?!amp)[A-Za-z#]"


def _character(code: Column) -> Column:
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    old = F.element_at(F.split(F.lit("\x01".join(_OLD_NUMBERS)), "\x01"), (code - 127).cast("int"))
    return F.when(code.between(128, 159), old).when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))


def _lookup(names: dict[str, str], key: Column) -> Column:
    # Two literals that constant folding turns into arrays, not thousands of nodes.
    keys = F.split(F.lit("\x01".join(names)), "\x01")
    values = F.split(F.lit("\x01".join(names.values())), "\x01")
    return F.try_element_at(values, F.nullif(F.array_position(keys, key), F.lit(0)).cast("int"))


def _decode_after_ampersand(part: Column, attribute: bool) -> Column:
    """``amp;x`` -> ``&x``: the text behind one ampersand with its reference decoded."""
    short = _BARE + (_ENDS if attribute else "")
    name = F.regexp_extract(part, _REFERENCE, 1)
    bare = F.regexp_extract(part, short, 1)
    decimal = F.regexp_extract(name, r"^#([0-9]{1,9});?$", 1)
    hexadecimal = F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]{1,8});?$", 1)
    named = F.when(decimal != "", _character(decimal.cast("bigint")))
    named = named.when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).cast("bigint")))
    named = named.when(name.startswith("#"), F.lit("\ufffd")).when(name != "", _lookup(html5, name))
    return F.coalesce(
        F.concat(named, F.regexp_replace(part, _REFERENCE, "")),
        F.concat(F.when(bare != "", _lookup(_BARE_NAMES, bare)), F.regexp_replace(part, short, "")),
        F.concat(F.lit("&"), part),
    )


def _decode_all(text: Column, attribute: bool) -> Column:
    def put_together(parts: Column) -> Column:
        behind = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(behind, lambda part: _decode_after_ampersand(part, attribute)), ""))

    return bind(F.split(text, "&", -1), put_together)


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Character references to characters, in one pass; unknown ones stay.

    In an ``attribute`` a name without semicolon counts only if no letter, digit or ``=`` follows.
    """

    ampersand = f"&amp;|&amp{_ENDS}" if attribute else "&amp;?"

    def decode(whole: Column) -> Column:
        quick = whole
        for name in _FREQUENT:
            quick = F.replace(quick, F.lit(f"&{name};"), F.lit(html5[f"{name};"]))
        # "&amp;" goes last in the quick form, so its "&" is never read again.
        return bind(
            quick,
            lambda q: F.when(q.rlike(_ANOTHER), _decode_all(whole, attribute)).otherwise(F.regexp_replace(q, ampersand, "&")),
        )

    return bind(text, decode)


def without_code(html: Column) -> Column:
    """Markup without comments, script bodies and style sheets."""
    return F.regexp_replace(html, _CODE, "")


def strip_markup(html: Column) -> Column:
    """Text nodes put together with nothing between: ``<p>a</p><p>b</p>`` -> ``ab``."""
    return decode_entities(F.regexp_replace(without_code(html), _TAG, ""))


def _attribute_values(html: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(without_code(html), F.lit(pattern), F.lit(1))
    return F.transform(found, lambda v: decode_entities(F.regexp_replace(v, r"""^["']|["']$""", ""), attribute=True))


def hrefs(html: Column) -> Column:
    return _attribute_values(html, _HREF)


def image_sources(html: Column) -> Column:
    return _attribute_values(html, _SRC)


def urls_in_scripts(bodies: Column) -> Column:
    found = F.transform(bodies, lambda body: F.regexp_extract_all(body, F.lit(SCRIPT_URL), F.lit(0)))
    return F.flatten(found)


def script_urls(html: Column) -> Column:
    """URLs written in script bodies; a script inside a comment is none."""
    return urls_in_scripts(F.regexp_extract_all(html, F.lit(_CODE), F.lit(1)))


# A quoted value that holds ">" or is never closed, or that reads like another attribute; "/" in place of the blank.
_ODD_TAG = (
    r"""(?i)<[a-z][^>]*?=\s*(?:"[^">]*>|'[^'>]*>|"[^">]*\s(?:href|src)\s*=|'[^'>]*\s(?:href|src)\s*=)|<(?:a|img)/"""
)
_ODD_COMMENT = r"<!--+>|--!>"


def _left_open(text: Column, opening: str, closing: str) -> Column:
    return F.contains(text, F.lit(opening)) & ~F.contains(F.substring_index(text, opening, -1), F.lit(closing))


def misread(html: Column) -> Column:
    """Whether the patterns above may read the markup otherwise than a tokenizer: odd quotes, comments, what is left open.

    Looks for signs in linear time and rather says yes; NULL and plain markup are False.
    """
    odd = html.rlike(_ODD_TAG) | html.rlike(_ODD_COMMENT) | _left_open(html, "<!--", "-->")
    for name in ("script", "style"):
        odd = odd | _left_open(F.lower(html), f"<{name}", f"</{name}")
    return F.coalesce(odd, F.lit(False))


def sitemap_locations(xml: Column) -> Column:
    return F.transform(F.regexp_extract_all(xml, F.lit(_LOC), F.lit(1)), lambda loc: decode_entities(loc))
