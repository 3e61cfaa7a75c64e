"""Text clean-up and extraction, following the string rules of the source data's producers."""

from __future__ import annotations

# White space in the sense of ECMAScript (all Unicode space separators, line ends and the BOM).
SPACE = r"[\t-\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# What counts as an e-mail address, as an eight-digit phone number, and as a green cabinet.
EMAIL_CHARS = "[a-zA-Z0-9._-]"
# The look-behind and the possessive run keep long texts without an at sign linear; the matches are the same.
EMAIL = rf"(?<!{EMAIL_CHARS}){EMAIL_CHARS}++@{EMAIL_CHARS}+\.{EMAIL_CHARS}+"
_S = f"{SPACE}?"
PHONE = (
    rf"(?:\+47{_S})?(?:[0-9]{{2}}{_S}[0-9]{{2}}{_S}[0-9]{{2}}{_S}[0-9]{{2}}|[0-9]{{3}}{_S}[0-9]{{2}}{_S}[0-9]{{3}})"
)
GREEN_CABINET = (
    rf"(?i)(?<![A-Za-z0-9_])gr[øØ]nt(?:{SPACE}+rundt)?(?:{SPACE}+varme)?{SPACE}*skap(?![A-Za-z0-9_])"
)
# A tag value must be shorter than this many UTF-16 units.
TAG_VALUE_LIMIT = 255


def literal(value: str) -> str:
    """A string literal; backslashes and quotes are kept as they are."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """`body` with `name` bound to `value`, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def replaced(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, {literal(pattern)}, {literal(by)})"


def trimmed(c: str) -> str:
    """Strip every kind of Unicode white space from both ends."""
    return replaced(c, f"^{SPACE}+|{SPACE}+$", "")


def utf16_length(c: str) -> str:
    return f"(octet_length(encode({c}, 'UTF-16BE')) div 2)"


def number_text(c: str) -> str:
    """Shortest decimal form without exponent, whole numbers without a fraction (10.0 -> 10, 1.0E-5 -> 0.00001)."""
    body = (
        "CASE WHEN n = floor(n) AND abs(n) < 1e15D THEN string(bigint(n)) "
        "WHEN abs(n) >= 1e-3D AND abs(n) < 1e7D THEN string(n) "
        f"ELSE coalesce({replaced('string(try_cast(string(n) AS decimal(38,25)))', '0+$', '')}, string(n)) END"
    )
    return let(f"double({c})", "n", body)


def clean_tag_value(c: str) -> str:
    """Normalise a text for use as a tag value; null when nothing is left or it is too long."""
    cleaned = c
    for pattern, by in (("[\r\n]+", ". "), (f"{SPACE}+", " "), (r" \.", "."), (r"\.+", ".")):
        cleaned = replaced(cleaned, pattern, by)
    # Up to half the limit in code points fits whatever the characters are.
    short = f"length(v) <= {(TAG_VALUE_LIMIT - 1) // 2} OR {utf16_length('v')} < {TAG_VALUE_LIMIT}"
    body = f"CASE WHEN length(v) > 0 AND ({short}) THEN v END"
    return let(trimmed(cleaned), "v", body)


def _distinct_or_null(values: str) -> str:
    return let(f"array_distinct(filter({values}, x -> x IS NOT NULL))", "found", "CASE WHEN size(found) > 0 THEN found END")


def extract_emails(c: str) -> str:
    """Distinct addresses in order of appearance, null if none."""
    return _distinct_or_null(f"transform(regexp_extract_all({c}, {literal(EMAIL)}, 0), m -> {clean_tag_value('m')})")


def extract_phones(c: str) -> str:
    """Distinct eight-digit numbers as '+47 12 34 56 78', null if none. Numbers written with the prefix are left out."""
    digits = f"transform(regexp_extract_all({c}, {literal(PHONE)}, 0), m -> {replaced('m', SPACE, '')})"
    grouped = replaced("m", "(..)(..)(..)(..)", "+47 $1 $2 $3 $4")
    return _distinct_or_null(f"transform(filter({digits}, m -> length(m) = 8), m -> {grouped})")


def cabinet_kind(c: str) -> str:
    return f"CASE WHEN {c} RLIKE '(?i)rotaid' THEN 'twist' END"


def cabinet_manufacturer(c: str) -> str:
    return f"CASE WHEN {c} RLIKE '(?i)rotaid' THEN 'Rotaid' END"


def cabinet_colour(c: str) -> str:
    return f"CASE WHEN {c} RLIKE {literal(GREEN_CABINET)} THEN 'green' END"


def xml_escape(c: str) -> str:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = f"replace({c}, {literal(mark)}, {literal(entity)})"
    return c


def yes_no(c: str) -> str:
    return f"CASE WHEN {c} THEN 'Y' WHEN NOT {c} THEN 'N' END"


def json_numbers(**fields: str) -> str:
    """A JSON object of numbers, each in its shortest form."""
    parts = [f"""'{"," if i else "{"}"{name}":', {number_text(value)}""" for i, (name, value) in enumerate(fields.items())]
    return f"concat({', '.join(parts)}, '}}')"
