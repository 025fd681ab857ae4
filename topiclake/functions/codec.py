"""Column expressions for the schema-registry wire format and canonical JSON.

Wire format of a registry-encoded message: one magic byte ``0x00``, the schema id as a
4-byte big-endian integer, then the payload (UTF-8 JSON text for JSON schemas).
All helpers return plain Catalyst expressions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format.
MAGIC_BYTE = 0
HEADER_LEN = 5

# Decode outcome codes (NULL status = decoded fine or tombstone).
TOO_SHORT = "too_short"
BAD_MAGIC = "bad_magic"
UNKNOWN_SCHEMA_ID = "unknown_schema_id"
NOT_JSON_TYPE = "not_json_type"
BAD_UTF8 = "bad_utf8"
BAD_JSON = "bad_json"


def utf8(c: Column) -> Column:
    return F.make_valid_utf8(c).cast("binary")


def wire_encode(schema_id: Column, payload_text: Column) -> Column:
    """``0x00 || int32_be(schema_id) || utf8(payload)``; NULL payload gives NULL."""
    header = F.concat(F.lit(bytearray([MAGIC_BYTE])),
                      F.unhex(F.lpad(F.hex(schema_id.cast("int")), 8, "0")))
    return F.when(payload_text.isNotNull(), F.concat(header, utf8(payload_text)))


def wire_magic_ok(msg: Column) -> Column:
    return F.substring(msg, 1, 1) == F.lit(bytearray([MAGIC_BYTE]))


def wire_schema_id(msg: Column) -> Column:
    """Schema id of a framed message; NULL when the frame is shorter than the header, lacks
    the magic byte, or holds a number that no schema id can be (over 2**31 - 1)."""
    return F.when((F.length(msg) >= HEADER_LEN) & wire_magic_ok(msg),
                  F.conv(F.hex(F.substring(msg, 2, 4)), 16, 10).cast("long").try_cast("int"))


def wire_payload_text(msg: Column) -> Column:
    """Payload as text, of any length; NULL where its bytes are not valid UTF-8."""
    return F.try_validate_utf8(F.substring(msg, HEADER_LEN + 1, (1 << 31) - 1).cast("string"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


# Fixed values of the canonical number form: integers that 64 bits hold stay integers, all other
# numbers are doubles, written plainly when their point lies within these places, else with e.
MIN_INT64, MAX_UINT64 = "-9223372036854775808", "18446744073709551615"
PLAIN_FROM, PLAIN_TO = -4, 15

_MARK = "\ue000"  # a private-use character: M + "n" before a number, M + "s" for itself
_NUMBER = r"-?\d[\d.eE+-]*+"
# numbers that a variant prints in their canonical form: integers, and fractions of at most 15 digits, not
# zero, of a size that is written plainly
_KEPT = r"(?:(?:0|-?[1-9]\d{0,16}+)|-?(?:0|[1-9]\d{0,7}+)\.(?!0000)\d{0,6}?[1-9]0{0,10}+)(?![\d.eE+-])"
# from the end of the last match: strings whole, such numbers, and what holds no number; then a number of
# another kind
_NEXT_NUMBER = r'\G((?:[^"\d-]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"|' + _KEPT + ")*+)(" + _NUMBER + ")"
# texts without fractions, exponents, long integers or a minus zero need no second look
_SPECIAL_NUMBER = r"\d[.eE]|\d{18}|-0"
_JSON_NUMBER = r"^-?(?:0|[1-9]\d*+)(?:\.\d++)?(?:[eE][+-]?\d++)?$"
_SHORT_TEXT = 1000  # characters; no number of a shorter text is longer than the JSON parser takes


def _spread(mantissa: Column, n: Column) -> Column:
    """``0.d * 10**n`` written plainly; ``mantissa`` is ``d`` with a point behind its first digit."""
    d = F.rtrim(F.translate(mantissa, ".", ""), F.lit("0"))
    return (F.when(F.length(d) <= n, F.concat(F.rpad(d, n, "0"), F.lit(".0")))
            .when(n > 0, F.concat(F.substring(d, F.lit(1), n), F.lit("."), F.substring(d, n + 1, F.lit(40))))
            .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -n), d)))


def _double_text(x: Column) -> Column:
    """A double that is not negative, by its shortest digits; NULL for infinity. Spark's own text is
    this form already where it has no exponent (between 0.001 and 10**7)."""
    def form(m: Column, e: Column) -> Column:
        science = F.concat(F.when(m.endswith(".0"), F.substring(m, 1, 1)).otherwise(m), F.when(e < 0, "e-").otherwise("e+"),
                           F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
        return F.when((e < PLAIN_FROM) | (e >= PLAIN_TO), science).otherwise(_spread(m, e + 1))

    def of_text(t: Column) -> Column:
        parts = F.struct(F.substring_index(t, "E", 1).alias("m"), F.substring_index(t, "E", -1).cast("int").alias("e"))
        return F.when(~t.contains("E"), F.when(t != "Infinity", t)).otherwise(_let(parts, lambda p: form(p["m"], p["e"])))

    return _let(x.cast("string"), of_text)


def _number_text(token: Column) -> Column:
    """A number in its canonical form; NULL where it is none of JSON or no double holds it."""
    sign = F.when(token.startswith("-"), "-").otherwise("")
    double = F.concat(sign, _double_text(F.abs(token.try_cast("double"))))
    exact = token.try_cast("decimal(38,0)")
    whole = (F.length(token) < 22) & exact.between(F.lit(MIN_INT64).cast("decimal(38,0)"), F.lit(MAX_UINT64).cast("decimal(38,0)"))
    return F.when(token.rlike(_JSON_NUMBER), F.when(token.rlike("[.eE]"), double).when(whole, exact.cast("string")).otherwise(double))


def canonical_json(text: Column) -> Column:
    """Compact JSON with object keys sorted at every level (NULL when not JSON).

    Duplicate keys keep the last value (``spark.sql.variant.allowDuplicateKeys``). Integers that 64
    bits hold keep their digits; other numbers print as doubles, by their shortest digits: ``1.0`` and
    ``1.00`` as ``1.0``, ``1e2`` as ``100.0``, ``1e20`` as ``1e+20``. A text with a number that no
    double holds (``1e999``) gives NULL.

    Variants keep numbers as decimals, whose own form is lost; so where a text has numbers of such
    kinds, they travel through the sorting as marked strings.
    """
    return _let(text, _canonical)


def _canonical(text: Column) -> Column:
    plain = F.to_json(F.try_parse_json(text))
    own = F.replace(text, F.lit(_MARK), F.lit(_MARK + "s"))
    own = F.when(text.contains("\\u"), F.regexp_replace(
        own, r"(?<!\\)((?:\\\\)*+)\\u[eE]000", "$1" + _MARK + "s")).otherwise(own)
    marked = F.regexp_replace(own, F.lit(_NEXT_NUMBER), F.lit('$1"' + _MARK + 'n$2"'))
    pieces = F.split(F.to_json(F.try_parse_json(marked)), '"' + _MARK + "n")

    def piece(x: Column, i: Column) -> Column:
        cut = F.instr(x, '"')
        # a number cannot be the name of a member
        value = F.when(F.substring(x, cut + 1, F.lit(1)) != ":", _number_text(F.substring(x, F.lit(1), cut - 1)))
        return F.when(i == 0, x).otherwise(F.concat(value, F.substring(x, cut + 1, F.length(x))))

    joined = _let(F.transform(pieces, piece), lambda p: F.when(
        ~F.exists(p, lambda x: x.isNull()), F.replace(F.array_join(p, ""), F.lit(_MARK + "s"), F.lit(_MARK))))
    return F.when(text.rlike(_SPECIAL_NUMBER), F.when((F.length(text) < _SHORT_TEXT) | plain.isNotNull(), joined)).otherwise(plain)


def decode_status(msg: Column, schema_type: Column, text: Column, parsed: Column) -> Column:
    """First failing check of a non-NULL message, as a code; NULL when it decodes.

    ``schema_type`` is NULL when the id is not registered; ``text`` is the payload's valid
    UTF-8 text and ``parsed`` its ``try_parse_json``. Total: any bytes get a code.
    """
    return (F.when(msg.isNull(), F.lit(None).cast("string"))
            .when(F.length(msg) < HEADER_LEN, F.lit(TOO_SHORT))
            .when(~wire_magic_ok(msg), F.lit(BAD_MAGIC))
            .when(schema_type.isNull(), F.lit(UNKNOWN_SCHEMA_ID))
            .when(schema_type != F.lit("JSON"), F.lit(NOT_JSON_TYPE))
            .when(text.isNull(), F.lit(BAD_UTF8))
            .when(parsed.isNull(), F.lit(BAD_JSON)))


def hex_summary(msg: Column, n: int = 16) -> Column:
    """Short payload summary for error reports: length and the leading bytes in hex."""
    return F.concat(F.lit("len="), F.length(msg).cast("string"), F.lit(" hex="),
                    F.hex(F.substring(msg, 1, n)))
