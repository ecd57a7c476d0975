"""Strict JSON line expressions (S2), the class of a parse error, and typed field access.

Python's ``json.loads`` rejects anything after the first value; Spark's
``from_json`` stops after it.  Two wrapped parses close that gap without a
Python worker:

* ``[line]`` as ``array<string>`` must give exactly one element: catches
  ``{..} xyz``, ``{..}} xyz`` and ``{..},{..}``;
* ``{"r":line}`` must parse without a corrupt record: catches ``{..}] xyz``.

Any trailing text has to start with ``,`` or ``]`` to survive the first parse
and neither survives the second.  The second parse reads the value as a
``variant``, so the record's fields come from it with no third parse, keeping
key presence (``null`` vs absent), the JSON type (string vs number) and
last-wins duplicate keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Jackson settings closest to Python's json module.  NaN, Infinity and
# -Infinity are accepted by both.
STRICT_OPTIONS = {
    "allowSingleQuotes": "false",
    "allowUnquotedFieldNames": "false",
    "allowNumericLeadingZeros": "false",
    "allowBackslashEscapingAnyCharacter": "false",
    "allowUnquotedControlChars": "false",
    "allowComments": "false",
}

_CORRUPT = "_corrupt"

# Possessive quantifiers: Java matches them in a loop, so a string of any length needs no stack.
_STRING_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# Non-numeric number tokens Jackson also accepts but Python's json rejects
# (fixed values: Python takes exactly NaN, Infinity and -Infinity).
_EXTRA_TOKEN = r"(?:^|[^A-Za-z0-9_])(?:\+?INF|-INF|\+Infinity|\+NaN|-NaN)(?:$|[^A-Za-z0-9_])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_array(line: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>", STRICT_OPTIONS)


def _as_member(line: Column) -> Column:
    """``{"r": line}`` parsed with ``r`` as a variant: the value itself, or a corrupt record."""
    return F.from_json(F.concat(F.lit('{"r":'), line, F.lit("}")), f"r variant, {_CORRUPT} string",
                       {**STRICT_OPTIONS, "columnNameOfCorruptRecord": _CORRUPT})


def parse_parts(line: Column | str) -> Column:
    """``struct(one boolean, member struct, extra boolean)``: the two parses of a line, and whether it holds a token that Python rejects."""
    line = _col(line)
    return F.struct((F.size(_as_array(line)) == 1).alias("one"), _as_member(line).alias("member"), _has_extra_token(line).alias("extra"))


def parts_ok(parts: Column) -> Column:
    """True when the line behind :func:`parse_parts` is exactly one JSON value."""
    return F.coalesce(parts["one"] & parts["member"][_CORRUPT].isNull(), F.lit(False)) & ~parts["extra"]


def parts_value(parts: Column) -> Column:
    """The parsed value as a variant, for a line that is valid.

    Duplicate keys keep the last value (``spark.sql.variant.allowDuplicateKeys``); NaN and Infinity are values.
    """
    return parts["member"]["r"]


def _has_extra_token(line: Column) -> Column:
    """True when a non-numeric token Python rejects occurs outside string literals.

    The string-blanking regex only runs on lines that contain ``INF``, ``+``
    or ``-NaN`` at all, so ordinary lines pay one substring search.
    """
    maybe = (F.instr(line, "INF") > 0) | (F.instr(line, "+") > 0) | (F.instr(line, "-NaN") > 0)
    outside = F.regexp_replace(line, _STRING_LITERAL, '""')
    return F.when(maybe, outside.rlike(_EXTRA_TOKEN)).otherwise(F.lit(False))


# Classes of parse errors, for reject messages.
TRAILING_TEXT, BAD_TOKEN, TRUNCATED, BAD_VALUE = "text after the value", "bad token", "truncated", "invalid value"


def parse_error_class(line: Column | str) -> Column:
    """Why a line that is not one JSON value fails: text behind a first valid value, a number token Python does not know, an
    object, array or string that does not end, or something else."""
    line = _col(line)
    bare = F.rtrim(line)
    opens = F.substring(F.ltrim(line), 1, 1)
    ends = F.when(opens == "{", bare.endswith("}")).when(opens == "[", bare.endswith("]")).when(
        opens == '"', bare.endswith('"') & (F.length(bare) > 1)).otherwise(F.lit(True))
    first = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>", STRICT_OPTIONS)
    behind = F.from_json(F.concat(F.lit("["), F.regexp_replace(line, r"[^}\]\"]*+$", ""), F.lit("]")), "array<string>", STRICT_OPTIONS)
    return (F.when(_has_extra_token(line), F.lit(BAD_TOKEN)).when(F.size(first) > 1, F.lit(TRAILING_TEXT))
            .when(~ends & (F.coalesce(F.size(behind), F.lit(0)) == 1) & (F.length(bare) > 0), F.lit(TRAILING_TEXT))
            .when(~ends, F.lit(TRUNCATED)).otherwise(F.lit(BAD_VALUE)))


def fields(value: Column, names: list[str]) -> Column:
    """The named top-level fields of a parsed value as variants.

    Absent key -> NULL; JSON null -> a variant null; a value that is not an
    object -> all NULL.
    """
    return F.struct(*[F.try_variant_get(value, f"$.{n}", "variant").alias(n) for n in names])


def variant_type(v: Column) -> Column:
    """JSON type of a variant: STRING, BIGINT, DOUBLE, BOOLEAN, VOID (null), OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(v)


def variant_is_string(v: Column) -> Column:
    return F.coalesce(variant_type(v) == F.lit("STRING"), F.lit(False))


def variant_text(v: Column) -> Column:
    """Text of a variant: the string itself, or the JSON text of other values; NULL for null."""
    return F.try_variant_get(v, "$", "string")
