"""Text rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def blank(c: Column) -> Column:
    """Missing means NULL or the empty string; spaces and ``0`` are values."""
    return F.coalesce(c, F.lit("")) == ""


def first_filled(*cs: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def double_text(c: Column) -> Column:
    """A double as plain text with its decimal point (``3.0``, ``0.0005``); below 0.0001 as ``5e-05``.

    Spark's own text has an exponent below 0.001 already (``5.0E-4``).
    """
    number = c.cast("double")
    text = number.cast("string")
    sign = F.when(number < 0, "-").otherwise("")
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, r"E-([0-9]+)$", 1)
    plain = F.concat(sign, F.lit("0.000"), F.replace(digits, F.lit("."), F.lit("")))
    scientific = F.concat(sign, digits, F.lit("e-"), F.lpad(exponent, 2, "0"))
    return F.when(exponent == "", text).when(exponent == "4", plain).otherwise(scientific)


def csv_line(cells: str) -> Column:
    """An array of texts as one CSV line."""

    def cell(c: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(c.rlike('[",\r\n]'), quoted).otherwise(F.coalesce(c, F.lit("")))

    return F.array_join(F.transform(cells, cell), ",")


def sorted_json(**fields: Column) -> Column:
    """One JSON object whose top-level keys are in alphabetical order; NULL fields are kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def json_text(value: Column) -> Column:
    """A text as a JSON string in ASCII: what is not printable ASCII is escaped, beyond 16 bits as two surrogates."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def escaped(c: Column) -> Column:
        code = F.ascii(c)
        high = F.lit(0xD800) + F.floor((code - 0x10000) / 0x400)
        low = F.lit(0xDC00) + (code - 0x10000) % 0x400
        short = F.lit(None).cast("string")
        for mark, name in _SHORT.items():
            short = F.when(c == mark, F.lit("\\" + name)).otherwise(short)
        return (
            F.when(short.isNotNull(), short)
            .when(code.between(0x20, 0x7E), c)
            .when(code < 0x10000, unit(code.cast("bigint")))
            .otherwise(F.concat(unit(high.cast("bigint")), unit(low.cast("bigint"))))
        )

    safe = F.regexp_replace(value, r'["\\]', r"\\$0")
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    body = F.when(value.rlike(r"[^\x20-\x7E]"), F.array_join(F.transform(chars, escaped), "")).otherwise(safe)
    return F.concat(F.lit('"'), body, F.lit('"'))


_SHORT = {'"': '"', "\\": "\\", "\n": "n", "\t": "t", "\r": "r", "\b": "b", "\f": "f"}


def python_json(fields: Sequence[tuple[str, Column]]) -> Column:
    """Flat JSON object of the non-NULL text fields, alphabetical, in ASCII, with ``": "`` and ``", "`` as separators."""
    parts = [
        F.when(value.isNotNull(), F.concat(F.lit(f'"{name}": '), json_text(value)))
        for name, value in sorted(fields, key=lambda f: f[0])
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def json_line_bytes(fields: dict[str, Column]) -> Column:
    """Bytes of a flat text record as one JSON line in ASCII, from lengths alone: nothing is serialised."""
    fixed = sum(len(name) + 6 for name in fields) + 2 * (len(fields) - 1) + 3
    total = F.lit(fixed)

    def held(value: Column, pattern: str) -> Column:
        return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))

    for value in fields.values():
        # one byte a character; one more for the short escapes, five for \uXXXX, eleven for a pair of them
        odd = held(value, r'["\\\n\t\r\x08\f]') + 5 * held(value, r"[^\x20-\x7E\n\t\r\x08\f]")
        odd += 6 * held(value, r"[\x{10000}-\x{10FFFF}]")
        total = total + F.length(value) + F.when(value.rlike(r'["\\]|[^\x20-\x7E]'), odd).otherwise(0)
    return total.cast("bigint")
