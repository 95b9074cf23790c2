"""Column builders for wire text: UTF-8, strict JSON, RFC 3339 and fingerprints.

Arguments are column names or SQL expressions. The columns are written as SQL
text: built piece by piece through the Python API, expressions of this size
would spend longer on the way to the JVM than small queries run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# An offset is mandatory. Spark's cast alone would also take no offset, a bare
# date, a bare time, one-digit fields and zone names.
RFC3339 = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)$"

# Other ISO 8601 spellings of the same thing: basic format, left-out minutes or
# seconds, comma fraction, any one separator between date and time.
ISO_VARIANT = (
    r"^(?!0000)(\d{4})(-?)(\d{2})\2(\d{2})"
    r"[^0-9Z](\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2})?)$"
)


def sql_text(text: str) -> str:
    """``text`` as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def utf8_text(payload: str) -> Column:
    """Text of a payload; bytes that are not UTF-8 become U+FFFD, NULL becomes ''."""
    return F.expr(f"coalesce(make_valid_utf8(CAST({payload} AS STRING)), '')")


def strict_json(text: str) -> Column:
    """Variant ``{"p": <document>}``, or NULL unless the whole text is one JSON document.

    Spark's JSON readers ignore what follows the first document. The text is
    therefore read inside an object and inside an array: only a text that is
    exactly one document closes both wrappers.
    """
    return F.expr(
        f"CASE WHEN json_array_length(concat('[', {text}, ']')) = 1"
        f" THEN try_parse_json(concat('{{\"p\":', {text}, '}}')) END"
    )


def rfc3339_timestamp(text: str) -> Column:
    """Instant of an ISO timestamp with offset; NULL for any other text."""
    respelled = f"regexp_replace({text}, r'{ISO_VARIANT}', '$1-$3-$4T$5:$7:$8.$9$10')"
    respelled = f"regexp_replace({respelled}, ':(?=[:.])', ':00')"
    respelled = rf"regexp_replace({respelled}, r'\.(?=[Z+-])', '')"
    return F.expr(
        f"CASE WHEN {text} RLIKE r'{RFC3339}' THEN try_cast({text} AS TIMESTAMP)"
        f" WHEN {text} RLIKE r'{ISO_VARIANT}' THEN try_cast({respelled} AS TIMESTAMP) END"
    )


def rfc3339_text(instant: str) -> Column:
    """UTC text with ``Z``; a zero fraction is left out, any other has six digits."""
    return F.expr(
        f"date_format({instant}, CASE WHEN unix_micros({instant}) % 1000000 = 0"
        r" THEN 'yyyy-MM-dd\'T\'HH:mm:ss\'Z\''"
        r" ELSE 'yyyy-MM-dd\'T\'HH:mm:ss.SSSSSS\'Z\'' END)"
    )


def fingerprint_sql(columns: Sequence[str]) -> str:
    texts = ", '|', ".join(f"CAST({c} AS STRING)" for c in columns)
    return f"sha2(concat({texts}), 256)"


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 hex of the columns' text joined by ``|``; NULL if any of them is NULL."""
    return F.expr(fingerprint_sql(columns))
