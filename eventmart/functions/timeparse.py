"""ISO 8601 text to UTC timestamps without a zone, in milliseconds.

Spark's own string cast is more lenient than the contract (it takes ``2024``, a
blank instead of ``T``, padded text, a bare time as *today*) and reads text
without a zone in the session zone. The expressions below first decide by shape
what the text is, so results do not depend on ``spark.sql.session.timeZone``.
Nothing here raises on bad text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"\d{4}-\d{2}-\d{2}"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)"
# Nearly all real input: complete, in UTC, whole seconds or at least milliseconds.
_UTC = rf"^{_DAY}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3,9}})?(Z|[+]00:00)\z"
_ANY = rf"^{_DAY}(T\d{{2}}(:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?)?{_ZONE}?)?\z"


def _completed(text: str) -> str:
    """Fill in the parts an abbreviated ISO text leaves out (UTC, minutes, seconds)."""
    zoned = rf"""CASE WHEN length({text}) = 10 THEN {text} || 'T00:00:00Z'
                     WHEN {text} RLIKE r'T.*{_ZONE}\z' THEN {text}
                     ELSE {text} || 'Z' END"""
    minutes = rf"regexp_replace({zoned}, r'T(\d{{2}})({_ZONE})\z', 'T$1:00$2')"
    return rf"regexp_replace({minutes}, r'T(\d{{2}}:\d{{2}})({_ZONE})\z', 'T$1:00$2')"


def _any_zone(text: str) -> str:
    """Through the instant: independent of the session zone, floored to milliseconds."""
    millis = f"unix_millis(try_cast({_completed(text)} AS TIMESTAMP))"
    return f"timestampadd(MICROSECOND, 1000 * {millis}, TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def utc_millis(column: str) -> Column:
    """``timestamp_ntz`` in UTC cut to milliseconds; null if the text is no ISO 8601 time."""
    text = f"`{column}`"
    cut = f"left({text}, IF(substr({text}, 20, 1) = '.', 23, 19))"
    return F.expr(
        f"""CASE WHEN {text} RLIKE r'{_UTC}' THEN try_cast({cut} AS TIMESTAMP_NTZ)
                 WHEN {text} RLIKE r'{_ANY}' THEN {_any_zone(text)} END"""
    )


# The rule for SQL text, always through the instant: a function Catalyst inlines.
SQL_FUNCTION = f"""
CREATE OR REPLACE TEMPORARY FUNCTION utc_millis(s STRING) RETURNS TIMESTAMP_NTZ RETURN
  CASE WHEN s RLIKE r'{_ANY}' THEN {_any_zone("s")} END
"""
