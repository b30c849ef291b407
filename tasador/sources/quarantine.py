"""Bad-source detection.

A downloaded "CSV" that is really an HTML error page (the reference's bus
stop file is one) must not be parsed as data. Each document is classified
by its whole content: markup at its head (after blanks and a byte order
mark) or at the head of any line, or a line without the expected number of
comma-separated fields. Rows are routed, never dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What may stand before the content: white space and the byte order mark.
LEADING = r"^[\s\uFEFF]+"


def classify_text(text: Column, expected_fields: int) -> tuple[Column, Column]:
    body = F.regexp_replace(text, LEADING, "")
    lines = F.transform(F.split(body, r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, LEADING, ""))
    lines = F.filter(lines, lambda x: x != "")
    reason = (F.when(text.isNull() | (body == ""), F.lit("empty"))
              .when(F.exists(lines, lambda x: x.startswith("<")), F.lit("markup, not delimited text"))
              .when(F.exists(lines, lambda x: F.size(F.split(x, ",")) != expected_fields),
                    F.lit("unexpected field count")))
    return reason.isNull(), reason


def quarantine(df: DataFrame, text_col: str, expected_fields: int) -> DataFrame:
    """Adds ``is_valid`` and ``quarantine_reason``."""
    ok, reason = classify_text(F.col(text_col), expected_fields)
    return df.select("*", ok.alias("is_valid"), reason.alias("quarantine_reason"))
