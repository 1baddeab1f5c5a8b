"""Small string expressions shared by parsing and reporting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a response body is cleaned of, and the length of a
# rejected message's preview.
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
PREVIEW_LENGTH = 500
REPLACEMENT = "�"


def nonblank(c: Column) -> Column:
    """True when the text has at least one character above the space character."""
    return F.coalesce(c.rlike(r"[^\x00-\x20]"), F.lit(False))


def preview(c: Column) -> Column:
    """Printable start of a rejected value."""
    return F.substring(F.regexp_replace(c, CONTROL_CHARACTERS, REPLACEMENT), 1, PREVIEW_LENGTH)


def clean_json_body(c: Column) -> Column:
    """JSON object inside a noisy body: control characters dropped, then the
    outermost braces; null when there is none."""
    inner = F.regexp_extract(F.regexp_replace(c, CONTROL_CHARACTERS, ""), r"(?s)\{.*\}", 0)
    return F.when(inner != "", inner)


def url_encoded(c: Column) -> Column:
    """Form encoding of a query value."""
    return F.url_encode(c)
