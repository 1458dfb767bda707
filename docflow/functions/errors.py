"""Classification of extraction errors by their message."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docflow.functions.text import ColumnOrName, col

# --- fixed values: message patterns ---
TRANSIENT_TERMS = (
    "RESOURCE_EXHAUSTED",
    "UNAVAILABLE",
    "DEADLINE_EXCEEDED",
    "INTERNAL",
    "BAD GATEWAY",
    "SERVICE UNAVAILABLE",
    "GATEWAY TIMEOUT",
    "TIMEOUT",
    "TIMED OUT",
)
TRANSIENT_CODES = ("429", "500", "502", "503", "504")
INVALID_ARGUMENT = "INVALID_ARGUMENT"
INVALID_ARGUMENT_CODE = "400"
PDF_MIME = "APPLICATION/PDF"
TOO_LARGE = "EXCEEDS MAX ALLOWED FILE SIZE"


def _standalone(*codes: str) -> str:
    return rf"(?<![0-9])(?:{'|'.join(codes)})(?![0-9])"


def _says(pattern: str, message: ColumnOrName) -> Column:
    return F.upper(col(message)).rlike(pattern)


def is_invalid_argument(message: ColumnOrName) -> Column:
    return _says(f"{INVALID_ARGUMENT}|{_standalone(INVALID_ARGUMENT_CODE)}", message)


def is_file_size_error(message: ColumnOrName) -> Column:
    text = F.upper(col(message))
    return (
        is_invalid_argument(message) & text.contains(PDF_MIME) & text.contains(TOO_LARGE)
    )


def is_transient(message: ColumnOrName) -> Column:
    pattern = "|".join(TRANSIENT_TERMS) + "|" + _standalone(*TRANSIENT_CODES)
    return ~is_file_size_error(message) & _says(pattern, message)


def error_outcome(
    message: ColumnOrName, mime: ColumnOrName = "mime_type", stage: ColumnOrName = "stage"
) -> Column:
    """What an error leads to: ``split``, ``retry``, ``empty`` or ``fail``.

    ``stage`` is ``direct`` for a whole document and anything else for a chunk
    or merge call, where a rejected argument is final.
    """
    direct = col(stage) == "direct"
    return (
        F.when(
            direct & (col(mime) == "application/pdf") & is_file_size_error(message),
            "split",
        )
        .when(is_transient(message), "retry")
        .when(direct & is_invalid_argument(message), "empty")
        .otherwise("fail")
    )
