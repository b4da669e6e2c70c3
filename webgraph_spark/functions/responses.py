"""Classification of fetch results as Column expressions (CLS-1, CLS-2, CLS-6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webgraph_spark.schemas import DEFAULT_COLOUR, MIME_CODES, TYPE_COLOURS

FAILED_STATUS = 500


def data_type_code(content_type: Column) -> Column:
    """Code of an exactly matching MIME type, else NULL."""
    code = F.lit(None).cast("string")
    for mime, name in MIME_CODES.items():
        code = F.when(content_type == mime, F.lit(name)).otherwise(code)
    return code


def _request_failed(status: Column, error: Column) -> Column:
    return error.isNotNull() | status.isNull() | (status >= 400)


def page_type(
    robots_ok: Column, error: Column, status: Column, content_type: Column, rendered: Column, duplicate: Column
) -> Column:
    """Type of a fetched page; the first condition that holds wins."""
    mime = F.coalesce(content_type, F.lit(""))
    return (
        F.when(~robots_ok, "DISALLOWED")
        .when(_request_failed(status, error), "ERROR")
        .when(
            mime.contains("text/html"),
            F.when(~F.coalesce(rendered, F.lit(False)), "ERROR")
            .when(F.coalesce(duplicate, F.lit(False)), "DUPLICATE")
            .otherwise("HTML"),
        )
        .when(mime.contains("image"), "IMAGE")
        .otherwise("BINARY")
    )


def stored_status(type_code: Column, status: Column) -> Column:
    """The real code survives only for pages that were fetched without error."""
    return F.when(type_code.isin("DISALLOWED", "ERROR"), F.lit(FAILED_STATUS)).otherwise(status).cast("int")


def type_colour(type_code: Column) -> Column:
    colour = F.lit(DEFAULT_COLOUR)
    for code, name in TYPE_COLOURS.items():
        colour = F.when(type_code == code, F.lit(name)).otherwise(colour)
    return colour
