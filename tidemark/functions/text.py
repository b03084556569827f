"""Text expressions for logs, paths and identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import MESSAGE_LIMIT


def failed_log_name(filename: Column) -> Column:
    """File name of a failure log: path separators become ``_`` and it ends in ``.error``."""
    flat = F.translate(filename, "/\\", "__")
    return F.when(flat.endswith(".error"), flat).otherwise(F.concat(flat, F.lit(".error")))


def short_message(message: Column, limit: int = MESSAGE_LIMIT) -> Column:
    return F.substring(message, 1, limit)


def plain_path(file_uri: Column) -> Column:
    """``_metadata.file_path`` (percent-encoded) in the spelling a file listing uses.

    Runs for every row, so paths without an escape, nearly all, are passed on as they
    are. ``url_decode`` follows the form convention where ``+`` means a space; a literal
    ``+`` is protected first.
    """
    decoded = F.url_decode(F.replace(file_uri, F.lit("+"), F.lit("%2B")))
    return F.when(file_uri.contains("%"), decoded).otherwise(file_uri)


def glob_literal(path: str) -> str:
    """``path`` with glob characters escaped, for readers that expand patterns."""
    return "".join("\\" + c if c in "\\[]{}*?" else c for c in path)


def new_batch_id() -> str:
    """One random identifier, drawn once on the driver (a column function would differ per row)."""
    return str(uuid.uuid4())


def slice_batch_id(batch_id: str | Column, batch_num: Column) -> Column:
    base = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return F.concat(base, F.lit("_b"), batch_num.cast("string"))
