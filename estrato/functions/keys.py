"""Deterministic keys built from several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato.functions.text import _col

# They decide the bytes that are hashed or compared.
NULL_PART = "-1:"
CONCAT_SEPARATOR = "~"
CONCAT_NULL = "<NULL>"
RAW_HASH_PATTERN = "sha256=([a-fA-F0-9]+)"


def hash_key(*fields: Column | str) -> Column:
    """SHA-256 over length-prefixed fields; no two different tuples share the hashed text."""

    def part(field: Column | str) -> Column:
        text = _col(field).cast("string")
        # concat is NULL for a NULL field, which the coalesce turns into the NULL marker
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_PART))

    # The hash is never NULL; saying so keeps "is not null" on a 40-column key from being inferred
    # and rewritten over every column alias below it while the query is planned.
    return F.coalesce(F.sha2(F.concat(*[part(f) for f in fields]), 256), F.lit(""))


def concat_key(*fields: Column | str) -> Column:
    """Readable composite key. Not injective: prefer a struct of the fields where the text is not needed."""
    return F.concat_ws(
        CONCAT_SEPARATOR, *[F.coalesce(_col(f).cast("string"), F.lit(CONCAT_NULL)) for f in fields]
    )


def sha256_in_path(path: Column | str) -> Column:
    """Hash stored in a raw object key, NULL when the key carries none."""
    return F.nullif(F.regexp_extract(_col(path), RAW_HASH_PATTERN, 1), F.lit(""))
