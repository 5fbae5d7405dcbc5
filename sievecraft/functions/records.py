"""Hashes, the train/validation split and the size of JSON Lines records, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_hash(code: Column) -> Column:
    return F.sha2(code, 256)


def split(repository: Column, seed: int, validation_ratio: float) -> Column:
    """"validation" for a fixed share of repositories, by the first 32 bits of a seeded SHA-256; else "train"."""
    if validation_ratio <= 0:
        return F.lit("train")
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), repository), 256), 1, 8)
    return F.when(F.conv(head, 16, 10).cast("double") / 0xFFFFFFFF < validation_ratio, "validation").otherwise("train")


def seeded_rank(name: Column, seed: int, stage: str) -> Column:
    """What random picks are ordered by: the same for every partitioning, another for each seed and stage."""
    return F.sha2(F.concat(F.lit(f"{seed}:{stage}:"), name), 256)


def record(text: Column, metadata: Column | None = None) -> Column:
    return F.struct(text.alias("text")) if metadata is None else F.struct(text.alias("text"), metadata.alias("metadata"))


def record_bytes(text: Column, metadata: Column | None = None, metadata_fields: int = 0) -> Column:
    """Bytes of the record's line as Python's json module writes it: a blank after each colon and comma, a line feed."""
    if metadata is None:
        return (F.octet_length(F.to_json(record(text))) + 2).cast("long")
    blanks = (2 + metadata_fields) + (1 + metadata_fields - 1)
    return (F.octet_length(F.to_json(record(text, metadata), {"ignoreNullFields": "false"})) + blanks + 1).cast("long")


#: Where source files are found, and what ends a file in the text export.
_HOST, _FILE_END = "https://github.com/", "\n<|file_end|>\n\n"


def source_url(owner: Column, name: Column, branch: Column, path: Column) -> Column:
    return F.concat(F.lit(_HOST), owner, F.lit("/"), name, F.lit("/blob/"), branch, F.lit("/"), path)


def export_text(text: Column) -> Column:
    """A file of the text export, with the mark that ends it."""
    return F.concat(text, F.lit(_FILE_END))


def utf8(raw: Column) -> Column:
    """Bytes as text; what is not UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))
