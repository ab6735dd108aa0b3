"""Expressions over binary cells: file type, content address, download envelope."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Leading bytes of each file type, tested in this order after JPEG and markup.
JPEG_MAGIC = b"\xff\xd8\xff"
MARKUP_PATTERN = r"^[ \t\n\r\x0B\f]*<"
BLANK_PATTERN = r"^[ \t\n\r\x0B\f]*$"
MAGIC = {
    b"\x89PNG\r\n\x1a\n": ".png",
    b"%PDF-": ".pdf",
    b"GIF87a": ".gif",
    b"GIF89a": ".gif",
}
DEFAULT_EXTENSION = ".bin"
DEFAULT_CONTENT_TYPE = "application/octet-stream"
SNIFFED_BYTES = 64
LINK_SUFFIX = "_s3_path"
BLOB_FOLDER = "blobs"


def binary_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]


def sniff_extension(content: Column) -> Column:
    """File extension from the first bytes; any markup counts as .xml."""

    def starts(magic: bytes) -> Column:
        return F.startswith(content, F.lit(magic))

    # The whole cell is decoded only where its beginning is nothing but white space.
    begin = F.decode(F.substring(content, 1, SNIFFED_BYTES), "ISO-8859-1")
    markup = F.when(begin.rlike(BLANK_PATTERN), F.decode(content, "ISO-8859-1").rlike(MARKUP_PATTERN))
    extension = F.when(starts(JPEG_MAGIC), F.lit(".jpg")).when(
        markup.otherwise(begin.rlike(MARKUP_PATTERN)), F.lit(".xml")
    )
    for magic, name in MAGIC.items():
        extension = extension.when(starts(magic), F.lit(name))
    return extension.otherwise(F.lit(DEFAULT_EXTENSION))


def blob_link(folder: Column, content: Column) -> Column:
    """Content address of a cell; empty and NULL cells have none."""
    address = F.concat(folder, F.lit("/"), F.sha2(content, 256), sniff_extension(content))
    return F.when(F.octet_length(content) > 0, address)


def blob_folder(root: str, db: str, schema: str, segment: str, column: str) -> str:
    parts = [BLOB_FOLDER, *(p.lower() for p in (db, schema, segment, column))]
    return "/".join([root.rstrip("/"), *parts])


def link_digest(link: Column) -> Column:
    """sha256 part of a link or key; NULL when there is none."""
    digest = F.regexp_extract(link, r"([0-9a-f]{64})(?:\.[a-z]+)?$", 1)
    return F.when(digest != "", digest)


def link_extension(link: Column) -> Column:
    return F.regexp_extract(link, r"(\.[A-Za-z0-9]+)$", 1)


def content_type(key: Column) -> Column:
    """Content type by file extension, from the registry Python ships with."""
    known = mimetypes.MimeTypes(filenames=()).types_map[True]
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.try_element_at(table, F.lower(link_extension(key)))
    return F.coalesce(found, F.lit(DEFAULT_CONTENT_TYPE))


def base64_text(content: Column) -> Column:
    return F.regexp_replace(F.base64(content), "[\r\n]", "")


def download_envelope(df: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """Add body, content type, file name and attachment header for a blob."""
    name = F.substring_index(F.col(key), "/", -1)
    return df.withColumns(
        {
            "content_type": content_type(F.col(key)),
            "file_name": name,
            "content_disposition": F.format_string('attachment; filename="%s"', name),
            "body": base64_text(F.col(content)),
        }
    ).drop(content)
