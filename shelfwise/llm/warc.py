"""Web-archive derivatives: metadata and plain-text conversion records from response records.

Every response yields two records that name it in ``WARC-Refers-To`` and each other in
``WARC-Concurrent-To``: ``metadata`` carries the source's headers, digest, title and links as
``application/warc-fields``; ``conversion`` carries its text as ``text/plain``. Both keep the
target address, date and digest of the source; their own block has a digest and a length in bytes.
Record ids are made from the source's, so a repeated run gives the same ids.

Character references that end in ``;`` are decoded, all at once. A comment, a script or the like that never
ends is left to the rule for tags; many begins of such a one (not of comments) in one page take time
that grows with their square.

A null page id, address or body counts as empty. Repeated rows give repeated records. An empty table
gives none. Columns beyond the named ones are not carried along. Only DataFrame expressions are
used for deriving; ``read_records`` parses files with Python.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.spans import bound

CRLF = "\r\n"
_RECORD = "warc_type string, record_id string, headers map<string,string>, block binary"


def _text(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def _one_line(text: Column) -> Column:
    return F.regexp_replace(text, "[\r\n]+", " ")


def _urn(seed: Column) -> Column:
    h = F.md5(seed.cast("binary"))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records of crawled pages: their HTTP header is what is known of the page."""
    body = _text("html")
    header = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
    )
    return pages.select(
        "page_id",
        _urn(F.concat(F.lit("response "), _text("page_id"), F.lit(" "), _text("url"))).alias(
            "record_id"
        ),
        _one_line(_text("url")).alias("target_uri"),
        F.lit(date).alias("warc_date"),
        header.alias("http_header"),
        body.alias("payload"),
    )


def _replace(text: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


# In order: comments, other parts that are not text, breaks between blocks, other tags; white space.
COMMENT = (r"(?is)<!--.*?-->", " ")
HIDDEN = "|".join(rf"{tag}\b[^>]*>.*?</{tag}" for tag in ("script", "style", "noscript", "head"))
TAG_STEPS = (
    (rf"(?is)<(?:{HIDDEN})\s*>", " "),
    (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
SPACE_STEPS = ((r"[ \t\f\r]+", " "), (r" ?\n[ \n]*", "\n"))
ONE_LINE = ((r"[ \t\f\r\n]+", " "),)
#: A link's tag up to the end of its address: in double, single or no quotes.
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
LINK_STEPS = ((r"(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*", ""), (r"""^["']|["']$""", ""))
#: A character reference: by decimal or hexadecimal number, or by name.
REFERENCE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
#: What a number means that names no character.
NO_CHARACTER = "\ufffd"


def named_characters() -> dict[str, str]:
    """Text of the references by name, and of the numbers 128 to 159, which mean those of Windows.

    Spaces that do not break are plain ones in plain text.
    """
    names = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    for n in range(128, 160):
        names[f"#{n}"] = bytes([n]).decode("cp1252", "ignore") or chr(n)
    return {**names, "#160": "\u00a0"} | {k: v.replace("\u00a0", " ") for k, v in [*names.items(), ("#160", " ")]}


def _character(name: Column, names: Column) -> Column:
    """Text of a reference; one without a meaning stays as it is."""
    hexadecimal = F.substring(name, 2, 1).isin("x", "X")
    digits = F.when(hexadecimal, F.conv(F.ltrim(F.substring(name, 3, 1 << 30), F.lit("0")), 16, 10)).otherwise(
        F.ltrim(F.substring(name, 2, 1 << 30), F.lit("0"))
    )
    # Longer numbers name no character, and would not fit a number here.
    code = F.when(F.length(digits) <= 9, F.concat(F.lit("0"), digits).cast("int")).otherwise(0)
    real = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    known = F.try_element_at(names, F.concat(F.lit("#"), code.cast("string")))
    number = F.when(real, F.coalesce(known, text)).otherwise(F.lit(NO_CHARACTER))
    own = F.coalesce(F.try_element_at(names, name), F.concat(F.lit("&"), name, F.lit(";")))
    return F.when(name.startswith("#"), number).otherwise(own)


def _decoded(text: Column) -> Column:
    """All character references replaced in one pass, so that what one stands for is not read again."""
    names = F.from_json(F.lit(json.dumps(named_characters())), "map<string,string>")

    def decoded(text):
        pieces = F.zip_with(
            F.split(text, REFERENCE, -1),
            F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)),
            lambda gap, name: F.concat(gap, F.coalesce(_character(name, names), F.lit(""))),
        )
        return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)

    return bound(text, decoded)


def _up_to_last(html: Column, end: str, *steps: tuple[str, str]) -> Column:
    """Steps whose matches end in ``end``, taken up to its last place: behind it all begins look in vain."""

    def replaced(html):
        rest = F.substring_index(html, end, -1)
        head = F.substring(html, F.lit(1), F.length(html) - F.length(rest))
        return F.concat(_replace(head, *steps), rest)

    return bound(html, lambda h: F.when(h.contains(end), replaced(h)).otherwise(h))


def plain_text(html: Column) -> Column:
    text = _decoded(_up_to_last(_up_to_last(html, "-->", COMMENT), ">", *TAG_STEPS))
    return F.btrim(_replace(text, *SPACE_STEPS), F.lit(" \n"))


def _fields(*lines: tuple[str, Column]) -> Column:
    return F.concat(
        *[part for name, value in lines for part in (F.lit(f"{name}: "), value, F.lit(CRLF))]
    )


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows per response: page_id, the record's header fields, ``header`` and ``block``."""
    title = F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title>", 1)
    title = _replace(_decoded(_replace(title, *TAG_STEPS[2:])), *ONE_LINE)
    links = F.regexp_extract_all("payload", F.lit(LINK), F.lit(0))
    link = lambda x: _one_line(_replace(x, *LINK_STEPS))
    read = source.select(
        "*",
        _digest(F.col("payload")).alias("source_digest"),
        plain_text(F.col("payload")).alias("plain"),
        F.trim(title).alias("title"),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), link(x), F.lit(CRLF))), "").alias(
            "outlinks"
        ),
        _urn(F.concat(F.lit("metadata "), F.col("record_id"))).alias("metadata_id"),
        _urn(F.concat(F.lit("conversion "), F.col("record_id"))).alias("conversion_id"),
    )
    headers = F.concat(
        F.lit("source-header: "),
        F.replace(F.col("http_header"), F.lit(CRLF), F.lit(f"{CRLF}source-header: ")),
        F.lit(CRLF),
    )
    known = F.concat(
        headers,
        _fields(
            ("source-digest", F.col("source_digest")),
            ("title", F.col("title")),
            ("text-length", F.length("plain").cast("string")),
        ),
        F.col("outlinks"),
    )

    def record(kind: str, own: str, other: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"),
            F.col(own).alias("record_id"),
            F.col(other).alias("concurrent_to"),
            F.lit(content_type).alias("content_type"),
            block.alias("block"),
        )

    both = F.array(
        record("metadata", "metadata_id", "conversion_id", "application/warc-fields", known),
        record("conversion", "conversion_id", "metadata_id", "text/plain; charset=utf-8", F.col("plain")),
    )
    rows = read.select(
        "page_id",
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "warc_date",
        "source_digest",
        F.explode(both).alias("r"),
    ).select("page_id", "refers_to", "target_uri", "warc_date", "source_digest", "r.*")
    rows = rows.withColumns(
        {
            "block_digest": _digest(F.col("block")),
            "content_length": F.octet_length("block").cast("long"),
        }
    )
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _fields(
            ("WARC-Type", F.col("warc_type")),
            ("WARC-Record-ID", F.col("record_id")),
            ("WARC-Date", F.col("warc_date")),
            ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Refers-To", F.col("refers_to")),
            ("WARC-Concurrent-To", F.col("concurrent_to")),
            ("WARC-Source-Digest", F.col("source_digest")),
            ("WARC-Block-Digest", F.col("block_digest")),
            ("Content-Type", F.col("content_type")),
            ("Content-Length", F.col("content_length").cast("string")),
        ),
    )
    return rows.withColumn("header", header)


def write_records(records: DataFrame, path: str) -> None:
    """Gzipped record files, one per task, on whatever file system Spark writes to."""
    whole = F.concat("header", F.lit(CRLF), "block", F.lit(CRLF))
    lines = records.select(whole.alias("value")).write
    lines.option("lineSep", CRLF).option("compression", "gzip").text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of one file, gzipped or not."""
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.partition(b":")
            fields[name.decode()] = value.strip().decode()
        yield fields, stream.read(int(fields["Content-Length"]))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """warc_type, record_id, headers and block of every record below ``path``."""

    def records(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = [
                    (h.get("WARC-Type"), h.get("WARC-Record-ID"), h, block)
                    for h, block in parse(content)
                ]
                yield pd.DataFrame(rows, columns=["warc_type", "record_id", "headers", "block"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInPandas(records, _RECORD)
