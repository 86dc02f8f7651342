"""Derivatives of WARC responses: a metadata record and a plain-text conversion record for each response.

Records are rows: warc_type, record_id, target_uri, date, refers_to, header (the WARC header block), block and its digest.
Derived records name the response they come from in WARC-Refers-To and keep its target URI, date, HTTP headers
and payload digest; the metadata record also names the conversion. Ids are made from content, so a run that is repeated
gives the same records. Digests are labelled SHA-256 in hex.

A null page body is an empty payload, a null URL an empty target; pages that repeat give records with equal ids; an
empty table gives no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.llm.quality import let

EOL = "\r\n"
#: Named characters that are written out in the text.
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&copy;": "©", "&middot;": "·",
    "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&amp;": "&",
}
DROPPED = (
    r"(?s)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?is)<noscript\b[^>]*>.*?</noscript\s*>", r"(?is)<head\b[^>]*>.*?</head\s*>",
)
BREAKS = (
    r"(?i)</?(?:p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|tr|table|article|section|aside|main|nav|header|footer|blockquote|pre|form|body|html)\b[^>]*>"
)


def written_out(text: Column) -> Column:
    """The text with its named characters written out. It is cut at ampersands once; what stands between one and the next
    semicolon is looked up."""
    names = F.create_map(*[F.lit(x) for name, character in ENTITIES.items() for x in (name[1:], character)])

    def one(part: Column) -> Column:
        end = F.locate(";", part)
        known = F.concat(F.try_element_at(names, F.substring(part, F.lit(1), end)), F.substring(part, end + 1, F.length(part)))
        return F.coalesce(known, F.concat(F.lit("&"), part))

    return let(F.split(text, "&"), lambda parts: F.concat(
        F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), "")))


def plain_text(html: Column) -> Column:
    """What a page shows: a line per block element, blanks joined, tags and scripts gone."""
    text = html
    for pattern in DROPPED:
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(text, r"[ \t\r\n\f]+", " ")
    text = F.regexp_replace(text, BREAKS, "\n")
    text = written_out(F.regexp_replace(text, r"<[^>]*>", ""))
    return F.btrim(F.regexp_replace(text, r" *\n[ \n]*", "\n"), F.lit(" \n"))


def digest(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value, 256))


def record_id(*parts: Column) -> Column:
    """A URN in the form of a UUID, from the parts' content."""
    x = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def header(**fields: Column) -> Column:
    """The header block of a record; a null field is left out."""
    lines = [F.lit("WARC/1.1")] + [F.concat(F.lit(f"{k.replace('_', '-')}: "), v) for k, v in fields.items()]
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL + EOL))


def record(kind: str, urn: Column, content_type: str, block: Column) -> Column:
    return F.struct(F.lit(kind).alias("warc_type"), urn.alias("record_id"), F.lit(content_type).alias("content_type"), block.alias("block"))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages as response records. The date is when they were fetched, which the table of pages does not say."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.coalesce(F.col(url_col), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(EOL + EOL))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.lit("response").alias("warc_type"), url.alias("target_uri"), F.lit(date).alias("date"),
        F.concat(http, html).alias("block"), digest(html).alias("payload_digest"))
    rows = rows.withColumn("record_id", record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "payload_digest"))
    return rows.withColumn("header", header(
        WARC_Type=F.col("warc_type"), WARC_Record_ID=F.col("record_id"), WARC_Date=F.col("date"), WARC_Target_URI=F.col("target_uri"),
        WARC_Payload_Digest=F.col("payload_digest"), WARC_Block_Digest=digest(F.col("block")),
        Content_Type=F.lit("application/http; msgtype=response"), Content_Length=F.octet_length("block").cast("string")))


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response of `records`: its conversion and its metadata record; other types are passed over."""
    end = F.locate(EOL + EOL, F.col("block"))
    source = records.where(F.col("warc_type") == "response").select(
        "page_id", "target_uri", "date", "payload_digest", F.col("record_id").alias("refers_to"),
        F.when(end > 0, F.expr("substring(block, 1, locate('\\r\\n\\r\\n', block) - 1)")).otherwise(F.lit("")).alias("http"),
        F.when(end > 0, F.expr("substring(block, locate('\\r\\n\\r\\n', block) + 4)")).otherwise(F.col("block")).alias("html"))
    conversion = record_id(F.lit("conversion"), F.col("refers_to"))
    title = F.trim(written_out(F.regexp_replace(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title", 1), r"[ \t\r\n\f]+", " ")))
    language = F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", 1)
    http_lines = F.regexp_replace("http", r"(?m)^", "http-header: ")
    fields = F.concat_ws(EOL, F.concat(F.lit("title: "), title), F.concat(F.lit("language: "), language),
                         F.concat(F.lit("conversion: "), conversion), F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")), http_lines, F.lit(""))
    both = source.select(
        "page_id", "target_uri", "date", "refers_to", "payload_digest",
        F.inline(F.array(
            record("conversion", conversion, "text/plain; charset=utf-8", plain_text(F.col("html"))),
            record("metadata", record_id(F.lit("metadata"), F.col("refers_to")), "application/warc-fields", fields))))
    both = both.withColumn("content_length", F.octet_length("block").cast("bigint")).withColumn("block_digest", digest(F.col("block")))
    return both.withColumn("header", header(
        WARC_Type=F.col("warc_type"), WARC_Record_ID=F.col("record_id"), WARC_Date=F.col("date"), WARC_Target_URI=F.col("target_uri"),
        WARC_Refers_To=F.col("refers_to"), WARC_Block_Digest=F.col("block_digest"),
        Content_Type=F.col("content_type"), Content_Length=F.col("content_length").cast("string")))


def write_warc(records: DataFrame, folder: str) -> None:
    """The records as WARC files, one per task."""
    records.select(F.concat("header", "block")).write.option("lineSep", EOL + EOL).text(folder)
