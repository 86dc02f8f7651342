import hashlib

from nearkin.llm import warc

HTML = (
    "<!DOCTYPE html><html lang='fr'><head><title> A &amp; B\n</title><style>p{}</style></head><body><!-- no --><script>var x='</p>'</script>"
    "<p>One  <b>two</b>&nbsp;three<br>four &lt;five&gt;</p>\n<div>\n<ul><li>six</li></ul> &copy; é</div></body></html>"
)


def records(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, block string, header string")
    responses = warc.responses(pages, date="2024-05-06T07:08:09Z")
    return responses, warc.derivatives(responses)


def test_records_are_linked_and_digests_hold(spark):
    responses, derived = records(spark, [(1, "http://x.com/", HTML, "clash", "clash"), (2, None, None, None, None), (1, "http://x.com/", HTML, "c", "c")])
    source = {r.page_id: r for r in responses.collect()}
    rows = derived.collect()
    assert len(rows) == 6
    for r in rows:
        own = source[r.page_id]
        assert r.refers_to == own.record_id and f"WARC-Refers-To: {own.record_id}\r\n" in r.header
        assert (r.target_uri, r.date, r.payload_digest) == (own.target_uri, own.date, own.payload_digest)
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.header.startswith(f"WARC/1.1\r\nWARC-Type: {r.warc_type}\r\n") and r.header.endswith(f"Content-Length: {len(r.block.encode())}\r\n\r\n")
        http, payload = own.block.split("\r\n\r\n", 1)
        assert own.payload_digest == "sha256:" + hashlib.sha256(payload.encode()).hexdigest()
        if r.warc_type == "metadata":
            conversion = next(x for x in rows if x.page_id == r.page_id and x.warc_type == "conversion")
            assert f"conversion: {conversion.record_id}\r\n" in r.block and own.payload_digest in r.block
            assert all(f"http-header: {line}\r\n" in r.block for line in http.split("\r\n"))
    text = {(r.page_id, r.warc_type): r.block for r in rows}
    assert text[1, "conversion"] == "One two three\nfour <five>\nsix\n© é" and text[2, "conversion"] == ""
    assert text[1, "metadata"].startswith("title: A & B\r\nlanguage: fr\r\n")


def test_named_characters(spark):
    from pyspark.sql import functions as F

    texts = ["", "a", "&", "&&lt;;", "&amp;lt;", "x &nbsp;&copy;y&unknown; &lt", "&amp;&amp;amp;", "&#39;&apos;&quot;;&gt", "é&hellip;é&mdash;", "; & ;&lt;&LT;"]
    for text, found in zip(texts, spark.createDataFrame([(t,) for t in texts], "t string").select(warc.written_out(F.col("t"))).collect()):
        for name, character in warc.ENTITIES.items():
            text = text.replace(name, character)
        assert found[0] == text


def test_long_page_files_and_empty_table(spark, tmp_path):
    responses, derived = records(spark, [(1, "http://x.com/", "<p>word</p>" * 50_000, None, None)])
    assert derived.where("warc_type = 'conversion'").first().block == "\n".join(["word"] * 50_000)
    warc.write_warc(derived, str(tmp_path / "warc"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    assert data.count(b"WARC/1.1\r\n") == 2 and data.endswith(b"\r\n\r\n")
    _, none = records(spark, [(1, "u", "h", None, None)])
    assert none.where("false").count() == 0 and warc.derivatives(responses.where("false")).count() == 0
