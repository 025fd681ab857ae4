"""Operator 4: round trip, revisits, random access, odd rows."""
import hashlib

import zstandard

from topiclake.llm import files, warc

from .helpers import rows_of

SCHEMA = "page_id long, url string, html string, record_type string, row int"


def test_round_trip_and_revisits(spark, scratch):
    big = "<p>" + "x" * 100 + "é</p>"
    rows = [(5, "http://a/1", big), (3, "http://a/2", big), (9, None, big), (4, "u", "small"), (6, "u", "small"),
            (7, "u", None), (8, "u\r\nX-Bad: 1", ""), (None, "n", "<p>null id " + "y" * 120), (10, "l", "z" * 700_000),
            (11, "r", "WARC/1.1\r\n\r\n" * 20), (11, "r", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    manifest = warc.write_bundles(pages, scratch, frame_bytes=1000)
    out = warc.read_bundles(manifest, scratch).collect()
    assert len(out) == len(rows)
    for r in out:
        payload = next((h or "").encode() for i, _, h in rows if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.payload is None) == (r.record_type == "revisit")
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in out)
    assert (3, "response", None) in kinds and (5, "revisit", 3) in kinds and (9, "revisit", 3) in kinds
    assert kinds.count((11, "response", None)) == 1 and kinds.count((11, "revisit", 11)) == 1
    assert (4, "response", None) in kinds and (6, "response", None) in kinds  # under 100 bytes

    found = 0
    for m in manifest.collect():
        reader = warc.BundleReader(scratch, m.name)
        for name, frame, _ in reader.index:
            head, payload = reader.record(name)
            assert head["WARC-Record-ID"] == f"<urn:page:{name}>" and frame < len(reader.frames)
            found += 1
        # an ordinary reader skips index and seek table and sees the plain records
        fs, root = files.filesystem(scratch)
        with fs.open_input_file(f"{root}/{m.name}") as f:
            plain = zstandard.ZstdDecompressor().stream_reader(f.read(), read_across_frames=True).read()
        assert plain == b"".join(reader.frame(i) for i in range(len(reader.frames)))
    assert found == len(rows)


def test_null_and_repeated_ids_equal_sql(spark, scratch, duck):
    import pandas as pd
    big, other = "<p>" + "x" * 120, "<p>" + "y" * 120
    rows = [(None, big), (3, big), (None, big), (4, big), (7, other), (7, other), (None, "small"), (None, "small")]
    pages = spark.createDataFrame([(i, None, h, "clash", 1) for i, h in rows], SCHEMA)
    got = warc.read_bundles(warc.write_bundles(pages, scratch), scratch).toPandas()
    table = pd.DataFrame(rows, columns=["page_id", "html"])
    table["page_id"] = table["page_id"].astype("Int64")
    want = duck(warc.OP4_SQL, pages=table)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(got, cols) == rows_of(want, cols)
    assert len(got[(got.record_type == "response") & (got.page_id == 3)]) == 1


def test_empty_table(spark, scratch):
    manifest = warc.write_bundles(spark.createDataFrame([], SCHEMA), scratch)
    assert warc.read_bundles(manifest, scratch).count() == 0
