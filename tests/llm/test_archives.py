"""ARC to WARC and back."""

import base64
import gzip
import hashlib

import pytest

from readtrack.llm import op6_warc


def test_arc_versions():
    body = "<p>né\r\n\r\n</p>".encode()
    for version in (1, 2):
        data = op6_warc.arc_version_block(version) + op6_warc.arc_record("http://a b/", body, version) + op6_warc.arc_record(None, b"", version)
        one, two = op6_warc.parse_arc(data)
        assert one["URL"] == "http://a%20b/" and one["block"].endswith(body) and two["URL"] == "-"
        (bare,) = op6_warc.parse_arc(op6_warc.arc_record("u", body, version))
        assert bare["block"].endswith(body)
        record = op6_warc.to_warc(one, 5)
        ((heads, block),) = op6_warc.parse_warc(iter([record + b"\r\n\r\n"]))
        assert heads["WARC-Type"] == "response" and block == one["block"] and heads["WARC-Payload-Digest"][5:] == base64.b32encode(hashlib.sha1(body).digest()).decode()
    cut = list(op6_warc.parse_arc(data[:-20]))
    assert cut[0] == one and set(cut[1]) == {"error", "at", "line"} and "declared" in cut[1]["error"]
    with pytest.raises(ValueError):
        list(op6_warc.parse_warc(iter([record[:-5]])))


def test_unzip_of_many_members():
    parts = [b"a" * 100_000, b"", b"b" * 3]
    data = b"".join(map(gzip.compress, parts))
    for size in (1, 7, 1000, len(data)):
        assert b"".join(op6_warc.unzipped((data[i : i + size] for i in range(0, len(data), size)), 1000)) == b"".join(parts)
    assert b"".join(op6_warc.unzipped([b"WARC", b"/1.0"])) == b"WARC/1.0"


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://x", "<p>a</p>"), (2, "http://y", "<p>a</p>"), (9, None, None), (8, "http://z", ""), (3, "http://é/", "b\r\n\r\nWARC/1.0\r\n"), (4, "u", "c" * 300_000), (4, "u", "c" * 300_000), (None, "n", "<p>a</p>"), (None, "m", "only")]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    op6_warc.write_warc(pages, str(tmp_path / "w"))
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in op6_warc.read_warc(spark, str(tmp_path / "w")).collect())
    assert got == sorted([
        ("1", 8, "revisit", 2), ("2", 8, "response", None), ("9", 0, "response", None), ("8", 0, "revisit", 9), ("3", 15, "response", None), ("4", 300_000, "response", None), ("4", 300_000, "response", None),
        ("None", 8, "revisit", 2), ("None", 4, "response", None),
    ])
    assert sorted(map(str, op6_warc.read_warc(spark, str(tmp_path / "w"), whole=0).collect())) == sorted(map(str, op6_warc.read_warc(spark, str(tmp_path / "w")).collect()))
    heads = [h for f in (tmp_path / "w").glob("part-*") for h, _ in op6_warc.parse_warc(op6_warc.unzipped([f.read_bytes()]))]
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(set(ids)) == len(ids) == len(rows)
    of_page = {h.get("X-Page-ID"): h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response"}
    assert all(h["WARC-Refers-To"] == of_page[h["X-Refers-To-Page-ID"]] for h in heads if h["WARC-Type"] == "revisit")
    op6_warc.write_warc(pages, str(tmp_path / "least"), least_bytes=10**6)
    assert op6_warc.read_warc(spark, str(tmp_path / "least")).where("record_type = 'revisit'").count() == 0
    op6_warc.write_warc(pages.limit(0), str(tmp_path / "none"))
    assert op6_warc.read_warc(spark, str(tmp_path / "none")).count() == 0


def test_repeated_rows_have_ids_of_their_own(spark, tmp_path):
    rows = [(7, "u", "x")] * 3 + [(5, "u", "x"), (None, None, None), (None, None, ""), (9, "v", ""), (9, "v", "")]
    op6_warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    heads = [h for f in (tmp_path / "w").glob("part-*") for h, _ in op6_warc.parse_warc(op6_warc.unzipped([f.read_bytes()]))]
    assert len({h["WARC-Record-ID"] for h in heads}) == len(rows)
    assert sorted(h["WARC-Type"] for h in heads) == ["response"] * 5 + ["revisit"] * 3
    assert not [h for h in heads if "WARC-Refers-To" in h]  # three and two responses: none is the one


def test_archives_of_any_bytes(spark, tmp_path):
    """ARC files on disk, of both versions, with payloads that are no UTF-8 and documents that are no HTTP."""
    (tmp_path / "arc").mkdir()
    bodies = [b"\xff\xfe\x00caf\xe9", b"", "é".encode("latin-1") * 1000]
    for version in (1, 2):
        data = op6_warc.arc_version_block(version) + b"".join(op6_warc.arc_record(f"http://h/{i}", x, version) for i, x in enumerate(bodies))
        raw = b"plain\r\n\r\ntext \x80"
        tail = ["dns:h", "0.0.0.0", "20010203", "text/dns"] + (["200", "-", "-", "0", "f"] if version == 2 else [])
        data += f"{' '.join([*tail, str(len(raw))])}\n".encode() + raw + b"\n"
        (tmp_path / "arc" / f"{version}.arc").write_bytes(data if version == 1 else gzip.compress(data))
    op6_warc.convert_arcs(spark, str(tmp_path / "arc"), str(tmp_path / "w"))
    records = [x for f in (tmp_path / "w").glob("part-*") for x in op6_warc.parse_warc(op6_warc.unzipped([f.read_bytes()]))]
    assert len(records) == 8 and len({h["WARC-Record-ID"] for h, _ in records}) == 8
    payloads = sorted(b.partition(b"\r\n\r\n")[2] if h["WARC-Type"] == "response" else b for h, b in records)
    assert payloads == sorted([*bodies, raw] * 2)
    assert {h["WARC-Date"] for h, _ in records if h["WARC-Type"] == "resource"} == {"2001-02-03T00:00:00Z"}
    got = op6_warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted(r["payload_bytes"] for r in got) == sorted(len(x) for x in payloads)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_files_and_back(spark, tmp_path, version):
    pages = spark.createDataFrame([(1, "http://a b", "<p>é</p>"), (2, None, None), (3, "http://c", "x\n\ny")], "page_id long, url string, html string")
    op6_warc.write_arc(pages, str(tmp_path / "a"), version)
    op6_warc.convert_arcs(spark, str(tmp_path / "a/part-*"), str(tmp_path / "w"))
    got = op6_warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sorted((r["payload_bytes"], r["record_type"]) for r in got) == [(0, "response"), (4, "response"), (9, "response")]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("step", [1, 13, 10**6])
def test_odd_arc_files(version, step):
    """Spaces in addresses, lines that are no header, a version block of one line, line ends of two bytes, a record cut off: read in pieces of any size."""
    rest = " ".join(["1.2.3.4", "20020304050607", "text/html", *(["200", "sum", "-", "0", "f.arc"] if version == 2 else [])])
    entry = lambda url, body, end="\n": f"{url} {rest} {len(body)}{end}".encode() + body + b"\n"
    named = op6_warc.arc_version_block(version)
    short = f"filedesc://x 0.0.0.0 20020304 text/plain {'200 - - 0 x ' if version == 2 else ''}3\n".encode() + f"{version} 0".encode() + b"\n"
    bodies = [b"HTTP/1.0 200 OK\r\n\r\na b", b"", b"\n\n\n", b"x" * 50]
    urls = ["http://h/a b  c", "http://h/1 2 3 4 5 6", "u", "http://h/\u00e9 20020304"]
    good = [entry(u, b, "\r\n" if i == 2 else "\n") for i, (u, b) in enumerate(zip(urls, bodies, strict=True))]
    for block in (named, short, b""):
        data = block + good[0] + good[1] + b"broken line\nand more\n\n" + good[2] + good[3] + good[0][:-9]
        found = list(op6_warc.parse_arc(data[i : i + step] for i in range(0, len(data), step)))
        kept = [x for x in found if "error" not in x]
        assert [x["block"] for x in kept] == bodies
        if block or version == 2:
            assert [x["URL"] for x in kept] == urls
        bad = [x for x in found if "error" in x]
        assert [x["line"] for x in bad] == ["broken line", good[0].split(b"\n")[0].decode()] and all(data[x["at"] :].decode().startswith(x["line"]) for x in bad)


def test_bad_entries_and_long_archives(spark, tmp_path):
    """One bad record ends no job; archives read as streams give what archives read as rows give."""
    (tmp_path / "arc").mkdir()
    good = b"".join(op6_warc.arc_record(f"http://h/{i}", b"y" * (i * 1000), 1) for i in range(30))
    (tmp_path / "arc" / "a.arc").write_bytes(op6_warc.arc_version_block(1) + good + b"junk here\n" + good[:-1500])
    (tmp_path / "arc" / "b.arc.gz").write_bytes(b"".join(gzip.compress(x) for x in (op6_warc.arc_version_block(1), good)))
    (tmp_path / "arc" / "c.arc").write_bytes(b"")
    rows = []
    for whole in (0, 1 << 20):
        op6_warc.convert_arcs(spark, str(tmp_path / "arc"), str(tmp_path / f"w{whole}"), whole)
        rows.append(sorted(map(str, op6_warc.read_warc(spark, str(tmp_path / f"w{whole}")).collect())))
        bad = op6_warc.bad_entries(spark, str(tmp_path / "arc"), whole).collect()
        assert [(r["path"][-5:], r["error"][:9]) for r in sorted(bad, key=lambda r: r["at"])] == [("a.arc", "no header"), ("a.arc", bad[-1]["error"][:9])] and "declared" in sorted(bad, key=lambda r: r["at"])[1]["error"]
    assert rows[0] == rows[1] and len(rows[0]) == 89


def test_a_gigabyte_in_bounded_memory():
    import tracemalloc

    body = b"z" * (8 << 20)
    record = op6_warc.arc_record("http://h/", body, 1)

    def pieces():
        for _ in range(128):
            for i in range(0, len(record), 1 << 20):
                yield record[i : i + (1 << 20)]

    tracemalloc.start()
    assert sum(len(x["block"]) for x in op6_warc.parse_arc(pieces())) > 1 << 30
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()
