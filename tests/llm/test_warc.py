"""WARC archives: round trips, ranges of every size, and bytes that only look like a record."""

import gzip
import hashlib
import io
import os
import random
import zlib

import corpora

from equitylake.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string"


def expected(rows):
    """The contract, row by row."""
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for body, pages in groups.items():
        sha1, first = hashlib.sha1(body).hexdigest(), max(pages, key=lambda p: (p is not None, p or 0))
        pages = list(pages)
        if len(body) >= 1000:
            pages.remove(first)
            out.append((first, len(body), sha1, "response", None))
            out += [(p, len(body), sha1, "revisit", first) for p in pages]
        else:
            out += [(p, len(body), sha1, "response", None) for p in pages]
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=str)


def pages(n=60):
    pick = random.Random(4)
    big = [corpora.words(i, 400) for i in range(6)]
    rows = [(i, f"http://h/{i}", pick.choice([*big, "short", "", None, "é" * 500, "é" * 499, corpora.words(100 + i, 300)])) for i in range(n)]
    return rows + [(7, None, big[0]), (7, "u\r\nWARC-Type: x", big[0]), (None, "a", big[1]), (None, "a", "x" * 1000), (None, "a", "x" * 1000), (None, "b", "x" * 1000)]


def test_query_matches_the_contract(spark, scratch):
    rows = pages() + [(500, "same", "y" * 2000)] * 3 + [(500, "other", "y" * 2000), (3, "same", "y" * 2000)]
    corpora.write(spark.createDataFrame(rows, SCHEMA).repartition(3), scratch, "pages")
    assert as_rows(queries.QUERIES["op13_warc"](spark, scratch)) == expected(rows)


def test_every_split_gives_each_record_once(spark, scratch):
    rows = pages()
    archives = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(2), f"{scratch}/w", archive_bytes=4000)
    listed = archives.collect()
    assert len(listed) > 2 and sum(os.path.getsize(r.archive) for r in listed) == sum(r.size for r in listed)
    for split in (97, 1000, 1 << 20):
        found = warc.read_archives(archives, split)
        assert as_rows(warc.page_rows(found)) == expected(rows)
    read = found.where("record_type = 'response'").collect()
    assert all(r.digest_ok for r in read)
    bodies = sorted((bytes(r.payload) for r in read))
    assert set(bodies) == {(h or "").encode() for _, _, h in rows}


def test_other_tools_read_the_archives(spark, scratch):
    archives = warc.write_archives(spark.createDataFrame(pages(), SCHEMA), f"{scratch}/w").collect()
    whole = b"".join(gzip.open(r.archive).read() for r in archives)
    assert whole.count(b"WARC/1.1\r\n") == 66 + len(archives)


def in_ranges(data, split):
    out = []
    for start in range(0, len(data), split):
        out += [(o, c) for o, c in warc.records(warc._Bytes(io.BytesIO(data), len(data)), start, min(start + split, len(data)))]
    return out


def test_an_archive_inside_a_payload_is_no_record():
    pick = random.Random(1)
    inner = b"".join(warc.page_record(i, "in", "ab" * 20, 3000, pick.randbytes(3000), None, "") for i in range(40))
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)  # level 0: the payload lies in the archive as it is
    held = stored.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner + b"\r\n\r\n") + stored.flush()
    assert held.count(warc.MAGIC) > 40
    outer = [warc.page_record(i, "out", "cd" * 20, 9, b"x" * 9, None, "") for i in range(3)]
    data = outer[0] + held + outer[1] + held + outer[2]
    at = [0, len(outer[0]), len(outer[0]) + len(held), len(outer[0] + held + outer[1]), len(data) - len(outer[2])]
    for split in (500, 4099, 70_000, len(data)):
        assert [o for o, _ in in_ranges(data, split)] == at


def test_broken_members_cost_only_themselves():
    made = [warc.page_record(i, "u", "ab" * 20, 2000, random.Random(i).randbytes(2000), None, "") for i in range(30)]
    broken = made[:10] + [made[10][:900]] + made[11:20] + [made[20][:-6] + b"\0" * 6] + made[21:]
    data = b"".join(broken) + made[0][:200]
    for split in (333, 5000, len(data)):
        ids = [warc.fields(c.split(b"\r\n\r\n")[0])["warc-record-id"] for _, c in in_ranges(data, split)]
        assert ids == [warc.record_id(i, "ab" * 20) for i in range(30) if i not in (10, 20)]


def test_empty_table_and_extra_columns(spark, scratch):
    empty = spark.createDataFrame([], SCHEMA + ", payload int, sha1 string")
    assert warc.read_archives(warc.write_archives(empty, f"{scratch}/e")).collect() == []
    rows = spark.createDataFrame([(1, "u", None, 5, "s"), (1, "u", None, 5, "s")], SCHEMA + ", payload int, sha1 string")
    assert as_rows(warc.page_rows(warc.read_archives(warc.write_archives(rows, f"{scratch}/x")))) == expected([(1, "u", None)] * 2)
