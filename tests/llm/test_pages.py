"""URL filters and WARC archives on small tables."""

import hashlib
import io

import pytest
from pyspark.sql import functions as F

from lakezones.llm import url_filters, warc
from lakezones.llm.queries import RULES
from lakezones.llm.shipping import prepared


@pytest.fixture
def pages(spark):
    prepared(spark)
    return lambda rows: spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


# URL filters


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("example.org/es/", "", "", None, "allow"),
        ("http://example.org/es/x", "example.org", "/es/x", "example.org/es/", "block"),
        ("http://A.EXAMPLE.org/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("http://badexample.org/es/x", "badexample.org", "/es/x", "org/", "allow"),
        ("http://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://example.org?x=/es/", "example.org", "", None, "allow"),
        ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
        ("http://x.com/de/#a?b", "x.com", "/de/", "com/de/", "block"),
        ("HTTP://ÄX.com/DE/", "Äx.com", "/DE/", None, "allow"),
        ("://x.com/de/://y", "x.com", "/de/://y", "com/de/", "block"),
        ("http://user@x.com:80/de/", "user@x.com:80", "/de/", None, "allow"),
    ],
)
def test_rules(pages, url, host, path, rule, verdict):
    (row,) = url_filters.judge_urls(pages([(1, url, None)]), RULES).collect()
    assert tuple(row) == (1, host, path, rule, verdict)


def canonical(target):
    return f"<html><LINK href='{target}' data-x=1 rel=\"Canonical\"></html>"


def refresh(target):
    return f'<meta content="0; URL={target}" http-equiv="refresh">'


def test_aliases(pages):
    rows = [
        (1, "http://a.net/1", canonical("http://x.com/de/9")),  # alias of a blocked page that is no row
        (2, "https://b.net/2", refresh("http://a.net/1")),  # two links away
        (3, "http://c.net/3", refresh("//b.net/2#top")),
        (4, "http://c.net/4", canonical("/3")),
        (5, "http://d.net/5", canonical("http://c.net/4") + "<p>x"),
        (6, "http://e.org/6", refresh("http://a.net/1x")),  # allowed by its own rule
        (7, "http://a.net/1x", "<p>"),
        (8, "http://f.net/8", canonical("http://g.org/8") + refresh("http://y.com/de/1")),  # allow takes precedence
        (9, "http://h.net/9/", canonical("http://h.net/9/#x")),  # no alias but itself
        (10, "http://i.net/a/b", canonical("c")),
        (11, "http://i.net/a/c", refresh("http://z.com/de/")),
        (12, "http://k.net/", "<link rel=canonical href=>"),
        (13, None, canonical("http://x.com/de/9")),
        (13, "http://c.net/3?q", None),
        (None, "https://c.net/3", ""),
    ]
    found = url_filters.judge_urls(pages(rows).selectExpr("*", "1 AS node", "2 AS a", "3 AS component"), RULES).collect()
    verdicts = sorted((row["page_id"] or 0, row["verdict"]) for row in found)
    assert verdicts == [
        (0, "block"), (1, "block"), (2, "block"), (3, "block"), (4, "block"), (5, "block"), (6, "allow"), (7, "allow"),
        (8, "allow"), (9, "allow"), (10, "block"), (11, "block"), (12, "allow"), (13, "allow"), (13, "allow"),
    ]
    assert url_filters.judge_urls(pages(rows).filter("false"), RULES).collect() == []


LINKS = [
    ("http://a.net/x", '<link rel="canonical" href="http://x.com/de/1?a=1&amp;b=2">', "http://x.com/de/1?a=1&b=2"),
    ("http://a.net/x", "<link rel=canonical><link rel=canonical href=''><link href='http://b.net/2' rel=canonical>", "http://b.net/2"),
    ("http://a.net/x", '<link rel="canonical" href=" http://b.net/a b ">', "http://b.net/a b"),
    ("http://a.net/x", '<link data-href="http://no.net/" rel="canonical" href="http://b.net/2">', "http://b.net/2"),
    ("http://a.net/p/q/r", '<link rel="canonical" href="../s/./t">', "http://a.net/p/s/t"),
    ("http://a.net/p/q/r", '<link rel="canonical" href="../../../..">', "http://a.net/"),
    ("http://a.net/p/q/r", '<link rel="canonical" href=".">', "http://a.net/p/q/"),
    ("http://a.net/p", '<link rel="canonical" href="http://b.net/x/../y/..?q=/../z#/../f">', "http://b.net/?q=/../z#/../f"),
    ("http://a.net/p", '<link rel="canonical" href="/...a/..b/x">', "http://a.net/...a/..b/x"),
    ("http://a.net/p", "<link rel='canonical' href='http://b.net/?q=&quot;&lt;&#39;&amp;amp;'>", "http://b.net/?q=\"<'&amp;"),
]
REDIRECTS = [
    ("http://a.net/x", '<meta http-equiv="refresh" content="0;url=http://b.net/?page=2&amp;ref=x;y">', "http://b.net/?page=2&ref=x;y"),
    ("http://a.net/x", """<meta http-equiv="refresh" content="0; URL='http://b.net/a'">""", "http://b.net/a"),
    ("http://a.net/x", '<meta http-equiv="refresh" content="5"><meta http-equiv=refresh content="1; url=/b">', "http://a.net/b"),
]


@pytest.mark.parametrize("url, html, target", LINKS + REDIRECTS)
def test_targets(pages, url, html, target):
    kinds = [(url_filters.CANONICAL_TAG, url_filters.LINK_ADDRESS), (url_filters.REFRESH_TAG, url_filters.REFRESH_ADDRESS)]
    found = pages([(1, url, html)]).select(*[url_filters.link_target(F.col("url"), F.col("html"), *kind) for kind in kinds]).first()
    assert sorted(filter(None, found)) == [target]


def test_links_against_sql(pages, spark, tmp_path):
    """The registered SQL, on a table that has links."""
    import duckdb

    from lakezones.llm.queries import ORACLES

    rows = [(i, url.replace("a.net", f"a{i}.net"), html.replace("a.net", f"a{i}.net")) for i, (url, html, _) in enumerate(LINKS + REDIRECTS)]
    rows += [(100, "http://b.net/2", canonical("http://x.com/de/9")), (101, "https://b.net/./k/../2", None), (102, "http://b.net/a", refresh("http://y.com/fr/1"))]
    rows += [(200 + i, f"http://s{i}.net/", canonical(f"http://s{i // 2}.net/")) for i in range(20)] + [(300, "http://s0.net/", refresh("http://x.com/de/"))]
    found = sorted(map(tuple, url_filters.judge_urls(pages(rows), RULES).collect()))
    path = str(tmp_path / "pages.parquet")
    pages(rows).coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    cursor = connection.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op5_url_filters']})")
    assert sorted(cursor.fetchall()) == found
    assert {row[4] for row in found} == {"allow", "block"}


def test_many_aliases_of_one_page(pages):
    rows = [(i, f"http://s{i}.net/", canonical("http://x.com/de/1")) for i in range(300)]
    assert {row["verdict"] for row in url_filters.judge_urls(pages(rows), RULES).collect()} == {"block"}


# WARC


def expected_records(rows):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= 100:
            first[payload] = min(page_id, first.get(payload, page_id))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        again = payload in first and page_id != first[payload]
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
                    first[payload] if again else None))
    return sorted(map(str, out))


def page_rows():
    rows = [(i, f"http://x/{i}", "é" * (i * 37)) for i in range(40)]
    rows += [(100, "u", "a" * 100), (99, "u\r\nWARC-Type: x", "a" * 100), (101, None, "a" * 100), (102, "", "b" * 99), (103, "", "b" * 99)]
    rows += [(200, "u", None), (201, "u", ""), (None, "u", "a" * 100), (None, "u", "only"), (300, "v", "\r\n0\r\n\r\nWARC/1.1\r\n" * 9000)]
    rows += [(400, "w", "c" * 5000), (400, "w", "c" * 5000), (401, "w", "c" * 5000), (400, "w", "other" * 100)]
    return rows


@pytest.mark.parametrize("segment, file", [(32 << 10, 1 << 30), (700, 3000), (1, 500)])
def test_round_trip(pages, segment, file):
    rows = page_rows() if segment > 1 else [(i, "u", "abc" * i) for i in range(30)]
    named = pages(rows).selectExpr("*", "1 AS digest", "2 AS payload", "3 AS refers_to", "4 AS path", "5 AS again")
    found = warc.round_trip(named, segment, file).collect()
    assert sorted(map(str, map(tuple, found))) == expected_records(rows)
    assert warc.round_trip(named.filter("false"), segment, file).collect() == []


def test_shuffled_revisits_agree(pages, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = page_rows()
    assert sorted(map(str, map(tuple, warc.round_trip(pages(rows)).collect()))) == expected_records(rows)


def test_ids_beyond_floating_point_survive_segments(pages):
    rows = [(2**53 + 1, "u", "x" * 50_000), (2**53 + 3, "u", "x" * 50_000), (2**62 + 1, "u", "y" * 50_000), (None, "u", "z" * 50_000)]
    found = warc.round_trip(pages(rows), 1000).collect()
    assert sorted(map(str, map(tuple, found))) == expected_records(rows)
    assert {row.refers_to for row in found} == {None, 2**53 + 1}


def tasks_of(df):
    """The number of tasks that give rows."""
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def test_files_are_read_by_many_tasks(pages, tmp_path):
    rows = [(i, "u", f"{i} " * 400) for i in range(64)]
    files = warc.write_warc(warc.with_storage(pages(rows).repartition(8)), str(tmp_path / "out"), 1 << 20, 1)
    assert files.count() == 64 and tasks_of(warc.read_warc(files)) == 64
    # One file is read in stretches.
    one = warc.write_warc(warc.with_storage(pages(rows).coalesce(1)), str(tmp_path / "one"), 1 << 20, 1 << 30, 1000)
    assert one.select("path").distinct().count() == 1 and one.count() > 8
    found = warc.read_warc(one)
    assert tasks_of(found) == one.count()
    assert sorted(map(str, map(tuple, found.collect()))) == expected_records(rows)


def test_files_hold_standard_records(pages, tmp_path):
    rows = [(1, "http://x/1", "p" * 3000), (2, "http://x/2", "p" * 3000), (3, "http://x/3", "q")]
    files = warc.write_warc(warc.with_storage(pages(rows)), str(tmp_path / "out"), 1000)
    records = []
    for path in {row["path"] for row in files.collect()}:
        with open(path, "rb") as stream:
            records += list(warc.records_of(stream))
    kinds = sorted(headers["warc-type"] for headers, _ in records)
    assert kinds == ["continuation"] * 3 + ["response", "response", "revisit"]
    first = next(h for h, _ in records if h.get("warc-segment-number") == "1")
    parts = sorted((int(h["warc-segment-number"]), b, h) for h, b in records if h.get("warc-segment-origin-id") == first["warc-record-id"])
    assert [n for n, _, _ in parts] == [2, 3, 4] and "warc-segment-total-length" in parts[-1][2]
    (block,) = [b for h, b in records if h is first]
    whole = block + b"".join(b for _, b, _ in parts)
    assert len(whole) == int(parts[-1][2]["warc-segment-total-length"])
    assert warc.payload_of(whole) == b"p" * 3000


@pytest.mark.parametrize("size", [0, 1, 7, 8, 9, 5000])
def test_chunks(size):
    payload = bytes(i % 256 for i in range(size))
    assert warc.dechunked(warc.chunked(payload, 8)) == payload
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


@pytest.mark.parametrize("body", [b"", b"5\r\nabc\r\n0\r\n\r\n", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n"])
def test_broken_chunks(body):
    with pytest.raises(warc.BrokenRecordError):
        warc.dechunked(body)


def test_broken_segments_and_files():
    import pyarrow as pa

    block = warc.HTTP_HEAD + warc.chunked(b"abc")
    digest = hashlib.sha256(b"abc").hexdigest()

    def parts(numbers, total):
        size = -(-len(block) // 3)
        return pa.Table.from_pylist(
            [{"origin": "o", "segment": n, "total_length": total if n == 3 else None, "record_type": "response" if n == 1 else "continuation",
              "page_id": 1 if n == 1 else None, "refers_to": None, "payload_digest": digest, "block": block[(n - 1) * size : n * size]}
             for n in numbers],
            warc._arrow_schema(warc.RECORDS),
        )

    assert warc.reassembled(parts([3, 1, 2], len(block)))["payload_bytes"].to_pylist() == [3]
    for broken in (parts([1, 3], len(block)), parts([1, 2], None), parts([2, 3], len(block)), parts([1, 2, 3], len(block) + 1)):
        with pytest.raises(warc.BrokenRecordError):
            warc.reassembled(broken)
    member = b"".join(warc.members("id", 1, "u", b"abc" * 99, "", None, 1 << 20))
    assert len(list(warc.records_of(io.BytesIO(member * 3)))) == 3
    with pytest.raises(warc.BrokenRecordError):
        list(warc.records_of(io.BytesIO(member + member[:-40])))
