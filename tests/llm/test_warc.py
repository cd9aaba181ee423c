import hashlib
import random

import pytest

from callstrata.llm import warc as C

PAGES = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def expected(rows):
    best = {}
    for p, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 1000 and p is not None:
            best[data] = max(best.get(data, p), p)
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        last = best.get(data)
        again = last is not None and last != p
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


def read(spark, path):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
                   for r in C.read_archives(spark, path).collect()), key=str)


def sample(n=300):
    big = ["é" * 700, "x" * 1000, "y" * 999, "WARC/1.1\r\n\r\n" * 100]
    rng = random.Random(4)
    return [(i, f"http://www.h{rng.randrange(5)}.org/p{rng.randrange(9)}?b=2&a=1", rng.choice([*big, f"page {i} " * 200, "", None])) for i in range(n)]


def test_round_trip(spark, tmp_path):
    rows = sample()
    C.archive(pages(spark, rows).repartition(5), str(tmp_path))
    assert read(spark, str(tmp_path)) == expected(rows)
    payloads = {r["page_id"]: r["payload"] for r in C.read_archives(spark, str(tmp_path)).where("record_type = 'response'").collect()}
    by = {p: (h or "").encode() for p, _, h in rows}
    assert payloads and all(by[p] == bytes(x) for p, x in payloads.items())


def test_index_is_globally_ordered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "MERGED_ROWS", 40)  # many runs, many ranges
    rows = sample()
    C.archive(pages(spark, rows).repartition(3), str(tmp_path))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.select("run").distinct().count() >= 6
    index = C.histories(spark, str(tmp_path)).orderBy("part", "place").collect()
    keys = [(r["urlkey"], r["timestamp"], r["page_id"]) for r in index]
    assert len(keys) == 300 and keys == sorted(keys) and len({r["part"] for r in index}) > 1
    assert read(spark, str(tmp_path)) == expected(rows)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges_sorted_runs(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20), i, n) for n in range(rng.randrange(9))) for i in range(k)]
    got = list(C.loser_tree([iter([(x[0], x) for x in r]) for r in runs]))
    assert [x for _, x in got] == sorted((x for r in runs for x in r), key=lambda x: (x[0], x[1], x[2]))


def test_archives_are_gzip_members_that_common_tools_read(spark, tmp_path):
    import gzip

    C.archive(pages(spark, sample(20)).coalesce(1), str(tmp_path))
    file = next((tmp_path / "archive").glob("*.warc.gz"))
    data = gzip.decompress(file.read_bytes())
    assert data.count(b"WARC-Type: ") == 20 and data.startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize(("url", "key"), [
    ("http://www.Example.com/A/b?z=1&y=2#top", "com,example)/a/b?y=2&z=1"), ("https://m.example.com", "com,example,m)/"),
    ("http://u:p@example.com:8080/", "com,example:8080)/"), ("https://example.com:443/x", "com,example)/x"),
    (None, ""), ("Not a url", "not a url"), ("http://[bad/", "http://[bad/"),
])
def test_url_keys(url, key):
    assert C.url_key(url) == key


def test_damage_is_noticed():
    payload = b"z" * 50
    whole = C.record(1, "http://a", payload, hashlib.sha1(payload).hexdigest(), None)
    assert C.parse(whole)["payload"] == payload
    for bad in (whole.replace(b"zz", b"zy", 1), whole[:-3]):
        with pytest.raises(ValueError):
            C.parse(bad)


def test_hot_payload_nulls_and_repeats(spark, tmp_path):
    same = "<p>" + "hot " * 400
    rows = [(i, f"http://a/{i}", same) for i in range(1_500)] + [(None, None, same), (None, "u\r\nx: y", None), (7_000, None, ""), (7_000, None, "")]
    rows += [(8_000, "http://b", "q" * 1200), (8_000, "http://b", "q" * 1200)]
    df = pages(spark, rows)
    for c in ("digest", "payload", "n", "last", "file", "run"):
        df = df.selectExpr("*", f"'kept' AS {c}")
    C.archive(df, str(tmp_path / "a"))
    assert read(spark, str(tmp_path / "a")) == expected(rows)
    C.archive(df.limit(0), str(tmp_path / "b"))
    assert C.read_archives(spark, str(tmp_path / "b")).count() == 0
