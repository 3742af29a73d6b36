import hashlib

from sparkloom.llm import common as C
from sparkloom.llm import warc


def rows():
    long, other = "<p>" + "x" * 120, "<i>" + "é" * 80
    out = [(i, f"http://h/{i}", f"<html>{i}" + "word " * (i % 50) + "</html>", i) for i in range(10, 200)]
    return out + [(3, "http://a\r\nX: y", long, 0), (1, None, long, 0), (2, "u", long, 0), (4, "u", "short", 0), (5, "u", "short", 0), (6, "u", None, 0), (7, "u", "", 0), (8, "u", other, 0), (9, "u", other, 0), (None, "u", long, 0), (1, None, long, 0), (500, "u", "z" * 300_000, 0)]


def brute(table):
    first = {}
    for p, _, h, _ in table:
        b = (h or "").encode()
        if len(b) >= 100 and p is not None:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, _, h, _ in table:
        b = (h or "").encode()
        ref = first.get(b)
        ref = None if ref == p else ref
        out.append((-1 if p is None else p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if ref is not None else "response", ref if ref is not None else -1))
    return sorted(out)


def test_round_trip_and_decisions(spark):
    table = rows()
    df = spark.createDataFrame(table, "page_id long, url string, html string, digest int").repartition(4)
    manifest = warc.write_warc(df, C.scratch(spark, "w"))
    got = warc.read_warc(manifest, with_payload=True).collect()
    assert sorted((-1 if r[0] is None else r[0], r[2], r[3], r[4], -1 if r[5] is None else r[5]) for r in got) == brute(table)
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got if r["record_type"] == "response")
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")


def test_dictionary_leads_the_archive_and_helps(spark, tmp_path):
    import zstandard

    a = warc.Archive(f"file://{tmp_path}", 6)
    raws = [warc.record(i, "http://h/p", f"<html><head><title>{i}</title></head><body>hello {i * 7} world</body></html>", "0" * 64, None, "d") for i in range(700)]
    for r in raws:
        a.add(r)
    path, n, size = a.close()
    data = open(path[7:], "rb").read()
    assert n == 700 and size == len(data) and int.from_bytes(data[:4], "little") == warc.SKIPPABLE and int.from_bytes(data[4:8], "little") > 100
    assert list(warc.records(path)) == raws
    assert size < 0.6 * sum(len(zstandard.ZstdCompressor(level=6).compress(r)) for r in raws)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.digest(df).collect() == []


def test_record_ids_are_unique_and_referred_to(spark):
    table = [*rows(), (None, None, "short", 0), (None, None, "short", 0), (3, "http://other", "<p>again", 0)]
    df = spark.createDataFrame(table, "page_id long, url string, html string, digest int").repartition(4)
    ids, refers = [], set()
    for r in warc.write_warc(df, C.scratch(spark, "w")).collect():
        for raw in warc.records(r["path"]):
            f = warc.parse(raw)["fields"]
            ids.append(f["warc-record-id"])
            refers |= {f["warc-refers-to"]} if "warc-refers-to" in f else set()
    twins = sum(1 for p, u, h, _ in table if (p, u) == (1, None)) - 1  # rows that agree in all of page_id, url and payload
    assert len(ids) == len(table) and len(set(ids)) == len(ids) - twins and refers and refers <= set(ids)
