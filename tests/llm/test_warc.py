"""Archives: round trip, revisits, and files that depend on the records alone."""

import base64
import gzip
import hashlib
import os

import pytest

from sediment.llm import files, warc
from sediment.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, shard string, kind string"


def pages():
    rows = [(i, f"http://h/{i}", f"<p>{i % 37}</p>" * (i % 11)) for i in range(400)]
    rows += [(None, "http://h/x y\r\nEvil: 1", "alone"), (500, None, None), (501, "", ""), (None, "u", "<p>1</p>"), (None, "u", "no id"), (None, "u2", "no id")]
    rows += [(502, "a", "twice"), (502, "a", "twice"), (502, "b", "other"), (503, "big", "ü" * 3_000_000)]
    return [(*r, "d", "s", "k") for r in rows]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def wanted(rows):
    out, seen = [], set()
    for page_id, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        same = [r[0] for r in rows if (r[2] or "") == (html or "")]
        first = min((i for i in same if i is not None), default=None)
        response = html not in seen and (html or "") not in seen
        seen.add(html or "")
        out.append((page_id, len((html or "").encode()), digest(html), "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


def got(frame):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def archive(frame, tmp_path, name, **sizes):
    folder = f"file://{tmp_path}/{name}"
    return folder, warc.write(frame, folder, **sizes)


def contents(tmp_path, name):
    return {f: open(tmp_path / name / f, "rb").read() for f in sorted(os.listdir(tmp_path / name)) if f.endswith(".gz")}


def test_round_trip(spark, tmp_path):
    rows = pages()
    folder, manifest = archive(spark.createDataFrame(rows, SCHEMA), tmp_path, "a")
    found = warc.read(folder, manifest)
    assert got(found) == wanted(rows)
    payloads = {(r["page_id"], r["payload"].decode()) for r in found.where("record_type = 'response'").collect()}
    assert (503, rows[-1][2]) in payloads and (None, "alone") in payloads
    assert sum(r["records"] for r in manifest.collect()) == len(rows)


def test_files_depend_on_records_alone(spark, tmp_path):
    frame = spark.createDataFrame(pages(), SCHEMA)
    sizes = {"shard_bytes": 2000, "roll_bytes": 3000}
    for name, part in (("a", frame), ("b", frame.repartition(7)), ("c", frame.orderBy("html").coalesce(1))):
        folder, manifest = archive(part, tmp_path, name, **sizes)
        assert got(warc.read(folder, manifest)) == wanted(pages())
    a, b, c = (contents(tmp_path, n) for n in "abc")
    assert a == b == c
    assert len({n.split("-")[1] for n in a}) > 2  # several shards
    for r in manifest.collect():
        assert len(c[r["name"]]) == r["bytes"] and hashlib.sha1(c[r["name"]]).hexdigest() == r["sha1"]
        assert r["bytes"] <= 3000 or r["records"] == 1
    assert all(gzip.decompress(x).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for x in c.values())


def test_only_committed_files_are_read_and_commit_repeats(spark, tmp_path):
    folder, manifest = archive(spark.createDataFrame(pages(), SCHEMA), tmp_path, "a")
    lost = files.Output(folder, "part-00000-00000.warc.gz")  # an attempt that was lost
    lost.write(b"junk")
    lost.close()
    again = manifest.selectExpr("name", "'_temporary/gone' as temporary", "records")
    assert files.commit(folder, again).count() == manifest.count()
    assert got(warc.read(folder, manifest)) == wanted(pages())
    with pytest.raises(Exception, match="neither"):
        files.commit(folder, spark.createDataFrame([("no.gz", "_temporary/no")], "name string, temporary string"))


def test_damage_is_found(spark, tmp_path):
    folder, manifest = archive(spark.createDataFrame(pages()[:5], SCHEMA), tmp_path, "a")
    name = manifest.first()["name"]
    data = gzip.decompress(open(tmp_path / "a" / name, "rb").read()).replace(b"<p>4</p>", b"<p>5</p>", 1)
    with open(tmp_path / "a" / name, "wb") as file:
        file.write(gzip.compress(data))
    with pytest.raises(Exception, match="damaged"):
        warc.read(folder, manifest).collect()


def test_empty_table(spark, tmp_path):
    folder, manifest = archive(spark.createDataFrame([], SCHEMA), tmp_path, "a")
    assert manifest.collect() == [] and warc.read(folder, manifest).collect() == []


def test_stores_of_hadoop_are_found_by_their_own_scheme():
    paths = ("s3a://bucket/a", "s3n://bucket/a", "s3://bucket/a", "gs://bucket/a", "file:///a", "/a")
    assert [files.own_scheme(path) for path in paths] == ["s3://bucket/a"] * 3 + ["gs://bucket/a", "file:///a", "/a"]


def test_shards_are_about_equal(spark):
    rows = [(k, "u", f"{k:05d}" * 40) for k in range(2000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-shards")
    manifest = warc.write(frame, folder, shard_bytes=10_000).collect()
    records = [row["records"] for row in manifest]
    assert len(manifest) >= 35 and max(records) < 3 * sorted(records)[len(records) // 2]
