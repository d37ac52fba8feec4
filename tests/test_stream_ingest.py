"""Documents that arrive twice, broken lines, and batches that are mostly broken."""

import json
import os
import tempfile

import pytest

from tallyhawk.operators.extract import extract_collection
from tallyhawk.sources.commits import read_committed
from tallyhawk.sources.documents import read_documents
from tallyhawk.streaming.jobs import stream_ingest


def doc(i, **more):
    return json.dumps({"_id": {"$oid": f"{i:024x}"}, "amount": i, "user": f"u{i}", **more})


class Feed:
    def __init__(self, spark):
        self.spark, self.top = spark, tempfile.mkdtemp(prefix="th-ingest-", dir="/tmp")
        os.makedirs(f"{self.top}/in")

    def add(self, name, *lines):
        with open(f"{self.top}/in/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")

    def drain(self, **options):
        options = {"max_bad_rate": 0.5, **options}
        stream_ingest(self.spark, f"{self.top}/in", f"{self.top}/table", f"{self.top}/bad", f"{self.top}/ckpt", "transfer", "salt", **options)

    def got(self, name):
        df = read_committed(self.spark, f"{self.top}/{name}")
        return [] if df is None else df.collect()


def test_each_document_once(spark):
    f = Feed(spark)
    f.add("a.json", "// export", doc(1), doc(2), '{"cut": ', "[1, 2]", json.dumps({"amount": 5}))
    f.drain()
    assert len(f.got("table")) == 3
    assert sorted((r["reason"], r["text"], os.path.basename(r["file"])) for r in f.got("bad")) == [
        ("not JSON", '{"cut": ', "a.json"), ("not an object", "[1,2]", "a.json")]
    f.drain()  # nothing new
    f.add("again.json", doc(2), doc(1), doc(3), '{"cut": ', json.dumps({"amount": 5}), doc(3))
    f.drain()
    assert len(f.got("table")) == 4 and len(f.got("bad")) == 2
    f.add("good.json", doc(1), doc(2), doc(3), json.dumps({"amount": 5}))
    want = extract_collection(read_documents(spark, f"{f.top}/in/good.json"), "transfer", "salt")
    assert sorted(map(repr, f.got("table"))) == sorted(map(repr, want.collect()))


def test_a_batch_that_is_mostly_broken(spark):
    f = Feed(spark)
    f.add("a.json", doc(1), "{", "{{", "x")
    with pytest.raises(Exception, match="3 of 4 documents"):
        f.drain()
    assert f.got("table") == [] and f.got("bad") == []
    f.drain(max_bad_rate=0.9)  # the same batch, under another limit
    assert len(f.got("table")) == 1 and len(f.got("bad")) == 3
