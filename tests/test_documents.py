"""Document reading, the extraction allowlist and planted marks."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators.extract import extract_collection
from tallyhawk.sources.documents import collection_paths, parse_documents, read_documents
from tallyhawk.sources.sheets import header_map


def test_planted_marks_never_leak(spark):
    """Marks in fields outside the contract, and in e-mail addresses, are in no output cell."""
    planted = {"_id": {"$oid": "7f" * 12}, "dateCreated": {"$date": "2021-03-04T05:06:07Z"}, "pin": "mark-one-4411",
               "ssn": "mark-two-900-11-2222", "emails": ["mark-three@nowhere.test"], "names": {"first": "mark-four"},
               "email": "mark-five@nowhere.test"}
    out = extract_collection(parse_documents(spark.createDataFrame([(json.dumps(planted),)], "json string")), "user", "salt")
    row = out.first().asDict()
    assert not any("mark-" in str(v) for v in row.values())
    assert not {"ssn", "pin", "emails", "names"} & {c.lower() for c in out.columns}
    assert row["_raw_dateCreated"].year == 2021


def test_ndjson_array_comments_and_failfast(spark):
    d = tempfile.mkdtemp(prefix="th-docs-", dir="/tmp")
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write('// export\n{"_id": {"$oid": "1"}}\n/* note */\n{"_id": {"$oid": "2"}}\n')
    with open(os.path.join(d, "b.json"), "w") as fh:
        fh.write('// export\n[{"_id": {"$oid": "3"}},\n {"_id": {"$oid": "4"}}]\n')
    docs = read_documents(spark, [os.path.join(d, "a.json"), os.path.join(d, "b.json")])
    ids = sorted(r[0] for r in docs.select(F.try_variant_get("doc", "$['_id']['$oid']", "string")).collect())
    assert ids == ["1", "2", "3", "4"]
    limited = read_documents(spark, [os.path.join(d, "a.json"), os.path.join(d, "b.json")], limit_per_file=1)
    assert limited.count() == 2
    with open(os.path.join(d, "bad.json"), "w") as fh:
        fh.write('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):
        read_documents(spark, os.path.join(d, "bad.json")).collect()
    with open(os.path.join(d, "bad.json"), "w") as fh:
        fh.write('[{"a": 1} {"a": 2}]')
    with pytest.raises(Exception):
        read_documents(spark, os.path.join(d, "bad.json")).collect()


def test_mixed_folder_and_missing_exports(spark):
    d = tempfile.mkdtemp(prefix="th-docs-", dir="/tmp")
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write('{"_id": "1"}\n{"_id": "2"}\n')
    with open(os.path.join(d, "b.json"), "w") as fh:
        fh.write('/* two\nlines */\n [ {"_id": "[3", "x": "// no comment"} ,\n {"_id": "4]"}\n]\n')
    with open(os.path.join(d, "c.json"), "w") as fh:
        fh.write("[ ]")
    for path in (d, f"file:{d}", f"{d}/*.json"):
        docs = read_documents(spark, path).select(F.try_variant_get("doc", "$._id", "string"))
        assert sorted(r[0] for r in docs.collect()) == ["1", "2", "4]", "[3"]
    with pytest.raises(FileNotFoundError):
        read_documents(spark, f"{d}/none.json")
    with pytest.raises(FileNotFoundError):
        collection_paths(spark, d, "transfer")
    os.rename(os.path.join(d, "b.json"), os.path.join(d, "transfer.json"))
    assert collection_paths(spark, f"file:{d}", "transfer") == [f"file:{d}/transfer.json"]


def test_array_larger_than_a_variant(spark):
    """More than 128 MiB in one array: elements become rows one by one."""
    d = tempfile.mkdtemp(prefix="th-docs-", dir="/tmp")
    body = "x" * 1_000_000
    with open(os.path.join(d, "big.json"), "w") as fh:
        fh.write("[" + ",\n".join(json.dumps({"_id": i, "body": body}) for i in range(140)) + "]")
    docs = read_documents(spark, d).select(F.try_variant_get("doc", "$._id", "int").alias("i"))
    assert docs.agg(F.count("i"), F.sum("i")).first() == (140, sum(range(140)))


def test_array_pieces(spark, monkeypatch):
    """Arrays on one line and on many, read in ranges of a few bytes: braces,
    brackets, quotes and comment marks inside strings, elements of any kind."""
    from tallyhawk.sources import documents
    monkeypatch.setattr(documents, "PEEK", 3, raising=False)
    rows = [{"_id": str(i), "x": ["}", "{[", '\\"}', "//", "/* } */", "é€😀", "\\", "a,b]"][i % 8] * (i % 5),
             "in": {"l": [{"a": i}, [], {}]}} for i in range(300)]
    d = tempfile.mkdtemp(prefix="th-docs-", dir="/tmp")
    texts = {"one": json.dumps(rows), "raw": json.dumps(rows, ensure_ascii=False), "lines": json.dumps(rows, indent=1),
             "tight": "\ufeff" + json.dumps(rows, separators=(",", ":")),
             "notes": "// } [\n/* { \n\" */ /* x */\n[" + ",\n// it's \"}\n".join(map(json.dumps, rows)) + "\n/* } */]\n// } end"}
    for name, text in texts.items():
        with open(os.path.join(d, f"{name}.json"), "w", encoding="utf-8") as fh:
            fh.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        docs = [json.loads(r[0]) for r in read_documents(spark, d).select(F.to_json("doc")).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, docs)) == sorted(map(key, rows * len(texts)))


def test_array_is_never_held_whole(spark):
    """No reader of whole files is in the plan, and the driver sees a bounded
    part of an array written on one line."""
    from tallyhawk.sources import documents
    d = tempfile.mkdtemp(prefix="th-docs-", dir="/tmp")
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write(json.dumps([{"_id": i, "body": "x" * 1000} for i in range(3000)]))
    docs = read_documents(spark, d)
    assert "binaryFile" not in docs._jdf.queryExecution().toString()
    assert docs.count() == 3000 and documents.PEEK <= 1 << 20


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1},]', '[,{"a": 1}]', '[{"a": 1}, "b]', '[{"a": [1}]]', "[1 2]", '[{"a": 1}] {"a": 2}',
                                  '[{"a": 1}]]', '[{"a": 1}', '[{"a": 1} /* ]', '[{"a": 1} x, {"a": 2}]', "[{]}", '[{"a": 1}][{"a": 2}]'])
def test_malformed_arrays_fail(spark, text):
    d = tempfile.mkdtemp(prefix="th-docs-", dir="/tmp")
    with open(os.path.join(d, "bad.json"), "w") as fh:
        fh.write(text)
    with pytest.raises(Exception):
        read_documents(spark, d).collect()


def test_header_aliases():
    cols = ["AGENT_CODE", "FOLIO (as the sender knows it)", "UNIQUE  TRNX ID @partner", "AMOUNT", "RB_DATE"]
    found = header_map(cols)
    assert found["folio"] == cols[1] and found["partner_txn"] == cols[2]
    assert "reason_code" not in found


def test_wrapped_numbers_are_the_same_id(spark):
    from tallyhawk.operators.extract import read_field
    rows = ['{"_id": {"$numberLong": "5"}}', '{"_id": 5}', '{"_id": "5"}', '{"_id": {"$oid": "5"}}', '{"_id": {"$numberInt": "5"}}']
    odd = ['{"_id": {"a": 1}}', '{"_id": null}', '{}', '{"_id": "{5"}', '{"_id": {"$date": {"$numberLong": "5"}}}']
    df = parse_documents(spark.createDataFrame([(r,) for r in rows + odd], "json string"))
    got = [r[0] for r in df.select(read_field("doc", "_id", "string")).collect()]
    assert got == ["5"] * 5 + [None, None, None, "{5", "5"]


def test_unwrap_extended_json(spark):
    from tallyhawk.operators.extract import read_field
    doc = {"a": {"$numberLong": "5"}, "d": {"$date": {"$numberLong": "86400000"}}, "b": "  ",
           "n": {"x": {"y": 1.5}}}
    df = parse_documents(spark.createDataFrame([(json.dumps(doc),)], "json string"))
    r = df.select(read_field("doc", "a", "bigint").alias("a"), read_field("doc", "d", "timestamp").alias("d"),
                  read_field("doc", "b", "string").alias("b"), read_field("doc", "n.x.y", "double").alias("y"),
                  read_field("doc", "n.q.z", "string").alias("gap")).first()
    assert r["a"] == 5 and r["d"].year == 1970 and r["d"].day == 2
    assert r["b"] is None and r["y"] == 1.5 and r["gap"] is None


def test_compressed_exports(spark, tmp_path):
    """Exports are written compressed; the shape of a compressed file is told by what is in it."""
    import gzip

    from tallyhawk.sources import documents
    lines = spark.range(500).select(F.to_json(F.struct(F.col("id").cast("string").alias("_id"), F.lit("same for all").alias("note"))).alias("json"))
    documents.export_lines(lines, f"{tmp_path}/lines")
    files = [f for f in documents.data_files(spark, f"{tmp_path}/lines")]
    assert files and all(f.endswith(".gz") for f in files)
    with gzip.open(f"{tmp_path}/array.json.gz", "wt") as out:
        out.write('// export\n[{"_id": "a"},\n{"_id": "b"}]')
    docs = documents.read_documents(spark, [f"{tmp_path}/lines", f"{tmp_path}/array.json.gz"])
    ids = {r[0] for r in docs.select(F.variant_get("doc", "$._id", "string")).collect()}
    assert ids == {str(n) for n in range(500)} | {"a", "b"}
