"""The leak scan finds what its pattern finds, in one scan of the documents."""

from pyspark.sql import functions as F

from tallyhawk.operators import extract as X
from tallyhawk.plans.queries_gate import CELL_PATTERNS, holds_email


def test_as_the_pattern(spark):
    texts = ["", None, "@", "a@b", "a@b.c", "a@b.co", "@b.co", " @b.co", "x y+z%@b-c.d.org!", "a@@b.co", "a@b..co", "a" * 300, "é@b.co",
             "a@b.c1 c@d.ef", "a@.co", "a@b.co@"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", holds_email(F.col("t")).alias("got"), F.regexp_like("t", F.lit(CELL_PATTERNS["email_like"])).alias("want"))
    rows = df.collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows] and sum(bool(r["got"]) for r in rows) > 4


def test_columns_go_along_with_the_extraction(spark):
    docs = spark.createDataFrame([('{"_id": "1", "sender_email": "A@B.example"}',), ('{"_id": "2"}',)], "j string").select(
        F.parse_json("j").alias("doc"))
    out = X.extract_collection(docs, "transfer", "s", keep={"there": F.to_json("doc").contains("@")})
    assert out.columns[0] == "there"
    assert sorted((r["there"], r["sender_email_domain"]) for r in out.collect()) == [(False, None), (True, "b.example")]
    plain = X.extract_collection(docs, "transfer", "s")
    assert plain.columns == out.columns[1:]
