"""Plans that must stay as they were made."""

import pytest
from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.operators import prep as PR
from tallyhawk.operators.extract import contract_columns, extract_collection
from tallyhawk.sources.documents import parse_documents


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", sorted(K.CONTRACTS))
def test_extraction_compiles(spark, kind):
    """Whole-stage code generation takes the whole projection (no fallback is allowed here)."""
    docs = parse_documents(spark.createDataFrame([('{"_id": {"$oid": "1"}}',), ('{"_id": "x", "date": {"$date": "2024-01-01"}}',)], "json string"))
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        out = extract_collection(docs, kind, "salt")
        assert len(out.collect()) == 2
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_two_forms_of_the_projection_agree(spark):
    """Wrapped, plain, nested, blank and wrong values, one column at a time and all at once."""
    import json
    wraps = [lambda v: v, lambda v: {"$oid": str(v)}, lambda v: {"$numberLong": str(v)}, lambda v: {"$numberDouble": str(v)},
             lambda v: {"$date": v}, lambda v: {"$date": {"$numberLong": "1700000000123"}}, lambda v: {"other": v}, lambda v: [v],
             lambda v: None, lambda v: {"$numberInt": "7"}, lambda v: {"$numberLong": "zz", "$numberInt": 3}]
    values = ["  ", "abc", "12", 12, 1.5, True, "2024-05-06T07:08:09Z", 1700000000123, "{not an object", "a@B.com "]
    rows = []
    for n, v in enumerate(values):
        for m, wrap in enumerate(wraps):
            doc = {}
            for i, (field, *_) in enumerate(K.CONTRACTS["transfer"]):
                place = doc
                *above, last = field.split(".")
                for part in above:
                    place = place.setdefault(part, {})
                place[last] = wraps[(m + i) % len(wraps)](values[(n + i) % len(values)])
            rows.append((json.dumps(doc),))
    docs = parse_documents(spark.createDataFrame(rows, "json string"))
    one = extract_collection(docs, "transfer", "salt")
    cols = contract_columns("transfer", "salt")
    two = docs.select(*[c.alias(n) for n, c in cols.items()]).select(*one.columns)
    assert [tuple(map(repr, r)) for r in one.collect()] == [tuple(map(repr, r)) for r in two.collect()]


def test_bounded_maps_take_no_join(spark):
    """Levels and frequencies of category columns are in the plan; only an unbounded map is joined."""
    rows = [(i, f"a{i % 3}", f"b{i % 40}", f"c{i}", i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "_id int, few string, some string, many string, label int")
    state = PR.fit(df, exclude=["_id", "label"])
    assert (state.kinds["few"], state.kinds["some"], state.kinds["many"]) == ("category", "category+frequency", "frequency")
    out = PR.transform(state, df.withColumn("few", F.when(F.col("_id") % 5 > 0, F.col("few"))), keep=["_id"])
    assert plan(out).count("Join") == 1 and plan(PR.transform(state, df.drop("many"))).count("Join") == 0
    got = {r["_id"]: r for r in out.collect()}
    assert got[1]["few"] == 1 and got[5]["few"] is None and got[41]["some"] == sorted({r[2] for r in rows}).index("b1")
    assert got[41]["some_FE"] == pytest.approx(15 / 600) and got[7]["many_FE"] == pytest.approx(1 / 600)
    odd = PR.transform(state, spark.createDataFrame([(1, "new", None, "c1", 0)], df.schema), keep=["_id"]).first()
    assert (odd["few"], odd["some"], odd["some_FE"]) == (None, None, -1.0)
