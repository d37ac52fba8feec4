"""Safety-gate queries over the real training table and feature matrix,
plus the incremental-ingest stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhawk.functions.columns import pseudonym
from tallyhawk.operators import gate as G
from tallyhawk.operators import labels as LB
from tallyhawk.plans.catalog import query
from tallyhawk.plans.queries_features import TRAINING_SQL, training_table
from tallyhawk.plans.queries_labels import LBL
from tallyhawk.plans.queries_prep import prep_frame
from tallyhawk.operators import extract as X
from tallyhawk.plans.queries_sources import docs, extract_sql, textualise
from tallyhawk.session import passing, scratch_path, settled
from tallyhawk.sources import documents as D
from tallyhawk.sources import fixtures as FX


@query("gate_pii_columns", "select 'pii_columns' as gate, true as passed, 'ok' as detail where (select count(*) from orders) > 0")
def gate_pii_columns(spark, sf_dir):
    return G.gate_pii_columns(training_table(spark, sf_dir))


@query("gate_forbidden_columns", "select 'forbidden_columns' as gate, true as passed, 'ok' as detail where (select count(*) from orders) > 0")
def gate_forbidden_columns(spark, sf_dir):
    return G.gate_forbidden_columns(training_table(spark, sf_dir))


@query("gate_label_domain", LBL + """
select count(*) as rows, count(*) filter (where label is not null and label not in (0, 1)) as bad_labels from labels""")
def gate_label_domain(spark, sf_dir):
    return G.label_domain(training_table(spark, sf_dir))


@query("gate_point_in_time", "select count(*) filter (where user_age_days < 0) as negative_user_age_days,\n"
       "       count(*) filter (where recipient_age_days < 0) as negative_recipient_age_days,\n"
       "       count(*) filter (where prior_sends_to_recipient < 0) as negative_prior_sends_to_recipient\n"
       f"from ({TRAINING_SQL}) x")
def gate_point_in_time(spark, sf_dir):
    return G.point_in_time(training_table(spark, sf_dir))


@query("gate_feature_matrix")
def gate_feature_matrix(spark, sf_dir):
    from tallyhawk.operators.prep import prepare_matrix
    state, _m = prepare_matrix(prep_frame(spark, sf_dir))
    fails = G.gate_feature_matrix(state.feature_cols)
    return spark.createDataFrame([("feature_matrix", not fails, "; ".join(fails) or "ok")], G.GATE_SCHEMA)


# FIXED VALUES: the normalisation vector of the pseudonym.
HASH_VECTOR = [("  ABC123  ", "abc123"), ("Abc123", "abc123")]


@query("gate_hash_consistency", """
select count(*) as hashed_values, cast(0 as bigint) as mismatches, true as normalisation_ok, true as blanks_null
from customer""")
def gate_hash_consistency(spark, sf_dir):
    """The same values hashed in separate processes (the expression in the
    executors' JVMs, its definition in Python workers, which take the salt from
    the configuration on their own; each written to shared storage) must agree
    row for row; the fixed vector checks normalisation."""
    salt = FX.FIXTURE_SALT
    names = FX.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    a, b = scratch_path(spark, "hash-a"), scratch_path(spark, "hash-b")
    names.select("c_custkey", pseudonym("c_name", salt).alias("h")).write.parquet(a)
    hashed_apart(names, "c_name").withColumnRenamed("c_name", "h").write.parquet(b)
    ra, rb = spark.read.parquet(a), spark.read.parquet(b)
    diff = ra.exceptAll(rb).unionByName(rb.exceptAll(ra)).agg(F.count(F.lit(1)).alias("mismatches"))
    vec = spark.createDataFrame(HASH_VECTOR + [(None, None), ("", None), ("   ", None)], "a string, b string")
    checks = vec.agg(
        F.bool_and(F.when(F.col("b").isNotNull(), pseudonym("a", salt) == pseudonym("b", salt))).alias("normalisation_ok"),
        F.bool_and(F.when(F.col("b").isNull(), pseudonym("a", salt).isNull())).alias("blanks_null"))
    n = ra.agg(F.count(F.lit(1)).alias("hashed_values"))
    one = F.lit(1)
    return (n.withColumn("_o", one).join(diff.withColumn("_o", one), "_o")
             .join(checks.withColumn("_o", one), "_o").drop("_o"))


def hashed_apart(df, col):
    """``col`` pseudonymised in Python workers. Nothing of the hash comes from
    the process that plans the job: each worker resolves the salt itself."""
    at = df.columns.index(col)

    def run(batches):
        import pyarrow as pa

        from tallyhawk.functions.columns import pseudonym_text
        from tallyhawk.sources.fixtures import FIXTURE_SALT
        for batch in batches:
            done = pa.array([pseudonym_text(x, FIXTURE_SALT) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([done if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)
    return df.mapInArrow(run, df.schema)


@query("gate_hash_agreement", LBL + """
select (select count(distinct partner_reference) from cb) as sheet_references,
       (select count(distinct partner_reference) from cb where partner_reference in (select partner_reference from tk)) as agreeing_references,
       (select count(distinct partner_txn_id) from cb) as sheet_transactions,
       (select count(distinct partner_txn_id) from cb where partner_txn_id in (select partner_txn_id from tk)) as agreeing_transactions""")
def gate_hash_agreement(spark, sf_dir):
    """Keys hashed by the extractor from documents and keys hashed from the
    partner's sheet, which spells them with blanks and in another case, meet."""
    sheet = LB.parse_chargebacks(FX.chargebacks_raw(spark, sf_dir), FX.FIXTURE_SALT)
    known = _keys(X.extract_collection(docs(spark, sf_dir), "transfer", FX.FIXTURE_SALT, only=list(HASH_KEYS)))
    both = _keys(sheet).join(known.withColumn("there", F.lit(True)), ["key", "k"], "left")
    of = lambda key: F.col("key") == key
    return both.agg(*[F.count_if(found).alias(f"{what}_{name}") for key, name in HASH_KEYS.items()
                      for what, found in (("sheet", of(key)), ("agreeing", of(key) & F.col("there").isNotNull()))])


# keys that documents and sheets share, and what the report calls their values
HASH_KEYS = {"partner_reference": "references", "partner_txn_id": "transactions"}


def _keys(df):
    """The distinct (key, k) of the hashed keys of a table, from one pass: a
    filter on a generated value stays behind the hashing, which is done once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("k")) for c in HASH_KEYS])
    return df.select(F.explode(pairs).alias("_p")).select("_p.key", "_p.k").where("k is not null").distinct()


# FIXED VALUES: sentinel patterns for the cell scan (identity number, e-mail).
CELL_PATTERNS = {
    "ssn_like": "(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}([^0-9]|$)",
    "email_like": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}",
}
SCAN_TARGETS = [("documents", "text"), ("conversations", "text"), ("pages", "html")]

_scan_sql = "\nunion all\n".join(
    f"select '{t}.{c}' as source, '{name}' as pattern, "
    f"count(*) filter (where coalesce(regexp_matches({c}, '{pat}'), false)) as hits from {t}"
    for t, c in SCAN_TARGETS for name, pat in CELL_PATTERNS.items())


@query("gate_cell_scan", _scan_sql)
def gate_cell_scan(spark, sf_dir):
    parts = []
    for t, c in SCAN_TARGETS:
        df = FX.table(spark, sf_dir, t).select(c)
        agg = df.agg(*[F.count_if(F.coalesce(F.regexp_like(F.col(c), F.lit(p)), F.lit(False))).alias(n)
                       for n, p in CELL_PATTERNS.items()])
        stack = F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.col(n).alias("hits"))
                                    for n in CELL_PATTERNS]))
        parts.append(agg.select(F.lit(f"{t}.{c}").alias("source"), stack.alias("_s")).select("source", "_s.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def holds_email(text):
    """Whether the e-mail pattern is found anywhere in a text. One character
    before the @ decides as well as all of them, and the search then does not
    try every beginning of every word; a text without @ is not searched."""
    return text.contains("@") & F.regexp_like(text, F.lit(CELL_PATTERNS["email_like"].replace("]+@", "]@", 1)))


# the collections whose documents hold e-mail addresses, and the tables they come from
LEAK_TARGETS = {"user": "customer", "transfer": "orders"}


@query("gate_extract_scan", "\nunion all\n".join(
    f"select '{t}' as collection, count(*) as documents, count(*) as raw_hits, cast(0 as bigint) as extracted_hits from {table}"
    for t, table in LEAK_TARGETS.items()))
def gate_extract_scan(spark, sf_dir):
    """E-mail addresses in the documents and in what the extractor makes of
    them: there in every document, in no output cell."""
    parts = []
    for t in LEAK_TARGETS:
        # one scan: what the document holds goes along with what is extracted from it
        out = X.extract_collection(docs(spark, sf_dir, t), t, FX.FIXTURE_SALT, keep={"_there": holds_email(F.to_json("doc"))})
        cells = F.concat_ws("\n", *[F.col(c).cast("string") for c in out.columns if c != "_there"])
        parts.append(out.agg(F.count(F.lit(1)).alias("documents"), F.count_if("_there").alias("raw_hits"),
                             F.count_if(holds_email(cells)).alias("extracted_hits")).select(F.lit(t).alias("collection"), "*"))
    return parts[0].unionByName(parts[1])


@query("safety_gate")
def safety_gate(spark, sf_dir):
    """Every gate as one pass/fail table."""
    from tallyhawk.operators.prep import prepare_matrix
    ids = ["_id", "user_id", "recipient_id", "_t", "partner_reference", "partner_txn_id"]
    with passing(spark):
        t = settled(spark, lambda: training_table(spark, sf_dir, keep_ids=True), stays=False)     # read by every gate
        train = t.drop(*[c for c in ids if c in t.columns])
        named = [tuple(r) for g in (G.gate_pii_columns(train), G.gate_forbidden_columns(train)) for r in g.collect()]
        dom = G.label_domain(train).first()
        pit = G.point_in_time(train).first().asDict()
        rec = G.reconcile_rows(FX.transfer_table(spark, sf_dir), t).first()
    with passing(spark):
        state, _ = prepare_matrix(prep_frame(spark, sf_dir))
    fm = G.gate_feature_matrix(state.feature_cols)
    hashed = gate_hash_consistency(spark, sf_dir).first()
    return spark.createDataFrame([
        *named,
        ("label_domain", dom["bad_labels"] == 0, f"{dom['bad_labels']} labels outside 0/1"),
        ("point_in_time", all(v == 0 for v in pit.values()), str(pit)),
        ("row_reconciliation", bool(rec["reconciled"]),
         f"source {rec['source_rows']} training {rec['training_rows']}"),
        ("hash_consistency", hashed["mismatches"] == 0 and hashed["normalisation_ok"]
         and hashed["blanks_null"], f"{hashed['mismatches']} of {hashed['hashed_values']} values hash otherwise in another process"),
        ("feature_matrix", not fm, "; ".join(fm) or "ok"),
        *[(f"extract_{r['collection']}", r["extracted_hits"] == 0, f"{r['extracted_hits']} of {r['documents']} documents leak")
          for r in gate_extract_scan(spark, sf_dir).collect()]], G.GATE_SCHEMA)


@query("stream_extract", extract_sql("transfer"))
def stream_extract(spark, sf_dir):
    """New document files -> contract projection -> Parquet, exactly once."""
    from tallyhawk.streaming.jobs import stream_extract as run
    src = scratch_path(spark, "stream-src")
    D.transfer_documents(spark, sf_dir).write.text(src)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    run(spark, src, sink, ckpt, "transfer", FX.FIXTURE_SALT)
    return textualise(spark.read.parquet(sink))


@query("stream_ingest", extract_sql("transfer"))
def stream_ingest(spark, sf_dir):
    """As stream_extract, from files that are delivered twice and hold broken lines."""
    from tallyhawk.sources.commits import read_committed
    from tallyhawk.streaming.jobs import stream_ingest as run
    src, table, bad, ckpt = (scratch_path(spark, f"ingest-{n}") for n in ("src", "table", "bad", "ckpt"))
    docs = D.transfer_documents(spark, sf_dir)
    broken = docs.limit(1).select(F.lit('{"cut": ').alias("json"))
    for _ in range(2):
        docs.unionByName(broken).write.mode("append").text(src)
        run(spark, src, table, bad, ckpt, "transfer", FX.FIXTURE_SALT, max_files_per_trigger=64)
    return textualise(read_committed(spark, table))
