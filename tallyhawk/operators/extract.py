"""Contract projection of raw documents (VARIANT) into flat tables.

The ``select`` is generated from the contract: KEEP/LABEL/META read as is,
HASH pseudonymised, DERIVE parked as ``_raw_*`` except sensitive fields,
which are transformed at read (email -> domain) or not read at all (raw IP).
A path outside the contract is never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk import contract as K
from tallyhawk.functions.columns import blank_to_null, email_domain, pseudonym

# Value types of contract fields (anything not listed is text).
DOUBLE_FIELDS = {"send_amount", "amount_paid", "transfer_fee", "rate", "discount", "risk_score",
                 "threshold_level", "remainingBalance"}
LONG_FIELDS = {"threshold_level_no", "addressChangeCounter", "cardDeletionCounter", "pinFailedAttemptsCount"}
BOOL_FIELDS = {"isEnabled3Ds", "isChallenged3Ds", "determine3dsResult.shouldChallenge",
               "determine3dsResult.attemptNo3ds", "is_recipient_changed", "ipDetails.security.vpn",
               "ipDetails.security.proxy", "ipDetails.security.tor", "ipDetails.security.relay",
               "isBusinessAccount", "is_phone_verified", "isVerified", "isDocumentExpired", "isPinLocked"}
TIME_FIELDS = {"date", "dateCreated", "dob", "date_created"}
ARRAY_FIELDS = {"previous_recipient"}


def field_type(field: str) -> str:
    if field in DOUBLE_FIELDS:
        return "double"
    if field in LONG_FIELDS:
        return "bigint"
    if field in BOOL_FIELDS:
        return "boolean"
    if field in TIME_FIELDS:
        return "timestamp"
    if field in ARRAY_FIELDS:
        return "array<string>"
    return "string"


def vpath(field: str, *more: str) -> str:
    return "$" + "".join(f"['{p}']" for p in field.split(".") + list(more))


def read_field(doc: str, field: str, typ: str | None = None, keep_blank: bool = False,
               relative: bool = False) -> Column:
    """Typed value at a dotted path with extended-JSON wrappers unwrapped;
    a gap in the path or (unless ``keep_blank``) a blank string is null.
    ``relative``: ``doc`` already holds the value of the path's first part
    and ``field`` is the rest (possibly empty)."""
    typ = typ or field_type(field)
    parts = [p for p in field.split(".") if p] if relative else field.split(".")
    g = lambda *p, t: F.try_variant_get(F.col(doc), "$" + "".join(f"['{x}']" for x in parts + list(p)), t)
    if typ == "string":
        plain = g(t="string")
        # an object is a wrapper or no text at all; a text may begin with a brace too
        opened = F.coalesce(*[g(w, t="string") for w in ("$oid", "$numberLong", "$numberInt", "$numberDouble",
                                                          "$numberDecimal")],
                            g("$date", "$numberLong", t="string"), g("$date", t="string"),
                            F.when(g(t="map<string,variant>").isNull(), plain))
        v = F.when(plain.startswith("{"), opened).otherwise(plain)
        return v if keep_blank else blank_to_null(v)
    if typ in ("double", "bigint"):
        return F.coalesce(g("$numberDouble", t=typ), g("$numberLong", t=typ), g("$numberInt", t=typ), g(t=typ))
    if typ == "timestamp":
        return F.coalesce(F.timestamp_millis(g("$date", "$numberLong", t="bigint")),
                          F.timestamp_millis(g("$date", t="bigint")),
                          F.try_to_timestamp(g("$date", t="string")),
                          F.try_to_timestamp(g(t="string")))
    return g(t=typ)


def out_name(field: str) -> str:
    return field.replace(".", "__")


def _plan(doc_type: str):
    """(output column, field, how) for every output of the contract."""
    out = []
    for field, action, _tier, _sens in K.CONTRACTS[doc_type]:
        col = out_name(field)
        if action == "HASH":
            out.append((col, field, "hash"))
        elif action == "DERIVE":
            if field in K.SENSITIVE_DERIVE:
                target = K.SENSITIVE_DERIVE[field]
                if target is not None:          # None: the raw value is written nowhere
                    out.append((target, field, "email" if target.endswith("email_domain") else "text"))
            else:
                out.append((f"_raw_{col}", field, "typed"))
        else:
            out.append((col, field, "typed"))
    return out


#: wrappers of extended JSON that a value of a type may come in
_NUMBERS = ("$numberDouble", "$numberLong", "$numberInt")
_TEXTS = ("$oid", "$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")


def _ddl(types: dict[str, str]) -> str:
    """A struct type with a member per dotted path."""
    tree: dict = {}
    for path, typ in types.items():
        *above, last = path.split(".")
        place = tree
        for part in above:
            place = place.setdefault(part, {})
        place[last] = typ
    show = lambda t: t if isinstance(t, str) else "struct<" + ", ".join(f"`{k}`: {show(v)}" for k, v in t.items()) + ">"
    return show(tree)


def _read_all(docs: DataFrame, doc: str, kinds: dict[str, str], keep: dict[str, Column]) -> DataFrame:
    """Columns ``_r0``, ``_r1``, ... with the values at the dotted paths of
    ``kinds`` (path -> type), blank strings kept; as :func:`read_field`.
    Before them the columns ``keep``.

    A document is looked at four times, not once per field and wrapper: as
    what the contract expects, as wrapped values, and for dates as wrapped
    numbers in two forms; each time as one struct with a member per path."""
    wrapped, dated, millis = {}, {}, {}
    for f, typ in kinds.items():
        if typ == "string":
            wrapped[f] = _ddl({w: "string" for w in (*_TEXTS, "$date")})
            dated[f] = "struct<`$date`: struct<`$numberLong`: string>>"
        elif typ in ("double", "bigint"):
            wrapped[f] = _ddl(dict.fromkeys(_NUMBERS, typ))
        elif typ == "timestamp":
            wrapped[f] = "struct<`$date`: string>"
            dated[f] = "struct<`$date`: struct<`$numberLong`: bigint>>"
            millis[f] = "struct<`$date`: bigint>"
    plain = {f: "string" if typ == "timestamp" else typ for f, typ in kinds.items()}
    views = {"_plain": plain, "_wrapped": wrapped, "_dated": dated, "_millis": millis}
    seen = docs.select(*[c.alias(n) for n, c in keep.items()], *[F.try_variant_get(F.col(doc), "$", _ddl(v)).alias(n) for n, v in views.items() if v])

    def at(view: str, field: str, *more: str) -> Column:
        c = F.col(view)
        for part in (*field.split("."), *more):
            c = c.getField(part)
        return c

    def value(f: str, typ: str) -> Column:
        if typ == "string":
            text = at("_plain", f)
            # an object is a wrapper or no text at all; a text may begin with a brace too
            opened = F.coalesce(*[at("_wrapped", f, w) for w in _TEXTS], at("_dated", f, "$date", "$numberLong"),
                                at("_wrapped", f, "$date"), F.when(at("_wrapped", f).isNull(), text))
            return F.when(text.startswith("{"), opened).otherwise(text)
        if typ in ("double", "bigint"):
            return F.coalesce(*[at("_wrapped", f, w) for w in _NUMBERS], at("_plain", f))
        if typ == "timestamp":
            return F.coalesce(F.timestamp_millis(at("_dated", f, "$date", "$numberLong")), F.timestamp_millis(at("_millis", f, "$date")),
                              F.try_to_timestamp(at("_wrapped", f, "$date")), F.try_to_timestamp(at("_plain", f)))
        return at("_plain", f)
    return seen.select(*keep, *[value(f, typ).alias(f"_r{i}") for i, (f, typ) in enumerate(kinds.items())])


def extract_collection(docs: DataFrame, doc_type: str, salt: str, doc: str = "doc",
                       keep: dict[str, Column] | None = None, only: list[str] | None = None) -> DataFrame:
    """Contract projection in stages - read each path once, normalise,
    then hash/derive - so no document value is looked up or normalised more
    than once per row (the optimizer keeps stages apart rather than
    duplicating non-trivial expressions). ``keep``: columns of the documents
    that go before the contract's. ``only``: the output columns that are asked
    for; paths that none of them needs are not read (the optimizer can't prune
    them, since texts are changed as arrays)."""
    plan = _plan(doc_type)
    canon = K.CANONICAL if doc_type == "transfer" else {}
    if only is not None:
        unknown = set(only) - {c for c, _f, _h in plan} - set(canon)
        if unknown:
            raise ValueError(f"the contract of {doc_type!r} gives no column {sorted(unknown)}")
        plan = [p for p in plan if p[0] in only]
        canon = {c: aliases for c, aliases in canon.items() if c in only}
    fields = list(dict.fromkeys([f for _c, f, _h in plan] + [a for al in canon.values() for a in al]))
    text_like = {f for _c, f, h in plan if h != "typed"} | {a for al in canon.values() for a in al}
    raw = {f: f"_r{i}" for i, f in enumerate(fields)}
    inner = [f for f in fields if any(g.startswith(f"{f}.") for g in fields)]
    if inner:
        raise ValueError(f"contract fields that hold other contract fields: {inner}")
    stage1 = _read_all(docs, doc, {f: "string" if f in text_like else field_type(f) for f in fields}, keep or {})
    # Texts are normalised and hashed as arrays: an expression per field and
    # stage makes methods that are too long to be compiled.
    from tallyhawk.functions.columns import strip_ws
    texts = [f for f in fields if f in text_like or field_type(f) == "string"]
    stage2 = _as_array(stage1, {raw[f]: F.col(raw[f]) for f in texts}, blank_to_null)
    keys = {col: F.col(raw[f]) for col, f, how in plan if how == "hash"}
    keys |= {col: F.coalesce(*[F.col(raw[a]) for a in aliases]) for col, aliases in canon.items()}

    def hashed(key):
        n = F.lower(strip_ws(key))
        return F.when(n != "", F.substring(F.sha2(F.concat(F.lit(salt), n), 256), 1, 24))

    stage3 = _as_array(stage2, {f"_n_{col}": key for col, key in keys.items()}, hashed)
    outs = []
    for col, f, how in plan:
        if how == "hash":
            outs.append(F.col(f"_n_{col}").alias(col))
        elif how == "email":
            outs.append(email_domain(F.col(raw[f])).alias(col))
        else:
            outs.append(F.col(raw[f]).alias(col))
    outs += [F.col(f"_n_{col}").alias(col) for col in canon]
    return stage3.select(*(keep or {}), *outs)


def _as_array(df: DataFrame, texts: dict[str, Column], change) -> DataFrame:
    """The columns ``texts`` after ``change``, which is applied to them as one array."""
    if not texts:
        return df
    changed = df.withColumn("_texts", F.transform(F.array(*texts.values()), change))
    return changed.withColumns({c: F.get("_texts", F.lit(i)) for i, c in enumerate(texts)}).drop("_texts")


def contract_columns(doc_type: str, salt: str, doc: str = "doc") -> dict[str, Column]:
    """Single-expression form of the projection (one column at a time)."""
    cols: dict[str, Column] = {}
    for col, f, how in _plan(doc_type):
        if how == "hash":
            cols[col] = pseudonym(read_field(doc, f, "string"), salt)
        elif how == "email":
            cols[col] = email_domain(read_field(doc, f, "string"))
        elif how == "text":
            cols[col] = read_field(doc, f, "string")
        else:
            cols[col] = read_field(doc, f)
    for canon, aliases in (K.CANONICAL.items() if doc_type == "transfer" else []):
        cols[canon] = pseudonym(F.coalesce(*[read_field(doc, a, "string") for a in aliases]), salt)
    return cols


def _canonical_source(doc: str) -> dict[str, Column]:
    """Canonical field -> the alias that resolves it in a document."""
    out = {}
    for canon, aliases in K.CANONICAL.items():
        expr = F.lit("UNRESOLVED")
        for a in reversed(aliases):
            expr = F.when(read_field(doc, a, "string").isNotNull(), F.lit(a)).otherwise(expr)
        out[canon] = expr
    return out


def canonical_sources(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Which alias resolved each canonical field (or UNRESOLVED), per doc."""
    return docs.select(*[c.alias(f"{n}_source") for n, c in _canonical_source(doc).items()])


def extraction_audit(docs: DataFrame, doc_type: str, doc: str = "doc") -> DataFrame:
    """Long form (metric, n): documents, contract-field misses per tier and,
    for transfers, canonical resolution counts per alias."""
    tiers = sorted({t for _f, a, t, _s in K.CONTRACTS[doc_type]})
    miss = {t: sum((read_field(doc, f).isNull().cast("long") for f, a, tt, _s in K.CONTRACTS[doc_type] if tt == t),
                   F.lit(0)) for t in tiers}
    per = [("docs", F.lit(1).cast("long"))] + [(f"missing_tier{t}", m) for t, m in miss.items()]
    rows = [F.struct(F.lit(name).alias("metric"), n.alias("n")) for name, n in per]
    if doc_type == "transfer":
        rows += [F.struct(F.concat(F.lit(f"{canon}<-"), source).alias("metric"), F.lit(1).cast("long").alias("n"))
                 for canon, source in _canonical_source(doc).items()]
    # one scan: a document gives a handful of rows, summed before they are shuffled
    return (docs.select(F.explode(F.array(*rows)).alias("_m")).groupBy("_m.metric").agg(F.sum("_m.n").alias("n")))
