"""Chronological split and model-matrix preparation (fit on train, apply
anywhere).

The fitted state is three small tables - ``plan(col, kind, n_unique)``,
``freq(col, value, freq)`` and ``levels(col, value, idx)`` - so it persists
as Parquet and reloads in another job. Only O(columns) values ever reach the
driver (the plan); maps stay DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from tallyhawk import contract as K
from tallyhawk.functions.columns import epoch_us
from tallyhawk.operators.features import as_timestamp
from tallyhawk.operators.ranking import row_at


def split_sizes(n: int, test_frac: float = K.TEST_FRAC, val_frac: float = K.VAL_FRAC) -> tuple[int, int, int]:
    n_test = int(n * test_frac)
    n_val = int((n - n_test) * val_frac)
    return n - n_test - n_val, n_val, n_test


def temporal_split(df: DataFrame, test_frac: float = K.TEST_FRAC, val_frac: float = K.VAL_FRAC,
                   time_col: str = "date", id_col: str = "_id") -> DataFrame:
    """train | val | test by position in (time, id) order; a row with an
    unparseable time raises. Adds ``split``.

    Only times and ids are ordered, to find the first row of val and of test;
    the table itself is compared with these two cuts where it lies. Rows that
    share time and id stay together."""
    d = df.withColumn("_sus", epoch_us(as_timestamp(df, time_col)))

    def cuts(n: int, bad: int) -> list[int]:
        if bad:
            raise ValueError(f"{bad} rows have an unparseable {time_col}; cannot order them.")
        n_train, n_val, _ = split_sizes(n, test_frac, val_frac)
        return [n_train, n_train + n_val]
    first_val, first_test = row_at(d, ["_sus", id_col], cuts)
    place = F.struct("_sus", id_col)

    def before(cut) -> Column:
        return F.lit(True) if cut is None else place < F.struct(F.lit(cut["_sus"]).alias("_sus"),
                                                                F.lit(cut[id_col]).cast(d.schema[id_col].dataType).alias(id_col))
    split = (F.when(before(first_val), F.lit("train")).when(before(first_test), F.lit("val")).otherwise(F.lit("test")))
    return d.withColumn("split", split).drop("_sus")


def split_summary(split_df: DataFrame, time_col: str = "date") -> DataFrame:
    t = as_timestamp(split_df, time_col)
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("min_date"),
                                         F.max(t).alias("max_date"))


def fraud_rate_by_split(split_df: DataFrame, label: str = "label") -> DataFrame:
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                         F.avg(F.col(label).cast("double")).alias("fraud_rate"))


def class_weight(train: DataFrame, label: str = "label") -> DataFrame:
    """neg/pos ratio from the fit data only (denominator at least 1)."""
    r = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    pos = F.coalesce(F.col("pos"), F.lit(0))
    neg = F.col("n") - pos
    return r.select(neg.alias("neg"), pos.alias("pos"),
                    (neg / F.greatest(pos, F.lit(1))).alias("scale_pos_weight"))


@dataclass
class PrepState:
    plan: DataFrame
    freq: DataFrame
    levels: DataFrame
    kinds: dict[str, str] = field(default_factory=dict)
    n_unique: dict[str, int | None] = field(default_factory=dict)
    _bounded: dict | None = None

    @property
    def feature_cols(self) -> list[str]:
        cols = [c for c, k in self.kinds.items() if k in ("numeric", "boolean", "category", "category+frequency")]
        cols += [f"{c}{K.FE_SUFFIX}" for c, k in self.kinds.items() if "frequency" in k]
        return sorted(set(cols))

    def bounded(self) -> dict[str, tuple[list[str], list[float]]]:
        """Per category column its levels in order and their frequencies (of a
        column that has any): at most drop_original_above per column, so they
        go into plans as literals."""
        if self._bounded is None:
            cols = [c for c, k in self.kinds.items() if k.startswith("category")]
            freq = self.freq.select("col", "value", "freq")
            rows = (self.levels.filter(F.col("col").isin(*cols)).join(freq, ["col", "value"], "left")
                    .select("col", "idx", "value", "freq").collect()) if cols else []
            found: dict[str, tuple[list[str], list[float]]] = {c: ([], []) for c in cols}
            for r in sorted(rows, key=lambda r: (r["col"], r["idx"])):
                found[r["col"]][0].append(r["value"])
                found[r["col"]][1].append(-1.0 if r["freq"] is None else r["freq"])
            self._bounded = found
        return self._bounded

    def save(self, path: str) -> None:
        self.plan.write.mode("overwrite").parquet(f"{path}/plan")
        self.freq.write.mode("overwrite").parquet(f"{path}/freq")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PrepState:
        plan = spark.read.parquet(f"{path}/plan")
        rows = plan.collect()            # one row per column
        return PrepState(plan, spark.read.parquet(f"{path}/freq"), spark.read.parquet(f"{path}/levels"),
                         {r["col"]: r["kind"] for r in rows}, {r["col"]: r["n_unique"] for r in rows})


def fit(train: DataFrame, exclude: list[str] | None = None, freq_threshold: int = K.FREQ_THRESHOLD,
        drop_original_above: int = K.DROP_ORIGINAL_ABOVE) -> PrepState:
    """Cardinality policy from the train split: constant/all-null dropped;
    numeric and boolean pass; text with <= freq_threshold values is a
    category, up to drop_original_above a category plus a frequency column,
    above that frequency only."""
    spark = train.sparkSession
    skip = set(K.METADATA_COLS) | set(exclude or [])
    fields = [f for f in train.schema.fields if f.name not in skip]
    numeric = [f.name for f in fields if isinstance(f.dataType, (NumericType, BooleanType))]
    text = [f.name for f in fields if f.name not in numeric]
    aggs = []
    for c in numeric:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)      # NaN is no value: a column of NaN and one constant carries nothing
        aggs += [F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    st = train.agg(*aggs).first() if aggs else {}
    # one pass over the text columns gives distinct counts, frequencies and levels; what is kept is the small table
    from tallyhawk.session import materialize
    counts = (materialize(_melt(train, text).groupBy("col", "value").agg(F.count(F.lit(1)).alias("_c"))) if text
              else spark.createDataFrame([], "col string, value string, _c long"))
    totals = counts.groupBy("col").agg(F.count(F.lit(1)).alias("_nd"), F.sum("_c").alias("_t")).collect()      # one row per column
    distinct = {r["col"]: r["_nd"] for r in totals}
    kinds, nuniq, rows = {}, {}, []
    for f in fields:
        c = f.name
        if c in numeric:
            lo, hi = st[f"min__{c}"], st[f"max__{c}"]
            kind = "dropped" if lo is None or lo == hi else (
                "boolean" if isinstance(f.dataType, BooleanType) else "numeric")
            nu = None
        else:
            nu = int(distinct.get(c, 0))
            if nu <= 1:
                kind = "dropped"
            elif nu <= freq_threshold:
                kind = "category"
            elif nu <= drop_original_above:
                kind = "category+frequency"
            else:
                kind = "frequency"
        kinds[c], nuniq[c] = kind, nu
        rows.append((c, kind, nu))
    plan = spark.createDataFrame(rows, "col string, kind string, n_unique long")

    freq_cols = [c for c, k in kinds.items() if "frequency" in k]
    cat_cols = [c for c, k in kinds.items() if k.startswith("category")]
    total = F.lit(None).cast("long")
    for r in totals:
        total = F.when(F.col("col") == r["col"], F.lit(r["_t"])).otherwise(total)
    freq = (counts.filter(F.col("col").isin(*freq_cols))
            .select("col", "value", (F.col("_c") / total).cast("float").alias("freq")))
    # at most drop_original_above levels per column
    w = Window.partitionBy("col").orderBy("value")
    levels = (counts.filter(F.col("col").isin(*cat_cols))
              .select("col", "value", (F.row_number().over(w) - 1).cast("int").alias("idx")))
    return PrepState(plan, freq, levels, kinds, nuniq)


def _melt(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (col, value) of non-null values of ``cols`` in one pass."""
    arr = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(arr).alias("_m")).select("_m.col", "_m.value").filter(F.col("value").isNotNull())


def transform(state: PrepState, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Feature matrix from train-learned maps only: frequency (unseen/null
    -> -1), pinned category level index (unseen -> null), boolean -> 0/1,
    the rest numeric (bad -> null), a missing column -> null."""
    if not state.kinds:
        raise RuntimeError("transform called before fit")
    out = df
    feats = {}
    bounded = state.bounded()
    for c, kind in state.kinds.items():
        present = c in df.columns
        text = F.col(c).cast("string") if present else F.lit(None).cast("string")
        if kind.startswith("category"):
            levels, freqs = bounded[c]
            at = F.array_position(F.lit(levels).cast("array<string>"), text) - 1     # -1: unseen
            feats[c] = F.when(at >= 0, at).cast("int")
            if "frequency" in kind:
                freq = F.get(F.lit(freqs).cast("array<float>"), at.cast("int"))
                feats[f"{c}{K.FE_SUFFIX}"] = F.coalesce(F.when(at >= 0, freq), F.lit(-1.0).cast("float"))
        elif kind == "frequency":
            name = f"{c}{K.FE_SUFFIX}"
            if present:
                # as many values as the data has: a join, whose strategy the runtime sizes decide
                m = state.freq.filter(F.col("col") == c).select(F.col("value").alias(f"_fv_{c}"),
                                                                 F.col("freq").alias(f"_ff_{c}"))
                out = out.join(m, out[c].cast("string") == F.col(f"_fv_{c}"), "left")
                feats[name] = F.coalesce(F.col(f"_ff_{c}"), F.lit(-1.0).cast("float"))
            else:
                feats[name] = F.lit(-1.0).cast("float")
        elif kind == "boolean":
            feats[c] = F.col(c).cast("int") if present else F.lit(None).cast("int")
        elif kind == "numeric":
            feats[c] = F.col(c).try_cast("double") if present else F.lit(None).cast("double")
    cols = [F.col(k) for k in (keep or []) if k in df.columns]
    return out.select(*cols, *[feats[c].alias(c) for c in state.feature_cols])


def prepare_matrix(training: DataFrame, exclude: list[str] | None = None, test_frac: float = K.TEST_FRAC,
                   val_frac: float = K.VAL_FRAC, time_col: str = "date", id_col: str = "_id", fixed: bool = False):
    """Split, fit on train, transform every split. Returns (state, matrix)
    where matrix holds id, split, y, amount (amount_paid if the column
    exists, else send_amount) and the features. ``fixed``: ``training`` is
    materialized already."""
    from tallyhawk.session import materialize
    # the training table feeds the cuts of the split, the fit and the
    # transform: computed once, then read from the shared checkpoint folder
    split = temporal_split(training if fixed else materialize(training), test_frac, val_frac, time_col, id_col)
    state = fit(split.filter(F.col("split") == "train"), exclude=(exclude or []) + [id_col, "split"])
    amt = "amount_paid" if "amount_paid" in training.columns else "send_amount"
    base = split.withColumns({"y": F.col("label").cast("int"), "amount": F.col(amt).try_cast("double")})
    matrix = transform(state, base, keep=[id_col, "split", "y", "amount"])
    leaked = [m for m in K.METADATA_COLS if m in state.feature_cols]
    if leaked:
        raise AssertionError(f"metadata reached the features: {leaked}")
    return state, matrix


def feature_coverage(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Per row: expected features supplied (non-null) and the share; below
    the minimum share the score is flagged as untrustworthy."""
    present = [c for c in features if c in df.columns]
    provided = sum((F.col(c).isNotNull().cast("int") for c in present), F.lit(0))
    n = len(features)
    cov = provided / F.lit(float(n)) if n else F.lit(0.0)
    return df.select(*(keep or []), provided.cast("bigint").alias("features_provided"),
                     F.lit(n).cast("bigint").alias("features_expected"), cov.alias("coverage"),
                     (cov < K.MIN_FEATURE_COVERAGE).alias("low_coverage"))
