"""Keyed time-range frames that survive hot keys.

A plain ``Window.partitionBy(user).orderBy(t).rangeBetween(...)`` sends every
row of one user to one task; AQE splits skewed joins, not window partitions.
Here the partition key is (key, time bucket) instead. A bucket spans at
least the longest frame, and every row whose time lies within reach of the
next (or previous) bucket is also emitted there as a *halo* copy, so each
real row still sees its complete frame. Halo rows are dropped after the
window. The result is exact, one shuffle plus one sort for all frames
together, and a hot key is spread over as many tasks as it has buckets.

A frame [t + lo, t + hi] is the difference of two frames that only grow
(everything up to t + hi, less everything before t + lo), because Spark adds a
row to a growing frame once, while a sliding frame is summed anew for each
row. So that the difference is exact, an amount is taken apart into whole
numbers of 2^62, 2^31, 1, 2^-31 and 2^-62 (an exact split of a double but for
what is below the last), and these are summed as 64-bit numbers. Amounts of
2^92 (5e27) and more count as infinite. NaN is no amount.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Frame:
    """One output column: ``agg`` of ``value`` over rows of the same key whose
    time lies in [t + lo_us, t + hi_us] (both bounds inclusive)."""
    name: str
    agg: str            # "count" | "sum" | "exists"
    value: str | None
    lo_us: int
    hi_us: int


#: the parts of an amount: (name, size of its unit, size of the unit above)
PARTS = (("_p62", 2.0 ** 62, None), ("_p31", 2.0 ** 31, 2.0 ** 62), ("_p0", 1.0, 2.0 ** 31),
         ("_m31", 2.0 ** -31, 1.0), ("_m62", 2.0 ** -62, 2.0 ** -31))
HUGE = 2.0 ** 92
_DOWN = 1 << 32


def _split(value: str) -> dict[str, Column]:
    """Columns with the whole-number parts of a value; ``_n`` marks a value,
    ``_w`` one that counts as infinite (1 up, 2^32 down)."""
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    usual = F.when(F.abs(v) < HUGE, v)
    cols = {f"{value}{name}": ((usual if above is None else usual % F.lit(above)) / F.lit(unit)).cast("long")
            for name, unit, above in PARTS}
    wild = F.when(v >= HUGE, F.lit(1)).when(v <= -HUGE, F.lit(_DOWN)).cast("long")
    return cols | {f"{value}_n": v.isNotNull().cast("long"), f"{value}_w": wild}


def _joined(sums: dict[str, Column]) -> Column:
    """The sum of a frame from the sums of its parts; null for no value."""
    # the smallest first: each step rounds at the size reached
    total = sum((sums[name].cast("double") * F.lit(unit) for name, unit, _ in reversed(PARTS)), F.lit(0.0))
    up, down = sums["_w"].bitwiseAND(F.lit(_DOWN - 1)) > 0, F.shiftright(sums["_w"], 32) > 0
    inf = float("inf")
    total = F.when(up & down, F.lit(float("nan"))).when(up, F.lit(inf)).when(down, F.lit(-inf)).otherwise(total)
    return F.when(sums["_n"] > 0, total)


def with_time_frames(df: DataFrame, key: str, us_col: str, frames: list[Frame],
                     bucket_us: int | None = None) -> DataFrame:
    """Add one column per frame. Rows with a null key or null time get null
    (callers decide the fill). Every frame must lie entirely before or
    entirely after the current row (lo, hi both < 0 or both > 0)."""
    back = max([-f.lo_us for f in frames if f.hi_us < 0] or [0])
    fwd = max([f.hi_us for f in frames if f.lo_us > 0] or [0])
    for f in frames:
        if not (f.hi_us < 0 or f.lo_us > 0) or f.lo_us > f.hi_us:
            raise ValueError(f"frame {f.name} must exclude the current row")
    reach = max(back, fwd)
    width = int(bucket_us or 2 * reach)
    if width < reach:
        raise ValueError("bucket must span the longest frame")

    t = F.col(us_col)
    b = F.floor(t / F.lit(width)).cast("bigint")
    off = t - b * F.lit(width)
    home = F.struct(b.alias("_b"), F.lit(False).alias("_halo"))
    copies = [home]
    if back:
        # rows late in bucket b fall inside trailing frames of rows in b + 1
        copies.append(F.when(off >= F.lit(width - back),
                             F.struct((b + 1).alias("_b"), F.lit(True).alias("_halo"))))
    if fwd:
        # rows early in bucket b fall inside leading frames of rows in b - 1
        copies.append(F.when(off < F.lit(fwd),
                             F.struct((b - 1).alias("_b"), F.lit(True).alias("_halo"))))

    valid = F.col(key).isNotNull() & t.isNotNull()
    # Rows without a key or time get no frame; they are spread over 1024
    # partitions by a deterministic row hash (retries place them alike) and
    # kept apart from real buckets by the _valid partition column.
    spread = F.struct(F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1024)).alias("_b"),
                      F.lit(False).alias("_halo"))
    places = F.when(valid, F.filter(F.array(*copies), lambda x: x.isNotNull())).otherwise(F.array(spread))
    placed = (df.withColumn("_valid", valid)
                .withColumn("_place", F.explode(places))
                .select("*", "_place._b", "_place._halo").drop("_place"))
    part = Window.partitionBy(key, "_b", "_valid")
    # the values are split behind the exchange, which carries them whole
    placed = placed.repartition(key, "_b", "_valid")
    for value in sorted({f.value for f in frames if f.value and f.agg in ("count", "sum")}):
        placed = placed.withColumns(_split(value))
    sums, cols = {}, {}
    zero = F.lit(0).cast("long")

    def upto(c: Column, behind: bool, edge: int) -> Column:
        """``c`` over all rows up to an edge. Frames behind the row are ordered
        by time, those ahead by time descending: both grow towards the row."""
        at = part.orderBy(t if behind else t.desc()).rangeBetween(Window.unboundedPreceding, edge)
        return F.col(sums.setdefault((str(c), behind, edge), (f"_upto_{len(sums)}", c.over(at)))[0])

    for f in frames:
        behind = f.hi_us < 0
        near, far = (f.hi_us, f.lo_us) if behind else (-f.lo_us, -f.hi_us)

        def inside(c: Column, behind=behind, near=near, far=far) -> Column:
            return F.coalesce(upto(c, behind, near), zero) - F.coalesce(upto(c, behind, far - 1), zero)

        if f.agg == "exists":
            closest = upto(F.max(t) if behind else F.min(t), behind, near)
            cols[f.name] = F.coalesce(F.abs(closest - t) <= F.lit(-far), F.lit(False))
        elif f.agg == "count":
            cols[f.name] = inside(F.sum(f"{f.value}_n") if f.value else F.count(F.lit(1)))
        elif f.agg == "sum":
            cols[f.name] = _joined({n: inside(F.sum(f"{f.value}{n}")) for n in ("_n", "_w", *[n for n, _, _ in PARTS])})
        else:
            raise ValueError(f"unknown frame aggregate {f.agg!r}")
    found = placed.withColumns(dict(sums.values())).filter(~F.col("_halo"))
    return found.select(*df.columns, *[F.when(F.col("_valid"), c).alias(n) for n, c in cols.items()])


def with_ranged_frames(df: DataFrame, key: str, us_col: str, frames: list[Frame], buckets: int | None = None) -> DataFrame:
    """As :func:`with_time_frames` for trailing frames, for keys of any size:
    no time bucket of a key is one task's work.

    Rows lie in ranges of (key, time) whose edges follow the data, so a key
    with very many rows, in a week or in a minute, spans as many ranges as it
    fills. Inside a range running totals are taken to the edges of the frames;
    a key that spans several ranges adds the total of its earlier ranges
    (carry), and an edge that lies before the range is looked up in the earlier
    range that holds it. Most rows look nothing up: at most two keys per range
    span several, and of these only rows near its beginning, or rows of very
    large keys, reach back. The rows are fixed by a checkpoint and shuffled
    twice, so this costs more than time buckets where no key is large.
    """
    from tallyhawk.operators.ranking import range_bucket
    from tallyhawk.session import materialize
    for f in frames:
        if f.agg not in ("count", "sum") or f.hi_us >= 0 or f.lo_us > f.hi_us:
            raise ValueError(f"frame {f.name} is no trailing count or sum")
    t, zero = F.col(us_col), F.lit(0).cast("long")
    valid = F.col(key).isNotNull() & t.isNotNull()
    d = range_bucket(df.filter(valid).withColumn("_rid", F.monotonically_increasing_id()), [F.col(key), t], "_p", buckets)
    d = d.withColumn("_one", F.lit(1).cast("long"))
    for value in sorted({f.value for f in frames if f.value}):
        d = d.withColumns(_split(value))
    cols = [c for c in d.columns if c == "_one" or c not in df.columns and any(c.startswith(f"{f.value}_") for f in frames if f.value)]
    edges = sorted({f.hi_us for f in frames} | {f.lo_us - 1 for f in frames})
    add = lambda c: F.coalesce(F.sum(c), zero)

    # ranges of keys that span several: at most two per range, so both tables below are broadcast
    spans = d.groupBy(key, "_p").agg(F.min(t).alias("_first"), *[add(c).alias(f"_s{j}") for j, c in enumerate(cols)])
    whole = Window.partitionBy(key)
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_many", F.count(F.lit(1)).over(whole)).filter("_many > 1").select(
        key, "_p", "_first", *[F.coalesce(F.sum(f"_s{j}").over(before), zero).alias(f"_c{j}") for j in range(len(cols))])
    spans = materialize(spans)
    carries = [f"_c{j}" for j in range(len(cols))]
    ladder = spans.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_first", "_p", *carries))).alias("_ladder"))

    # edges before the own range, looked up in the last range that begins before them
    asked = (d.join(F.broadcast(spans.select(key, "_p", "_first")), [key, "_p"])
             .select(key, "_rid", "_first", F.explode(F.array(*[
                 F.struct(F.lit(i).alias("edge"), (t + F.lit(e)).alias("at")) for i, e in enumerate(edges)])).alias("_e"))
             .select(key, "_rid", "_first", "_e.edge", F.col("_e.at").alias("_at")).filter(F.col("_at") < F.col("_first"))
             .join(F.broadcast(ladder), key)
             .withColumn("_ladder", F.filter("_ladder", lambda x: x["_first"] <= F.col("_at"))).filter(F.size("_ladder") > 0)
             .withColumn("_in", F.element_at("_ladder", -1))
             .select(key, "_in._p", "_at", "_rid", "edge", *[f"_in.{c}" for c in carries], *[F.lit(None).cast("long").alias(c) for c in cols]))
    there = d.join(F.broadcast(spans.select(key, "_p")), [key, "_p"], "left_semi").select(
        key, "_p", t.alias("_at"), F.lit(None).cast("long").alias("_rid"), F.lit(None).cast("int").alias("edge"),
        *[F.lit(None).cast("long").alias(c) for c in carries], *cols)
    upto = Window.partitionBy(key, "_p").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    found = there.unionByName(asked).withColumns({f"_x{j}": F.coalesce(F.sum(c).over(upto), zero) for j, c in enumerate(cols)})
    found = (found.filter(F.col("_rid").isNotNull()).groupBy("_rid").agg(*[
        F.max(F.when(F.col("edge") == i, F.col(f"_x{j}") + F.col(f"_c{j}"))).alias(f"_x{i}_{j}")
        for i in range(len(edges)) for j in range(len(cols))]))

    base = Window.partitionBy(key, "_p").orderBy(t)
    local = {f"_l{i}_{j}": F.coalesce(F.sum(c).over(base.rangeBetween(Window.unboundedPreceding, e)), zero)
             for i, e in enumerate(edges) for j, c in enumerate(cols)}
    rows = d.withColumns(local).join(F.broadcast(spans), [key, "_p"], "left").join(found, "_rid", "left")

    def total(edge: int, c: str) -> Column:
        i, j = edges.index(edge), cols.index(c)
        own = F.col(f"_l{i}_{j}")
        return (F.when(F.col("_first").isNull(), own).when(t + F.lit(edge) >= F.col("_first"), F.col(f"_c{j}") + own)
                .otherwise(F.coalesce(F.col(f"_x{i}_{j}"), zero)))

    out = []
    for f in frames:
        inside = lambda c, f=f: total(f.hi_us, c) - total(f.lo_us - 1, c)
        value = (inside(f"{f.value}_n" if f.value else "_one") if f.agg == "count" else
                 _joined({n: inside(f"{f.value}{n}") for n in ("_n", "_w", *[n for n, _, _ in PARTS])}))
        out.append(value.alias(f.name))
    rows = rows.select(*df.columns, *out)
    rest = df.filter(~F.coalesce(valid, F.lit(False)))
    return rows.unionByName(rest.select(*df.columns, *[F.lit(None).cast(rows.schema[f.name].dataType).alias(f.name) for f in frames]))
