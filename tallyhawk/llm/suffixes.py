"""Suffix-array dedup: every byte inside a string of ``length`` bytes that also
starts earlier in the corpus is removed.

1. Anchors (see ``anchors``) cut the windows of every text into stretches.
   Equal stretches are equal strings, so of each set of equal stretches all
   but the earliest are covered whole. Each task settles its own repeats
   before anything is shuffled, so a passage that a third of all documents
   hold sends a row per task, not per document.
2. Windows that repeat with other surroundings lie in stretches with the same
   anchor and different strings. Such strings meet in a bucket per anchor. An
   enhanced suffix array over the bucket (all suffixes that begin a window,
   sorted, with the lengths of common prefixes) is scanned with a stack: each
   interval of the array with a common prefix of ``length`` or more, whose
   members differ in the byte to their left, is a maximal repeat, with all its
   occurrences. All but the earliest occurrence are covered.
3. A bucket too large for a task, and anchors that a sample shows to be very
   frequent, are dealt out by the first ``length`` bytes of the suffixes
   instead, which is as exact: suffixes with equal beginnings meet, the
   earliest stays.
4. Covered bytes are cut out of each document.

Earlier means a smaller document id, then a smaller start. Strings are judged
on the input, not on what is left of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.anchors import stretches, string_hashes
from tallyhawk.llm.common import cut, fresh, saved

LENGTH = 100
#: bytes of text a task takes apart at once, and bytes of sorted suffixes in one suffix array
PIECE_BYTES, ARRAY_BYTES = 8 << 20, 24 << 20
#: strings of one anchor that share a suffix array; larger buckets are dealt out
BUCKET = 8192
#: documents in the sample for frequent anchors, and share of them that makes an anchor frequent
SAMPLE_DOCS, FREQUENT = 2000, 0.2
COVERED, STRING, DEALT = 0, 1, 2

_ROW = "kind tinyint, h long, u long, ord long, start long, n long"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def merged(ord_: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of the intervals of each document, those that touch as one."""
    if not len(ord_):
        return ord_, start, end
    order = np.lexsort((start, ord_))
    ord_, start, end = ord_[order], start[order], end[order]
    doc = np.cumsum(np.concatenate(([0], ord_[1:] != ord_[:-1])))
    far = doc * (int(end.max()) + 2)
    reach = np.maximum.accumulate(far + end)
    new = np.concatenate(([True], (far + start)[1:] > reach[:-1]))
    first = np.nonzero(new)[0]
    last = np.concatenate((first[1:], [len(new)])) - 1
    return ord_[first], start[first], reach[last] - far[last]


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ROWS = pa.schema([("kind", pa.int8()), ("h", pa.int64()), ("u", pa.int64()), ("ord", pa.int64()),
                   ("start", pa.int64()), ("n", pa.int64())])


def _pieces(length: int, frequent):
    """Texts to stretches; repeats within the piece become covered spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value if frequent is not None else np.empty(0, np.int64)
        for batch in batches:
            sizes = np.array([len(x.as_buffer()) for x in batch.column(1)], np.int64)
            for part in cut(batch, sizes, PIECE_BYTES):
                texts = part.column(1).to_pylist()
                begin = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
                data = b"".join(texts)
                text, first, last, _, h = stretches(np.frombuffer(data, np.uint8), begin, length)
                if not len(h):
                    continue
                u = np.fromiter(string_hashes(data, first, last + length, 1), np.uint64, len(h))
                ord_ = part.column(0).to_numpy()[text]
                start, n = first - begin[text], last - first + 1
                order = np.lexsort((start, ord_, u, h))
                h, u, ord_, start, n = _signed(h[order]), _signed(u[order]), ord_[order], start[order], n[order]
                own = np.concatenate(([True], (h[1:] != h[:-1]) | (u[1:] != u[:-1])))
                again = ~own
                o, s, e = merged(ord_[again], start[again], start[again] + n[again] + length - 1)
                zero = np.zeros(len(o), np.int64)
                kind = np.where(np.isin(h[own], often), DEALT, STRING)
                yield _batch(_ROWS, np.full(len(o), COVERED), zero, zero, o, s, e - s)
                yield _batch(_ROWS, kind, h[own], u[own], ord_[own], start[own], n[own])
    return run


def _firsts(length: int):
    """Rows sorted by (kind, h, u, ord, start): equal stretches after the
    first become covered spans; a first is kept if its anchor has other
    strings (or is dealt out). Holds one row between batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (-1, 0, 0)
        held, shared = None, False  # the last first, and whether the one before had its anchor
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, h, u, ord_, start, n = (batch.column(i).to_numpy() for i in range(6))
            new = np.concatenate((
                [(kind[0], h[0], u[0]) != last],
                (kind[1:] != kind[:-1]) | (h[1:] != h[:-1]) | (u[1:] != u[:-1])))
            last = (kind[-1], h[-1], u[-1])
            done = (kind == COVERED) | ~new
            size = np.where(kind == COVERED, n, n + length - 1)
            zero = np.zeros(int(done.sum()), np.int64)
            yield _batch(_ROWS, np.full(len(zero), COVERED), zero, zero, ord_[done], start[done], size[done])
            at = np.nonzero(~done)[0]
            if not len(at):
                continue
            cols = [kind[at], h[at], u[at], ord_[at], start[at], n[at]]
            if held is not None:
                cols = [np.concatenate(([x], c)) for x, c in zip(held, cols, strict=True)]
            same = (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1])
            before = np.concatenate(([shared if held is not None else False], same))
            keep = (before[:-1] | same | (cols[0][:-1] == DEALT))
            yield _batch(_ROWS, *[c[:-1][keep] for c in cols])
            held, shared = tuple(c[-1] for c in cols), bool(before[-1])
        if held is not None and (shared or held[0] == DEALT):
            yield _batch(_ROWS, *[[x] for x in held])
    return run


def maximal_repeats(strings: list[bytes], windows: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length of the repeat, string numbers, offsets) of the maximal repeats of
    at least ``length`` bytes among ``strings``; of string i the suffixes at
    offsets 0 to windows[i] - 1 take part, each at least ``length`` long."""
    lens = np.array([len(s) for s in strings], np.int64)
    width = int(lens.max())
    begin = np.cumsum(lens) - lens
    text = np.frombuffer(b"".join(strings) + bytes(width), np.uint8)
    owner = np.repeat(np.arange(len(strings)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place, left_over = begin[owner] + offset, lens[owner] - offset
    rows = np.lib.stride_tricks.sliding_window_view(text, width)[place]
    for at in range(0, len(rows), 1 << 14):  # bounded memory
        rows[at:at + (1 << 14)][np.arange(width)[None, :] >= left_over[at:at + (1 << 14), None]] = 0
    order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    # common prefixes of neighbours in the array
    common = np.zeros(len(order) + 1, np.int64)
    for at in range(0, len(order) - 1, 1 << 14):
        both = rows[order[at:at + (1 << 14) + 1]]
        differ = both[:-1] != both[1:]
        common[at + 1:at + 1 + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[1:-1] = np.minimum(common[1:-1], np.minimum(left_over[order[1:]], left_over[order[:-1]]))
    # the byte to the left; nothing is known left of a string, which counts as different
    left = np.where(offset > 0, text[place - 1].astype(np.int64), -1)[order]
    inside = common[1:-1] >= length
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    for lo, hi in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0], strict=True):
        run = left[lo:hi + 1]
        if run[0] >= 0 and (run == run[0]).all():
            continue  # no interval inside differs to the left
        stack: list[tuple[int, int]] = []
        for i in range(lo + 1, hi + 2):
            now, bound = (int(common[i]) if i <= hi else 0), i - 1
            while stack and stack[-1][0] > now:
                size, bound = stack.pop()
                run = left[bound:i]
                if run.min() < 0 or (run != run[0]).any():
                    members = order[bound:i]
                    yield size, owner[members], offset[members]
            if now >= length and (not stack or stack[-1][0] < now):
                stack.append((now, bound))


_SPOT = pa.struct([("ord", pa.int64()), ("start", pa.int64())])
_GROUPS = pa.schema([("length", pa.int64()), ("occurrences", pa.list_(_SPOT)), ("ord", pa.int64()), ("start", pa.int64()),
                     ("size", pa.int64())])


def _arrays(length: int):
    """Rows (h, ord, start, n, s) sorted by h to maximal repeat groups (length,
    occurrences) and to the spans (ord, start, size) that they cover, joined
    where they touch. Whole buckets are put under one suffix array until its
    suffixes, as wide as the longest string, have ARRAY_BYTES."""
    def groups(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes, flat, counts = [], [], []
        if len(rows) > 1:
            ord_, start = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            for size, who, offset in maximal_repeats([r[4] for r in rows], np.array([r[3] for r in rows]), length):
                o, s = ord_[who], start[who] + offset
                by = np.lexsort((s, o))
                sizes.append(size)
                counts.append(len(by))
                flat.append(np.stack([o[by], s[by]]))
        if not sizes:
            return
        both, ends = np.concatenate(flat, axis=1), np.cumsum(counts)
        spots = pa.StructArray.from_arrays([pa.array(both[0]), pa.array(both[1])], ["ord", "start"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), spots)
        none = pa.nulls(len(sizes), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), lists, none, none, none], _GROUPS.names)
        later = np.ones(both.shape[1], bool)
        later[ends - counts] = False  # the earliest of each group stays
        reach = np.repeat(sizes, counts)
        o, s, e = merged(both[0][later], both[1][later], both[1][later] + reach[later])
        none = pa.nulls(len(o), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.nulls(len(o), lists.type), pa.array(o), pa.array(s), pa.array(e - s)],
                                         _GROUPS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []  # whole buckets
        bucket: list[tuple] = []
        count = width = 0  # of the suffixes of the buckets that are ready
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket and bucket[0][0] != row[0]:
                    if len(bucket) > 1:
                        more, wide = sum(r[3] for r in bucket), max(len(r[4]) for r in bucket)
                        if ready and (count + more) * max(width, wide) > ARRAY_BYTES:
                            yield from groups(ready)
                            ready, count, width = [], 0, 0
                        ready += bucket
                        count, width = count + more, max(width, wide)
                    bucket = []
                bucket.append(row)
        yield from groups(ready + bucket)
    return run


def _strings(length: int):
    """(ord, text, wanted [(h, start, n, big)]) to (h, ord, start, n, big, s)."""
    schema = pa.schema([("h", pa.int64()), ("ord", pa.int64()), ("start", pa.int64()), ("n", pa.int64()),
                        ("big", pa.bool_()), ("s", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for ord_, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(w["h"], ord_, w["start"], w["n"], w["big"], text[w["start"]:w["start"] + w["n"] + length - 1])
                        for w in wanted]
                if len(out) >= 20_000:
                    yield _batch(schema, *zip(*out, strict=True))
                    out = []
            if out:
                yield _batch(schema, *zip(*out, strict=True))
    return run


def _beginnings(length: int):
    """(ord, start, n, s) to (a, b, ord, start): a 128-bit hash of each window."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ord", pa.int64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                ord_, start, n, s = (c.to_pylist() for c in batch.slice(at, 2000).columns)
                digests = b"".join([xxh3_128_digest(x[i:i + length]) for x, m in zip(s, n, strict=True) for i in range(m)])
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                n = np.array(n)
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield _batch(schema, halves[:, 0], halves[:, 1], np.repeat(ord_, n), np.repeat(start, n) + within)
    return run


def _frequent(docs: DataFrame, length: int) -> np.ndarray:
    """Anchors that many documents of a sample of fixed size hold. They are
    only dealt out differently; results do not depend on this choice."""
    few = docs.orderBy(F.xxhash64("ord", F.lit(3))).limit(SAMPLE_DOCS)
    rows = few.mapInArrow(_pieces(length, None), _ROW).where(F.col("kind") == STRING)
    least = max(8, int(FREQUENT * SAMPLE_DOCS))
    often = rows.groupBy("h").agg(F.countDistinct("ord", "u").alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r["h"] for r in often.select("h").orderBy(F.desc("n"), "h").limit(10_000).collect()], np.int64))


def repeats(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(spans, groups) for ``docs`` (ord: unique long, data: binary, not null).

    spans: ord, start, size of covered bytes, overlapping and repeated.
    groups: length and occurrences (array of {ord, start}, earliest first) of
    the maximal repeats among strings with one anchor.
    """
    spark = docs.sparkSession
    docs = docs.select("ord", "data")
    frequent = spark.sparkContext.broadcast(_frequent(docs, length))
    rows = docs.where(F.length("data") >= length).mapInArrow(_pieces(length, frequent), _ROW)
    # a frequent anchor is split by string, spans by document
    deal = F.when(F.col("kind") == STRING, F.col("h")).when(F.col("kind") == DEALT, F.xxhash64("h", "u")).otherwise(
        F.xxhash64("ord", "start"))
    rows = rows.repartition(deal).sortWithinPartitions("kind", "h", "u", "ord", "start")
    rows = saved(rows.mapInArrow(_firsts(length), _ROW), "stretches")
    wanted = rows.where(F.col("kind") != COVERED)
    sizes = wanted.where(F.col("kind") == STRING).groupBy("h").count().where(F.col("count") > bucket)
    wanted = (wanted.join(sizes.select("h", F.lit(True).alias("over")), "h", "left")
              .withColumn("big", F.coalesce("over", F.lit(False)) | (F.col("kind") == DEALT)))
    by_doc = wanted.groupBy("ord").agg(F.collect_list(F.struct("h", "start", "n", "big")).alias("wanted"))
    strings = saved(docs.join(by_doc, "ord").select("ord", "data", "wanted").mapInArrow(
        _strings(length), "h long, ord long, start long, n long, big boolean, s binary"), "strings")
    groups = (strings.where(~F.col("big")).select("h", "ord", "start", "n", "s").repartition("h")
              .sortWithinPartitions("h", "ord", "start").mapInArrow(
                  _arrays(length), "length long, occurrences array<struct<ord:long,start:long>>, ord long, start long, size long"))
    groups = saved(groups, "repeat-groups")
    again = groups.where(F.col("ord").isNotNull()).select("ord", "start", "size")
    windows = strings.where("big").select("ord", "start", "n", "s").mapInArrow(
        _beginnings(length), "a long, b long, ord long, start long")
    earliest = windows.groupBy("a", "b").agg(F.min(F.struct("ord", "start")).alias("one"), F.count("*").alias("m"))
    dealt = (windows.join(earliest.where("m > 1"), ["a", "b"])
             .where(F.struct("ord", "start") != F.col("one")).select("ord", "start", F.lit(length).cast("long").alias("size")))
    spans = (rows.where(F.col("kind") == COVERED).select("ord", "start", F.col("n").alias("size"))
             .unionByName(again)
             .unionByName(dealt))
    return spans, groups.where(F.col("occurrences").isNotNull()).select("length", "occurrences")


def _cut_out(whole_characters: bool):
    """Replaces the last two columns (data, spans) by (kept, removed, n_bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x.as_buffer()) for x in batch.column(batch.num_columns - 2)], np.int64)
            for part in cut(batch, sizes, PIECE_BYTES):
                kept, runs, counts = [], [], []
                for data, spans in zip(part.column(part.num_columns - 2).to_pylist(),
                                       part.column(part.num_columns - 1).to_pylist(), strict=True):
                    start = np.array([s["start"] for s in spans or ()], np.int64)
                    end = start + np.array([s["size"] for s in spans or ()], np.int64)
                    _, start, end = merged(np.zeros(len(start), np.int64), start, end)
                    if whole_characters:
                        start, end = _inward(data, start, end)
                    at, out = 0, []
                    for s, e in zip(start.tolist(), end.tolist(), strict=True):
                        out.append(data[at:s])
                        at = e
                    kept.append(b"".join([*out, data[at:]]))
                    runs.append([{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist(), strict=True)])
                    counts.append(len(data))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], pa.array(kept, pa.binary()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(counts, pa.int64())],
                    [*part.schema.names[:-2], "_kept", "_removed", "_n_bytes"])
    return run


def _inward(data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs without the bytes of characters that are not wholly inside."""
    inner = np.append((np.frombuffer(data, np.uint8) & 0xC0) == 0x80, False)
    for _ in range(3):
        start, end = start + inner[start], end - inner[end]
    some = start < end
    return start[some], end[some]


def ordered(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """``docs`` and the name of a column that orders its rows: the id where
    it is unique and never null, else a place in the order (id, nulls last)."""
    ids = docs.groupBy(id_col).count()
    if not ids.where((F.col("count") > 1) | F.col(id_col).isNull()).limit(1).count():
        return docs, id_col
    (name,) = fresh(docs, "ord")
    rest = [F.xxhash64(c) for c in docs.columns]
    placed = docs.orderBy(F.col(id_col).asc_nulls_last(), *rest).withColumn(name, F.monotonically_increasing_id())
    return saved(placed, "ordered-docs"), name


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the texts that stay; characters stay whole."""
    out, names = remove_repeats(docs, id_col=id_col, text_col=text_col, whole_characters=True, **options)
    text = F.col(names["kept"]).cast("string")
    return out.select(*[text.alias(c) if c == text_col else c for c in docs.columns])


def remove_repeats(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET, id_col: str = "doc_id",
                   text_col: str = "text", keep: list[str] | None = None,
                   whole_characters: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` (all columns but the text unless given) of every row of ``docs``
    and the columns kept (binary: the bytes that stay), removed (array of
    {start, end}, maximal runs in bytes) and n_bytes, under names that clash
    with none of ``docs``; returns the names too. With ``whole_characters`` a
    character that is only partly covered stays.

    Null texts count as empty; texts shorter than ``length`` stay whole; a
    long text is taken apart in pieces that overlap. Of exact copies the one
    with the smallest id stays whole; rows that share an id are ordered by
    their content, null ids come last. No rows give no rows.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    docs, order = ordered(docs, id_col)
    ord_, data, kept, removed, n_bytes, spans_name = fresh(docs, "ord_", "data", "kept", "removed", "n_bytes", "spans")
    whole = docs.select(F.col(order).cast("long").alias(ord_), *keep,
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias(data))
    spans, _ = repeats(whole.select(F.col(ord_).alias("ord"), F.col(data).alias("data")), length, bucket)
    by_doc = spans.groupBy(F.col("ord").alias(ord_)).agg(F.collect_list(F.struct("start", "size")).alias(spans_name))
    joined = whole.join(by_doc, ord_, "left").select(*keep, data, spans_name)
    typed = joined.select(*keep, F.col(data).alias("_kept"),
                          F.lit(None).cast("array<struct<start:long,end:long>>").alias("_removed"),
                          F.lit(None).cast("long").alias("_n_bytes"))
    out = joined.mapInArrow(_cut_out(whole_characters), typed.schema).toDF(*keep, kept, removed, n_bytes)
    return out, {"kept": kept, "removed": removed, "n_bytes": n_bytes}
