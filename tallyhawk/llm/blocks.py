"""Substring dedup with fixed-block anchors.

Every word inside a window of ``window`` words that also starts in a document
with a smaller id is removed.

1. Each text is cut into non-overlapping blocks of ``(window + 1) // 2`` words,
   so that every window holds one block whole. The blocks are the index, and the
   same number of words from every place on (every rolling window) is a probe.
   Index and probes meet in buckets by hash; a place is *live* if an indexed
   block of some other document matches it.
2. A live place is extended by the words around it: the windows that hold it are
   looked up among all live windows, and those that a smaller document has too
   are covered. Neighbouring covered windows merge into the maximal exact repeat.
3. Covered words are cut out.

A task takes texts apart a piece at a time and settles what repeats inside the
piece by itself, so that a block or window that a third of all documents hold
sends one entry per piece. Entries are packed: a hash and the distance to the
entry before. Windows are equal if 64 bits of one and 32 of another hash of
their words are; both hashes cover the words whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, fresh, saved

WINDOW = 13
#: bytes of text a task takes apart at once; entries a bucket is sized for
PIECE_BYTES, BUCKET_ENTRIES = 4 << 20, 2_000_000
#: kinds of rows: the documents of a piece, entries, settled places, places that share a fate
TABLE, ENTRIES, SETTLED, SHARED = 0, 1, 2, 3
NULL_ID = np.iinfo(np.int64).max

_PACKED = pa.schema([("bucket", pa.int32()), ("piece", pa.int64()), ("kind", pa.int8()),
                     ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_PACKED_SQL = "bucket int, piece long, kind tinyint, a binary, b binary, c binary"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Hashes of words (runs of bytes that are no ASCII white space) and of
    the sequences of words that start at each word."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.letter = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base, self.step = (rng.integers(1 << 40, 1 << 62, 2, np.uint64) << np.uint64(1)) | np.uint64(1)

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.empty(0, np.uint64)
        size = end - start
        first = np.cumsum(size) - size
        inside = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
        power = np.ones(int(size.max()), np.uint64)
        power[1:] = self.base
        power = np.multiply.accumulate(power)
        letters = self.letter[data[np.repeat(start, size) + inside]]
        return _mixed(np.add.reduceat(letters * power[inside], first) + size.astype(np.uint64))

    def runs(self, words: np.ndarray, k: int) -> np.ndarray:
        """Of the k words from each place on, for all places that have k."""
        n = max(len(words) - k + 1, 0)
        h = np.zeros(n, np.uint64)
        for i in range(k):
            h = h * self.step + words[i:i + n]
        return _mixed(h)


def word_bounds(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the words of texts that follow each other in
    ``data`` and begin at ``begin`` (the end of data last)."""
    ink = ~_SPACE[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[begin] = True
    before = np.concatenate(([False], ink[:-1])) & ~cuts[:-1] if len(data) else ink
    after = np.concatenate((ink[1:], [False])) & ~cuts[1:] if len(data) else ink
    start, end = np.nonzero(ink & ~before)[0], np.nonzero(ink & ~after)[0] + 1
    return start, end, np.searchsorted(begin[1:], start, side="right")


class Piece:
    """Texts of a batch with their words laid end to end."""

    def __init__(self, texts: list[bytes]):
        begin = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.start, self.end, self.text = word_bounds(self.data, begin)
        #: first word of each text, then the number of words
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def runs(self, seed: int, k: int) -> np.ndarray:
        hasher = Hasher(seed)
        with np.errstate(over="ignore"):
            return hasher.runs(hasher.words(self.data, self.start, self.end), k)

    def whole(self, k: int) -> np.ndarray:
        """Places from which k words of one text follow."""
        n = max(len(self.text) - k + 1, 0)
        at = np.arange(n)
        return at[at + k <= self.first[1:][self.text[:n]]]


def _rows(*rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACKED, strict=True)],
                                      schema=_PACKED)


def _bytes(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _gaps(at: np.ndarray) -> bytes:
    """Ascending places as distances, in two bytes each where they fit."""
    gap = np.diff(at, prepend=0)
    return _bytes(gap, np.uint16 if gap.max(initial=0) < 1 << 16 else np.uint32)


def _ungapped(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype(np.int64))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _groups(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of equal numbers, none of them negative."""
    edges = np.nonzero(np.diff(x, prepend=-1))[0].tolist()
    return zip(edges, [*edges[1:], len(x)], strict=False)


def _by_bucket(bucket: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows of it in the order of their places)."""
    order = np.lexsort((at, bucket))
    for lo, hi in _groups(bucket[order]):
        yield int(bucket[order[lo]]), order[lo:hi]


def _pieces(make: Callable) -> Callable:
    """A mapInArrow function that runs ``make(piece id, part)`` on pieces of a
    batch whose second column holds the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(1)], np.int64)
            for part in cut(batch, sizes, PIECE_BYTES):
                yield from make(number, part)
                number += 1
    return run


def _settled(number: int, buckets: int, first: np.ndarray, uids: np.ndarray, done: np.ndarray,
             asks: np.ndarray, shares: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a piece besides its entries. Places ``shares`` have the fate of
    the places ``asks``."""
    home = number % buckets
    yield _rows((home, number, TABLE, _bytes(first, np.int64), _bytes(uids, np.int64), None))
    if len(done):
        yield _rows((home, number, SETTLED, _bytes(done, np.int64), None, None))
    if len(shares):
        yield _rows((home, number, SHARED, _bytes(asks, np.int64), _bytes(shares, np.int64), None))


def _index(window: int, buckets: int) -> Callable:
    """(uid, data) to the entries of index and probes."""
    block = (window + 1) // 2

    def make(number: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        piece = Piece(part.column(1).to_pylist())
        at = piece.whole(block)
        if not len(at):
            return
        h = piece.runs(1, block)[at]
        text = piece.text[at]
        indexed = (at - piece.first[text]) % block == 0
        order = np.lexsort((at, h))
        h, at, text, indexed = h[order], at[order], text[order], indexed[order]
        edge = np.concatenate(([True], h[1:] != h[:-1]))
        lead = np.nonzero(edge)[0]
        group = np.cumsum(edge) - 1
        several = np.maximum.reduceat(text, lead) != np.minimum.reduceat(text, lead)
        index = np.logical_or.reduceat(indexed, lead)
        again = ~edge & ~several[group]
        yield from _settled(number, buckets, piece.first, part.column(0).to_numpy(), at[several[group]],
                            at[lead][group[again]], at[again])
        h, at = h[lead], at[lead]
        for bucket, rows in _by_bucket(_bucket(h, buckets), at):
            yield _rows((bucket, number, ENTRIES, _bytes(h[rows] & np.uint64(0xFFFFFFFF), np.uint32), _gaps(at[rows]),
                         np.packbits(index[rows]).tobytes()))
    return _pieces(make)


def _live(entries: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, whether it is live) of the entries of a bucket: a block
    that several pieces hold and one has in its index."""
    counts = [len(r["a"]) // 4 for r in entries]
    h = np.frombuffer(b"".join(r["a"] for r in entries), np.uint32)
    index = np.concatenate([np.unpackbits(np.frombuffer(r["c"], np.uint8), count=n) for r, n in zip(entries, counts, strict=True)])
    order = np.argsort(h, kind="stable")
    sorted_ = h[order]
    lead = np.nonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))[0]
    size = np.diff(lead, append=len(h))
    live = np.empty(len(h), bool)
    live[order] = np.repeat((size > 1) & (np.maximum.reduceat(index[order], lead) > 0), size)
    return np.repeat(np.arange(len(entries)), counts), np.concatenate(
        [_ungapped(r["b"], n) for r, n in zip(entries, counts, strict=True)]), live


def _extend(window: int, buckets: int) -> Callable:
    """(uid, data, id, live places) to the entries of the windows around them."""
    block = (window + 1) // 2
    reach = window - block + 1  # places of a window at which a block may start

    def make(number: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        piece = Piece(part.column(1).to_pylist())
        live = np.zeros(len(piece.text) + reach + 1, np.int64)
        for first, places in zip(piece.first, part.column(3).to_pylist(), strict=False):
            live[first + np.frombuffer(places, np.int32) + 1] = 1
        live = np.cumsum(live)
        at = piece.whole(window)
        at = at[live[at + reach] > live[at]]
        if not len(at):
            return
        h, check = piece.runs(1, window)[at], piece.runs(2, window)[at].astype(np.uint32)
        text = piece.text[at]
        ids = part.column(2).fill_null(NULL_ID).to_numpy()
        order = np.lexsort((at, ids[text], check, h))
        h, check, at, text = h[order], check[order], at[order], text[order]
        edge = np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])))
        lead = np.nonzero(edge)[0]
        group = np.cumsum(edge) - 1
        least = ids[text[lead]]
        later = ids[text] > least[group]
        again = ~edge & ~later
        yield from _settled(number, buckets, piece.first, part.column(0).to_numpy(), at[later], at[lead][group[again]], at[again])
        h, check, at, ids = h[lead], check[lead], at[lead], least
        for bucket, rows in _by_bucket(_bucket(_mixed(h), buckets), at):
            own = ids[rows]
            run = np.nonzero(np.concatenate(([True], own[1:] != own[:-1])))[0]
            yield _rows((bucket, number, ENTRIES, _bytes(h[rows], np.uint64) + _bytes(check[rows], np.uint32), _gaps(at[rows]),
                         _bytes(own[run], np.int64) + _bytes(np.diff(run, append=len(own)), np.uint32)))
    return _pieces(make)


def _covered(entries: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, whether it is covered) of the windows of a bucket: those
    that a smaller id has too."""
    counts = np.array([len(r["a"]) // 12 for r in entries])
    h = np.concatenate([np.frombuffer(r["a"], np.uint64, n) for r, n in zip(entries, counts, strict=True)])
    check = np.concatenate([np.frombuffer(r["a"], np.uint32, n, 8 * n) for r, n in zip(entries, counts, strict=True)])
    ids = np.concatenate([np.repeat(np.frombuffer(r["c"], np.int64, m), np.frombuffer(r["c"], np.uint32, m, 8 * m))
                          for r in entries for m in (len(r["c"]) // 12,)])
    order = np.lexsort((ids, check, h))
    edge = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])))
    least = ids[order][np.nonzero(edge)[0]][np.cumsum(edge) - 1]
    covered = np.empty(len(h), bool)
    covered[order] = ids[order] > least
    return np.repeat(np.arange(len(entries)), counts), np.concatenate(
        [_ungapped(r["b"], n) for r, n in zip(entries, counts, strict=True)]), covered


def _matched(judge: Callable) -> Callable:
    """Rows sorted by (kind, bucket): entries are judged a bucket at a time,
    the others pass."""
    def done(entries: list[dict]) -> Iterator[pa.RecordBatch]:
        row, at, hit = judge(entries)
        row, at = row[hit], at[hit]
        for lo, hi in _groups(row):
            yield _rows((0, entries[row[lo]]["piece"], SETTLED, _bytes(at[lo:hi], np.int64), None, None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[dict] = []
        for batch in batches:
            kinds = batch.column(2).to_numpy()
            rest = batch.filter(pa.array(kinds != ENTRIES))
            if rest.num_rows:
                yield rest
            for row in batch.filter(pa.array(kinds == ENTRIES)).to_pylist():
                if entries and row["bucket"] != entries[0]["bucket"]:
                    yield from done(entries)
                    entries = []
                entries.append(row)
        if entries:
            yield from done(entries)
    return run


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (piece, kind) to (uid, places in the text) of each text
    of a piece that has any."""
    schema = pa.schema([("uid", pa.int64()), ("places", pa.binary())])

    def done(piece: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        ints = lambda kind, col: np.frombuffer(b"".join(r[col] for r in piece.get(kind, ())), np.int64)
        first, uids, found = ints(TABLE, "a"), ints(TABLE, "b"), ints(SETTLED, "a")
        found = np.unique(np.concatenate((found, ints(SHARED, "b")[np.isin(ints(SHARED, "a"), found)])))
        text = np.searchsorted(first[1:], found, side="right")
        out = [(int(uids[text[lo]]), _bytes(found[lo:hi] - first[text[lo]], np.int32)) for lo, hi in _groups(text)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                                             schema=schema)

    piece, number = {}, None
    for batch in batches:
        for row in batch.to_pylist():
            if number != row["piece"]:
                if piece:
                    yield from done(piece)
                piece, number = {}, row["piece"]
            piece.setdefault(row["kind"], []).append(row)
    if piece:
        yield from done(piece)


def _places(rows: DataFrame, judge: Callable, buckets: int, name: str) -> DataFrame:
    """(uid, places) of the entries that ``judge`` finds."""
    met = (rows.repartition(buckets, "bucket").sortWithinPartitions("kind", "bucket")
           .mapInArrow(_matched(judge), _PACKED_SQL))
    met = saved(met.drop("bucket"), f"{name}-met")
    return saved(met.repartition("piece").sortWithinPartitions("piece", "kind").mapInArrow(
        _resolved, "uid long, places binary"), name)


def covered_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(uid, places: 32-bit numbers of the words at which covered windows
    start) for ``docs`` (uid: unique long, id: long, data: binary, not null)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.length("data"))).first()[0] or 0
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, -(-size // (6 * BUCKET_ENTRIES)))
    index = docs.select("uid", "data").mapInArrow(_index(window, buckets), _PACKED_SQL)
    live = _places(index, _live, buckets, "live-places")
    around = docs.join(live, "uid").select("uid", "data", "id", "places")
    return _places(around.mapInArrow(_extend(window, buckets), _PACKED_SQL), _covered, buckets, "covered-windows")


def _cut_out(window: int) -> Callable:
    """Replaces the last two columns (data, places) by (kept, removed, n_words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns
            sizes = np.array([len(x.as_buffer()) for x in batch.column(last - 2)], np.int64)
            for part in cut(batch, sizes, PIECE_BYTES):
                kept, removed, counts = [], [], []
                for data, places in zip(part.column(last - 2).to_pylist(), part.column(last - 1).to_pylist(), strict=True):
                    words = data.split()  # at ASCII white space
                    counts.append(len(words))
                    runs = []
                    if places:
                        step = np.zeros(len(words) + 1, np.int64)
                        at = np.frombuffer(places, np.int32)
                        np.add.at(step, at, 1)
                        np.add.at(step, at + window, -1)
                        stays = np.cumsum(step[:-1]) == 0
                        edge = np.diff(np.concatenate(([True], stays, [True])).astype(np.int8))
                        runs = [{"start": s, "end": e} for s, e in zip(
                            np.nonzero(edge == -1)[0].tolist(), np.nonzero(edge == 1)[0].tolist(), strict=True)]
                        words = compress(words, stays)
                    kept.append(b" ".join(words))
                    removed.append(runs)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], pa.array(kept, pa.binary()),
                     pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(counts, pa.int64())],
                    [*part.schema.names[:-2], "_kept", "_removed", "_n_words"])
    return run


def remove_repeated(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` (all columns but the text unless given) of every row of ``docs``
    and the columns kept (string: the words that stay, joined by one space),
    removed (array of {start, end}, maximal runs in words) and n_words, under
    names that clash with none of ``docs``; returns the names too.

    A null text has no words; texts of fewer than ``window`` words stay whole; a
    text of any length is one piece. Of exact copies the one with the smallest
    id stays whole. Rows that share an id do not cover each other, nor do
    repeats inside one document; a null id counts as larger than all others.
    No rows give no rows.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    ids = docs.groupBy(id_col).count()
    uid, id_, data, places, kept, removed, n_words = fresh(docs, "uid", "id", "data", "places", "kept", "removed", "n_words")
    whole = docs.select(F.col(id_col).cast("long").alias(id_), *keep,
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias(data))
    if ids.where((F.col("count") > 1) | F.col(id_col).isNull()).limit(1).count():
        whole = saved(whole.withColumn(uid, F.monotonically_increasing_id()), "numbered-docs")
    else:
        whole = whole.withColumn(uid, F.col(id_))
    found = covered_windows(whole.select(F.col(uid).alias("uid"), F.col(id_).alias("id"), F.col(data).alias("data")), window)
    joined = whole.join(found.toDF(uid, places), uid, "left").select(*keep, data, places)
    typed = joined.select(*keep, F.col(data).alias("_kept"),
                          F.lit(None).cast("array<struct<start:long,end:long>>").alias("_removed"),
                          F.lit(None).cast("long").alias("_n_words"))
    out = joined.mapInArrow(_cut_out(window), typed.schema).toDF(*keep, kept, removed, n_words)
    out = out.withColumn(kept, F.col(kept).cast("string"))
    return out, {"kept": kept, "removed": removed, "n_words": n_words}
