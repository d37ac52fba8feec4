"""Bounded samples of labelled documents, and scores appended to documents.

Both classifiers fit on the driver, on a sample whose size is a parameter and
does not grow with the data; scoring runs over all rows in tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled documents per class that a fit may use, and the length above which a document is not used
SAMPLE_PER_CLASS = 1000
SAMPLE_CHARS = 20_000


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id, as text, falls in the part kept from
    learning; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def sample(docs: DataFrame, labels: DataFrame, target: str, parts: int, part: int, per_class: int = SAMPLE_PER_CLASS,
           most_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, dict]:
    """([(text, label, weight)], {label: number of labelled rows to learn from}).

    Rows are taken in the order of a hash of the id, ``per_class`` of each
    label. The weight makes the sample stand for all labelled rows. A document
    labelled more than once counts by its smallest label; null ids, null labels
    and labels without a document count nowhere.
    """
    known = (labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, parts, part))
             .groupBy(F.col(id_col).alias("id")).agg((F.min(target) > 0).cast("int").alias("label")))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("id", F.lit(11))
    ids = None
    for y in (0, 1):
        few = known.where(F.col("label") == y).orderBy(order, "id").limit(per_class + per_class // 2)
        ids = few if ids is None else ids.union(few)
    texts = (docs.where(F.length(text_col) <= most_chars).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(ids), "id")  # at most 3 * per_class rows of an id and a label
             .orderBy(order, "id", "text").limit(3 * per_class).collect())
    rows = []
    for y in (0, 1):
        got = [r for r in texts if r["label"] == y][:per_class]
        weight = totals.get(y, 0) / max(1, len(got))
        rows += [(r["id"], r["text"], y, weight) for r in got]
    rows.sort(key=lambda r: (zlib.crc32(f"o{r[0]}".encode()), r[1]))
    return [r[1:] for r in rows], totals


def append_scores(docs: DataFrame, scorer: Callable[[], Callable[[list[str]], list[list]]],
                  new: list[tuple[str, str]], keep: list[str], text_col: str = "text",
                  rows_at_once: int = 256) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the columns ``new`` (name, type) that
    the scorer makes from the whole texts, ``rows_at_once`` texts at a time.
    ``scorer`` is called once per task."""
    (work,) = _fresh([*docs.columns, *[n for n, _ in new]], "scored_text")
    rows = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(work))
    schema = rows.select(*keep, *[F.lit(None).cast(t).alias(n) for n, t in new]).schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        kinds = [to_arrow_type(schema[n].dataType) for n, _ in new]
        score = scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                found = score(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(c, k) for c, k in zip(found, kinds, strict=True)]], names)

    return rows.mapInArrow(run, schema)


def _fresh(taken: list[str], base: str) -> list[str]:
    name = f"_{base}"
    while name in taken:
        name = f"_{name}"
    return [name]
