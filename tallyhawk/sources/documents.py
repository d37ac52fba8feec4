"""Raw document sources.

Documents are polymorphic nested JSON with extended-JSON scalars
(``{"$oid": ...}``, ``{"$date": ...}``, ``{"$numberLong": ...}``). They are
read into one ``VARIANT`` column (``doc``): no schema inference pass, and a
path the contract never reads is never materialised.

The fixture builders turn the driver's tables into such documents with
``to_json`` (null fields vanish, so documents differ by provider).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.sources import fixtures as FX

# FIXED VALUES: candidate export file names per collection, tried in order and
# concatenated.
LOCAL_COLLECTIONS = {
    "transfer": ["transfers.json", "transfer.json", "checkout_transfers.json",
                 "nmi_transfers.json", "omnex_transfers.json"],
    "user": ["users.json", "user.json"],
    "recipient": ["recipients.json"],
    "flag": ["transfer_flags.json", "flags.json"],
}


def _oid(c):
    return F.struct(F.col(c).cast("string").alias("$oid"))


def _date_ms(c):
    return F.struct(F.struct(F.unix_millis(F.col(c).cast("timestamp")).cast("string").alias("$numberLong"))
                    .alias("$date"))


def _date_iso(c):
    return F.struct(F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("$date"))


def transfer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per transfer (column ``json``)."""
    t = FX.transfers_o(spark, sf_dir)
    prio = F.substring("provider", 1, 1)
    key = F.col("_id")
    doc = F.struct(
        _oid("_id").alias("_id"),
        _oid("user_id").alias("user_id"),
        F.col("recipient_id").cast("string").alias("recipient_id"),
        _date_ms("txn_ts").alias("date"),
        "send_amount", "transfer_fee", "amount_paid",
        F.col("provider").alias("paymentProvider"),
        F.col("omnexpaymentid").alias("omnexPaymentId"), "payment_receipt_number", "transaction_id",
        "description_code", "sending_from",
        F.when(prio == "1", F.lit("mtn")).when(prio == "3", F.lit("   ")).alias("recipient_network"),
        F.col("isenabled3ds").alias("isEnabled3Ds"),
        "previous_recipient",
        F.struct(F.concat(F.lit("10.0."), (key % 250).cast("string"), F.lit("."), (key % 199).cast("string")).alias("ip"),
                 F.struct(F.col("ip_country").alias("country")).alias("location")).alias("ipDetails"),
        F.concat(F.lit("sender"), F.col("user_id").cast("string"), F.lit("@Mail.Example ")).alias("sender_email"),
        F.when(prio == "4", F.lit("hold")).alias("status"),
        F.when(F.col("description_code").isNull(), F.lit("review later")).alias("internalNote"),
        F.when(prio == "5", F.lit("x")).alias("partnerDebug"),
    )
    return t.select(F.to_json(doc).alias("json"))


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = FX.users(spark, sf_dir)
    k = F.col("user_id")
    doc = F.struct(
        _oid("user_id").alias("_id"), _date_iso("datecreated").alias("dateCreated"),
        "country", "billing_address",
        F.col("threshold_level").alias("threshold_level"),
        F.col("remainingbalance").alias("remainingBalance"),
        "email", F.concat(F.lit("9"), (k * 7919 % 100000000).cast("string")).alias("ssn"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("occ")).alias("occupation"))
    return u.select(F.to_json(doc).alias("json"))


def recipient_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = FX.recipients(spark, sf_dir)
    doc = F.struct(_oid("recipient_id").alias("_id"), _date_iso("date_created").alias("date_created"),
                   "bank_name",
                   F.concat(F.lit("r"), F.col("recipient_id").cast("string"), F.lit("@Bank.Example")).alias("recipient_email"))
    return r.select(F.to_json(doc).alias("json"))


def flag_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = FX.flags(spark, sf_dir)
    doc = F.struct(_oid("transfer").alias("transfer"), "action", _date_ms("flag_ts").alias("date"),
                   F.lit("system").alias("admin"))
    return f.select(F.to_json(doc).alias("json"))


BUILDERS = {"transfer": transfer_documents, "user": user_documents,
            "recipient": recipient_documents, "flag": flag_documents}


#: documents in a compressed file at most: such a file is read by one task
FILE_DOCUMENTS = 100_000


def export_lines(json_df: DataFrame, path: str) -> None:
    """Write document texts as compressed files of lines. The field names are
    the same in every document, so this is a fraction of the plain text."""
    json_df.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)


def parse_documents(json_df: DataFrame, col: str = "json") -> DataFrame:
    """JSON text -> one VARIANT column ``doc`` (bad JSON raises).

    The one-element explode is a projection barrier: without it the
    optimizer inlines ``parse_json`` into every field lookup of the contract
    projection and each document is parsed once per field.
    """
    return json_df.select(F.explode(F.array(F.parse_json(F.col(col)))).alias("doc"))


def read_documents(spark: SparkSession, paths: list[str] | str, limit_per_file: int | None = None) -> DataFrame:
    """Read NDJSON and JSON-array files into a VARIANT column ``doc``.

    Paths are files, folders or patterns on any file system, compressed or
    not; a path without a file raises. The shape is told per file, so a folder may hold both.
    ``//`` and ``/* */`` comments are tolerated and a malformed record fails
    the job. Array files are read in pieces that end behind a brace, brought
    back in order and cut into elements as they stream by: a task holds one
    document and a few pieces, however large the file is and wherever its line
    breaks are. ``limit_per_file`` caps documents per path (smoke runs),
    applied before the union.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise FileNotFoundError("no document files were given")
    frames = []
    for p in paths:
        files = data_files(spark, p)
        if not files:
            raise FileNotFoundError(f"no document files at {p}")
        shapes: dict[bool, list[str]] = {}
        with ThreadPoolExecutor(min(32, len(files))) as pool:
            for f, array in zip(files, pool.map(lambda f: _opens_array(spark, f), files), strict=True):
                shapes.setdefault(array, []).append(f)
        parts = []
        if lines := shapes.get(False):
            reader = spark.read.option("singleVariantColumn", "doc").option("allowComments", "true")
            parts.append(reader.option("mode", "FAILFAST").json(lines))
        if arrays := shapes.get(True):
            parts.append(parse_documents(_pieces(spark, arrays).mapInArrow(_elements, "json string")))
        df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        frames.append(df if limit_per_file is None else df.limit(int(limit_per_file)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _pieces(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, piece: the bytes between two closing braces. All pieces of a file
    are in one partition, in their order; Spark splits and sorts the files, so
    no task holds one."""
    read = spark.read.option("lineSep", "}").text(files)
    rows = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("nth"), F.col("value").cast("binary").alias("piece"))
    return (rows.repartition("file").sortWithinPartitions("file", "start", "nth").select("file", "piece"))


#: what can be passed over, whole strings included: inside an element, and between elements
_INSIDE = re.compile(r'(?:[^"{}\[\]/]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+', re.DOTALL)
_BETWEEN = re.compile(r'(?:[^"{}\[\]/,]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+', re.DOTALL)
_STRING_REST = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+', re.DOTALL)
_SPACE = " \t\r\n"


class _ArrayCutter:
    """Texts of the elements of one JSON array that arrives in pieces; each
    piece ends where the file has a closing brace, and after its last one."""

    def __init__(self) -> None:
        self.depth, self.inside, self.parts, self.found, self.first = 0, "", [], [], True
        self.closed = self.ended = False

    def _element(self, last: bool) -> None:
        text = "".join(self.parts).strip(_SPACE)
        self.parts = []
        if text or not (last and self.first):
            json.loads(text)  # anything but one value raises
            self.found.append(text)
        self.first = False

    def _between(self, text: str) -> None:
        if self.depth:
            self.parts.append(text)
        elif text.strip(_SPACE):
            raise ValueError(f"{text[:20]!r} is outside the array")

    def add(self, piece: bytes) -> list[str]:
        """The elements that end in this piece."""
        text = piece.decode("utf-8") + "}"
        at = 0
        while at < len(text):
            if self.inside == '"':
                end = _STRING_REST.match(text, at).end()
                if text[end:end + 1] == '"':
                    end, self.inside = end + 1, ""
                else:
                    end = len(text)
                self.parts.append(text[at:end])
                at = end
                continue
            if self.inside:
                end = text.find(self.inside, at)
                at = len(text) if end < 0 else end + len(self.inside)
                self.inside = self.inside if end < 0 else ""
                continue
            at = self._plain(text, at)
        out, self.found = self.found, []
        return out

    def _plain(self, text: str, at: int) -> int:
        """Reads on until a comment, a string beyond this piece or its end."""
        done = at
        while (place := (_INSIDE if self.depth > 1 else _BETWEEN).match(text, at).end()) < len(text):
            token, at = text[place], place + 1
            if token == "/":
                self._between(text[done:place])
                self.inside = {"//": "\n", "/*": "*/"}.get(text[place:place + 2], "")
                if not self.inside:
                    raise ValueError(f"{text[place:place + 20]!r} is neither a value nor a comment")
                self._between(" ")
                return place + 2
            if self.depth == 0:
                self._between(text[done:place])
                if token == "}" and self.closed and not self.ended and place == len(text) - 1:
                    self.ended = True  # put there by add
                    return len(text)
                if token != "[" or self.closed:
                    raise ValueError(f"{text[place:place + 20]!r} is outside the array")
                self.depth, done = 1, place + 1
            elif token == '"':
                self.parts.append(text[done:])
                self.inside = '"'
                return len(text)
            elif token in "{[":
                self.depth += 1
            elif self.depth > 1:
                self.depth -= token in "}]"
            elif token in ",]":
                self.parts.append(text[done:place])
                self._element(token == "]")
                done = place + 1
                if token == "]":
                    self.depth, self.closed = 0, True
        self._between(text[done:])
        return len(text)

    def finish(self) -> None:
        if not self.closed or self.inside == "*/":
            raise ValueError("the array is not closed")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files that hold one JSON array each, piece by piece in their order, to
    the texts of their elements."""
    file, cutter, found, size = None, None, [], 0
    for batch in batches:
        for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != file:
                if cutter is not None:
                    cutter.finish()
                file, cutter = name, _ArrayCutter()
                piece = piece.removeprefix(b"\xef\xbb\xbf")
            for text in cutter.add(piece):
                found.append(text)
                size += len(text)
                if len(found) >= 1000 or size >= 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["json"])
                    found, size = [], 0
    if cutter is not None:
        cutter.finish()
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["json"])


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files at a path or pattern, folders below it included, on any
    Hadoop file system, sorted. Names that begin with a dot or an underscore
    (and folders so named) are no data."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: list[str] = []
    for top in fs.globStatus(where) or []:
        todo = [top]
        while todo:
            s = todo.pop()
            if s is not top and s.getPath().getName().startswith((".", "_")):
                continue
            if s.isDirectory():
                todo += fs.listStatus(s.getPath())
            elif s.getLen():
                found.append(s.getPath().toString())
    return sorted(found)


#: bytes of a file that are read at a time to see its first character
PEEK = 65_536


def _opens_array(spark: SparkSession, file: str) -> bool:
    """Whether the first thing in a file, comments aside, is a bracket; reads
    no more than it needs, wherever the line breaks are."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(file)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(where)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(where)
    stream = stream if codec is None else codec.createInputStream(stream)
    try:
        head = b""
        while more := bytes(stream.readNBytes(PEEK)):
            head = (head + more).lstrip(b"\xef\xbb\xbf \t\r\n")
            while head.startswith((b"//", b"/*")):
                end = b"\n" if head.startswith(b"//") else b"*/"
                at = head.find(end, 2)
                if at < 0:
                    head = head[:2] + head[-1:]  # a comment's inside is not kept
                    break
                head = head[at + len(end):].lstrip(b" \t\r\n")
            if head and not head.startswith((b"//", b"/*")) and head != b"/":
                return head.startswith(b"[")
        return False
    finally:
        stream.close()


def collection_paths(spark: SparkSession, data_dir: str, doc_type: str) -> list[str]:
    """Existing export files for one collection, in the fixed order; raises
    when there is none, so a missing export is never an empty collection."""
    from tallyhawk.sources.tables import path_exists
    named = [f"{data_dir.rstrip('/')}/{n}" for n in LOCAL_COLLECTIONS.get(doc_type, [])]
    found = [p for p in named if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"no export of {doc_type!r} in {data_dir}; looked for {named}")
    return found
