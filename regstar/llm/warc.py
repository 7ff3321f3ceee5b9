"""WARC archives: writing, normalising whole-file gzip streams, and reading back.

``write_archives`` lets Spark's text writer make monolithic archives: each
task's records, one after the other, in one gzip stream. Such a file has to be
inflated from its start to reach any record. ``normalise`` inflates each
stream once, record by record, gives every record its own gzip member, and
makes a sidecar index of archive, offset and length from what it wrote. ``read_archives`` reads
normalised archives.

All files are read and written by Spark's own text source, so any file system
that Spark reaches will do. Bytes pass it unchanged: a row is the bytes between
two separators. A monolithic archive's separator is CRLF, which ends the record
as the format asks for. A normalised archive's separator is ``EMPTY_MEMBER``, a
gzip member of no bytes: concatenated members are one gzip file, so a plain
reader sees the same stream as before.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from regstar.llm.common import ship, small_side, stage, text_of
from regstar.session import scratch_path
from regstar.sources.tables import read_table

CRLF = b"\r\n"
#: Payloads of fewer bytes are stored again rather than referred to.
REVISIT_BYTES = 0
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS, BASE32_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are 4 digits to the base 32."""
    digest = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), BASE32_DIGITS, BASE32_ALPHABET)


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One row per page: the text of its WARC record without the last CRLF.

    Of the pages with one payload the smallest id is the response. Only digests
    that occur more than once are joined back: by broadcast if they are few,
    else by a shuffle that AQE may split when one payload is very common.
    """
    p = pages.select(F.col("page_id"), F.col("url"), text_of("html").alias("payload")).withColumns(
        {"payload_digest": sha1_base32(F.encode("payload", "UTF-8")), "payload_bytes": F.octet_length("payload").cast("long")})
    firsts = (p.filter(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter((F.col("n") > 1) & F.col("first_id").isNotNull()).drop("n"))
    p = p.join(small_side(stage(firsts, "repeated-payloads")), "payload_digest", "left").withColumn(
        "revisit", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", " ")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"), F.lit(">"))),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(F.col("revisit"), "0").otherwise(F.col("payload_bytes").cast("string"))))
    body = F.when(F.col("revisit"), "").otherwise(F.col("payload"))
    return p.select(F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n")).alias("value"))


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Monolithic archives under ``path``: a gzip stream for each task's records."""
    records(pages, revisit_bytes).write.mode("overwrite").option("compression", "gzip").option("lineSep", "\r\n").text(path)


RECORD = pa.schema([
    ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("block", pa.binary())])


def parse_record(data: bytes) -> dict:
    """Header fields and block of one whole record."""
    head, _, rest = data.partition(CRLF + CRLF)
    fields = {}
    for line in head.split(CRLF)[1:]:
        name, _, value = line.decode("utf-8").partition(":")
        fields[name.strip().lower()] = value.strip()
    urn = lambda k: fields.get(k, "").removeprefix("<urn:page:").removesuffix(">") or None
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block):] != CRLF + CRLF:
        raise ValueError(f"record {fields.get('warc-record-id')} does not have its stated length")
    return {"warc_type": fields.get("warc-type"), "record_id": urn("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
            "refers_to": urn("warc-refers-to"), "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "declared_bytes": int(fields["warc-payload-length"]) if "warc-payload-length" in fields else None, "block": block}


def records_of_lines(lines: Iterator[tuple[tuple, bytes]]) -> Iterator[tuple[tuple, bytes]]:
    """(archive, whole record) from the CRLF-separated pieces of inflated streams, in order.

    Holds one record at a time. The block is counted in bytes, so separators
    inside it are part of it.
    """
    held: list[bytes] = []
    archive, body_left = None, None
    for name, line in lines:
        if name != archive:
            if held:
                raise ValueError(f"{archive} ends inside a record")
            archive, held, body_left = name, [], None
        held.append(line)
        if body_left is None:
            if line:
                continue
            length = [x for x in held if x.lower().startswith(b"content-length:")]
            if not length:
                raise ValueError(f"{archive}: a record without Content-Length")
            body_left = int(length[0].split(b":")[1])
            held_body = -2  # the first piece of the block has no separator before it
            continue
        held_body += 2 + len(line)
        if held_body == body_left + 2 and not line:
            yield archive, CRLF.join(held) + CRLF
            held, body_left = [], None
        elif held_body > body_left + 2:
            raise ValueError(f"{archive}: a record longer than its Content-Length")
    if held:
        raise ValueError(f"{archive} ends inside a record")


MEMBER = pa.schema([("archive", pa.int64()), ("seq", pa.int64()), ("member", pa.binary())])
MEMBERS = "archive long, seq long, member binary"
#: Bytes of members that are handed to Spark at once.
BATCH_BYTES = 8 << 20


def _members():
    """The members of inflated streams, in order."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), MEMBER, strict=True)], schema=MEMBER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines():
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)

        rows: list[tuple] = []
        size, archive, seq = 0, None, 0
        for name, data in records_of_lines(lines()):
            if name != archive:
                archive, seq = name, 0
            member = gzip.compress(data, compresslevel=6, mtime=0)
            rows.append((archive, seq, member))
            seq, size = seq + 1, size + len(member)
            if size >= BATCH_BYTES or len(rows) >= 10_000:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    return run


PLACE = pa.schema([("archive", pa.int64()), ("block", pa.int64()), ("seq", pa.int64()), ("local", pa.int64()), ("length", pa.int64()),
                   ("record_id", pa.string()), ("warc_type", pa.string())])
PLACES = "archive long, block long, seq long, local long, length long, record_id string, warc_type string"


def whole_members(pieces: Iterator[tuple[object, bytes]]) -> Iterator[tuple[object, bytes, bytes]]:
    """(split, member, record) of the pieces between separators: a member may hold a separator's bytes itself."""
    split, held = None, b""
    for name, piece in pieces:
        if name != split and held:
            raise ValueError("an archive ends inside a member")
        split, held = name, held + piece
        d = zlib.decompressobj(31)
        data = d.decompress(held)
        if not d.eof:
            held += EMPTY_MEMBER
            continue
        yield split, held, data
        held = b""
    if held:
        raise ValueError("an archive ends inside a member")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each member of the written archives is, counted within the split that is read."""
    def pieces():
        for b in batches:
            yield from zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True), b.column(2).to_pylist(), strict=True)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PLACE, strict=True)], schema=PLACE)

    rows, split, seq, local = [], None, 0, 0
    for name, member, data in whole_members(pieces()):
        if name != split:
            split, seq, local = name, 0, 0
        r = parse_record(data)
        rows.append((*split, seq, local, len(member), r["record_id"], r["warc_type"]))
        seq, local = seq + 1, local + len(member) + len(EMPTY_MEMBER)
        if len(rows) >= 10_000:
            yield batch()
            rows = []
    if rows:
        yield batch()


def _written(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of normalised archives between separators, in order."""
    return spark.read.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites the monolithic archives under ``source`` as ``target/archive=<number>/part-*``.

    Returns the sidecar index (archive, source, seq, offset, length, record_id,
    warc_type), which is stored as Parquet in ``target-index``; ``source`` is
    the name of the monolithic file. A gzip stream cannot be split, so a task
    inflates whole archives, once, but it holds one record at a time, and the task
    that inflates an archive also writes it: nothing is shuffled. The index is
    made from the archives as they were written: places are counted within each
    split that is read, and the lengths of the splits before it are added. A
    broken archive raises.
    """
    ship(spark)
    lines = spark.read.option("lineSep", "\r\n").text(source).select(F.xxhash64("_metadata.file_name").alias("archive"), F.col("value").cast("binary").alias("line"))
    (lines.mapInArrow(_members(), MEMBERS).select("archive", "seq", F.col("member").cast("string").alias("value"))
     .sortWithinPartitions("archive", "seq").select("archive", "value").write.mode("overwrite").partitionBy("archive")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(target))
    names = spark.read.format("binaryFile").load(source).select(F.element_at(F.split("path", "/"), -1).alias("source"))
    written = _written(spark, target)
    if "archive" not in written.columns:  # no archive was written
        empty = "archive long, source string, seq long, offset long, length long, record_id string, warc_type string"
        spark.createDataFrame([], empty).write.mode("overwrite").parquet(f"{target}-index")
        return spark.read.schema(empty).parquet(f"{target}-index")
    pieces = written.select(F.col("archive").cast("long").alias("archive"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary"))
    places = stage(pieces.mapInArrow(_places, PLACES), "places")
    earlier = Window.partitionBy("archive").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = places.groupBy("archive", "block").agg(F.sum(F.col("length") + len(EMPTY_MEMBER)).alias("size"), F.count(F.lit(1)).alias("n")).select(
        "archive", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("seq_before"))
    (places.join(splits, ["archive", "block"]).join(names.withColumn("archive", F.xxhash64("source")), "archive")
     .select("archive", "source", (F.col("seq") + F.col("seq_before")).alias("seq"), (F.col("local") + F.col("before")).alias("offset"), "length",
             "record_id", "warc_type").write.mode("overwrite").parquet(f"{target}-index"))
    return spark.read.parquet(f"{target}-index")


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _in_batches(parse_record(data) for _, _, data in whole_members((None, p) for b in batches for p in b.column(0).to_pylist())):
        yield pa.RecordBatch.from_pylist(b, schema=RECORD)


def _in_batches(rows: Iterator[dict]) -> Iterator[list[dict]]:
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += len(r["block"])
        if size >= BATCH_BYTES or len(out) >= 10_000:
            yield out
            out, size = [], 0
    if out:
        yield out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of normalised archives, with the digest and length of the blocks read."""
    ship(spark)
    members = _written(spark, path).select(F.col("value").cast("binary").alias("member"))
    found = members.mapInArrow(_read_members, "warc_type string, record_id string, target_uri string, refers_to string,"
                               " declared_digest string, declared_bytes long, block binary")
    return found.withColumns({"block_digest": sha1_base32(F.col("block")), "block_bytes": F.octet_length("block").cast("long")})


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to monolithic archives, normalised, read back: the contract's row per page.

    Repeated rows of the smallest page_id are all responses; a NULL page_id
    revisits the smallest one that is known; NULL html is the empty payload. A
    response whose block does not have its stated digest makes the query fail.
    """
    pages = read_table(spark, sf_dir, "pages")
    raw, normal = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    write_archives(pages, raw)
    normalise(spark, raw, normal)
    r = read_archives(spark, normal)
    response = F.col("warc_type") == "response"
    same = (F.col("block_digest") == F.col("declared_digest")) & (F.col("block_bytes") == F.col("declared_bytes"))
    digest = F.when(response & ~same, F.raise_error(F.concat(F.lit("payload differs in record "), F.col("record_id")))
                    ).otherwise(F.col("declared_digest"))
    return r.select(F.col("record_id").cast("long").alias("page_id"), F.col("declared_bytes").alias("payload_bytes"),
                    digest.alias("payload_digest"), F.col("warc_type").alias("record_type"),
                    F.col("refers_to").cast("long").alias("refers_to"))


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, upper(sha1(html)) AS h FROM p),
x AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((
      (instr('0123456789ABCDEF', substr(h, CAST(5 * (i // 4) + 1 AS INT), 1)) - 1) * 65536 + (instr('0123456789ABCDEF', substr(h, CAST(5 * (i // 4) + 2 AS INT), 1)) - 1) * 4096
      + (instr('0123456789ABCDEF', substr(h, CAST(5 * (i // 4) + 3 AS INT), 1)) - 1) * 256 + (instr('0123456789ABCDEF', substr(h, CAST(5 * (i // 4) + 4 AS INT), 1)) - 1) * 16
      + (instr('0123456789ABCDEF', substr(h, CAST(5 * (i // 4) + 5 AS INT), 1)) - 1)) >> (15 - 5 * CAST(i % 4 AS INT))) & 31 AS INT), 1)), '') AS payload_digest
  FROM d),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM x GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM x JOIN f USING (payload_digest)
"""
