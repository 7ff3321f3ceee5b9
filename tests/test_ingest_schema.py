"""Kept schemas, malformed lines, long files, native streams, counts of a stream."""

import os

import pytest

from regstar.domain import registrations as R
from regstar.operators.quality import StreamCounts, expect_on_stream
from regstar.session import scratch_path
from regstar.sources import csv_ingest as C
from regstar.streaming.ingest import ingest_known, ingest_stream, kept_schema, read_evolved


def write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_new_columns_are_kept_from_their_first_file_on(spark, tmp_path):
    src = str(tmp_path)
    out, ckpt, schema = (scratch_path(spark, n) for n in ("o", "c", "s"))
    write(src, "a.csv", "RegNo,fuel\nA1,CNG\n")
    ingest_stream(spark, src, out, ckpt, schema_path=schema)
    assert kept_schema(spark, schema) == R.GOLDEN_COLUMNS
    write(src, "b.csv", "Note ,RegNo,,fuel\nn1,A2,x,LPG\n")
    ingest_stream(spark, src, out, ckpt, schema_path=schema)
    assert kept_schema(spark, schema) == [*R.GOLDEN_COLUMNS, "note", "_c2"]
    write(src, "c.csv", "RegNo,NOTE,modeldesc_\nA3,n3,m\n")
    ingest_stream(spark, src, out, ckpt, schema_path=schema)
    names = kept_schema(spark, schema)
    ingest_stream(spark, src, out, ckpt, schema_path=schema)  # nothing new
    assert kept_schema(spark, schema) == names == [*R.GOLDEN_COLUMNS, "note", "_c2", "modeldesc_"]
    got = sorted((r.tempRegistrationNumber, r.fuel, r.note, r["_c2"], r["modeldesc_"]) for r in read_evolved(spark, out, schema).collect())
    assert got == [("A1", "CNG", None, None, None), ("A2", "LPG", "n1", "x", None), ("A3", None, "n3", None, "m")]
    assert sorted(os.listdir(schema.removeprefix("file:"))) == [f"version-{k:012d}" for k in range(3)]


def test_extra_names_do_not_clash_with_golden_ones():
    names = ["FUEL", "office cd", "seatcapacity ", "", "Office CD", "slno"]
    got = C.extra_columns(names, {"fuel": "fuel"}, ["fuel", "SeatCapacity", "slno"])
    assert got == {"office cd": "office cd", "seatcapacity": "seatcapacity_extra", "_c3": "_c3", "slno": "slno_extra"}


def test_malformed_lines_are_kept_with_their_file(spark, tmp_path):
    write(str(tmp_path), "a b.csv", 'RegNo,fuel\nA1,CNG\nA2\nA3,LPG,more\nA4,"x,y"\n')
    write(str(tmp_path), "c.csv", "fuel,RegNo,z\nEV,A5,\nEV,A6\n")
    rows = C.ingest_csv(spark, str(tmp_path), malformed=True)
    got = sorted((r.tempRegistrationNumber, r.fuel, r["_malformed"], r["_source_file"].rsplit("/", 1)[1]) for r in rows.collect())
    assert got == [("A1", "CNG", None, "a%20b.csv"), ("A2", None, "A2", "a%20b.csv"), ("A3", "LPG", "A3,LPG,more", "a%20b.csv"),
                   ("A4", "x,y", None, "a%20b.csv"), ("A5", "EV", None, "c.csv"), ("A6", "EV", "EV,A6", "c.csv")]
    few = rows.filter("_malformed is not null").select("fuel")
    assert sorted(str(r.fuel) for r in few.collect()) == ["EV", "LPG", "None"]  # also when little is selected


def test_a_long_file_is_left_after_its_header(spark, tmp_path, monkeypatch):
    write(str(tmp_path), "long.csv", "RegNo,fuel\n" + "A1,CNG\n" * 200_000)
    write(str(tmp_path), "short.csv", "RegNo\nA2\n")
    monkeypatch.setattr(C, "_headers_of", lambda alone, real=C._headers_of: real(alone, 2))
    found = {r.path.rsplit("/", 1)[1]: (r.header, r.problem) for r in C.file_headers(spark, [str(tmp_path)]).collect()}
    assert found == {"long.csv": ("RegNo,fuel", None), "short.csv": ("RegNo", None)}
    assert C.ingest_csv(spark, str(tmp_path)).count() == 200_001


def test_headers_of_files_that_share_a_task():
    import pyarrow as pa
    rows = [("a", ""), ("a", "x,y"), ("a", "1,2"), ("b", '"p'), ("b", 'q",r'), ("c", " "), ("d", "z"), ("e", '"')]
    batches = [pa.RecordBatch.from_pylist([{"p": p, "l": x} for p, x in rows[i:i + 3]]) for i in range(0, len(rows), 3)]
    got = [tuple(r.values()) for b in C._headers_of(False)(iter(batches)) for r in b.to_pylist()]
    assert got == [("a", "x,y", None), ("b", '"p\nq",r', None), ("c", None, "no header in a file that is not empty"),
                   ("d", "z", None), ("e", None, "a quote in the header is never closed")]


def test_known_headers_stream_equals_the_batch_read(spark, tmp_path):
    for i, text in enumerate(("RegNo,fuel,FUEL\nA1,,CNG\nA2,EV,\n", "color,regno\nred,A3\n")):
        os.makedirs(tmp_path / str(i))
        write(str(tmp_path / str(i)), "x.csv", text)
    out, ckpt = scratch_path(spark, "o"), scratch_path(spark, "c")
    headers = {str(tmp_path / "0"): "RegNo,fuel,FUEL", str(tmp_path / "1"): "color,regno"}
    ingest_known(spark, headers, out, ckpt)
    write(str(tmp_path / "1"), "y.csv", "color,regno\nblue,A4\n")
    ingest_known(spark, headers, out, ckpt)
    want = sorted(map(repr, C.ingest_csv(spark, str(tmp_path)).collect()))
    assert len(want) == 4 and sorted(map(repr, spark.read.parquet(out).select(*R.GOLDEN_COLUMNS).collect())) == want


def test_counts_of_a_stream(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), scratch_path(spark, "o"), scratch_path(spark, "c")
    spark.range(10).repartition(3).write.parquet(src)
    counts = StreamCounts("few")
    spark.streams.addListener(counts)
    try:
        kept = expect_on_stream(spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(src), {"small": "id < 7", "even": "id % 2 = 0"}, "few")
        kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
        assert counts.wait() == {"rows": 10, "failed_small": 3, "failed_even": 5}
    finally:
        spark.streams.removeListener(counts)
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(TimeoutError):
        StreamCounts("none").wait(0.01)
