"""Readers: CSV/TSV dialect traps, ragged rows, header drift, zipped exports, payloads, nanos."""

import io
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from feedloom.operators import audit, normalize
from feedloom.operators.layout import list_files
from feedloom.schemas import EVENT_FIELDS
from feedloom.sources.csv import read_csv_by_header, read_event_csv, read_event_tsv, read_text_csv
from feedloom.sources.files import newest_stamp, stamp_of
from feedloom.sources.parquet import read_parquet_nanos, read_table
from feedloom.sources.zipped import read_event_zips


def test_csv_doubled_quotes_commas_and_backslash(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text('a,b,c\r\n"x, y","say ""hi""","ends\\"\r\n1,,3\r\n')
    df = read_text_csv(spark, str(p), ["a", "b", "c"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", None, "3"), ("x, y", 'say "hi"', "ends\\")]


def _tsv_line(values):
    return "\t".join(values)


def test_tsv_quote_in_field_and_ragged_rows(spark, tmp_path):
    good = [str(i) for i in range(61)]
    good[6] = '"Quoted name'
    short = [str(i) for i in range(60)]
    long = [str(i) for i in range(62)]
    p = tmp_path / "20260916000000.export.CSV"
    p.write_text("\n".join(_tsv_line(x) for x in (good, short, long)) + "\n")
    df = read_event_tsv(spark, str(p), position=False).cache()
    assert df.count() == 3
    row = df.filter(F.col("GlobalEventID") == "0").filter(F.col("_corrupt_record").isNull()).first()
    assert row.Actor1Name == '"Quoted name' and row.SOURCEURL == "60"
    assert audit.ragged(df).count() == 2


def test_csv_files_with_different_headers_align_by_name(spark, tmp_path):
    d = tmp_path / "days"
    d.mkdir()
    (d / "2026-09-16.csv").write_text("GlobalEventID,AvgTone,DATEADDED\n1,2.5,20260916000000\n")
    (d / "2026-09-17.csv").write_text("DATEADDED,GlobalEventID\n20260917000000,2\n")
    df = read_csv_by_header(spark, str(d / "*.csv"))
    got = sorted((r.GlobalEventID, r.AvgTone, r.DATEADDED) for r in df.collect())
    assert got == [("1", "2.5", "20260916000000"), ("2", None, "20260917000000")]


def _zip_bytes(text: bytes) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("20260916001500.export.CSV", text)
    return buf.getvalue()


def test_zipped_exports_unzip_in_tasks(spark, tmp_path):
    row = [str(i) for i in range(61)]
    row[0] = "77"
    row[59] = "20260916001500"
    bad = "\t".join(row[:60]).encode()
    text = ("\t".join(row) + "\r\n").encode() + b"\n" + bad + b"\n" + ("\t".join(row).replace("1", "\xff", 0)).encode()
    text += b"\t\xff\n"
    (tmp_path / "20260916001500.export.CSV.zip").write_bytes(_zip_bytes(text))
    (tmp_path / "20260916003000.export.CSV.zip").write_bytes(_zip_bytes(b""))
    df = read_event_zips(spark, str(tmp_path)).cache()
    assert df.count() == 3
    assert df.filter(F.col("_nfields") != 61).count() == 2
    assert {r.stamp for r in df.collect()} == {"20260916001500"}
    assert df.filter(F.col("GlobalEventID") == "77").count() == 3


def test_lenient_casts_count_what_they_lose(spark):
    recs = [("1", "", "20260916000000", "20260916"), ("2", "abc", "20260916000000", "20260916"),
            ("3", "1.5", "20260916000000", "20260916"), ("4", "1e3", "20260916000000", "20260916"),
            ("5", " 12 ", "20260916000000", "20260916"), ("6", "nan", "2026-09-16", "20260916"),
            (None, "1", "20260916000000", "20260916")]
    raw = spark.createDataFrame(recs, "GlobalEventID string, NumMentions string, DATEADDED string, Day string")
    raw = raw.withColumn("AvgTone", F.col("NumMentions"))
    typed, rejects = normalize.events(raw)
    typed = typed.cache()
    got = {r.GlobalEventID: (r.NumMentions, r.AvgTone) for r in typed.collect()}
    assert got[1] == (None, None) and got[2] == (None, None) and got[3] == (2, 1.5)
    assert got[4] == (1000, 1000.0) and got[5] == (12, 12.0)
    assert rejects.count() == 2  # NULL id; malformed DATEADDED
    both = typed.join(raw.select(F.col("GlobalEventID").cast("bigint").alias("GlobalEventID"),
                                 F.col("NumMentions").alias("nm_raw"), F.col("AvgTone").alias("tone_raw")),
                      "GlobalEventID")
    loss = {r.column: r.lost for r in audit.cast_loss(both, {"NumMentions": "nm_raw", "AvgTone": "tone_raw"}).collect()}
    assert loss == {"NumMentions": 1, "AvgTone": 1}


def test_event_day_and_ingest_day_stay_apart(spark, tmp_path):
    p = tmp_path / "ingest_day=2026-09-17"
    p.mkdir()
    (p / "a.csv").write_text(",".join(EVENT_FIELDS) + "\n" + ",".join(
        ["9", "20260915"] + [""] * 57 + ["20260917000000", "http://x"]) + "\n")
    df = read_event_csv(spark, str(tmp_path), landed=False, basePath=str(tmp_path))
    typed, _ = normalize.events(df)
    r = typed.first()
    assert str(r.event_day) == "2026-09-15" and str(r.ingest_day) == "2026-09-17" and r.Day == 20260915


def test_nanosecond_parquet(spark, tmp_path):
    p = str(tmp_path / "ns.parquet")
    t = pa.table({"time": pa.array(pd.to_datetime(["2026-09-16T19:30:00.123456789"]), pa.timestamp("ns")),
                  "v": [1.0]})
    pq.write_table(t, p)
    df = read_parquet_nanos(spark, p, ["time"])
    assert df.schema["time"].dataType.simpleString() == "timestamp"
    assert str(df.first().time) == "2026-09-16 19:30:00.123456"


def test_listing_stamps_and_empty_folder(spark, tmp_path):
    for s in ("20260916000000", "20260916001500"):
        (tmp_path / f"{s}.export.CSV.zip").write_bytes(b"x")
    files = list_files(spark, str(tmp_path / "*.zip"), recursive=False)
    assert newest_stamp(files).first().stamp == "20260916001500"
    assert files.select(stamp_of("path").alias("s")).count() == 2
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_table(spark, str(empty), "a int").count() == 0


def test_unicode_line_separators_stay_inside_a_field(spark, tmp_path):
    row = [str(i) for i in range(61)]
    row[6] = "name with separator"
    text = ("\t".join(row) + "\n").encode("utf-8")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.CSV", text)
    (tmp_path / "20260916000000.export.CSV.zip").write_bytes(buf.getvalue())
    got = read_event_zips(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].Actor1Name == "name with separator" and got[0]._nfields == 61


def test_no_source_files_means_no_write(spark, tmp_path):
    from feedloom.operators.merge import compact_days, table_exists
    empty = spark.createDataFrame([], "id bigint, day date")
    rep = compact_days(spark, str(tmp_path / "t"), empty, "id", day_col="day")
    assert rep["rows_in"] == 0 and rep["partitions"] == 0 and not table_exists(spark, str(tmp_path / "t"))


def test_header_aligned_read_keeps_partition_columns(spark, tmp_path):
    for day, text in (("2026-09-16", "a,b\n1,2\n"), ("2026-09-17", "b,a\n3,4\n")):
        d = tmp_path / f"ingest_day={day}"
        d.mkdir()
        (d / "x.csv").write_text(text)
    df = read_csv_by_header(spark, str(tmp_path / "ingest_day=*" / "*.csv"), base_path=str(tmp_path))
    got = sorted((str(r.ingest_day), r.a, r.b) for r in df.collect())
    assert got == [("2026-09-16", "1", "2"), ("2026-09-17", "4", "3")]
