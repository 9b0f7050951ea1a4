"""Each file in its own encoding, found by what its bytes can mean."""

import pytest

from recall_lens.plans.ingest import ingest
from recall_lens.sources.delimited import DelimitedFeed, read_feeds, read_text
from recall_lens.sources.encodings import layouts, probe, single_byte
from recall_lens.sources.scores import read_snapshot

NAMES = {"a.txt": ("utf-8", "Zürich 日本"), "b.txt": ("cp1252", "œuvre “x” €5"), "c.txt": ("latin1", "Zürich \x81é"), "d.txt": ("utf-8", "plain")}


def write(folder, name, encoding, text, mark=b""):
    (folder / name).write_bytes(mark + f"KNUMBER|DEVICENAME\nK-{name}|{text}\n".encode(encoding))


def encodings_of(spark, path, *given):
    return {r.path.rsplit("/", 1)[1]: r.encoding for r in probe(spark, str(path), *given).collect()}


def test_first_encoding_that_fits_every_line(spark, tmp_path):
    for name, (encoding, text) in NAMES.items():
        write(tmp_path, name, encoding, text)
    assert encodings_of(spark, tmp_path, ("utf-8", "cp1252", "latin1", "utf-16")) == {n: e for n, (e, _) in NAMES.items()}
    assert encodings_of(spark, tmp_path, ("latin1", "utf-8")) == dict.fromkeys(NAMES, "latin1")
    feed = DelimitedFeed("premarket_510k", f"{tmp_path}/*.txt", encoding=("utf-8", "cp1252", "latin1"))
    assert {r.DEVICENAME for r in read_text(spark, feed).collect()} == {text for _, text in NAMES.values()}


def test_a_late_line_decides(spark, tmp_path):
    lines = ["KNUMBER|DEVICENAME", *[f"K{i}|name {i}" for i in range(5000)]]
    (tmp_path / "late.txt").write_bytes("\n".join(lines).encode() + b"\nK|caf\xe9\n")
    (tmp_path / "never.txt").write_bytes("\n".join(lines).encode() + b"\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert encodings_of(spark, tmp_path, ("utf-8", "cp1252")) == {"late.txt": "cp1252", "never.txt": "utf-8"}
        found = layouts(spark, str(tmp_path), ("utf-8", "cp1252"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {layout.header for layout in found} == {b"KNUMBER|DEVICENAME"}


def test_nothing_fits(spark, tmp_path):
    write(tmp_path, "x.txt", "latin1", "a\x81\xe9b")
    assert encodings_of(spark, tmp_path, ("utf-8", "cp1252")) == {"x.txt": "utf-8"}
    feed = DelimitedFeed("premarket_510k", str(tmp_path), encoding=("utf-8", "cp1252"))
    assert [r.DEVICENAME for r in read_text(spark, feed).collect()] == ["a��b"]


def test_marks_headers_and_names_with_blanks(spark, tmp_path):
    write(tmp_path, "with mark %20 +.txt", "utf-8", "é", b"\xef\xbb\xbf")
    (tmp_path / "other order.txt").write_bytes("DEVICENAME|KNUMBER|Größe\nœ|K2|1\n".encode("cp1252"))
    (tmp_path / "empty.txt").write_bytes(b"")
    rows = read_text(spark, DelimitedFeed("premarket_510k", str(tmp_path), encoding=("utf-8", "cp1252")))
    assert set(rows.columns) == {"KNUMBER", "DEVICENAME", "Größe"}
    assert {(r.KNUMBER, r.DEVICENAME, r["Größe"]) for r in rows.collect()} == {("K-with mark %20 +.txt", "é", None), ("K2", "œ", "1")}


def test_surplus_rows_and_quotes_of_found_encodings(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes('KNUMBER|DEVICENAME|PRODUCTCODE\nK1|"a|“b”"|P\nK2|x|P|œ\n'.encode("cp1252"))
    feed = DelimitedFeed("premarket_510k", str(tmp_path / "a.txt"), encoding=("utf-8", "cp1252"))
    assert [r.DEVICENAME for r in read_feeds(spark, [feed])["premarket_510k"].collect()] == ["a|“b”"]
    target = str(tmp_path / "tables")
    ingest(spark, [feed], None, target)
    assert [r[0] for r in spark.read.parquet(f"{target}/quarantine/premarket_510k").collect()] == ["K2|x|P|œ"]


def test_snapshots_in_any_usual_encoding(spark, tmp_path):
    for encoding in ("utf-8-sig", "cp1252"):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("PMA_PMN_NUM,rpss,device_name\nK1,0.5,Gerät €\n".encode(encoding))
        row = read_snapshot(spark, str(path)).first()
        assert (row.PMA_PMN_NUM, row.rpss, row.device_name) == ("K1", 0.5, "Gerät €")


@pytest.mark.parametrize("name", ["cp1252", "latin1", "cp1250", "iso8859-15", "koi8-r", "ascii"])
def test_tables_agree_with_the_codec(name):
    table = single_byte(name)
    for value in range(256):
        try:
            meant = bytes([value]).decode(name)
        except UnicodeDecodeError:
            assert chr(value) in table.undefined
        else:
            assert table.decode(chr(value)) == meant


@pytest.mark.parametrize("name", ["utf-16", "gbk", "shift_jis", "cp037", "utf-7"])
def test_other_encodings_are_refused(name):
    with pytest.raises(ValueError):
        single_byte(name)
