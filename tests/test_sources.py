from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from trialguard.sources import raw as R

DM_HEADER = "SUBJID,SITEID,AGE,SEX,RACE,ARMCD,ARM,TRTSDT,TRTEDT"
DM_ROWS = ["101-0001,101,40,M,WHITE,PBO,Placebo,2025-01-01,2025-03-25", "101-0002,101,50,F,ASIAN,DRGA50,Drug A 50 mg,2025-01-01,2025-03-25"]


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_lower_case_header_and_text_values(spark, tmp_path):
    p = write(tmp_path / "dm.csv", DM_HEADER.lower() + "\n" + "\n".join(DM_ROWS) + "\n")
    df = R.read_raw(spark, p, "dm")
    assert "SUBJID" in df.columns and df.count() == 2
    assert dict(df.dtypes)["AGE"] == "string"


def test_semicolon_and_latin1(spark, tmp_path):
    rows = [r.replace(",", ";") for r in DM_ROWS] + ["101-0003;101;60;M;José;PBO;Placebo;2025-01-01;2025-03-25"]
    p = write(tmp_path / "dm.csv", DM_HEADER.replace(",", ";") + "\n" + "\n".join(rows) + "\n", "latin-1")
    df = R.read_raw(spark, p, "dm")
    assert df.count() == 3 and "José" in {r["RACE"] for r in df.collect()}


def test_utf8_bom_and_value_normalisation(spark, tmp_path):
    rows = DM_ROWS + ["  101-0003 ,101,nan,None,<NA>,PBO,Placebo,NaT,2025-03-25"]
    p = write(tmp_path / "dm.csv", "﻿" + DM_HEADER + "\n" + "\n".join(rows) + "\n")
    df = R.read_raw(spark, p, "dm")
    row = [r for r in df.collect() if r["SUBJID"] == "101-0003"][0]
    assert (row["AGE"], row["SEX"], row["RACE"], row["TRTSDT"]) == ("", "", "", "")
    assert "SUBJID" in df.columns


def test_parquet_is_read_as_text(spark, tmp_path):
    t = pa.table({"subjid": ["1", None], "AGE": [30, None], "SITEID": ["1", "1"], "SEX": ["M", "F"], "RACE": ["A", "B"],
                  "ARMCD": ["PBO", "PBO"], "ARM": ["P", "P"], "TRTSDT": ["2025-01-01"] * 2, "TRTEDT": ["2025-01-02"] * 2})
    pq.write_table(t, tmp_path / "dm.parquet")
    df = R.read_raw(spark, str(tmp_path / "dm.parquet"), "dm")
    vals = {(r["SUBJID"], r["AGE"]) for r in df.collect()}
    assert vals == {("1", "30"), ("", "")}
    assert df.select("RECNO").distinct().count() == 2


@pytest.mark.parametrize(
    ("content", "match"),
    [
        (b"", "empty"),
        (b"\x00\x01\x02 not a table", "missing required"),
        (b"SUBJID,AGE\n1,30\n", "missing required"),
        ((DM_HEADER + "\n").encode(), "no subjects"),
        ((DM_HEADER + "\n" + DM_ROWS[0] + ",extra\n").encode(), "could not be parsed"),
        ((DM_HEADER + ",subjid\n" + DM_ROWS[0] + ",1\n").encode(), "duplicate column"),
    ],
)
def test_file_level_errors(spark, tmp_path, content, match):
    (tmp_path / "dm.csv").write_bytes(content)
    with pytest.raises(R.InputError, match=match):
        R.read_raw(spark, str(tmp_path / "dm.csv"), "dm")


def test_not_found_and_unparseable_parquet(spark, tmp_path):
    with pytest.raises(R.InputError, match="not found"):
        R.read_raw(spark, str(tmp_path / "missing.csv"), "dm")
    (tmp_path / "x.parquet").write_bytes(b"not parquet")
    with pytest.raises(R.InputError, match="could not be parsed"):
        R.read_raw(spark, str(tmp_path / "x.parquet"), "dm")


def test_discovery_and_digest(spark, tmp_path):
    write(tmp_path / "dm.csv", DM_HEADER + "\n" + DM_ROWS[0] + "\n")
    assert R.discover(spark, str(tmp_path), "dm").endswith("/dm.csv")
    write(tmp_path / "dm_raw.csv", DM_HEADER + "\n" + DM_ROWS[0] + "\n")
    assert R.discover(spark, str(tmp_path), "dm").endswith("/dm_raw.csv")
    assert R.discover(spark, str(tmp_path), "lb") is None


def test_quotes_short_rows_and_line_breaks(spark, tmp_path):
    rows = [
        '101-0001,101,40,M,WHITE,DRGA50,"Drug ""A"", 50 mg",2025-01-01,2025-03-25',
        "101-0002,101,50,F,ASIAN,PBO,Placebo,2025-01-01",
        "101-0003,101,50,F,ASIAN,PBO,Placebo,2025-01-01,2025-03-25,",
    ]
    p = write(tmp_path / "dm.csv", DM_HEADER + "\n" + "\n".join(rows) + "\n")
    got = {r["SUBJID"]: r for r in R.read_raw(spark, p, "dm").collect()}
    assert got["101-0001"]["ARM"] == 'Drug "A", 50 mg' and got["101-0002"]["TRTEDT"] == "" and len(got) == 3
    broken = '101-0004,101,40,M,"WH\nITE",PBO,Placebo,2025-01-01,2025-03-25'
    p = write(tmp_path / "dm2.csv", DM_HEADER + "\n" + "\n".join([*rows, broken]) + "\n")
    got = {r["SUBJID"]: r for r in R.read_raw(spark, p, "dm", multi_line=True).collect()}
    assert got["101-0004"]["RACE"] == "WH\nITE" and len(got) == 4


def test_input_order_of_many_files(spark, tmp_path):
    """The first file's copy of a subject comes first, however large the files are."""
    from trialguard.operators import cleaning

    folder = tmp_path / "dm_raw.csv"
    folder.mkdir()
    copy = "7,101,{},M,WHITE,PBO,Placebo,2025-01-01,2025-03-25"
    write(folder / "part-0.csv", DM_HEADER + "\n" + copy.format(40) + "\n")
    many = "\n".join(f"{k},101,50,F,ASIAN,PBO,Placebo,2025-01-01,2025-03-25" for k in range(1000, 9000))
    write(folder / "part-1.csv", DM_HEADER + "\n" + many + "\n" + copy.format(77) + "\n")
    clean, quarantine, _ = cleaning.clean_dm(R.read_raw(spark, str(folder), "dm"))
    assert clean.where("SUBJID = '7'").first()["AGE"] == 40 and quarantine.where("SUBJID = '7'").first()["AGE"] == "77"


def test_delimiter_detection():
    assert R.detect_delimiter("A;B;C") == ";" and R.detect_delimiter("A\tB") == "\t" and R.detect_delimiter("A") == ","


@pytest.mark.parametrize(
    ("line", "rejected"),
    [
        ("1,2,3,4,5,6,7,8,9", False), ("1,2", False), ("1,2,3,4,5,6,7,8,9,,,,,,,", False), ("1,2,3,4,5,6,7,8,9, , ", False),
        ("1,2,3,4,5,6,7,8,9,x", True), ("1,2,3,4,5,6,7,8,9,,,,,x", True), ("1,2,3,4,5,6,7,8,9" + "," * 40 + "x", True),
        ('1,2,3,4,"a,b,c,d,e,f,g",6,7,8,9', False), ('1,2,3,4,"a ""q"", b",6,7,8,9,,"z"', True), ('"a,b","c,d,e,f,g,h,i,j,k"', False),
    ],
)
def test_a_value_beyond_the_header_rejects_the_file(spark, tmp_path, line, rejected):
    path = tmp_path / "dm_raw.csv"
    path.write_text("SUBJID,SITEID,AGE,SEX,RACE,ARMCD,ARM,TRTSDT,TRTEDT\na,1,40,M,ASIAN,PBO,Placebo,2025-01-01,2025-01-02\n" + line + "\n")
    if rejected:
        with pytest.raises(R.InputError, match="more fields than the header"):
            R.read_raw(spark, str(path), "dm")
    else:
        assert R.read_raw(spark, str(path), "dm").count() == 2
