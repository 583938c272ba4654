import os

from flowguard.sources import csv_flows


def test_csv_micro(spark, tmpdir_path):
    utf = os.path.join(tmpdir_path, "Monday.csv")
    lat = os.path.join(tmpdir_path, "Tuesday.csv")
    with open(utf, "w", encoding="utf-8") as f:
        f.write(" Flow Duration, Fwd Header Length, Fwd Header Length, Label\n")
        f.write("1,2,3,BENIGN\n2,Infinity,4,DoS\n3,NaN,5,BENIGN\n")
    with open(lat, "wb") as f:
        f.write(b" Flow Duration, Label\n")
        f.write(b"4,Web Attack \x96 Brute Force\n")
    flows, log = csv_flows.load_flows(spark, [utf, lat, os.path.join(tmpdir_path, "missing.csv")])
    lg = {r["file"]: (r["rows"], r["encoding"], r["error"]) for r in log.collect()}
    assert lg["Monday.csv"] == (3, "utf-8", None)
    assert lg["Tuesday.csv"] == (1, "latin-1", None)
    assert lg["missing.csv"] == (0, "none", "FileNotFoundError")
    assert flows.columns == ["Flow Duration", "Fwd Header Length", "Fwd Header Length.1", "Label", "Day"]
    rows = flows.orderBy("`Flow Duration`").collect()
    assert rows[1]["Fwd Header Length"] == float("inf")
    assert rows[2]["Fwd Header Length"] is None          # NaN text -> missing
    assert rows[3]["Fwd Header Length"] is None and rows[3]["Day"] == "Tuesday.csv"
    assert rows[3]["Label"] == "Web Attack \u0096 Brute Force"


def test_folders_spaces_and_tokens(spark, tmpdir_path):
    day = os.path.join(tmpdir_path, "my day.csv")
    folder = os.path.join(tmpdir_path, "latin folder")
    empty = os.path.join(tmpdir_path, "empty.csv")
    os.mkdir(folder)
    with open(day, "wb") as f:
        f.write(b"a,b,c,t\n1,NA,true,caf\xe9\ninf,2,,x\n")
    with open(os.path.join(folder, "part-0.csv"), "wb") as f:
        f.write(b"b,t\n7,plain\n")
    with open(os.path.join(folder, "part-1.csv"), "wb") as f:
        f.write(b"b,t\n8,\xfcber\n")
    open(empty, "w").close()
    flows, log = csv_flows.load_flows(spark, [day, folder, empty])
    assert {tuple(r) for r in log.collect()} == {
        ("my day.csv", 2, "latin-1", None), ("latin folder", 2, "latin-1", None), ("empty.csv", 0, "none", "EmptyDataError")}
    assert dict(flows.dtypes) == {"a": "double", "b": "bigint", "c": "boolean", "t": "string", "Day": "string"}
    assert {tuple(r) for r in flows.collect()} == {
        (1.0, None, True, "café", "my day.csv"), (float("inf"), 2, None, "x", "my day.csv"),
        (None, 7, None, "plain", "latin folder"), (None, 8, None, "über", "latin folder")}


def test_only_missing_files(spark, tmpdir_path):
    flows, log = csv_flows.load_flows(spark, [os.path.join(tmpdir_path, "none.csv")])
    assert flows is None and [tuple(r) for r in log.collect()] == [("none.csv", 0, "none", "FileNotFoundError")]


def test_verified_write_keeps_partition_types(spark, tmpdir_path):
    from flowguard.sources import stage
    df = spark.createDataFrame([("001", 1), ("002", 2)], "Day string, n int")
    path = os.path.join(tmpdir_path, "t")
    assert tuple(stage.write_verified(df, path, ["Day"]).first())[1:] == (2, 2, True)
    import pytest
    with pytest.raises(FileNotFoundError, match="train"):
        stage.read_stage(spark, os.path.join(tmpdir_path, "gone"), "train")


def _write(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_malformed_files_are_logged_and_left_out(spark, tmpdir_path):
    bad = _write(tmpdir_path, "bad.csv", b"x,Label\n1,A\n2,B,EXTRA\n3,C,\n")
    good = _write(tmpdir_path, "good.csv", b"x,Label\n4,A\n5\n\n6,B\n")
    part = _write(tmpdir_path, "folder/part-0.csv", b"x,Label\n7,A\n")
    _write(tmpdir_path, "folder/part-1.csv", b"x,Label\n8,A,9\n")
    got = csv_flows.load_files(spark, [bad, good, os.path.dirname(part)])
    assert {tuple(r) for r in got.log.collect()} == {
        ("bad.csv", 0, "utf-8", "ParserError: 2 records of too many fields"), ("good.csv", 3, "utf-8", None),
        ("folder", 1, "utf-8", "ParserError: 1 records of too many fields in 1 of 2 files")}
    assert sorted(tuple(r) for r in got.flows.collect()) == [(4, "A", "good.csv"), (5, None, "good.csv"), (6, "B", "good.csv"), (7, "A", "folder")]
    assert {(r["path"].rsplit("/", 1)[1], r["too_long"], r["ok"]) for r in got.files.collect()} == {
        ("bad.csv", 2, False), ("good.csv", 0, True), ("part-0.csv", 0, True), ("part-1.csv", 1, False)}
    # counts do not depend on which columns are read
    assert got.flows.select("x").count() == 4 and got.flows.count() == 4


def test_quoted_separators_quotes_and_line_breaks(spark, tmpdir_path):
    one = _write(tmpdir_path, "q.csv", b'x,Label,note\n1,"A\nB","say ""hi"", ok"\n2,"a,b",plain\n3,"tail\r\n\n end",z\n')
    flat = _write(tmpdir_path, "flat.csv", b'x,Label,note\n4,"a,b","c""d"\n')
    worse = _write(tmpdir_path, "worse.csv", b'x,Label\n1,"A\nB"\n2,"C\nD",E\n3,"F\nG",\n4,"H\nI",,,J\n5\n')
    latin = _write(tmpdir_path, "latin.csv", b'x,Label\n9,"\xe9\n\xfc"\n')
    got = csv_flows.load_files(spark, [one, flat, worse, latin])
    log = {r["file"]: tuple(r)[1:] for r in got.log.collect()}
    assert log == {"q.csv": (3, "utf-8", None), "flat.csv": (1, "utf-8", None), "worse.csv": (0, "utf-8", "ParserError: 3 records of too many fields"),
                   "latin.csv": (1, "latin-1", None)}
    rows = {r["x"]: (r["Label"], r["note"]) for r in got.flows.collect()}
    assert dict(got.flows.dtypes)["x"] == "bigint"
    assert rows[1] == ("A\nB", 'say "hi", ok') and rows[2] == ("a,b", "plain") and rows[4] == ("a,b", 'c"d') and rows[9] == ("é\nü", None)
    assert rows[3][0].replace("\r\n", "\n") == "tail\n\n end"


def test_encodings_are_told_file_by_file_in_a_folder(spark, tmpdir_path):
    _write(tmpdir_path, "day/part-0.csv", "x,Label\n1,é\n".encode())
    _write(tmpdir_path, "day/part-1.csv", "x,Label\n2,é\n".encode("latin-1"))
    _write(tmpdir_path, "day/part-2.csv", "﻿x,Label\n3,日本\n".encode())
    got = csv_flows.load_files(spark, [os.path.join(tmpdir_path, "day")])
    assert {(r["x"], r["Label"]) for r in got.flows.collect()} == {(1, "é"), (2, "é"), (3, "日本")}
    assert {(r["path"][-5], r["encoding"]) for r in got.files.collect()} == {("0", "utf-8"), ("1", "latin-1"), ("2", "utf-8")}
    assert got.log.first()["encoding"] == "latin-1"


def test_types_by_file_widen(spark, tmpdir_path):
    a = _write(tmpdir_path, "a.csv", b"n,m,b,e,t\n1,1,true,,1\n2,NA,False,nan,2\n")
    b = _write(tmpdir_path, "b.csv", b"n,m,b,e,t\n1.50,2,TRUE,,007\n")
    c = _write(tmpdir_path, "c.csv", b"n,m,b,t\ninf,99999999999999999999,1,x\n")
    got = csv_flows.load_files(spark, [a, b, c])
    assert {(r["file"], r["column"]): r["type"] for r in got.types.collect()} == {
        ("a.csv", "n"): "bigint", ("a.csv", "m"): "bigint", ("a.csv", "b"): "boolean", ("a.csv", "e"): "none", ("a.csv", "t"): "bigint",
        ("b.csv", "n"): "double", ("b.csv", "m"): "bigint", ("b.csv", "b"): "boolean", ("b.csv", "e"): "none", ("b.csv", "t"): "bigint",
        ("c.csv", "n"): "double", ("c.csv", "m"): "double", ("c.csv", "b"): "bigint", ("c.csv", "e"): "none", ("c.csv", "t"): "string"}
    assert dict(got.flows.dtypes) == {"n": "double", "m": "double", "b": "string", "e": "double", "t": "string", "Day": "string"}
    assert {(r["n"], r["t"]) for r in got.flows.collect()} == {(1.0, "1"), (2.0, "2"), (1.5, "007"), (float("inf"), "x")}


def test_unreadable_files_are_logged_other_failures_raised(spark, tmpdir_path, monkeypatch):
    import pytest

    good = _write(tmpdir_path, "good.csv", b"x\n1\n")
    torn = _write(tmpdir_path, "torn.csv.gz", b"\x1f\x8b\x08\x00broken")
    got = csv_flows.load_files(spark, [good, torn])
    log = {r["file"]: r for r in got.log.collect()}
    assert log["good.csv"]["error"] is None and log["torn.csv.gz"]["error"] and got.flows.count() == 1
    tries = []

    def fail(*_):
        tries.append(1)
        raise RuntimeError("executor lost")
    monkeypatch.setattr(csv_flows, "probe_files", fail)
    with pytest.raises(RuntimeError, match="executor lost"):
        csv_flows.load_files(spark, [good, torn])
    assert len(tries) == 1
