import pytest
from pyspark.sql import functions as F

from waypost.operators.cleaning import Dims, load_clean_data, missing_policy, undated_rows
from waypost.sources import dims as DM
from waypost.sources import files as FI
from waypost.sources import vocab


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), (None, 2.0), ("NaN", None)], "s string, v double")
    FI.write_csv(df, str(tmp_path / "out"))
    back = FI.scan_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("a", "1.5"), (None, "2.0"), (None, None)], key=str)
    typed = FI.scan_csv(spark, str(tmp_path / "out"), df.schema)
    assert dict(typed.dtypes) == {"s": "string", "v": "double"}
    assert FI.csv_header(spark, str(tmp_path / "out")) == ["s", "v"]


def test_json_and_report_sinks(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, DATE '2024-02-05' AS d")
    FI.write_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":1,"d":"2024-02-05"}'
    FI.write_report(spark.createDataFrame([("# T\nx",)], "report_md string"), str(tmp_path / "r"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "r")).collect()] == ["# T", "x"]


def test_rename_rejects_two_aliases_of_one_name(spark):
    df = spark.createDataFrame([("a", "b")], ["Tipo_Documento", "Tipo Documento"])
    with pytest.raises(ValueError):
        FI.rename_columns(df, vocab.COLUMN_NAMES)


def test_city_keeps_last_listed_code(spark):
    d = DM.dim(spark, [("IST", "Istanbul", "a", 1), ("ISL", "Istanbul", "b", 2), ("TIA", "Tirana", "c", 3)], "iata string, city string, airport string, ord int")
    codes = {r["city"]: r["iata"] for r in DM.city_codes(d).collect()}
    assert codes == {"ISTANBUL": "ISL", "TIRANA": "TIA"}
    assert {r["iata"] for r in DM.city_codes(d, {"Istanbul": "IST"}).collect()} == {"IST", "TIA"}


def test_load_clean_data(spark, tmp_path):
    (tmp_path / "ALLARMI.csv").write_text(
        "OCCORRENZE,AREOPORTO_ARRIVO,AREOPORTO_PARTENZA,DATA_PARTENZA,ZONA,3zona,TOT,tot voli,MOTIVO_ALLARME,note_operatore,flag_rischio,Paese Partenza,PAESE_PART\n"
        "Allarmi Generati ,fco, tia,05/02/2024 10:00:00,99,3,x,~5 voli,sdi,,ALTO,?,Albania\n"
        "respinto/a,FCO,TIA,n.d.,1,3,x,1 voli,,,,Albania,\n"
        "boh,FCO,,2024-02-06,1,3,x,2000,,note,,Albania,\n"
    )
    (tmp_path / "TIPOLOGIA_VIAGGIATORE.csv").write_text(
        "AREOPORTO_ARRIVO,AREOPORTO_PARTENZA,DATA_PARTENZA,PAESE_PART,ZONA,GENERE,NAZIONALITA,FLAG_TRANSITO,ENTRATI,INVESTIGATI,ALLARMATI,note_operatore\n"
        "FCO,tia,2024/02/05,Albania,4,maschio,ND,Transito,10 pax,5,1,\n"
        "FCO,TIA,2024/02/05,Albania,4,F,ALB,N/C,300,5,1,\n"
        "FCO,TIA,2024/02/05,Cossovo,-1,,ALB,1,7,N.D.,1,\n"
    )
    airports = DM.dim(spark, [("TIA", "Tirana", "Rinas"), ("FCO", "Roma", "Fiumicino")], "iata string, city string, airport string")
    alarms, travelers = load_clean_data(spark, str(tmp_path), Dims(airports, DM.countries(spark)))
    rows = [r.asDict() for r in alarms.orderBy("DEPARTURE_DATE").collect()]
    assert len(rows) == 2
    first, last = rows
    assert (first["OCCURRENCES"], first["ZONE"], first["TOTAL_FLIGHTS"], first["RISK_FLAG"]) == ("generated_alerts", 3, 5, "HIGH RISK")
    assert (first["DEPARTURE_COUNTRY"], first["DEPARTURE_COUNTRY_CODE"], first["DEPARTURE_CITY"]) == ("Albania", "ALB", "Tirana")
    assert (first["ALARM_REASON"], first["OPERATOR_NOTES"]) == ("SDI", "NO MANUAL NOTES")
    assert (last["OCCURRENCES"], last["DEPARTURE_AIRPORT_IATA"], last["TOTAL_FLIGHTS"], last["ALARM_REASON"]) == (None, None, 0, "NO REASON PROVIDED")
    got = travelers.collect()
    assert len(got) == 1
    t = got[0].asDict()
    assert (t["GENDER"], t["NATIONALITY"], t["TRANSIT_FLAG"], t["ENTRIES"], t["OPERATOR_NOTES"]) == ("M", "Unknown", "STOPOVER", 10, "NO_NOTES")
    assert (t["ARRIVAL_CITY"], t["DEPARTURE_COUNTRY_CODE"], t["ZONE"]) == ("Roma", "ALB", 4)


def test_missing_policy_fills(spark):
    rows = [(i, None if i < 7 else "x", None if i < 3 else 1.0, None if i < 1 else "b") for i in range(10)]
    out, decisions = missing_policy(spark.createDataFrame(rows, "k int, a string, n double, c string"))
    assert {r["column_name"]: r["action"] for r in decisions.collect()} == {"k": "keep", "a": "drop", "n": "fill_and_flag", "c": "fill_mode"}
    assert "a" not in out.columns and out.filter(F.col("n").isNull() | F.col("c").isNull()).count() == 0
    assert out.agg(F.sum("n_missing")).first()[0] == 3


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,note,zone\n1,"He said ""hi"", then left",5\n2,"two\nlines",6\n3," padded ",7\n')
    want = [("1", 'He said "hi", then left', "5"), ("2", "two\nlines", "6"), ("3", " padded ", "7")]
    df = FI.scan_csv(spark, str(tmp_path / "in.csv"))
    assert sorted(map(tuple, df.collect())) == want
    FI.write_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, FI.scan_csv(spark, str(tmp_path / "out")).collect())) == want
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '""hi""' in text and "\\" not in text


def test_undated_rows_are_counted(spark, tmp_path):
    (tmp_path / "ALLARMI.csv").write_text("AREOPORTO_ARRIVO,AREOPORTO_PARTENZA,DATA_PARTENZA\nFCO,TIA,20240105\nFCO,TIA,soon\n")
    (tmp_path / "TIPOLOGIA_VIAGGIATORE.csv").write_text("AREOPORTO_ARRIVO,AREOPORTO_PARTENZA,DATA_PARTENZA\nFCO,TIA,\"Jan 5, 2024\"\n")
    dims = Dims(DM.dim(spark, [("TIA", "Tirana", "Rinas")], "iata string, city string, airport string"), DM.countries(spark))
    assert {r["source"]: (r["n_unparsed"], r["n_rows"]) for r in undated_rows(spark, str(tmp_path), dims).collect()} == {"alarms": (1, 2), "travelers": (0, 1)}
    assert [df.count() for df in load_clean_data(spark, str(tmp_path), dims)] == [1, 1]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    """Cells with line breaks, quotes and delimiters at every edge of the splits; one cell fills several splits."""
    import csv
    import random

    rng = random.Random(3)
    cell = lambda n: "".join(rng.choice(['"', "\n", ",", "a", "é", "x y", "\n\n"]) for _ in range(rng.randint(0, n)))
    rows = [[str(i), cell(30), "k" + cell(12)] for i in range(3_000)]
    rows[700][1] = cell(12_000) + "end"
    rows[701] = ["701", "", "\n"]
    file = tmp_path / "large.csv"
    with file.open("w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["id", "a b", "c"])
        writer.writerows(rows)
    (tmp_path / "other.csv").write_text('id,a b,c\n-1,"x\n\ny",z')
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = FI.scan_csv(spark, str(tmp_path))
        got = {r[0]: tuple(r) for r in df.collect()}
        tasks = spark.read.text(str(file)).rdd.getNumPartitions()
        whole = {r[0]: tuple(r) for r in FI.scan_csv(spark, str(tmp_path), multi_line=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert tasks > 20 and got == whole and len(got) == 3_001
    plain = lambda v: None if v in FI.NA_TOKENS else v
    assert all(got[r[0]] == (r[0], plain(r[1]), plain(r[2])) for r in rows)


def test_carriage_returns_end_records(spark, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'id,t\r\n1,"a\r\nb"\r\n2,c\r\n\r\n3,"d"')
    got = {r["id"]: r["t"] for r in FI.scan_csv(spark, str(tmp_path)).collect()}
    assert set(got) == {"1", "2", "3"} and got["2"] == "c" and got["3"] == "d" and got["1"].replace("\r", "") == "a\nb"
