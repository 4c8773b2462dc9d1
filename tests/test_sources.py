import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortweave import session
from cohortweave.catalog import QUERIES
from cohortweave.sources import codelists, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_typed_csv_keeps_ids_and_tolerates_bad_values(spark, tmp_path, rows):
    write(tmp_path / "a.csv", 'mother_id,delivery_dt,n\n"007",2022-01-31,3\n"008",not a date,NA\n')
    df = tables.read_typed_csv(spark, str(tmp_path / "a.csv"), {"delivery_dt": "date", "n": "int"})
    assert rows(df) == [("007", dt.date(2022, 1, 31), 3), ("008", None, None)]


def test_typed_csv_raises_on_missing_column(spark, tmp_path):
    write(tmp_path / "a.csv", "x\n1\n")
    with pytest.raises(ValueError):
        tables.read_typed_csv(spark, str(tmp_path / "a.csv"), {"y": "int"})


def test_files_with_other_column_order_raise(spark, tmp_path):
    write(tmp_path / "d/a.csv", "x,y\n1,2\n")
    write(tmp_path / "d/b.csv", "y,x\n3,4\n")
    with pytest.raises(Exception):
        tables.read_text_csv(spark, str(tmp_path / "d")).collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_written_table_round_trip(spark, tmp_path, rows, fmt):
    df = spark.createDataFrame([("023", None, 1.5), ('say "hi", then', "b", None), ("line", "", 2.0)], "id string, t string, x double")
    path = str(tmp_path / fmt)
    tables.write_table(df, path, fmt)
    back = spark.read.parquet(path) if fmt == "parquet" else tables.read_typed_csv(spark, path, {"x": "double"}, escaped=True)
    assert rows(back) == rows(df)


@pytest.mark.parametrize(
    "text", ["a\nb", "a\r\nb", " pad ", "NA", "\\NA", "", None, 'say "hi", then', "\\n", "\\", "\\b\\\\n", '"', ",", "\t", "\\\n", '\\"', "ü x"]
)
def test_written_csv_keeps_any_text(spark, tmp_path, text):
    df = spark.createDataFrame([(1, text, text), (2, "next", None)], "n int, t string, u string")
    tables.write_table(df, str(tmp_path / "t"))
    back = tables.read_typed_csv(spark, str(tmp_path / "t"), {"n": "int"}, escaped=True).orderBy("n").collect()
    assert [tuple(r) for r in back] == [(1, text, text), (2, "next", None)]


def test_parquet_dates_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([("2020-02-29", "x", dt.datetime(2021, 5, 6, 7))], "a_dt string, b string, c_dt timestamp")
    df.write.parquet(str(tmp_path / "p"))
    row = tables.read_parquet_dates(spark, str(tmp_path / "p")).first()
    assert (row.a_dt, row.b, row.c_dt) == (dt.date(2020, 2, 29), "x", dt.date(2021, 5, 6))


def snapshots(tmp_path):
    folder = tmp_path / "snap"
    write(folder / "Feature_df_01022024.csv", "person_id,age,race_a,other\np1,30,1,z\np2,40,0,z\n")
    write(folder / "Feature_df_01032024.csv", "race_a,person_id,previous_x,age\n5,p1,9,31\n6,p3,9,50\n")
    write(folder / "Feature_df_01042024.csv", "person_id,age\np2,41\n")
    return str(folder)


def test_snapshot_lookup_reads_each_file_with_its_own_header(spark, tmp_path, rows):
    keys = [("p1", "2024-01-02"), ("p1", "2024-01-03"), ("p2", "2024-01-04"), ("p2", "2024-01-03"), ("p9", "2024-01-05")]
    df = spark.createDataFrame(keys, "person_id string, score_dt string").withColumn("score_dt", F.to_date("score_dt"))
    got = tables.snapshot_lookup(df, snapshots(tmp_path), missing="skip", columns=["age"], prefixes=["race", "previous"])
    assert "other" not in got.columns
    assert rows(got, "person_id", "snapshot_dt", "age", "race_a", "previous_x") == [
        ("p1", dt.date(2024, 1, 2), "30", "1", None),
        ("p1", dt.date(2024, 1, 3), "31", "5", "9"),
        ("p2", dt.date(2024, 1, 4), "41", None, None),
    ]


def test_snapshot_lookup_can_insist_on_a_file(spark, tmp_path):
    df = spark.createDataFrame([("p9", dt.date(2024, 1, 5))], "person_id string, score_dt date")
    with pytest.raises(FileNotFoundError):
        tables.snapshot_lookup(df, snapshots(tmp_path), columns=["age"], missing="error")


def test_part_files_of_a_date_are_one_row_on_the_driver(spark, tmp_path, rows):
    """Two dates as folders of 300 part files each, one with its columns in another order."""
    folder = tmp_path / "parts"
    for i in range(300):
        write(folder / "Feature_df_01022024.csv" / f"part-{i:05}.csv", f"person_id,age,race_a\nq{i},{i},x\n")
        write(folder / "Feature_df_01032024.csv" / f"part-{i:05}.csv", f"age,person_id\n{i + 1},q{i}\n")
    listed = tables.snapshot_files(spark, str(folder), "Feature_df_").collect()
    assert len(listed) == 2 and {r.path.rsplit("/", 1)[1] for r in listed} == {"Feature_df_01022024.csv", "Feature_df_01032024.csv"}
    df = spark.createDataFrame([(f"q{i}", dt.date(2024, 1, 2 + i % 2)) for i in range(0, 300, 7)], "person_id string, score_dt date")
    got = tables.snapshot_lookup(df, str(folder), columns=["age"], prefixes=["race"])
    assert rows(got, "person_id", "age", "race_a") == sorted((f"q{i}", str(i + i % 2), None if i % 2 else "x") for i in range(0, 300, 7))


def test_stage_tables_go_with_their_owner(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    with session.stage_tables(spark) as outer:
        with session.stage_tables(spark) as inner:
            kept = inner.keep(session.written(spark.range(5), "kept"))
            session.written(spark.range(3), "gone")
            assert len(list(tmp_path.iterdir())) == 2
        assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["kept"] and kept.count() == 5 and len(outer.paths) == 1
    assert not list(tmp_path.iterdir())
    with pytest.raises(ZeroDivisionError), session.stage_tables(spark):
        session.written(spark.range(3), "gone")
        raise ZeroDivisionError
    assert not list(tmp_path.iterdir())
    for name in ("exact_quantiles", "snapshot_features", "tiered_identify", "long_term_care_groups", "child_training_rows"):
        with session.stage_tables(spark):
            assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0 and list(tmp_path.iterdir())
        assert not list(tmp_path.iterdir()), name


def test_code_list_filters_dots_and_drops_null(spark, rows):
    ref = spark.createDataFrame(
        [("ICD", "O9902", "Anemia complicating Childbirth"), ("ICD", "O80", "in childbirth"), ("ICD", None, "in childbirth"),
         ("CPT", "59400", "in childbirth"), ("ICD", "Z00", "other")],
        "type string, code string, definition string",
    )
    got = codelists.code_list(ref, "cb", code_type="ICD", definition_contains=["childbirth"], lower=True, dotted=True)
    assert rows(got) == [("cb", "O80", 3), ("cb", "O99.02", 6)]


def test_code_ranges_and_literals(spark, rows):
    got = codelists.code_ranges(spark, [("del", "O", 80, 82), ("bmi", "Z68.", 9, 10)])
    assert rows(got) == [("bmi", "Z68.10", 6), ("bmi", "Z68.9", 5), ("del", "O80", 3), ("del", "O81", 3), ("del", "O82", 3)]
    assert rows(codelists.code_literals(spark, {"rev": ["023"]})) == [("rev", "023", 3)]
