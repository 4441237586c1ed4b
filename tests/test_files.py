"""Which files are read, and when stage tables may be used again."""

import os
import time

import pytest
from pyspark.sql import functions as F

from annualis import codes
from annualis.operators import classify_episode
from annualis.sources.naming import source_identity
from annualis.plans import run, run_report
from annualis.plans.panel import DEPENDS, STAGES, table_keys
from annualis.sources.scan import list_files, scan_quality, scan_raw, source_report
from annualis.sources.stages import (
    MANIFEST, Versions, has_stage, publish, read_manifest, read_stage, read_summary, write_stage,
)


@pytest.fixture
def raw(tmp_path):
    """Three spellings of one file, pieces of a directory, a later year, and foreign names."""
    files = ["2015/XYZ2015FISCAL_CDF.TXT", "2015/XYZ2015FISCAL_CDFF.TXT", "2015/OLDXYZ2015FISCAL_CDF.TXT",
             "2016/XYZ2016FISCAL_CDF.TXT/part-00000", "2016/XYZ2016FISCAL_CDF.TXT/part-00001",
             "2026/XYZ2026FISCAL_CDF.TXT", "2015/XYZ2014FISCAL_CDF.TXT", "2015/notes.txt"]
    for f in files:
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("1;A;7\n")
    return str(tmp_path)


def test_a_file_is_read_once(spark, raw):
    rows = scan_raw(spark, raw, "FISCAL").groupBy("extract_year").count().collect()
    assert {r["extract_year"]: r["count"] for r in rows} == {2015: 1, 2016: 2, 2026: 1}


def test_source_report(spark, raw):
    report = {r["path"].split(raw)[-1]: r["status"] for r in source_report(spark, raw).collect()}
    assert len(report) == 8
    assert report["/2015/XYZ2015FISCAL_CDF.TXT"] == "read"
    assert {k for k, s in report.items() if s == "superseded"} == {
        "/2015/XYZ2015FISCAL_CDFF.TXT", "/2015/OLDXYZ2015FISCAL_CDF.TXT"}
    assert {k for k, s in report.items() if s == "unrecognised"} == {
        "/2015/XYZ2014FISCAL_CDF.TXT", "/2015/notes.txt"}


def test_regular_names_have_no_last_year(spark):
    df = spark.createDataFrame([("raw/2031/XYZ2031PERSONAL_CDF.TXT",)], "path string")
    assert tuple(df.select(source_identity(F.col("path")).alias("i")).select("i.*").first()) == (2031, "PERSONAL", None)


def test_half_written_stages_do_not_count(spark, tmp_path):
    root = str(tmp_path)
    write_stage(spark.range(3), root, "whole")
    write_stage(spark.range(3), root, "half")
    (tmp_path / "half" / "_SUCCESS").unlink()
    assert has_stage(spark, root, "whole")
    assert not has_stage(spark, root, "half") and not has_stage(spark, root, "absent")


def test_copies_in_folders_below_are_not_read(spark, tmp_path):
    """The file nearest to the root counts, with all its pieces."""
    for f, lines in {"2015/XYZ2015FISCAL_CDF.TXT": 1, "2015/old/XYZ2015FISCAL_CDF.TXT": 5,
                     "2016/b/XYZ2016FISCAL_CDF.TXT/part-00000": 1, "2016/b/XYZ2016FISCAL_CDF.TXT/part-00001": 1,
                     "2016/b/c/XYZ2016FISCAL_CDF.TXT/part-00000": 7, "2017/a b [1]/XYZ2017FISCAL_CDF.TXT": 3}.items():
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("1;A;7\n" * lines)
    rows = scan_raw(spark, str(tmp_path), "FISCAL").groupBy("extract_year").count().collect()
    assert {r["extract_year"]: r["count"] for r in rows} == {2015: 1, 2016: 2, 2017: 3}
    status = [r["status"] for r in source_report(spark, str(tmp_path)).collect()]
    assert sorted(status) == ["duplicate"] * 2 + ["read"] * 4


def test_parts_that_extracts_are_not_made_of(spark, tmp_path):
    for f in ("2012/XYZ2012AFILIAD3_CDF.TXT", "2012/XYZ2012AFILIAD4_CDF.TXT", "2013/XYZ2013AFILIAD4_CDF.TXT",
              "2013/XYZ2013COTIZA13_CDF.TXT", "2013/XYZ2013COTIZA14_CDF.TXT", "2013/XYZ2013AFILIAD_CDF.TXT"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("x\n")

    def left_out(**options):
        return sorted(r["path"].split("/")[-1][3:-8] for r in source_report(spark, str(tmp_path), **options).collect()
                      if r["status"] == "left out")
    assert left_out() == ["2012AFILIAD4", "2013AFILIAD", "2013COTIZA14"]
    assert left_out(limits={"AFILIAD": [(9999, 4)]}) == ["2013AFILIAD"]
    files = list_files(spark, str(tmp_path), 2013, 2013)
    assert {(f.source, f.part) for f in files} == {("AFILIAD", 4), ("COTIZA", 13)}
    assert scan_raw(spark, str(tmp_path), "AFILIAD", files=files).count() == 1
    none = scan_raw(spark, str(tmp_path), "PERSONAL", files=files)
    assert none.count() == 0 and none.columns == scan_raw(spark, str(tmp_path), "AFILIAD", files=files).columns


def test_ledger_of_rows(spark, tmp_path):
    whole = ";".join(["p"] * 11)
    lines = [whole, whole.encode() + b";\xff", "p;2017;20", '"a;b";' + whole, ";".join(["p"] * 48), ";".join(["p"] * 49)]
    (tmp_path / "2017").mkdir()
    (tmp_path / "2017/XYZ2017PRESTAC_CDF.TXT").write_bytes(
        b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines) + b"\n")
    row = scan_quality(spark, str(tmp_path)).first()
    assert tuple(row) == ("PRESTAC", 2017, None, 6, 1, 1, 1)
    rows = scan_raw(spark, str(tmp_path), "PRESTAC", ledger=True).select("n_fields", "undecodable").collect()
    assert [tuple(r) for r in rows] == [(11, False), (12, True), (3, False), (12, False), (48, False), (49, False)]


def test_the_manifest_changes_in_one_step(spark, tmp_path):
    root = str(tmp_path)
    assert read_manifest(spark, root) == {}
    publish(spark, root, {"tables": {}, "n": 1})
    publish(spark, root, {"tables": {}, "n": 2})
    assert read_manifest(spark, root)["n"] == 2
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == [MANIFEST]


def test_versions(spark, tmp_path):
    """A whole version is taken over, a half one is not, and only published ones outlive pruning."""
    first, root = Versions(spark, str(tmp_path)), str(tmp_path)
    first.table("t", "k1", lambda: spark.range(3))
    (tmp_path / "t" / f"k1-{first.run}" / "_SUCCESS").unlink()
    second = Versions(spark, root)
    assert second.table("t", "k1", lambda: spark.range(4)).count() == 4 and second.tables["t"]["built"]
    third = Versions(spark, root)
    assert third.table("t", "k1", lambda: spark.range(9)).count() == 4 and not third.tables["t"]["built"]
    assert third.table("t", "k1", lambda: spark.range(9), reuse=False).count() == 9
    publish(spark, root, {"tables": third.tables})
    assert read_stage(spark, root, "t").count() == 9
    assert len(third.prune()) == 2 and read_stage(spark, root, "t").count() == 9


def test_keys_change_with_what_decides_a_table(spark, raw):
    files = list_files(spark, raw)
    keys = table_keys(files, 2005, 2024, {})
    assert set(keys) == set(DEPENDS) == {n for names in STAGES.values() for n in names}

    def changed(files=files, first=2005, **options):
        return {n for n, k in table_keys(files, first, 2024, options).items() if k != keys[n]}
    assert changed() == set() and changed(first=2006) == set(keys)
    assert changed(per_key="max") == {"annual", "annual_demographics", "panel"}
    assert changed(names={"days": "d"}) == changed(inkind="once") == {"panel"}
    assert changed(files[1:]) == {"income", "income_work", "income_person", "income_pension", "panel"}


def person_file(folder, year, birth):
    (folder / str(year)).mkdir(parents=True, exist_ok=True)
    (folder / str(year) / f"XYZ{year}PERSONAL_CDF.TXT").write_text(f"p1;{birth};1;N34;N28;28;28079;;N34;43\n")
    (folder / str(year) / f"XYZ{year}AFILIAD1_CDF.TXT").write_text(
        "p1;111;;100;;20160201;20161231;;;F1;28079;1;5;19900101;1;;;A;7;C1;;;;;;;;;;2\n")


def test_a_run_that_died_is_taken_up_with_the_right_tables(spark, tmp_path, monkeypatch):
    """A crash between stages, other options and other files: what is still right is read, the rest is
    built, and readers see the last whole run."""
    from annualis.plans import panel as plan

    source, out = tmp_path / "raw", str(tmp_path / "out")
    person_file(source, 2016, "198003")
    before = run(spark, str(source), out, 2016, 2017, ledger=True)
    assert [r["birth_year"] for r in before.collect()] == [1980]
    manifest = read_manifest(spark, out)
    assert manifest["quality"]["PERSONAL"] == {"n_rows": 1, "n_short": 0, "n_long": 0, "n_undecodable": 0}
    report = {r["name"]: (r["built"], r["n_rows"], r["n_persons"]) for r in run_report(spark, out).collect()}
    assert report["persons"] == report["panel"] == (True, 1, 1)

    def dies(*_, **__):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(plan, "demographics_join", dies)
        with pytest.raises(RuntimeError):
            run(spark, str(source), out, 2016, 2017, per_key="max")
    assert read_manifest(spark, out) == manifest  # the old run is what readers see
    run(spark, str(source), out, 2016, 2017, from_stage=8, per_key="max")
    built = {n for n, t in read_manifest(spark, out)["tables"].items() if t["built"]}
    # the tables that the dead run had written with the new option are there; the panel's are not
    assert built == {"annual_demographics", "panel"}
    run(spark, str(source), out, 2016, 2017, from_stage=8)
    assert not any(t["built"] for t in read_manifest(spark, out)["tables"].values())
    assert {r["n_rows"] for r in run_report(spark, out).collect() if r["name"] == "panel"} <= {1, None}

    person_file(source, 2016, "199003")
    after = run(spark, str(source), out, 2016, 2017, from_stage=8)
    tables = read_manifest(spark, out)["tables"]
    assert [r["birth_year"] for r in after.collect()] == [1990]
    assert tables["persons"]["built"] and not tables["income"]["built"]
    assert [(r["year"], r["n_persons"]) for r in read_summary(spark, out).collect()] == [(2016, 1)]


def test_a_new_extract_is_merged_into_the_state(spark, tmp_path):
    """Files of extracts that the state holds are not opened again; a changed one is."""
    source, out = tmp_path / "raw", str(tmp_path / "out")
    person_file(source, 2015, "198003")
    run(spark, str(source), out, 2010, 2019)
    old = source / "2015" / "XYZ2015PERSONAL_CDF.TXT"
    told, text = os.stat(old), old.read_text()
    old.write_text(text.replace("1980", "1933"))  # same size and time: nobody can tell, and nobody looks
    os.utime(old, ns=(told.st_atime_ns, told.st_mtime_ns))
    person_file(source, 2016, "198003")
    rows = run(spark, str(source), out, 2010, 2019, from_stage=8).select("birth_year", "first_extract", "last_extract").collect()
    assert {tuple(r) for r in rows} == {(1980, 2015, 2016)}
    assert read_manifest(spark, out)["tables"]["person_state"]["built"]
    old.write_text(text)  # another time: the state is built from all files
    os.utime(old, ns=(told.st_atime_ns, told.st_mtime_ns + 5_000_000_000))
    person_file(source, 2017, "198103")
    assert run(spark, str(source), out, 2010, 2019, from_stage=8).count() == 0  # two birth years
    whole = run(spark, str(source), str(tmp_path / "anew"), 2010, 2019)
    assert whole.count() == 0


def test_a_folder_without_a_manifest_is_built_anew(spark, tmp_path):
    source, out = tmp_path / "raw", str(tmp_path / "out")
    person_file(source, 2016, "198003")
    write_stage(spark.range(3), out, "persons")  # of somebody else
    assert run(spark, str(source), out, 2016, 2017, from_stage=8).count() == 1
    assert read_manifest(spark, out)["tables"]["persons"]["built"]


def test_episodes_may_lack_columns(spark):
    df = classify_episode(spark.createDataFrame([(1, 111)], "person_id long, contribution_regime long"))
    row = df.first()
    assert "firm_muni" not in df.columns and row["basque_navarra"] is None and row["unemp_jr"] is None
    assert row["self_emp"] == 0


def test_fixed_codes():
    """Hand-picked values, as both sides of the SQL comparison take them from the same tables."""
    assert [codes.PROVINCE_REGION[p] for p in (1, 8, 28, 41, 52)] == [16, 9, 13, 1, 19]
    assert len(codes.PROVINCE_REGION) == 52 and codes.CPI_BASE == 103.664
    assert codes.WORK_REGIMES[0] == (111, 137)


def test_a_large_delivered_file_is_written_by_several_tasks(spark, tmp_path):
    """One year's rows are not all written by one task: the file comes in several pieces, all read."""
    from catalog.delivery import deliver

    rows = spark.range(0, 20000, numPartitions=8).selectExpr(
        "CAST(2015 AS SMALLINT) AS extract_year", "concat_ws(';', id, 'A', repeat('x', 40)) AS line")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        deliver(rows, str(tmp_path), "FISCAL")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    folder = tmp_path / "2015" / "XYZ2015FISCAL_CDF.TXT"
    assert len([p for p in os.listdir(folder) if p.startswith("part-")]) > 1
    read = scan_raw(spark, str(tmp_path), "FISCAL")
    assert read.count() == 20000 and read.select("c0").distinct().count() == 20000


def test_delivered_lines_take_little_disk(spark, tmp_path):
    """Lines are written compressed by the tasks that have them: no exchange, and all of them are read."""
    from catalog.delivery import deliver

    rows = spark.range(0, 60000, numPartitions=4).selectExpr(
        "CAST(2015 + id % 3 AS SMALLINT) AS extract_year", "CAST(1 + id % 4 AS INT) AS part",
        "concat_ws(';', id, '000000001', '20150101', '20151231', repeat('0;', 20)) AS line")
    shuffle = spark._jsc.sc().newShuffleId()
    deliver(rows, str(tmp_path), "AFILIAD")
    assert spark._jsc.sc().newShuffleId() == shuffle + 1  # none was made between
    stored = sum(p.stat().st_size for p in tmp_path.rglob("part-*"))
    assert stored < rows.selectExpr("sum(length(line) + 1)").first()[0] / 4
    read = scan_raw(spark, str(tmp_path), "AFILIAD")
    told = read.groupBy("extract_year", "part").agg(F.count_distinct("c0").alias("n")).collect()
    assert {(r["extract_year"], r["part"]): r["n"] for r in told} == {
        (2015 + y, 1 + p): 5000 for y in range(3) for p in range(4)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_more_files_than_are_open_at_once(spark, tmp_path, monkeypatch):
    import catalog.delivery as delivery

    monkeypatch.setattr(delivery, "OPEN_FILES", 2)
    rows = spark.range(0, 3000, numPartitions=2).selectExpr(
        "CAST(2015 + id % 2 AS SMALLINT) AS extract_year", "CAST(1 + id % 3 AS INT) AS part",
        "concat_ws(';', id, 'A') AS line")
    delivery.deliver(rows, str(tmp_path), "AFILIAD")
    read = scan_raw(spark, str(tmp_path), "AFILIAD")
    assert read.count() == 3000 and read.select("c0").distinct().count() == 3000


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_with_the_job_that_wrote_a_table(spark, tmp_path):
    before = shuffle_files(spark)
    table = spark.range(0, 20000, numPartitions=4).groupBy((F.col("id") % 7000).alias("k")).count()
    written = write_stage(table, str(tmp_path), "counts")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert written.count() == 7000
    assert table.agg(F.sum("count")).first()[0] == 20000  # what it was made of may be used again
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_panel_shuffles_its_wide_rows_three_times(spark):
    """By account for the firm repair, by person and year for both incomes, by person for the lag; the
    incomes themselves come to the rows. A wage is that of the person-year's main firm only."""
    from annualis.operators import assemble_panel

    years = spark.createDataFrame([(1, 2015, 7, "C1", 28), (1, 2016, 0, "C1", 28), (2, 2015, None, None, None)],
                                  "person_id long, year smallint, firm_id long, firm_cc string, firm_muni long")
    more = {"main_firm_cc2": "F1", "days": 360, "contract_type": 1, "birth_year": 1980, "age": 35.0, "education_7cats": 3,
            "days_lag1": 360, "education": 3}
    years = years.withColumns({c: F.lit(v) for c, v in more.items()})
    work = spark.createDataFrame([(1, "7", 2015, 10.0, 1.0), (1, "8", 2015, 99.0, 9.0), (1, "9", 2016, 20.0, 2.0),
                                  (2, "7", 2015, 50.0, 5.0)],
                                 "person_id long, firm_id string, year smallint, wage double, inkind double")
    personal = spark.createDataFrame([(1, 2016, 3.0, 0.0, 4.0, 0.0)], "person_id long, year smallint, inc_unemp double, "
                                     "inkind_unemp double, inc_prof double, inkind_prof double")
    retired = spark.createDataFrame([(1, 2030)], "person_id long, retirementyear int")
    correction = spark.createDataFrame([("C1", 9)], "firm_cc string, firm_id_correction long")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        panel = assemble_panel(years, work, personal, retired, correction)
        text = panel._jdf.queryExecution().executedPlan().toString()
        found = {(r["person_id"], r["year"]): r for r in panel.collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    # three of the wide rows, four of the joined tables
    assert text.count("Exchange hashpartitioning") == 7
    assert [(found[k]["firm_id"], found[k]["fiscal_wage"], found[k]["wage"]) for k in ((1, 2015), (1, 2016), (2, 2015))] == [
        ("7", 10.0, 11.0), ("9", 20.0, 22.0), (None, 0.0, 0.0)]
    assert (found[1, 2016]["tot_inc"], found[1, 2016]["tot_inc_lag"], found[1, 2016]["retirementyear"]) == (29.0, 11.0, 2030)
