"""Raw files of several years in a folder: scan, names, layouts, the staged run."""

import pytest
from pyspark.sql import functions as F

from annualis.operators import PANEL_COLUMNS
from annualis.plans import STAGES, run
from annualis.plans.panel import WIDE
from annualis.sources import layouts
from annualis.sources.naming import source_identity
from annualis.sources.scan import scan_raw
from annualis.sources.stages import read_stage


def put(root, year, name, lines):
    folder = root / str(year)
    folder.mkdir(parents=True, exist_ok=True)
    data = b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines)
    (folder / name).write_bytes(data + b"\n")


def fields(values: dict, width: int) -> str:
    return ";".join(str(values.get(i, "")) for i in range(width))


def episode(person, entry, exit_, firm="F1", firm_id="0", firm_cc="C1", regime=111, muni=28079,
            industry=1, old=2, contract=100):
    return fields({0: person, 1: regime, 3: contract, 5: entry, 6: exit_, 9: firm, 10: muni,
                   11: industry, 12: 5, 13: 19900101, 14: 1, 17: "A", 18: firm_id, 19: firm_cc,
                   29: old}, 30)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    # 2007: nameless .trs files; 2012 and 2017: other layouts; a stale 2016 file in 2017
    put(root, 2007, "PERSANON.trs", ["p1;198003;1;N34;N28;28;28079;;N34;43"])
    put(root, 2007, "CONVIVI.trs", ["p1;198003;1;201001;2"])
    put(root, 2007, "AFILANON1.trs", [episode("p1", 20050101, 20071231, industry=11)])
    put(root, 2007, "COTIANON1.trs", [fields({0: "p1", 1: "F1", 2: 2006, 8: 100}, 20)])
    put(root, 2007, "DATOS_FISCALES.trs", [fields({0: "p1", 2: "009", 4: "A", 6: 1000, 8: 50}, 44)])
    put(root, 2007, "PREANON.trs", [fields({0: "p1", 1: 2007, 3: "20", 9: 1, 10: 200706}, 11)])
    put(root, 2012, "XYZ2012PERSONAL_CDF.txt", [
        "p1;198003;1;N34;N28;28;28079;;N34;43;extra field",
        b"p2;199001; 2 ;N99;N\xf128;x;28079;;N40",
        "p3;197001;1;N34;N28;28;28079;;N34;43",
        "p3;197001;2;N34;N28;28;28079;;N34;43",
        "p1;198003;1;N34;N28;28;28079;;N34;43"])
    put(root, 2012, "XYZ2012AFILIAD1_CDF.TXT", [episode("p1", 20050101, 20120630, firm_id="0")])
    put(root, 2012, "XYZ2012AFILIAD4_CDF.TXT", [episode("p1", 20050101, 20110630)])
    put(root, 2012, "XYZ2012COTIZA3_CDF.TXT", [fields({0: "p1", 1: "F1", 2: 2011, 8: 100, 19: 20}, 20)])
    put(root, 2017, "XYZ2016PERSONAL_CDF.TXT", ["p9;198003;1;N34;N28;28;28079;;N34;43"])
    put(root, 2017, "XYZ2017PERSONAL_CDF.TXT", ["p1;198003;0;N34;N28;0;41001;201805;N34;48"])
    put(root, 2017, "XYZ2017CONVIVIR_CDF.TXT", [
        "p1;198003;1;201001;2;195001;1", "p1;198003;1;200901;2"])
    put(root, 2017, "XYZ2017AFILIAD4_CDF.TXT", [
        episode("p1", 20160201, 20160228), episode("p1", 20160301, 20171231, firm_id="7"),
        episode("p1", 20160301, 20171231, firm_id="7"),
        episode("p1", 20180301, 20171231), episode("p1", 20180301, "")])
    put(root, 2017, "XYZ2017COTIZA12_CDF.TXT", [
        fields({0: "p1", 1: "F1", 2: 2016, 3: 100, 14: 20}, 15),
        fields({0: "p1", 1: "F1", 2: 2016, 3: 150}, 10)])
    put(root, 2017, "XYZ2017COTIZA13_CDF.TXT", [fields({0: "p1", 1: "F1", 2: 2016, 3: 70}, 15)])
    put(root, 2016, "XYZ2016FISCAL_SDF.TXT", [
        fields({0: "p1", 2: "000000007", 4: "A", 6: 100000, 7: 500, 10: 2000, 11: 9}, 46),
        fields({0: "p1", 2: "7", 4: "A", 6: 1000}, 46),
        fields({0: "p1", 2: "55", 4: "C", 6: 3000}, 46)])
    put(root, 2017, "XYZ2017FISCAL_CDF.TXT", [
        fields({0: "p1", 2: "000000007", 4: "A", 6: 100000, 7: 500, 10: 2000, 11: 9}, 48),
        fields({0: "p1", 2: "8", 4: "G", 5: 1, 6: 700}, 48)])
    put(root, 2017, "XYZ2017PRESTAC_CDF.TXT", [
        fields({0: "p1", 1: 2017, 3: "J1", 9: 1, 10: 201703}, 11),
        fields({0: "p1", 1: 2017, 3: "25", 9: 1, 10: 200003}, 11),
        fields({0: "p1", 1: 2017, 3: "20", 9: 36, 10: 200003}, 11),
        fields({0: "p1", 1: 2017, 3: "20", 10: 200003}, 11)])
    put(root, 2017, "XYZ2017DIVISION_CDF.TXT", ["p1 2 11 extra", "p2 300 x"])
    return str(root)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_persons(spark, raw):
    got = by_key(layouts.read_persons(scan_raw(spark, raw, "PERSONAL")), "extract_year", "person_id")
    # p3 conflicts, the copy of p1 does not; the stale file is not read
    assert set(got) == {(2007, "p1"), (2012, "p1"), (2012, "p2"), (2017, "p1")}
    p2 = got[2012, "p2"]
    assert (p2["nationality"], p2["birth_country"], p2["birth_prov"], p2["sex"], p2["ss_reg_prov"],
            p2["edu_code"], p2["education"]) == (40, 40, None, 2, None, None, None)
    assert got[2017, "p1"]["death_year_month"] == 201805
    assert got[2007, "p1"]["education"] == 50


def test_other_layouts(spark, raw):
    homes = by_key(layouts.read_households(scan_raw(spark, raw, "CONVIVIR")), "extract_year")
    assert (homes[2017,]["birth_date2"], homes[2017,]["birth_date3"]) == ("200901", None)
    rows = scan_raw(spark, raw, "AFILIAD")
    episodes = layouts.read_episodes(layouts.delivered_episode_parts(rows))
    industry = {(r["extract_year"], r["sector_cnae93"], r["sector_cnae09"])
                for r in episodes.collect()}
    assert industry == {(2007, 11, None), (2012, 2, 1), (2017, 2, 1)}
    assert episodes.filter("extract_year = 2012").count() == 1
    rows = scan_raw(spark, raw, "COTIZA")
    bases = by_key(layouts.read_contributions(rows), "extract_year", "contribution_1")
    assert bases[2012, 100]["contribution_12"] == 20 and bases[2017, 150]["contribution_12"] is None
    assert [r["contribution_aut_1"] for r in layouts.read_contributions(rows, True).collect()] == [70]
    both = layouts.read_all_contributions(rows).filter("extract_year = 2017")
    assert sorted((r["contribution_1"] or 0, r["contribution_aut_1"] or 0)
                  for r in both.collect()) == [(0, 70), (100, 0), (150, 0)]
    pay = by_key(layouts.read_payments(scan_raw(spark, raw, "FISCAL")), "year", "firm_id")
    assert (pay[2007, "009"]["wage_cents"], pay[2007, "009"]["inkind"]) == (1050, 0.5)
    assert (pay[2016, "000000007"]["wage_cents"], pay[2016, "000000007"]["inkind_cents"]) == (102500, 2000)
    assert (pay[2017, "000000007"]["wage_cents"], pay[2017, "000000007"]["inkind_cents"]) == (102509, 2009)
    pensions = layouts.read_pensions(scan_raw(spark, raw, "PRESTAC"))
    assert sorted(r["date1"] for r in pensions.collect()) == [200706, 201703]
    files = layouts.read_file_numbers(scan_raw(spark, raw, "DIVISION"))
    assert sorted((r["person_id"], r["relacionesfile"], r["basesfile"]) for r in files.collect()) == [
        ("p1", 2, 11), ("p2", None, None)]


def test_files_of_other_sources_are_never_opened(spark, raw):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows its scans
    try:
        df = scan_raw(spark, raw, "DIVISION")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "file_path" in plan.toString()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    read = [s.metrics().apply("numFiles").value() for s in scans if s.metrics().contains("numFiles")]
    assert read == [1]


def test_names(spark):
    names = {
        ("2004", "EST.LABT2004.AFILANON.FICHERO1.TXT"): (2004, "AFILIAD", 1),
        ("2004", "EST.LABT2004.AFILANON.FICHERO2.EST.LABT2004.AFILANON.FICHERO2.EST.LAB.TXT"):
            (2004, "AFILIAD", 2),
        ("2004", "EST.LABT2004.COTIANON.FICHERO9.TXT"): (2004, "COTIZA", 9),
        ("2004", "EST.LABT2004.COTIANON.FICHER12.TXT"): (2004, "COTIZA", 12),
        ("2004", "EST.LABT2004.COTIANON.FICHERO6.TXT"): None,
        ("2004", "EST.LABT2004.COTIANON.FICHERO6.EST.LABT2004.COTIANON.FICHERO6.EST.LAB.TXT"):
            (2004, "COTIZA", 6),
        ("2004", "EST.LABT2004.CPROPIA.ANONIMO.TXT"): (2004, "CONVIVIR", None),
        ("2005", "XYZ2005BAFILIAD1.TXT"): (2005, "AFILIAD", 1),
        ("2005", "XYZ2005BPERSONAL.txt"): (2005, "PERSONAL", None),
        ("2006", "AFILANON3.trs"): (2006, "AFILIAD", 3),
        ("2008", "COTIANON13.TRS"): (2008, "COTIZA", 13),
        ("2009", "AFILANON3.trs"): None,
        ("2009", "XYZ2009COTIZA1.TXT"): (2009, "COTIZA", 1),
        ("2010", "XYZ2010AFLIAID1_CDF.TXt"): (2010, "AFILIAD", 1),
        ("2011", "XYZ2011.F2013.AFILIA2_CDF.txt"): (2011, "AFILIAD", 2),
        ("2013", "XYZ2012FISCAL_CDF.TXT"): None,
        ("2013", "XYZ2013FISCAL_CDF.TXT"): (2013, "FISCAL", None),
        ("2015", "XYZ2015COTIZA11_CDFF.TXT"): (2015, "COTIZA", 11),
        ("2016", "XYZ2016PERSONAL_SDF.TXT"): (2016, "PERSONAL", None),
        ("2017", "XYZ2017/XYZ2017FISCAL_CDF.TXT"): (2017, "FISCAL", None),
        ("2020", "XYZ2020PERSONAL.TXT"): (2020, "PERSONAL", None),
        ("2022", "XYZ2022PERSONAL.TXT"): None,
        ("2024", "XYZ2024COTIZA10_CDF.TXT/part-00003-abc.txt"): (2024, "COTIZA", 10),
        ("2024", "readme.txt"): None,
    }
    df = spark.createDataFrame([(f"file:/data/raw/{y}/{n}", y, n) for y, n in names],
                               "path string, y string, n string")
    got = {(r["y"], r["n"]): r["id"] and tuple(r["id"])
           for r in df.withColumn("id", source_identity(F.col("path"))).collect()}
    assert got == names


def test_run_and_resume(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    panel = run(spark, raw, out, 2007, 2017, wide_tables=True,
                names={"first_extract": "entry_extract"})
    assert set(panel.columns) == set(PANEL_COLUMNS) - {"first_extract"} | {"entry_extract"}
    rows = {r["year"]: r for r in panel.collect()}
    # only the episodes of the last extract, 2017
    assert sorted(rows) == [2016, 2017]
    r = rows[2016]
    # January max 150 and December 20, counted for both episodes of the firm in 2016
    assert r["total_contribution"] == 2 * 1.7
    # February whole, then March to December
    assert r["days"] == 330 and rows[2017]["days"] == 360 and rows[2017]["days_lag1"] == 330
    # the first episode's identifier 0 is repaired to 7; both paddings add up; in kind twice
    assert r["firm_id"] == "7"
    assert (r["fiscal_wage"], r["fiscal_inkind"], r["wage"]) == (1035.0, 20.0, 1055.0)
    assert (r["inc_unemp"], rows[2017]["inc_prof"]) == (30.0, 7.0)
    assert rows[2017]["tot_inc_lag"] == r["tot_inc"] == 1085.0
    assert (r["retirementyear"], r["sex"], r["education"], r["comunidad"], r["death_year"]) == (
        2007, 1, 4, 13, 2018)
    assert (r["famsize"], r["famsize_715"], r["entry_extract"], r["age_int"]) == (2, 1, 2007, 36)
    assert rows[2017]["fullyear_lag1"] == 0
    for names in STAGES.values():
        for name in names:
            assert read_stage(spark, out, name).columns
    summary = spark.read.option("header", "true").csv(f"{out}/panel_summary").collect()
    assert [(s["year"], s["n_persons"]) for s in summary] == [("2016", "1"), ("2017", "1")]
    # resuming reads the written tables, whatever the raw folder holds
    again = run(spark, raw, out, 2007, 2017, from_stage=5)
    assert {r["year"]: r["tot_inc"] for r in again.collect()} == {
        y: r["tot_inc"] for y, r in rows.items()}
    assert WIDE <= {n for names in STAGES.values() for n in names}
