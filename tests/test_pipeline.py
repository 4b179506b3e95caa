"""All three stages on small files, with results worked by hand."""

import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from indexloom.operators import series
from indexloom.plans import increments, ingest, publish, report
from indexloom.sources import delimited, tables

SALES = "carrier_toc_code,origin_code,destination_code,route_code,product_code,pro_group_1_code,adjusted_earnings,operating_journeys\n"
PLACES = "Origin Code,Destination Code,Route Code"


def flow(origin, destination, route, flow_id):
    return f"RF{origin}{destination}{route}000AS3112299901012019ATO000{flow_id}"


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    (root / "sales").mkdir()
    (root / "sales" / "one.csv").write_bytes(
        (
            SALES
            + 'EK,1,2,0,2MTA,PG04,"£1,000.00",10\n'  # season, regulated, list prices
            + "EK,1,2,0,2BAF,PG01,600000,20\n"  # anytime, regulated by carrier, derived prices
            + "EK,A01,2,0,2BAF,PG01,50,1\n"  # place with a letter
            + "EK,1,2,0,9XYZ,PG01,77,1\n"  # product out of scope
        ).encode("windows-1252")
    )
    (root / "sales" / "two.csv").write_bytes(
        (
            SALES
            + "HM,3,4,0,1ADV,PG02,300,3\n"  # advance, twice the same key
            + "HM,3,4,0,1ADV,PG02,100,1\n"
            + "??,1,2,0,2NEW,PG09,40,4\n"  # unknown carrier, group and category
            + "HM,1,2,0,2MTC,PG04,25,1\n"  # product left out of the price side
        ).encode("windows-1252")
    )
    (root / "regulated.csv").write_text("orig,dest,route,ticketa,flaga,ticket,flag2\n1,2,0,x,x,2BAF,SWT\n")
    (root / "categories.csv").write_text(
        "Product Code,Product Primary Code,Category\n2MTA,PG04,Season\n2MTC,PG04,Season\n2BAF,PG01,Anytime\n1ADV,PG02,ADVANCE\n"
    )
    (root / "tickets.csv").write_text("Fares ticket type code,Lennon product code (CTOT)\n7DS,2MTA\n7DC,2MTC\n")
    for year, fare in (("base", 2000), ("current", 2100)):
        (root / f"feed_{year}.txt").write_text(
            "/!! start\n" + flow("0001", "0002", "00000", "0000001") + f"\nRT00000017DS{fare:08d}\nRT00000017DC{fare:08d}\n"
        )
    for year, receipts in (("base", 10), ("current", 11)):
        (root / f"advance_{year}.csv").write_text(f"{PLACES},class,NetReceiptSterling,Issues\n3,4,0,1,{receipts},2\n")
        (root / f"non_advance_{year}.csv").write_text(
            f'{PLACES},Product Code,NetReceiptSterling,Issues\n1,2,0,2BAF,"£{receipts},000.00",100\n1,2,0,2MTA,999,1\nA01,2,0,2BAF,"{receipts}",1\n'
        )
    return root


def inputs_of(folders):
    return ingest.Inputs(
        sales=str(folders / "sales"), regulated=str(folders / "regulated.csv"), categories=str(folders / "categories.csv"),
        tickets=str(folders / "tickets.csv"), feed_base=str(folders / "feed_base.txt"), feed_current=str(folders / "feed_current.txt"),
        advance_base=str(folders / "advance_base.csv"), advance_current=str(folders / "advance_current.csv"),
        non_advance_base=str(folders / "non_advance_base.csv"), non_advance_current=str(folders / "non_advance_current.csv"),
    )


@pytest.fixture(scope="module")
def results(spark, folders):
    out = str(folders / "out")
    stage1 = ingest.run(spark, inputs_of(folders), f"{out}/stage1", "r1")
    stage2 = report.run(spark, f"{out}/stage1", f"{out}/stage2", "r1")
    return {**stage1, **stage2}


def test_fact(results):
    fact = results["fact"]
    assert fact.columns == ingest.FACT_COLUMNS
    rows = {(r["product"], r.origin): r for r in fact.collect()}
    assert fact.count() == 7 and ("9XYZ", "0001") not in rows
    assert (rows["2MTA", "0001"].status, rows["2MTA", "0001"].category) == ("Regulated", "season")
    assert rows["2BAF", "0001"].status == "Regulated" and rows["2BAF", "0A01"].status == "Unregulated"
    assert (rows["1ADV", "0003"].status, rows["1ADV", "0003"]["class"]) == ("Unregulated", "1")
    audit = {(r["product"], r.origin): r.status_pcc for r in results["status_audit"].collect()}
    assert audit["2BAF", "0001"] == "Regulated_by_TOC" and audit["1ADV", "0003"] == "Unregulated_by_PCC"
    new = rows["2NEW", "0001"]
    assert (new.sector, new.ticket_type, new.category) == ("Missing", "Other", "Missing")


def test_control_totals_match_the_input(results):
    totals = {r.carrier: (float(r.weight), r.journeys) for r in results["control_totals"].collect()}
    assert totals == {"EK": (601050.0, 31.0), "HM": (425.0, 5.0), "??": (40.0, 4.0)}


def test_missing_reports(results):
    assert [tuple(r) for r in results["missing_categories"].collect()] == [("2NEW", "PG09")]
    assert results["missing_sectors"].count() == 1
    assert results["regulated_duplicates"].count() == 0
    assert results["status_check"].count() == 6


def test_advance(results):
    row, = results["advance"].collect()
    assert (float(row.weight), row.journeys) == (400.0, 4.0)
    assert (row.price_base, row.price_current, row.change) == (500.0, 550.0, pytest.approx(10.0))


def test_non_advance(results):
    rows = {(r["product"], r.origin): (r.price_base, r.price_current, r.change) for r in results["non_advance"].collect()}
    assert rows == {
        ("2MTA", "0001"): (2000.0, 2100.0, pytest.approx(5.0)),
        ("2BAF", "0001"): (10000.0, 11000.0, pytest.approx(10.0)),
        ("2BAF", "0A01"): (1000.0, 1100.0, pytest.approx(10.0)),
        ("2MTC", "0001"): (2000.0, 2100.0, pytest.approx(5.0)),
    }


def test_review_sets(results):
    assert [r["product"] for r in results["heavy_rows"].collect()] == ["2BAF"]
    assert results["large_rises"].isEmpty() and results["large_falls"].isEmpty()
    assert results["list_base_conflicts"].isEmpty()


def test_grid(results):
    grid = {(r.sector, r["class"], r.category, r.status): r for r in results["cell_grid"].collect()}
    season = grid["Lon SE", "2", "season", "Regulated"]
    assert (float(season.priced_weight), float(season.total_weight), season.weighted_change) == (1000.0, 1000.0, pytest.approx(5.0))
    # The place with a letter is unregulated; it has a weight but takes no part in the change.
    assert grid["Lon SE", "2", "anytime", "Unregulated"].weighted_change is None
    assert float(grid["Long D", "2", "season", "Unregulated"].total_weight) == 25.0
    assert grid["Long D", "2", "season", "Unregulated"].weighted_change is None
    assert grid["Missing", "2", "Missing", "Unregulated"].weighted_change is None


def test_split_report(results):
    report_rows = {(r.split, r.part): r for r in results["split_report"].collect()}
    part = report_rows["sector1", "Lon SE"]
    assert part.average_change == pytest.approx((1000 * 5 + 600000 * 10) / 601050)
    assert part.share == pytest.approx(601050 / 601515)
    assert report_rows["sector2", "Lon SE"].average_change == part.average_change


def test_large_inputs_give_the_same(without_broadcast, folders, results):
    """With so few rows every key counts as hot, so this also takes the spread path of every join."""
    again = ingest.run(without_broadcast, inputs_of(folders), str(folders / "out/again"), "r1")
    for name, df in again.items():
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, results[name].collect())), name


@pytest.mark.parametrize("published", [False, True])
def test_publish(spark, results, folders, published):
    load_column = "Load_ID" if published else "load_id"
    warehouse = {kind.name: str(folders / f"warehouse_{kind.name}_{published}") for kind in (series.BY_SECTOR, series.BY_TICKET_TYPE)}
    columns = "load_id int, publication_status string, sector string, ticket_category string, category_order int, label string, label_order int, value double"
    for kind, sector, total, deflator in (
        (series.BY_SECTOR, "London and South East", "All operators", ("RPI", "All items index")),
        (series.BY_TICKET_TYPE, "London and SE operators", "All tickets", ("RPI (all items)", "RPI (all items)")),
    ):
        labels = kind.statistics(2018)
        rows = []
        for order, (s, category, stats) in enumerate(((sector, "All tickets", labels), (total, "All tickets", labels), (*deflator, labels[:1]))):
            rows += [(4, "Approved", s, category, order, "January 2017", 17, 100.0), (4, "Approved", s, category, order, "January 2018", 18, 110.0)]
            rows += [(4, "Approved", s, category, order, label, 19 + i, 1.0) for i, label in enumerate(stats)]
        first = spark.createDataFrame(rows, columns)
        tables.append_load(tables.published_series(first, kind.name) if published else first, warehouse[kind.name], load_column)

    keys = spark.createDataFrame(
        [("Lon SE", "London and South East", "All tickets"), ("Lon SE", "London and SE operators", "All tickets")],
        "part string, sector string, ticket_category string",
    )
    usage = spark.createDataFrame(
        [(2002 + i // 4, f"{2002 + i // 4}-{(3 + i // 4):02d} Quarter {i % 4 + 1}", 1.0, 2.0, 3.0, 4.0, 1, "published") for i in range(12)],
        "financial_year_key int, year_and_quarter string, `Long-distance` double, `London and South East` double, Regional double, "
        "`Non-franchised` double, source_item_id int, publication_status string",
    )
    written = publish.run(spark, warehouse, results["split_report"], keys, usage, usage, str(folders / f"out/stage3_{published}"), "r1", 2.5, 2019)
    change = results["split_report"].where("split = 'sector1' and part = 'Lon SE'").first().average_change
    new = written["ticket_type"].where("sector = 'London and SE operators' and label = 'January 2019'").first()
    assert new.value == pytest.approx(110 * (1 + change / 100))
    # Two of the three sectors are missing, so there is no total.
    assert written["ticket_type"].where("sector = 'All tickets' and label = 'January 2019'").first().value is None
    # A second year goes on from the first, and nothing of either is lost.
    publish.run(spark, warehouse, results["split_report"], keys, usage, usage, str(folders / f"out/stage3_{published}"), "r2", 2.5, 2020)
    loaded = tables.read_warehouse(spark, warehouse["ticket_category"])
    assert ("Year & stats" in loaded.columns) == published
    assert not loaded.where(" OR ".join(f"`{c}` IS NULL" for c in loaded.columns if c != "value")).count()
    plain = tables.plain_series(loaded, "ticket_category")
    assert sorted(r.load_id for r in plain.select("load_id").distinct().collect()) == [4, 5, 6]
    assert plain.where("load_id = 5").count() == written["ticket_category"].count()
    assert plain.where("load_id = 6 AND label = 'January 2020'").count() > 0
    with pytest.raises(ValueError, match="already"):
        tables.append_load(loaded.where(F.col(load_column) == 5), warehouse["ticket_category"], load_column)
    # The load to go on from can be chosen, and must be there.
    with pytest.raises(ValueError, match="no load 9"):
        publish.run(spark, warehouse, results["split_report"], keys, usage, usage, str(folders / f"out/stage3_{published}"), "r3", 2.5, 2019, load_id=9)
    again = publish.run(spark, warehouse, results["split_report"], keys, usage, usage, str(folders / f"out/stage3_{published}"), "r4", 2.5, 2019, load=False, load_id=4)
    assert again["ticket_type"].count() == written["ticket_type"].count()
    # The same from files: the report of the latest completed run, the key lookup and the usage views.
    files = folders / f"stage3_inputs_{published}"
    names = {to: name for name, to in delimited.SERIES_KEY_HEADER.items()}
    keys.withColumnsRenamed(names).write.option("header", True).csv(str(files / "keys"))
    usage.withColumn("another", F.lit("x")).write.parquet(str(files / "usage"))
    sources = publish.Sources(str(folders / "out/stage2"), str(files / "keys"), str(files / "usage"), str(files / "usage"), warehouse)
    tables.write_run(results["split_report"].limit(0), str(folders / "out/stage2"), "split_report", f"r9_{published}")  # not completed, so not read
    found = publish.run_from(spark, sources, str(folders / f"out/stage3_{published}"), "r5", 2.5, 2019, load=False, load_id=4)
    for name, df in found.items():
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, again[name].collect()))


def test_reviews(results):
    assert [tuple(r) for r in results["product_check"].collect()] == [("2BAF", "0001", "0002", Decimal(600000))]
    assert {tuple(r) for r in results["season_by_sector_product"].collect()} == {("Lon SE", "2MTA", Decimal(1000)), ("Long D", "2MTC", Decimal(25))}
    combined = results["list_base_combined"].orderBy("ticket_code").collect()
    assert [(r.origin, r.flow_id, r.carrier, r.ticket_code, r.fare, r["product"]) for r in combined] == [
        ("0001", "0000001", "ATO", "7DC", 2000, "2MTC"), ("0001", "0000001", "ATO", "7DS", 2000, "2MTA"),
    ]


def test_lookup_versions(spark, folders, tmp_path):
    (tmp_path / "old.csv").write_text("orig,dest,route,ticketa,flaga,ticket,flag2\n1,2,0,x,x,2BAF,OLD\n9,9,0,x,x,2MTA,OLD\n")
    found = ingest.compare_regulated(spark, str(folders / "regulated.csv"), str(tmp_path / "old.csv"), str(tmp_path / "out"), "r1")
    assert found["regulated_only_new"].count() == 0
    assert [(r.origin, r["product"]) for r in found["regulated_only_old"].collect()] == [("0009", "2MTA")]


def test_a_corrected_extract_is_the_only_one_read(spark, folders, results, tmp_path):
    """The reports of stage 1 from sums per extract; unchanged extracts are not opened again."""
    sales = tmp_path / "sales"
    sales.mkdir()
    texts = {"one.csv": (folders / "sales/one.csv").read_bytes(), "odd {6} [a,b] é+%.csv": (folders / "sales/two.csv").read_bytes()}
    for name, text in texts.items():
        (sales / name).write_bytes(text)
    lookups = str(folders / "regulated.csv"), str(folders / "categories.csv")

    def reports(run_id):
        return increments.run(spark, str(sales), *lookups, str(tmp_path / "store"), str(tmp_path / "out"), run_id)

    first = reports("r1")
    for name in ("control_totals", "revenue_by_product", "revenue_by_segment", "season_by_sector_product"):
        assert Counter(map(tuple, first[name].collect())) == Counter(map(tuple, results[name].collect())), name
    # One extract is corrected; of the other only its size and time are as they were, so reading it would fail.
    kept = sales / "odd {6} [a,b] é+%.csv"
    at = kept.stat()
    kept.write_bytes(b"?" * at.st_size)
    os.utime(kept, ns=(at.st_atime_ns, at.st_mtime_ns))
    (sales / "one.csv").write_bytes(texts["one.csv"].replace(b"1,000.00", b"1,500.00"))
    (sales / "three.csv").write_bytes((SALES + "ES,1,2,0,2BAF,PG01,7,1\n").encode())
    totals = {r.carrier: r.weight for r in reports("r2")["control_totals"].collect()}
    before = {r.carrier: r.weight for r in first["control_totals"].collect()}
    assert totals == before | {"EK": before["EK"] + 500, "ES": 7}
    # One that is gone drops out; the former version of another comes back without being read, as its sums are still there.
    (sales / "three.csv").unlink()
    assert {r.carrier: r.weight for r in reports("r3")["control_totals"].collect()} == before | {"EK": before["EK"] + 500}
    # A lookup that changed makes all of them new.
    changed = tmp_path / "regulated.csv"
    changed.write_text((folders / "regulated.csv").read_text().replace("SWT", "XXX"))
    with pytest.raises(AnalysisException, match="carrier_toc_code"):
        increments.run(spark, str(sales), str(changed), lookups[1], str(tmp_path / "store"), str(tmp_path / "out"), "r4")
