import datetime as dt
from decimal import Decimal
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from indexloom.operators import prices
from indexloom.plans import ingest
from indexloom.sources import delimited, feed, tables

SALES = "carrier_toc_code,origin_code,destination_code,route_code,product_code,pro_group_1_code,adjusted_earnings,operating_journeys,extra\n"


def test_sales_of_many_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes((SALES + 'EK,12,345,7,2MTA,PG04,"£1,234.50","1,000",x\n').encode("windows-1252"))
    (tmp_path / "b.csv").write_bytes((SALES + "EC,1234,5678,12345,2ABC,PG01,5,2.5,x\n").encode("windows-1252"))
    rows = {r.carrier: r for r in delimited.read_sales(spark, str(tmp_path)).collect()}
    assert (rows["EK"].origin, rows["EK"].destination, rows["EK"].route) == ("0012", "0345", "00007")
    assert (rows["EK"].weight, rows["EK"].journeys) == (Decimal("1234.5"), 1000.0)
    assert rows["EC"].journeys == 2.5
    assert "extra" not in rows["EK"].asDict()


def test_files_with_their_columns_in_another_order(spark, tmp_path):
    folder = tmp_path / "in a folder"
    folder.mkdir()
    (folder / "a.csv").write_text(SALES + "EK,12,345,7,2MTA,PG04,1,1,x\n")
    swapped = SALES.replace("carrier_toc_code,origin_code", "origin_code,carrier_toc_code")
    (folder / "b.csv").write_text(swapped + "13,EC,345,7,2MTA,PG04,1,1,x\n")
    (folder / "c.csv").write_text(SALES.replace(",extra", "") + "EM,14,345,7,2MTA,PG04,1,1\n")
    (folder / "d.csv").write_text("")
    rows = delimited.read_sales(spark, str(folder)).collect()
    assert sorted((r.carrier, r.origin) for r in rows) == [("EC", "0013"), ("EK", "0012"), ("EM", "0014")]
    (folder / "e.csv").write_text(SALES.replace("carrier_toc_code", "carrier") + "EK,12,345,7,2MTA,PG04,1,1,x\n")
    with pytest.raises(AnalysisException, match="carrier_toc_code"):
        delimited.read_sales(spark, str(folder))


def test_headers_of_many_files_take_few_jobs(spark, tmp_path):
    """2,000 files of three column orders; jobs are counted up to the query itself."""
    names = SALES.strip().split(",")
    orders = [names, names[::-1], [*names[3:], *names[:3]]]
    value = dict.fromkeys(names, "1") | {"carrier_toc_code": "EK", "product_code": "2MTA"}
    for i in range(2000):
        order = orders[i % 3]
        name = f"f{i}.csv" if i > 5 else f"odd {{{i}}} [a,b]*.csv"
        (tmp_path / name).write_text(",".join(order) + "\n" + ",".join({**value, "origin_code": str(i)}[n] for n in order) + "\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    rows = delimited.read_sales(spark, str(tmp_path))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs <= 3
    assert sorted(r.origin for r in rows.collect()) == sorted(str(i).zfill(4) for i in range(2000))


def test_first_lines_of_large_files(spark, tmp_path, monkeypatch):
    """Large files are read one to a task, up to their first filled line; both ways give the same."""
    (tmp_path / "a.csv").write_bytes(b"\r\n \n\xa3 a,b\r\n" + b"1,2\n" * 50_000)
    (tmp_path / "b.csv").write_bytes(b'"x, y",z\n')
    (tmp_path / "c.csv").write_bytes(b"\n\n")
    found = []
    for limit in (1 << 30, 0):
        monkeypatch.setattr(delimited, "SCANNED_BYTES", limit)
        found.append({n: [f.rpartition("/")[2] for f in files] for n, files in delimited.header_index(spark, str(tmp_path), "windows-1252").items()})
    assert found[0] == found[1] == {("x, y", "z"): ["b.csv"], ("\xa3 a", "b"): ["a.csv"]}
    assert int(spark.conf.get("spark.sql.files.openCostInBytes").rstrip("b")) == 4 << 20


def test_the_first_entry_of_several_lookup_files(spark, tmp_path):
    """The order of files is that of their names, not of their sizes, also where they are split."""
    (tmp_path / "a.csv").write_text("code,product\nX,first\n")
    (tmp_path / "b.csv").write_text("code,product\n" + "".join(f"Y{i},b{i}\n" for i in range(5000)) + "X,second\nY7,late\n")
    (tmp_path / "c.csv").write_text("code,product\nX,third\nY8,third\nZ,only\n")
    seen = []
    for size in ("128m", "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            tickets = delimited.read_ticket_lookup(spark, str(tmp_path), "code", "product")
            found = {r.ticket_code: r["product"] for r in prices.keep_first(tickets, ["ticket_code"], ["lookup_seq"]).collect()}
            rows = tickets.orderBy("lookup_seq").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(found) == 5002 and (found["X"], found["Y7"], found["Y8"], found["Z"]) == ("first", "b7", "b8", "only")
        seen.append([(r.ticket_code, r["product"]) for r in rows])
        assert [r.lookup_seq for r in rows] == list(range(5006))
    assert seen[0] == seen[1] == [("X", "first"), *((f"Y{i}", f"b{i}") for i in range(5000)), ("X", "second"), ("Y7", "late"), ("X", "third"), ("Y8", "third"), ("Z", "only")]


def test_files_of_several_folders(spark, tmp_path):
    for k, order in (("1", "a,b"), ("2", "b,a")):
        (tmp_path / f"k={k}").mkdir()
        (tmp_path / f"k={k}" / "same.csv").write_text(f"{order}\n" + ",".join(n + k for n in order.split(",")) + "\n")
    rows = delimited.read_named_csv(spark, str(tmp_path), {"a": "x", "b": "y"}).collect()
    assert sorted(map(tuple, rows)) == [("a1", "b1"), ("a2", "b2")]


def test_price_files(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('Origin Code,Destination Code,Route Code,Product Code,NetReceiptSterling,Issues\n1,2,3,2AAA,"£1,200.00",100\n1,2,4,2AAA,5,"1,234"\n1,2,5,2AAA,n/a,1\n1,2,6,2AAA,5,0\n')
    rows = {r.route: r.price for r in delimited.read_price_file(spark, str(path), "non-advance", "price").collect()}
    assert rows == {"00003": 1200.0, "00004": None, "00005": None, "00006": None}
    with pytest.raises(ValueError):
        delimited.read_price_file(spark, str(path), "advanced", "price")


def flow(origin="1072", until="31122999", flow_id="0000001"):
    return f"RF{origin}0032" + "01000" + "000" + "A" + "S" + until + "01012019" + "ATO" + "000" + flow_id


FEED = "\n".join(
    [
        "/!! comment", flow(), flow(until="31122098", flow_id="0000002"), flow(until="31122999", flow_id="0000003"),
        "RT0000001" + "SDS" + "00000500", "RT0000001" + "SDR" + "00000900", "RT0000002" + "SDS" + "00000400",
        "RT0000003" + "SDS" + "00000520", "RT0000003" + "SDR" + "00000900",
    ]
)


@pytest.fixture
def lines(spark, tmp_path):
    (tmp_path / "feed.txt").write_text(FEED + "\n")
    return feed.read_feed(spark, str(tmp_path / "feed.txt"))


def test_flows(lines):
    rows = feed.parse_flows(lines).orderBy("seq").collect()
    first = rows[0]
    assert (first.origin, first.destination, first.route, first.status_code) == ("1072", "0032", "01000", "000")
    assert (first.usage_code, first.direction, first.carrier, first.flow_id) == ("A", "S", "ATO", "0000001")
    assert (first.valid_until, first.valid_from) == ("31122999", "01012019")
    assert [r.valid_until_date for r in rows] == [dt.date(2100, 12, 31), dt.date(2098, 12, 31), dt.date(2100, 12, 31)]


def test_fares(lines):
    rows = feed.parse_fares(lines).orderBy("seq").collect()
    assert [(r.flow_id, r.ticket_code, r.fare) for r in rows][:2] == [("0000001", "SDS", 500), ("0000001", "SDR", 900)]
    assert len(rows) == 5


def test_list_prices(spark, lines):
    tickets = spark.createDataFrame([("SDS", "2AAA", 0), ("SDS", "2AAB", 1), ("SDR", "2BAF", 2)], "ticket_code string, product string, lookup_seq long")
    found = ingest.list_prices(lines, tickets)
    # Flow 2 has expired. The return fare is the same on flows 1 and 3 and stays once; the single fare differs.
    assert sorted((r["product"], r.fare) for r in found["prices"].collect()) == [("2AAA", 500.0), ("2AAA", 520.0), ("2BAF", 900.0)]
    assert sorted((r.flow_id, r.fare) for r in found["conflicts"].collect()) == [("0000001", 500), ("0000003", 520)]


def test_feed_order_over_many_blocks(spark, tmp_path):
    """The first of equal rows in file order is kept, also when the file is read in pieces."""
    records = [flow(flow_id=f"{i:07d}") for i in range(1, 2001)] + [f"RT{i:07d}SDS00000500" for i in range(1, 2001)]
    (tmp_path / "feed.txt").write_text("\n".join(records) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = feed.read_feed(spark, str(tmp_path / "feed.txt"))
        tickets = spark.createDataFrame([("SDS", "2AAA", 0)], "ticket_code string, product string, lookup_seq long")
        flows = feed.parse_flows(read)
        assert read.rdd.getNumPartitions() > 4
        kept = ingest.list_prices(read, tickets)["prices"].collect()
        first = flows.orderBy("file", "block", "seq").first().flow_id
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(kept) == 1 and first == "0000001"


def test_runs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.write_run(df, str(tmp_path), "t", "20200101_10-00")
    back = tables.write_run(df.withColumn("v", F.lit("b")), str(tmp_path), "t", "20200102_10-00")
    assert back.schema == df.schema and back.first().v == "b"
    assert tables.read_run(spark, str(tmp_path), "t").first().v == "b"
    assert tables.read_run(spark, str(tmp_path), "t", "20200101_10-00").first().v == "a"
    assert tables.write_run(df, str(tmp_path), "c", "r", "csv").first().v == "a"


def test_run_id():
    one, two = (tables.new_run_id(dt.datetime(2020, 4, 9, 10, 15, 7)) for _ in range(2))
    assert one.startswith("20200409_10-15-07_") and one != two


def test_runs_are_found_by_their_text(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.write_run(df, root, "t", "001")
    tables.write_run(df.limit(0), root, "t", "002")
    assert tables.read_run(spark, root, "t", "001").first().v == "a"
    # The latest run is the latest also if it has no rows.
    assert tables.read_run(spark, root, "t").isEmpty()
    with pytest.raises(ValueError):
        tables.read_run(spark, root, "t", "1")
    with pytest.raises(AnalysisException):
        tables.write_run(df, root, "t", "001")


def test_only_completed_runs_are_taken(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        tables.completed_run(spark, root)
    tables.complete_run(spark, root, "007")
    tables.write_run(spark.createDataFrame([(1,)], "k int"), root, "fact", "008")
    assert tables.completed_run(spark, root) == "007"
    with pytest.raises(ValueError):
        tables.completed_run(spark, root, "008")


def test_a_load_of_other_columns_is_refused(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    tables.append_load(spark.createDataFrame([(1, "x", 1.0)], "Load_ID int, `Year & stats` string, value double"), path, "Load_ID")
    with pytest.raises(ValueError, match="columns"):
        tables.append_load(spark.createDataFrame([(2, "x", 1.0)], "Load_ID int, label string, value double"), path, "Load_ID")
    assert tables.read_warehouse(spark, path).count() == 1


def test_feed_lines_that_are_no_fare(spark, tmp_path):
    text = (tmp_path / "feed.txt")
    text.write_text("RF0001000200003000\n\nRT0000001ABC00001000\nEND OF FILE\n")
    lines = feed.read_feed(spark, str(text))
    assert [r.fare for r in feed.parse_fares(lines).orderBy("seq").collect()] == [1000, None]
    assert [r.line for r in feed.rejected_lines(lines).collect()] == ["END OF FILE"]
    with pytest.raises(Exception, match="no number"):
        feed.checked_fares(feed.parse_fares(lines)).collect()


def test_loads(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    load = lambda n: spark.createDataFrame([(n, float(n))], "load_id int, value double")
    tables.append_load(load(1), path)
    tables.append_load(load(2), path)
    with pytest.raises(ValueError):
        tables.append_load(load(2), path)
    with pytest.raises(ValueError):
        tables.append_load(load(3).union(load(4)), path)
    table = tables.read_warehouse(spark, path)
    assert table.count() == 2
    assert tables.max_load_id(table).first().load_id == 2
    assert tables.latest_snapshot(table).first().value == 2.0
    assert tables.snapshot(table, 1).first().value == 1.0


def test_series_keys(spark, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text("final_answers,Sector,Ticket category\n\"('Long D', '1')\",Long distance,First class\n")
    assert tuple(delimited.read_series_keys(spark, str(path)).first()) == ("('Long D', '1')", "Long distance", "First class")


@pytest.mark.parametrize("kind, order", [("ticket_category", "ordering of year & stats"), ("ticket_type", "ordering value of year and stats")])
def test_series_column_names(spark, kind, order):
    names = "load_id int, publication_status string, sector string, ticket_category string, category_order int, label string, label_order int, value double"
    plain = spark.createDataFrame([(1, "Approved", "s", "c", 1, "January 2018", 2, 3.0)], names)
    published = tables.published_series(plain, kind)
    assert published.columns[6] == order and "Year & stats" in published.columns
    assert tables.plain_series(published, kind).schema == plain.schema
    assert tables.plain_series(plain, kind).schema == plain.schema


def test_one_of_two_loaders_wins(spark, tmp_path):
    """Loaders of one load id at once, from several threads; later ones are refused as well."""
    path = str(tmp_path / "w")
    loads = [spark.range(50).selectExpr("5 AS load_id", f"id + {1000 * i} AS value") for i in range(4)]

    def append(df):
        try:
            tables.append_load(df, path)
        except ValueError as e:
            return str(e)

    with ThreadPool(4) as pool:
        told = pool.map(append, loads)
    assert told.count(None) == 1
    rows = [r["value"] for r in spark.read.parquet(path).collect()]
    assert len(rows) == 50 and {v // 1000 for v in rows} == {told.index(None)}
    with pytest.raises(ValueError, match="already"):
        tables.append_load(loads[0], path)
    tables.append_load(loads[0].withColumn("load_id", F.lit(12)), path)
    assert tables.newest_load(spark, path) == 12 and spark.read.parquet(path).count() == 100


def test_a_claim_of_a_dead_loader_is_told(spark, tmp_path):
    path = str(tmp_path / "w")
    assert tables.claim(spark, f"{path}/_claims/load_id=5")
    assert not tables.claim(spark, f"{path}/_claims/load_id=5", patience=0.5)
    with pytest.raises(ValueError, match="_claims"):
        tables.append_load(spark.range(3).selectExpr("5 AS load_id", "id"), path)


def test_the_newest_load_opens_no_table_file(spark, tmp_path):
    for i in (2, 10, 9):
        tables.append_load(spark.range(3).selectExpr(f"{i} AS load_id", "id"), str(tmp_path / "w"))
    (tmp_path / "w" / "load_id=10" / "part-broken.parquet").write_bytes(b"no parquet at all")
    assert tables.newest_load(spark, str(tmp_path / "w")) == 10
