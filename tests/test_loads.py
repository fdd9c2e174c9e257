"""Whole loads, in batch and as streams."""

import csv
import gzip
import json
import os
from dataclasses import replace
from pathlib import Path

import pytest

from shelfwise import registry
from shelfwise.operators.forecast import REPORT_COLUMNS, REPORT_SCHEMA
from shelfwise.plans import etl, gold
from shelfwise.plans.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG
from shelfwise.sources import scratch
from shelfwise.sources.landing import (
    read_bronze,
    read_duplicates,
    read_landing,
    read_quarantine,
    read_report,
    write_landing,
    write_report,
)
from shelfwise.sources.silver import read_silver
from shelfwise.streaming.ingest import ingest_landing, ingest_messages
from shelfwise.streaming.messages import publish, read_landing_stream, to_messages

OPTIONS = etl.LoadOptions(as_of="2026-07-28", stamp="2026-07-28 00:00:00")
CATALOG = [
    ["S1", " I1 ", "wireless MOUSE", "toys", "10.5", "3"],
    ["S1", "I1", "wireless MOUSE", "toys", "9.5", "3"],
    ["S2", "I2", "lamp", "HOME goods", "4", ""],
    ["S2", "I3", "lamp", "", "4", "1"],
    ["S3", "I1", "x", "toys", "abc", "1"],
]
COMPANY = [["I1", "5", "50", "2026-07-01"], ["I2", "7", "70", "2026-7-2"], ["I3", "-1", "1", "2026-07-01"]]
COMPETITOR = [
    ["I1", "S9", "4", "40", "10", "2026-07-01"],
    ["I1", "S9", "6", "60", "10", "2026-07-01"],
    ["I2", "", "4", "40", "10", "2026-07-01"],
]


def land(path, spec, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(spec.columns)
        writer.writerows(rows)
    return str(path)


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_batch_loads_and_report(spark, tmp_path):
    lake = etl.Lake(str(tmp_path / "lake"))
    for _ in range(2):  # a rerun leaves the same lake
        for spec, rows in ((SELLER_CATALOG, CATALOG), (COMPANY_SALES, COMPANY), (COMPETITOR_SALES, COMPETITOR)):
            path = land(tmp_path / "landing" / f"{spec.name}.csv", spec, rows)
            etl.load_landing(spark, path, spec, lake, "b1", OPTIONS)
    catalog = read_silver(spark, lake.silver(SELLER_CATALOG))
    assert [tuple(r)[:4] for r in catalog.select(*SELLER_CATALOG.columns).orderBy("seller_id").collect()] == [
        ("S1", "I1", "Wireless Mouse", "Toys"), ("S2", "I2", "Lamp", "Home Goods"),
    ]
    assert catalog.where("seller_id = 'S1'").first()["marketplace_price"] == 9.5
    assert str(catalog.first()["ingestion_time"]) == "2026-07-28 00:00:00"
    reasons = {s.name: sorted(r["dq_failure_reason"] for r in read_quarantine(spark, lake.quarantine, s.name).collect())
               for s in (SELLER_CATALOG, COMPANY_SALES, COMPETITOR_SALES)}
    assert reasons == {
        "seller_catalog": ["missing_category", "price_negative"],
        "company_sales": ["units_negative"],
        "competitor_sales": ["missing_seller_id"],
    }
    market = read_silver(spark, lake.silver(COMPETITOR_SALES)).collect()
    assert [(r["item_id"], r["units_sold"]) for r in market] == [("I1", 6)]
    gold.publish_report(spark, lake)
    assert [tuple(r) for r in read_report(spark, lake.report, REPORT_SCHEMA).orderBy("seller_id").collect()] == [
        ("S1", "I2", "Lamp", "Home Goods", 19.99, 7.0, 7.0 * 19.99),
        ("S2", "I1", "Wireless Mouse", "Toys", 10.0, 6.0, 60.0),
    ]
    header = next(Path(lake.report).glob("part-*.csv")).read_text().splitlines()[0]
    assert header == ",".join(REPORT_COLUMNS)


def test_later_batch_updates_the_lake(spark, tmp_path):
    lake = etl.Lake(str(tmp_path / "lake"))
    first = land(tmp_path / "1.csv", SELLER_CATALOG, CATALOG[:1])
    etl.load_landing(spark, first, SELLER_CATALOG, lake, "b1", OPTIONS)
    second = land(tmp_path / "2.csv", SELLER_CATALOG, [["S1", "I1", "mouse", "toys", "8", "2"]])
    etl.load_landing(spark, second, SELLER_CATALOG, lake, "b2", etl.LoadOptions())
    rows = read_silver(spark, lake.silver(SELLER_CATALOG)).collect()
    assert [(r["item_name"], r["marketplace_price"]) for r in rows] == [("Mouse", 8.0)]
    assert read_bronze(spark, lake.bronze(SELLER_CATALOG)).count() == 1


def test_landing_text_stays_raw(spark, tmp_path):
    path = land(tmp_path / "a.csv", COMPANY_SALES, [["007", " 5", "", "2026-07-01"]])
    assert tuple(read_landing(spark, path).first()) == ("007", " 5", None, "2026-07-01")
    assert read_landing(spark, path, infer=True).schema["item_id"].dataType.simpleString() == "int"


def test_inferred_landing_loads_alike(spark, tmp_path):
    path = land(tmp_path / "a.csv", COMPANY_SALES, COMPANY)
    lakes = []
    for infer in (False, True):
        lake = etl.Lake(str(tmp_path / f"lake{infer}"))
        etl.load_landing(spark, path, COMPANY_SALES, lake, "b", replace(OPTIONS, infer=infer))
        lakes.append(rows_of(read_silver(spark, lake.silver(COMPANY_SALES)), *COMPANY_SALES.columns))
    assert lakes[0] == lakes[1] and len(lakes[0]) == 2


def test_report_texts_survive_csv(spark, tmp_path):
    rows = [("", "a,b", 'say "x"', None, 0.1 + 0.2, 1.0, None)]
    df = spark.createDataFrame(rows, REPORT_SCHEMA)
    write_report(df, str(tmp_path / "r"))
    assert [tuple(r) for r in read_report(spark, str(tmp_path / "r"), REPORT_SCHEMA).collect()] == rows


def test_stream_equals_batch_and_files_are_archived(spark, tmp_path):
    catalog = [[f"S{i % 9}", f"I{i}", f"name {i}", f"cat {i % 3}", str(i - 2), str(i)] for i in range(60)]
    batch, stream = etl.Lake(str(tmp_path / "batch")), etl.Lake(str(tmp_path / "stream"))
    etl.load_landing(spark, land(tmp_path / "all.csv", SELLER_CATALOG, catalog), SELLER_CATALOG, batch, "b", OPTIONS)
    landing, archive = tmp_path / "landing", tmp_path / "archive"

    def run():
        ingest_landing(
            spark, str(landing), SELLER_CATALOG, stream, str(tmp_path / "ckpt"), OPTIONS, 1, str(archive)
        ).awaitTermination()

    for n in range(3):
        land(landing / f"{n}.csv", SELLER_CATALOG, catalog[20 * n : 20 * n + 20])
    run()
    columns = SELLER_CATALOG.columns
    tables = [rows_of(read_silver(spark, lake.silver(SELLER_CATALOG)), *columns) for lake in (batch, stream)]
    assert tables[0] == tables[1] and len(tables[0]) == 58
    audits = [
        sorted(r["original_record"] for r in read_quarantine(spark, lake.quarantine, "seller_catalog").collect())
        for lake in (batch, stream)
    ]
    assert audits[0] == audits[1] and len(audits[0]) == 2
    # Only the new file is loaded by the next run, and it updates its row.
    land(landing / "3.csv", SELLER_CATALOG, [["S5", "I5", "renamed", "cat 2", "1", "1"]])
    run()
    table = read_silver(spark, stream.silver(SELLER_CATALOG))
    assert table.count() == 58
    assert table.where("item_id = 'I5'").first()["item_name"] == "Renamed"
    assert sum(1 for _ in archive.rglob("*.csv")) >= 3


def test_messages_hold_every_field_as_text(spark, tmp_path):
    land(tmp_path / "landing" / "c.csv", COMPANY_SALES, [["I1", "5", "", "2026-07-01"]])
    rows = read_landing_stream(spark, str(tmp_path / "landing"), COMPANY_SALES)
    publish(to_messages(rows), str(tmp_path / "ckpt"), "text", {"path": str(tmp_path / "topic")}).awaitTermination()
    values = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "topic")).collect()]
    assert values == [{"item_id": "I1", "units_sold": "5", "revenue": "", "sale_date": "2026-07-01"}]


def test_doubled_quotes_in_a_message_feed(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    head = ",".join(COMPANY_SALES.columns)
    (tmp_path / "landing" / "c.csv").write_text(f'{head}\n"5"" mount, black",1,2.0,2026-07-01\n')
    rows = read_landing_stream(spark, str(tmp_path / "landing"), COMPANY_SALES, doubled_quotes=True)
    publish(to_messages(rows), str(tmp_path / "ckpt"), "text", {"path": str(tmp_path / "topic")}).awaitTermination()
    (value,) = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "topic")).collect()]
    assert value["item_id"] == '5" mount, black' and value["units_sold"] == "1"


def test_loads_and_a_report_leave_no_scratch_tables(spark, tmp_path):
    lake = etl.Lake(str(tmp_path / "lake"))
    root = scratch.scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    feeds = ((SELLER_CATALOG, CATALOG), (COMPANY_SALES, COMPANY), (COMPETITOR_SALES, COMPETITOR))
    for batch in ("first", "second"):
        for spec, rows in feeds:
            path = land(tmp_path / f"{spec.name}.csv", spec, rows)
            etl.load_landing(spark, path, spec, lake, batch, OPTIONS)
    gold.publish_report(spark, lake)
    assert set(os.listdir(root)) == before


def test_write_landing_keeps_spaces(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "   ", None)], "x string, y string, z string")
    write_landing(df, str(tmp_path / "l"))
    assert tuple(read_landing(spark, str(tmp_path / "l")).first()) == (" a ", "   ", None)


def test_scratch_is_the_cluster_folder(spark, monkeypatch):
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch.scratch_root(Session())
    Context.master = "local[2]"
    assert scratch.scratch_root(Session()) == scratch.scratch_root(Session())


def test_columns_follow_the_header(spark, tmp_path):
    from shelfwise.streaming.messages import read_landing_stream

    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "item_id,sale_date,units_sold,revenue,channel\nI1,2026-01-01,5,10.0,web\n"
    )
    expected = {"item_id": "I1", "units_sold": "5", "revenue": "10.0", "channel": "web"}
    stream = read_landing_stream(spark, str(folder), COMPANY_SALES)
    query = (
        stream.writeStream.format("memory").queryName("by_header")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    for rows in (spark.table("by_header"), read_landing(spark, str(folder))):
        (row,) = rows.collect()
        assert {c: row[c] for c in expected} == expected
    (folder / "b.csv").write_text("item_id,units_sold,revenue,sale_date\nI2,7,11.0,2026-01-02\n")
    rows = {r["item_id"]: r.asDict() for r in read_landing(spark, str(folder)).collect()}
    assert rows["I2"] == {
        "item_id": "I2", "units_sold": "7", "revenue": "11.0", "sale_date": "2026-01-02", "channel": None
    }
    assert rows["I1"]["channel"] == "web" and rows["I1"]["revenue"] == "10.0"


HEADERS = {
    "a.csv": "item_id,units_sold,revenue,sale_date\nI1,5,50,2026-07-01\nI2,1,10,2026-07-01\n",
    "b.csv": 'sale_date,"item_id",units_sold,revenue,note\n2026-07-02,I3,7,70,"a,b"\n',
    "c[1].csv": "item_id,sale_date,units_sold\nI4,2026-07-03,2\n",
    "d.csv": "item_id,units_sold,revenue,sale_date\nI5,x,90,2026-07-04\n",
    "empty.csv": "",
    "only_header.csv": "item_id,colour\n",
}


def test_files_with_different_headers_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, text in HEADERS.items():
        (folder / name).write_text(text)
    with gzip.open(folder / "z.csv.gz", "wt") as f:
        f.write("units_sold,item_id,sale_date,revenue\n3,I6,2026-07-05,30\n")
    wanted = {
        ("I1", "5", "50", "2026-07-01", None), ("I2", "1", "10", "2026-07-01", None),
        ("I3", "7", "70", "2026-07-02", "a,b"), ("I4", "2", None, "2026-07-03", None),
        ("I5", "x", "90", "2026-07-04", None), ("I6", "3", "30", "2026-07-05", None),
    }
    rows = read_landing(spark, str(folder), declared=COMPANY_SALES.columns)
    assert rows.columns == [*COMPANY_SALES.columns, "colour", "note"]
    assert {tuple(r) for r in rows.drop("colour").collect()} == wanted
    inferred = read_landing(spark, str(folder), infer=True, declared=COMPANY_SALES.columns)
    kinds = {f.name: f.dataType.simpleString() for f in inferred.schema.fields}
    assert kinds["units_sold"] == "string" and inferred.count() == 6
    batch, stream = etl.Lake(str(tmp_path / "batch")), etl.Lake(str(tmp_path / "stream"))
    counts = etl.load_landing(spark, str(folder), COMPANY_SALES, batch, "b", OPTIONS)
    assert (counts.read, counts.accepted, counts.rejected) == (6, 5, 1)
    told = []
    ingest_landing(
        spark, str(folder), COMPANY_SALES, stream, str(tmp_path / "ckpt"), OPTIONS, 2,
        on_loaded=lambda batch_id, n: told.append(n),
    ).awaitTermination()
    columns = (*COMPANY_SALES.columns, "note")
    tables = [rows_of(read_silver(spark, lake.silver(COMPANY_SALES)), *columns) for lake in (batch, stream)]
    assert tables[0] == tables[1] and len(tables[0]) == 5
    assert sum(n.read for n in told) == 6 and len(told) == 4


def test_an_empty_folder_has_the_declared_columns(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    rows = read_landing(spark, str(tmp_path), declared=COMPANY_SALES.columns)
    assert rows.columns == list(COMPANY_SALES.columns) and rows.count() == 0


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("policy", ["reject", "drop"])
def test_counts_come_with_the_load_and_add_up(spark, tmp_path, after, policy):
    lake = etl.Lake(str(tmp_path / "lake"))
    options = replace(OPTIONS, dedupe_after_rules=after, null_policy=policy, audit_duplicates=True)
    for spec, rows in ((SELLER_CATALOG, CATALOG), (COMPANY_SALES, [*COMPANY, *COMPANY]), (COMPETITOR_SALES, COMPETITOR)):
        path = land(tmp_path / "landing" / f"{spec.name}.csv", spec, rows)
        for _ in range(2):  # a rerun replaces audits and counts alike
            n = etl.load_landing(spark, path, spec, lake, "b", options)
        assert n.read == len(rows) and n.merged == read_silver(spark, lake.silver(spec)).count()
        assert n.rejected == read_quarantine(spark, lake.quarantine, spec.name).count()
        if spec.dedupe_keys:
            lost = read_duplicates(spark, lake.duplicates, spec.name).collect()
            assert sum(r.n_copies for r in lost) == n.duplicates > 0
            assert {r.dq_failure_reason for r in lost} == {"duplicate_key"}
        else:
            assert n.duplicates == 0 and n.accepted > n.merged
    assert n.undecided == 0


def test_counts_of_an_empty_batch(spark, tmp_path):
    lake = etl.Lake(str(tmp_path / "lake"))
    for spec in (SELLER_CATALOG, COMPETITOR_SALES):
        path = land(tmp_path / "landing" / f"{spec.name}.csv", spec, [])
        n = etl.load_landing(spark, path, spec, lake, "b", OPTIONS)
        assert n == etl.LoadCounts(0, 0, 0, 0, 0, 0)
        assert read_silver(spark, lake.silver(spec)).count() == 0


def test_counts_that_do_not_add_up_are_refused():
    with pytest.raises(ValueError, match="lost track"):
        etl.LoadCounts(read=5, duplicates=1, rejected=1, undecided=0, accepted=2, merged=2)


def test_messages_are_loaded_and_unreadable_ones_kept(spark, tmp_path):
    lake = etl.Lake(str(tmp_path / "lake"))
    topic = tmp_path / "topic"
    topic.mkdir()
    good = [dict(zip(COMPANY_SALES.columns, row, strict=True)) for row in COMPANY]
    broken = ["{", "5", '["I9"]', "plain text", '"text"', ""]
    lines = [json.dumps(m) for m in good] + broken
    lines += ['{"item_id": "I7", "units_sold": 3, "revenue": "", "sale_date": "2026-07-01", "more": 1}', '{"item_id": "I8"}']
    (topic / "1.txt").write_text("\n".join(lines) + "\n")

    def run():
        told = []
        ingest_messages(
            spark, "text", {"path": str(topic)}, COMPANY_SALES, lake, str(tmp_path / "ckpt"), OPTIONS,
            on_loaded=lambda batch_id, n: told.append((batch_id, n)),
        ).awaitTermination()
        return told

    ((batch_id, n),) = run()
    assert n.read == len(good) + 2
    audit = read_quarantine(spark, lake.quarantine, "company_sales").collect()
    unread = sorted(r.original_record for r in audit if r.dq_failure_reason == "unreadable_message")
    assert unread == sorted(broken)
    rows = {r.item_id: r for r in read_silver(spark, lake.silver(COMPANY_SALES)).collect()}
    assert set(rows) == {"I1", "I2", "I7"} and rows["I7"].units_sold == 3 and rows["I7"].revenue == 0.0
    # Only new messages are taken, and the audit of the first ones stays.
    (topic / "2.txt").write_text(json.dumps({**good[0], "units_sold": "9"}) + "\n")
    run()
    rows = {r.item_id: r for r in read_silver(spark, lake.silver(COMPANY_SALES)).collect()}
    assert rows["I1"].units_sold == 9 and len(rows) == 3
    assert read_quarantine(spark, lake.quarantine, "company_sales").count() == len(audit)


def test_messages_are_parsed_once(spark, tmp_path):
    """Landing rows and unreadable messages are read from what the one parse wrote."""
    lake = etl.Lake(str(tmp_path / "lake"))
    (tmp_path / "topic").mkdir()
    good = json.dumps(dict(zip(COMPANY_SALES.columns, COMPANY[0], strict=True)))
    (tmp_path / "topic" / "1.txt").write_text(f"{good}\nnot json\n")
    ingest_messages(
        spark, "text", {"path": str(tmp_path / "topic")}, COMPANY_SALES, lake, str(tmp_path / "ckpt"), OPTIONS
    ).awaitTermination()
    written = spark.read.parquet(f"{lake.bronze(COMPANY_SALES)}/messages")
    kept = {r["value"]: (r["readable"], r["record"]) for r in written.collect()}
    assert set(kept) == {good, "not json"} and kept["not json"] == (False, None)
    assert kept[good][0] and kept[good][1].item_id == COMPANY[0][0]


def test_landing_files_grow_in_number_not_in_size(spark, monkeypatch):
    """The rows are those of four files, and there are still two batches."""
    sf = "/root/testdata/sf0.001"
    expected = sorted(map(str, registry.stream_landing_ingest(spark, sf).collect()))
    seen = []
    write, ingest = registry.landing.write_landing, registry.ingest_landing

    def written(df, path):
        write(df, path)
        seen.append(len(list(Path(path.removeprefix("file:")).glob("*.csv"))))

    def ingested(*args, **named):
        return ingest(*args, **named, on_loaded=lambda batch_id, n: seen.append(n.read))

    monkeypatch.setattr(registry.landing, "write_landing", written)
    monkeypatch.setattr(registry, "ingest_landing", ingested)
    monkeypatch.setattr(registry, "LINES_PER_FILE", 600, raising=False)
    assert sorted(map(str, registry.stream_landing_ingest(spark, sf).collect())) == expected
    n_files, *batches = seen
    assert n_files == 10 and len(batches) == 2


def test_a_lake_that_keeps_batch_numbers(spark, tmp_path):
    """An older file that is loaded again, as a batch of its old number, undoes nothing."""
    lake = etl.Lake(str(tmp_path / "lake"), sequence="batch", scopes={"company_sales": "global"})
    older = land(tmp_path / "1.csv", COMPANY_SALES, [["I1", "5", "50", "2026-07-01"], ["I2", "7", "70", "2026-07-02"]])
    newer = land(tmp_path / "2.csv", COMPANY_SALES, [["I1", "6", "60", "2026-07-01"], ["I2", "8", "80", "2026-07-09"]])
    for path, number in ((older, 1), (newer, 2), (older, 1)):
        etl.load_landing(spark, path, COMPANY_SALES, lake, f"b{number}", replace(OPTIONS, sequence=number))
    rows = {r.item_id: (r.units_sold, str(r.sale_date), r.batch) for r in read_silver(spark, lake.silver(COMPANY_SALES)).collect()}
    assert rows == {"I1": (6, "2026-07-01", 2), "I2": (8, "2026-07-09", 2)}
