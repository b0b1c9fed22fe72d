"""Export files by their own headers, and malformed fields by name."""

import gzip
import os

from pyspark.sql import functions as F

from costmart.operators.quality import quarantine_fields
from costmart.schemas import AWS_RAW_SCHEMA
from costmart.session import local_path
from costmart.sinks import mart_store as store
from costmart.sources.billing_csv import missing_columns, read_export, read_headers
from costmart.sources.layouts import AWS
from costmart.streaming.ingest import ingest_new_files
from tests import fixtures as fx

NAMES = AWS_RAW_SCHEMA.fieldNames()


def put(folder, name, header, rows, compress=False):
    os.makedirs(local_path(folder), exist_ok=True)
    values = lambda r: ",".join('"' + str(r[c]) + '"' if "," in str(r.get(c)) else str(r.get(c, "extra")) for c in header)
    text = "\n".join([",".join(header), *[values(r) for r in rows]]) + "\n" if header else ""
    opener = gzip.open if compress else open
    with opener(f"{local_path(folder)}/{name}", "wt", encoding="utf-8") as f:
        f.write(text)


def rows(first, n, **kw):
    return [dict(zip(NAMES, fx.aws_row(resource_id=f"r{i}", cost_usd=i + 0.5, **kw))) for i in range(first, first + n)]


def test_headers_of_all_kinds_of_files(spark, scratch):
    box = scratch("kinds")
    put(box, "a.csv", NAMES, rows(0, 1))
    put(box, "b.csv.gz", ["\ufeffnote", *NAMES], [], compress=True)
    put(box, "c.csv", [], [])
    put(box, "[d]*.csv", NAMES[:3], [])
    names = ["a.csv", "b.csv.gz", "c.csv", "[d]*.csv"]
    found = read_headers(spark, [f"{box}/{n}" for n in names])
    assert [found[f"{box}/{n}"] for n in names] == [tuple(NAMES), ("note", *NAMES), None, tuple(NAMES[:3])]
    assert missing_columns(tuple(NAMES[:3]), AWS) == ["service_name", "cost_usd"]
    assert missing_columns((*NAMES, "team"), AWS) == ["team"] and missing_columns((*reversed(NAMES), "x", "x"), AWS) == []


def test_files_with_their_own_headers(spark, scratch):
    root = scratch("by-header")
    box, base = f"{root}/inbox", f"{root}/mart"
    put(box, "1.csv", NAMES, rows(0, 3))
    put(box, "2.csv", ["note", *reversed(NAMES)], rows(3, 3))
    put(box, "3.csv", [c for c in NAMES if c != "cost_usd"], rows(6, 3))
    put(box, "4.csv.gz", [c for c in NAMES if c not in ("team", "usage_quantity")], rows(9, 3), compress=True)
    put(box, "[5]*.csv", NAMES, rows(12, 3, account_name="a, b"))
    put(box, "6.csv", [], [])
    put(box, "7.csv", NAMES, [])
    ingest_new_files(spark, AWS, f"{box}/*", base, f"{root}/state")
    landed = {r.resource_id: r for r in store.read_landing(spark, base).collect()}
    assert sorted(landed) == sorted(f"r{i}" for i in (0, 1, 2, 3, 4, 5, 9, 10, 11, 12, 13, 14))
    assert all(r.cost_usd == int(k[1:]) + 0.5 and r.service_name == "Amazon EKS" for k, r in landed.items())
    assert (landed["r9"].team, landed["r9"].usage_quantity, landed["r12"].account_name) == ("unknown", None, "a, b")
    assert store.read_fact(spark, base).count() == 12
    refused = store.read_quarantine(spark, base).collect()
    assert len(refused) == 1, refused
    assert [(r.reason, r.kept, "3.csv: bill_date" in r.raw_line) for r in refused] == [("missing_columns", False, True)]
    outcomes = {os.path.basename(r.input_file): r.outcome for r in store.read_input_files(spark, base).collect()}
    assert outcomes["3.csv"] == "refused" and sum(o == "loaded" for o in outcomes.values()) == 4

    # a batch of refused files only, then a good one
    put(box, "8.csv", ["cost_usd"], rows(20, 1))
    ingest_new_files(spark, AWS, f"{box}/*", base, f"{root}/state")
    put(box, "9.csv", NAMES, rows(21, 2))
    ingest_new_files(spark, AWS, f"{box}/*", base, f"{root}/state")
    assert store.read_fact(spark, base).count() == 14
    assert store.read_quarantine(spark, base).where("reason = 'missing_columns'").count() == 2


def test_malformed_fields_by_name(spark, scratch):
    root = scratch("fields")
    box, base = f"{root}/inbox", f"{root}/mart"
    odd = rows(0, 1, usage_quantity="many") + rows(1, 1) + rows(2, 1, usage_quantity="1e3")
    odd[0]["cost_usd"] = "n/a"
    put(box, "1.csv", ["note", *reversed(NAMES)], odd)
    with open(f"{local_path(box)}/2.csv", "w") as f:
        f.write(",".join(NAMES) + "\n" + "2024-05-06,7001\n")
    ingest_new_files(spark, AWS, f"{box}/*.csv", base, f"{root}/state")
    found = store.read_quarantine_fields(spark, base).collect()
    assert sorted((str(r.field), str(r.text)) for r in found) == [("None", "None"), ("cost_usd", "n/a"), ("usage_quantity", "many")]
    assert {r.raw_line for r in found if r.field} == {",".join(["extra", *[str(odd[0][c]) for c in reversed(NAMES)]])}
    assert sorted(r.resource_id for r in store.read_landing(spark, base).collect()) == ["r1", "r2"]
    # the same of a read by position
    put(box, "by-position.csv", NAMES, odd)
    raw = read_export(spark, f"{box}/by-position.csv", AWS, keep_corrupt=True)
    assert {(r.field, r.text) for r in quarantine_fields(raw, AWS).collect()} == {("cost_usd", "n/a"), ("usage_quantity", "many")}
    assert quarantine_fields(raw.drop("_corrupt_record").withColumn("note", F.lit(1)), AWS).collect() == []
