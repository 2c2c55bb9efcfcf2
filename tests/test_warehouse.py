"""The whole run on delivered files: fresh, repeated, failing, typed."""

import datetime as dt
import tempfile
from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import BIRTHS, SALES, at, deliver, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from terrace.plans import presets
from terrace.plans.bronze import quarantined
from terrace.plans.warehouse import CheckFailed, Warehouse
from terrace.schemas import SOURCE_BY_NAME
from terrace.session import shared_folder
from terrace.sources import buckets
from terrace.sources.layers import Layers

D = dt.date


class Clock:
    def __init__(self):
        self.now = at(1)

    def __call__(self):
        self.now += dt.timedelta(seconds=1)
        return self.now


def warehouse(spark, folder, **kw):
    return Warehouse(spark, folder + "/wh", as_of=D(2024, 3, 1), clock=Clock(), **kw)


@pytest.fixture(scope="module")
def loaded(spark):
    """One complete run, shared by the tests in file order."""
    folder = tempfile.mkdtemp(prefix="terrace-case-")
    w = warehouse(spark, folder)
    paths = deliver(folder)
    w.run(paths)
    return w, paths


def test_bronze_keeps_last_row_of_each_key(loaded):
    w, _ = loaded
    bronze = w.layers.read("bronze", "crm_cust_info")
    assert rows(bronze, "cst_id", "source_row_number") == [
        (" 11 ", 1), ("12", 2), ("13", 7), ("14", 6), ("abc", 4)
    ]
    t = {r.task_name: r for r in w.log.task_runs().collect()}["bronze.crm_cust_info"]
    assert (t.task_status, t.rows_read, t.rows_inserted, t.rows_updated, t.rows_rejected) == ("Success", 7, 5, 0, 1)
    assert t.duration_sec > 0


def test_silver_is_typed_and_decoded(loaded):
    w, _ = loaded
    silver = w.layers.read("silver", "crm_cust_info")
    assert rows(silver, "cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status",
                "cst_gndr", "cst_create_date") == [
        (11, "AW1", "Ann", "Lee", "Single", "Female", D(2024, 1, 5)),
        (12, "AW2", "Bob", "Ng, Jr", "Married", "Male", None),
        (13, "AW3", "Cy", "Foxx", "Married", "UnKnown", D(2024, 1, 2)),
    ]
    products = w.layers.read("silver", "crm_prd_info")
    assert rows(products, "prd_id", "prd_category", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_end_dt") == [
        (210, "CO_RF", "FR-9", "Frame", Decimal("0.0000"), "Road", None),
        (212, "AC_HE", "HL-7", "Helmet", Decimal("12.4300"), "Other Sales", D(2012, 6, 30)),
        (213, "AC_HE", "HL-7", "Helmet", Decimal("14.0000"), "Other Sales", D(2013, 6, 30)),
        (214, "AC_HE", "HL-7", "Helmet", Decimal("16.0000"), "Other Sales", None),
        (215, "CO_PE", "PD-1", "Pedal", Decimal("9.0000"), "N/A", D(2010, 12, 31)),
        (216, "CO_PE", "PD-1", "Pedal", Decimal("9.0000"), "N/A", None),
        (217, "XX_YY", "LATE", "Late", Decimal("5.0000"), "Touring", None),
    ]
    flags = rows(w.layers.read("silver", "erp_px_cat_g1v2"), "ID", "MAINTENANCE")
    assert flags == [("AC_HE", True), ("CO_RF", False), ("XX_YY", None)]


def test_gold_star(loaded):
    w, _ = loaded
    customers, dim = w.layers.read("gold", "dim_customers"), w.layers.read("gold", "dim_products")
    assert rows(customers, "customer_key", "customer_id", "full_name", "country", "gender", "age", "age_group") == [
        (1, 11, "Ann Lee", "United States", "Female", 33, "30-39"),
        (2, 12, "Bob Ng, Jr", "Denmark", "Male", -975, "Under 20"),
        (3, 13, "Cy Foxx", "", "M", 24, "20-29"),
    ]
    assert dim.agg(F.min("product_key"), F.max("product_key"), F.countDistinct("product_key")).first() == (1, 7, 7)
    assert dim.filter("category_id is null").count() == 2
    assert dim.filter("category_id is null and maintenance_flag <> 'No'").count() == 0
    fact = w.layers.read("gold", "fact_sales").join(dim.select("product_key", "product_id"), "product_key", "left")
    assert rows(fact, "sales_key", "order_number", "product_id", "customer_key", "order_date", "sales_amount", "price") == [
        (1, "SO1", 210, 1, D(2012, 6, 15), Decimal("0.0000"), Decimal("5.0000")),
        (2, "SO1", 212, 1, D(2012, 6, 15), Decimal("20.0000"), Decimal("10.0000")),
        (3, "SO2", None, 2, None, Decimal("10.0000"), Decimal("-4.0000")),
        (4, "SO3", None, None, D(2005, 1, 1), Decimal("10.0000"), Decimal("10.0000")),
    ]


def test_run_log(loaded):
    w, _ = loaded
    counts = {(r.schema_name, r.table_name): r.row_count for r in w.log.read("table_row_counts").collect()}
    assert len(counts) == 15 and counts[("gold", "fact_sales")] == 4
    audit = {r.source_name: r for r in w.log.read("source_file_audit").collect()}
    assert audit["crm_cust_info"].row_count == 7
    assert audit["crm_prd_info"].row_count == 9 and audit["crm_prd_info"].file_size_bytes > 300
    jobs = rows(w.log.job_runs(), "pipeline_name", "pl_status")
    assert jobs == [("bronze_load", "Success"), ("gold_load", "Success"), ("silver_load", "Success")]
    checks = {(r.model_name, r.test_name): r for r in w.log.read("data_quality_results").collect()}
    assert checks[("silver.crm_cust_info", "primary_key_cst_id")].test_status == "Pass"
    unconnected = checks[("gold.fact_sales", "connected_customer_key_product_key")]
    assert (unconnected.failed_row_count, unconnected.test_status) == (2, "Warn") and unconnected.details is not None
    assert checks[("gold.fact_sales", "rows_as_delivered")].test_status == "Pass"
    assert w.log.read("alerts").count() == 0


def test_repeated_load_updates(loaded):
    w, paths = loaded
    again = w.load_bronze(paths, [SOURCE_BY_NAME["crm_sales_details"]])["crm_sales_details"]
    assert (again.inserted, again.updated) == (0, 4)
    before = {r.cst_id: r for r in w.layers.read("silver", "crm_cust_info").collect()}
    w.load_silver(rebuild=False)
    after = {r.cst_id: r for r in w.layers.read("silver", "crm_cust_info").collect()}
    assert before.keys() == after.keys()
    for key, row in after.items():
        assert row.meta_created_at == before[key].meta_created_at
        assert row.meta_updated_at > before[key].meta_updated_at


def test_colliding_keys_stop_the_step(loaded):
    w, paths = loaded
    kept = rows(w.layers.read("silver", "crm_cust_info"))
    with open(paths["crm_cust_info"], "a", newline="") as f:
        f.write("11,AW1,Ann,Lee,S,F,2024-01-05\r\n")
    w.load_bronze(paths, [SOURCE_BY_NAME["crm_cust_info"]])
    with pytest.raises(CheckFailed):
        w.load_silver()
    w.layers.refresh()
    assert rows(w.layers.read("silver", "crm_cust_info")) == kept
    failed = w.log.job_runs().filter("pl_status = 'Failed'").collect()
    assert len(failed) == 1 and "primary_key_cst_id" in failed[0].status_message
    alert = w.log.read("alerts").first()
    assert alert.severity == "Critical" and alert.sent_at is None


def test_missing_file_fails_the_task(spark, folder):
    w = warehouse(spark, folder)
    paths = {**deliver(folder), "erp_loc_a101": folder + "/absent.csv"}
    w.set_up()
    with pytest.raises(Exception):
        w.load_bronze(paths, [SOURCE_BY_NAME["erp_cust_az12"], SOURCE_BY_NAME["erp_loc_a101"]])
    states = rows(w.log.task_runs(), "task_name", "task_status")
    assert states == [("bronze.erp_cust_az12", "Success"), ("bronze.erp_loc_a101", "Failed")]


def test_typed_delivery_of_current_products(spark, folder):
    customers = (
        "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\r\n"
        "11,AW1, Ann ,Lee , s,f ,2024-01-05\r\n11,AW1,Anna,Lee,M,F,2024-01-06\r\n"
        "13,AW3,Cy,Foxx,M,,2024-01-02\r\n,AW4,No,Id,M,M,2024-01-02\r\n"
    )
    w = warehouse(spark, folder, preset=presets.CURRENT, tolerate_malformed=True)
    w.run(deliver(folder, crm_cust_info=customers))
    read = w.layers.read
    assert dict(read("bronze", "crm_sales_details").dtypes)["sls_order_dt"] == "int"
    assert rows(read("gold", "dim_products"), "product_key", "product_id", "product_number", "category_id") == [
        (1, 210, "FR-9", "CO_RF"), (2, 216, "PD-1", "CO_PE"), (3, 218, "", " "),
        (4, None, "C", "AA_BB"), (5, 214, "HL-7", "AC_HE"), (6, 217, "LATE", "XX_YY"),
    ]
    assert rows(read("silver", "crm_prd_info").filter("prd_key = 'PD-1'"), "prd_end_dt") == [
        (None,), (D(2011, 12, 31),)
    ]
    assert rows(read("gold", "dim_customers"), "customer_id", "first_name", "country", "gender", "birthdate") == [
        (11, "Anna", "United States", "Female", D(1990, 5, 5)), (13, "Cy", "n/a", "Male", D(2000, 2, 29)),
    ]
    assert rows(read("gold", "fact_sales"), "order_number", "sales_amount", "price") == [
        ("SO1", 10, 5), ("SO1", 20, 10), ("SO2", 12, 3), ("SO3", 10, 10), ("SO4", 1, 1),
    ]


def test_malformed_typed_value_fails_the_load(spark, folder):
    w = warehouse(spark, folder, preset=presets.CURRENT)
    bad = SALES.replace("20120615", "soon", 1)
    with pytest.raises(Exception):
        w.load_bronze(deliver(folder, crm_sales_details=bad), [SOURCE_BY_NAME["crm_sales_details"]])
    assert w.log.read("alerts").count() == 1


def test_blank_keys_kept_on_request(spark, folder):
    source = SOURCE_BY_NAME["erp_cust_az12"]
    text = BIRTHS + ",1980-01-01,\r\nAW9,1981-01-01\r\n"
    for blank_keys, rejected, kept in (("keep", 0, 5), ("reject", 1, 4)):
        w = Warehouse(spark, f"{folder}/{blank_keys}", blank_keys=blank_keys, clock=Clock())
        w.set_up()
        counts = w.load_bronze(deliver(folder, erp_cust_az12=text), [source])["erp_cust_az12"]
        assert (counts.read, counts.rejected, counts.inserted) == (5, rejected, kept)
    bronze = w.layers.read("bronze", "erp_cust_az12")
    assert rows(bronze.filter("CID = 'AW9'"), "BDATE", "GEN") == [("1981-01-01", None)]


def test_only_touched_buckets_are_rewritten(spark, folder):
    source = SOURCE_BY_NAME["erp_cust_az12"]
    w = warehouse(spark, folder, buckets=8)
    w.set_up()
    many = "CID,BDATE,GEN\r\n" + "".join(f"AW{k},1980-01-01,M\r\n" for k in range(200))
    first = w.load_bronze(deliver(folder, erp_cust_az12=many), [source])["erp_cust_az12"]
    before = w.layers.paths("bronze", source.name)
    assert (first.inserted, first.updated) == (200, 0) and len(before) == 8
    few = "CID,BDATE,GEN\r\nAW7,1999-09-09,F\r\nNEW,1990-01-01,M\r\n"
    second = w.load_bronze(deliver(folder, erp_cust_az12=few), [source])["erp_cust_az12"]
    after = w.layers.paths("bronze", source.name)
    assert (second.read, second.inserted, second.updated) == (2, 1, 1)
    assert len(set(before) - set(after)) in (1, 2) and len(after) == 8
    bronze = w.layers.read("bronze", source.name)
    assert bronze.count() == 201 and "bucket" not in bronze.columns
    assert rows(bronze.filter("CID in ('AW7', 'AW8')"), "CID", "BDATE") == [("AW7", "1999-09-09"), ("AW8", "1980-01-01")]
    # A delivery without lines changes nothing; another number of buckets rewrites the table once.
    w.load_bronze(deliver(folder, erp_cust_az12="CID,BDATE,GEN\r\n"), [source])
    assert w.layers.paths("bronze", source.name) == after
    w.buckets = 3
    w.load_bronze(deliver(folder, erp_cust_az12=few), [source])
    assert len(w.layers.paths("bronze", source.name)) == 3 and w.layers.read("bronze", source.name).count() == 201


def test_malformed_lines_are_kept_apart(spark, folder):
    source = SOURCE_BY_NAME["erp_cust_az12"]
    text = BIRTHS + ",1980-01-01,M\r\nAW8,1981-01-01\r\nAW9,1982-02-02,F,more\r\n"
    w = warehouse(spark, folder, malformed="quarantine")
    w.set_up()
    counts = w.load_bronze(deliver(folder, erp_cust_az12=text), [source])["erp_cust_az12"]
    assert (counts.read, counts.inserted, counts.rejected, counts.malformed) == (6, 3, 1, 2)
    assert rows(quarantined(w.layers, source), "verdict", "line", "CID") == [
        ("malformed", "AW8,1981-01-01", "AW8"), ("malformed", "AW9,1982-02-02,F,more", "AW9"), ("no_key", None, "")
    ]
    assert "2 malformed" in w.log.task_runs().first().status_message
    assert rows(w.layers.read("bronze", source.name).filter("CID like 'AW%'"), "CID") == [("AW2",), ("AW3",)]
    typed = warehouse(spark, folder + "/typed", preset=presets.CURRENT, malformed="quarantine")
    counts = typed.load_bronze(deliver(folder, erp_cust_az12=text.replace("2000-02-29", "soon")), [source])["erp_cust_az12"]
    assert (counts.read, counts.inserted, counts.malformed) == (6, 3, 3)
    assert rows(quarantined(typed.layers, source), "line") == [("AW3,soon,M",), ("AW8,1981-01-01",), ("AW9,1982-02-02,F,more",)]
    assert rows(typed.layers.read("bronze", source.name), "CID", "BDATE") == [
        (None, D(1980, 1, 1)), ("AW2", D(2999, 1, 1)), ("NASAW1", D(1990, 5, 5))
    ]


def test_lines_over_lines_and_no_lineage(spark, folder):
    source = SOURCE_BY_NAME["erp_px_cat_g1v2"]
    text = 'ID,CAT,SUBCAT,MAINTENANCE\r\n"A,1","say ""hi""","two\nlines",Yes\r\nB,,x,No\r\n'
    w = warehouse(spark, folder, multiline=True, lineage=False)
    w.set_up()
    w.load_bronze(deliver(folder, erp_px_cat_g1v2=text), [source])
    bronze = w.layers.read("bronze", source.name)
    assert rows(bronze, "ID", "CAT", "SUBCAT", "batch_id") == [("A,1", 'say "hi"', "two\nlines", None), ("B", "", "x", None)]


def test_bronze_rules_are_recorded(loaded):
    w, _ = loaded
    found = {(r.model_name, r.test_name): r.failed_row_count for r in w.log.read("data_quality_results").orderBy("checked_at").collect()}
    assert found[("bronze.crm_sales_details", "valid_date_sls_order_dt")] == 1
    assert found[("bronze.crm_cust_info", "converts_cst_create_date")] == 1
    assert found[("bronze.crm_cust_info", "natural_key_cst_id")] == 0


def test_country_map_can_be_replaced(spark):
    from terrace.plans.silver import locations

    german = replace(presets.INCREMENTAL, countries=presets.COUNTRY_GERMANY, blank_country="n/a")
    raw = spark.createDataFrame([("AW-1", "DE"), ("AW-2", " "), ("AW-3", " USA ")], "CID string, CNTRY string")
    assert rows(locations(raw, german)) == [("AW1", "Germany"), ("AW2", "n/a"), ("AW3", "United States")]
    assert rows(locations(raw)) == [("AW1", "Denmark"), ("AW2", ""), ("AW3", "United States")]


def test_empty_country_of_a_delivery_can_be_null(spark, folder):
    place = SOURCE_BY_NAME["erp_loc_a101"]
    paths = deliver(folder)
    for told, wanted in ((False, ""), (True, None)):
        w = Warehouse(spark, f"{folder}/{told}", empty_is_null=told, clock=Clock())
        w.set_up()
        w.load_bronze(paths, [place])
        assert ("AW-3", wanted) in rows(w.layers.read("bronze", place.name), "CID", "CNTRY")


def test_replaced_versions_and_scratch_tables_are_deleted(spark, folder):
    """A second run leaves one version of each table, nothing beside it, and the same rows."""
    moving = ("batch_id", "loaded_at", "meta_created_at", "meta_updated_at")

    def held(table):
        return rows(table.drop(*moving))

    shared = Path(shared_folder(spark))
    w, paths = warehouse(spark, folder, keep_old=False), deliver(folder)
    w.run(paths)
    before, beside = {t: held(w.layers.read(*t)) for t in w.layers.tables()}, set(shared.glob("*"))
    w.run(paths)
    assert set(shared.glob("*")) <= beside
    assert {t: held(w.layers.read(*t)) for t in w.layers.tables()} == before
    for layer, name in w.layers.tables():
        assert len([p for p in Path(w.root, layer, name).glob("v-*") if list(p.rglob("*.parquet"))]) == 1


def test_staging_is_emptied_before_the_next_load_unless_old_versions_are_kept(spark, folder):
    place, paths = SOURCE_BY_NAME["erp_loc_a101"], deliver(folder)
    for keep in (True, False):
        w = Warehouse(spark, f"{folder}/{keep}", keep_old=keep, clock=Clock())
        w.set_up()
        w.load_bronze(paths, [place])
        staged, loaded = (w.layers.read(layer, place.name) for layer in ("staging", "bronze"))
        n, rows_loaded, columns = staged.count(), loaded.count(), staged.columns
        with pytest.raises(AnalysisException):
            w.load_bronze({place.name: f"{folder}/absent"}, [place])
        left = w.layers.read("staging", place.name)
        assert n > 0 and (left.count(), left.columns) == (n if keep else 0, columns)
        assert w.layers.read("bronze", place.name).count() == rows_loaded


def test_buckets_are_written_in_passes(spark, folder, monkeypatch):
    """The table is as after one pass: updated, inserted and kept rows, of null keys too."""
    ended = []
    monkeypatch.setattr(buckets, "release", lambda spark: ended.append(1))
    layers, kinds = Layers(spark, folder + "/wh"), "k string, v string"
    layers.replace("bronze", "t", spark.createDataFrame([(str(i), "old") for i in range(40)] + [(None, "none")], kinds), at(1))
    new = spark.createDataFrame([(str(i), "new") for i in range(20, 60)], kinds)
    told = buckets.upsert_buckets(layers, "bronze", "t", new, ["k"], rows_per_bucket=10)
    layers.publish({("bronze", "t"): told.paths}, at(2))
    expected = [(str(i), "old" if i < 20 else "new") for i in range(60)] + [(None, "none")]
    assert sorted(rows(layers.read("bronze", "t"), "k", "v"), key=str) == sorted(expected, key=str)
    assert (told.inserted, told.updated, len(ended)) == (20, 20, buckets.PASSES)


def test_old_and_new_rows_lie_side_by_side_for_one_share_only(spark, folder, monkeypatch):
    """Where replaced versions are not kept, a pass deletes what it replaced before the next one writes."""
    layers, kinds = Layers(spark, folder + "/wh", keep_old=False), "k string, v string"
    layers.replace("bronze", "t", spark.createDataFrame([], kinds), at(1))
    for turn, first in (("old", 0), ("new", 20)):
        new = spark.createDataFrame([(str(i), turn) for i in range(first, first + 60)], kinds)
        seen, publish = [], layers.publish

        def counted(*args):
            seen.append(len(list(Path(folder, "wh/bronze/t").glob("v-*/of-*/bucket=*"))))
            return publish(*args)

        with monkeypatch.context() as patched:
            patched.setattr(layers, "publish", counted)
            told = buckets.upsert_buckets(layers, "bronze", "t", new, ["k"], rows_per_bucket=8, at=at(2))
            layers.publish({("bronze", "t"): told.paths}, at(2))
    assert (told.inserted, told.updated) == (20, 40)
    assert sorted(rows(layers.read("bronze", "t"), "k", "v")) == sorted((str(i), "old" if i < 20 else "new") for i in range(80))
    assert len(seen) == buckets.PASSES and max(seen) <= 8 + 2
