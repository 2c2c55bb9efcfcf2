import datetime as dt
import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from pyspark.sql import SparkSession  # noqa: E402

from terrace.session import configured  # noqa: E402


def session():
    scratch = tempfile.mkdtemp(prefix="terrace-test-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", scratch)
        .config("spark.checkpoint.dir", scratch + "/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configured(spark)


@pytest.fixture(scope="session")
def spark():
    running = session()
    yield running
    running.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="terrace-case-")


CUSTOMERS = (
    "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\r\n"
    " 11 ,AW1, Ann ,Lee , s,f ,2024-01-05\r\n"
    "12,AW2,Bob,\"Ng, Jr\",M,M,2024-02-30\r\n"
    "13,AW3,Cy,Fox,X,,2023-12-31\r\n"
    "abc,AW4,No,Id,S,F,2024-01-01\r\n"
    ",AW5,Blank,Id,S,F,2024-01-01\r\n"
    "14, ,No,Key,S,F,2024-01-01\r\n"
    "13,AW3,Cy,Foxx,M,,2024-01-02\r\n"
)
SALES = (
    "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price\r\n"
    "SO1,HL-7,11,20120615,20120620,20120630,20,2,10\r\n"
    "SO1,FR-9,11,20120615,20120620,20120630,,2,5\r\n"
    "SO2,HL-7,12,0,20120620,2010,10,3,-4\r\n"
    "SO3,HL-7,99,20050101,20050102,20050103,10,1,10\r\n"
    "SO4,,11,20120615,20120620,20120630,1,1,1\r\n"
)
BIRTHS = "CID,BDATE,GEN\r\nNASAW1,1990-05-05,Female\r\nAW2,2999-01-01,Male\r\nAW3,2000-02-29,M\r\n"
PLACES = "CID,CNTRY\r\nAW-1, USA \r\nAW-2,DE\r\nAW-3,\r\n"
PRODUCTS = (
    "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\r\n"
    "210,CO-RF-FR-9,Frame,,R ,2003-07-01,\r\n"
    "212,AC-HE-HL-7,Helmet,12.43,S ,2011-07-01,2007-12-28\r\n"
    "213,AC-HE-HL-7,Helmet,14.0,S ,2012-07-01,2008-12-27\r\n"
    "214,AC-HE-HL-7, Helmet,16,S ,2013-07-01,\r\n"
    "215,CO-PE-PD-1,Pedal,9,,2010-01-01,2010-12-31\r\n"
    "216,CO-PE-PD-1,Pedal,9,x,2012-01-01,\r\n"
    "217,XX-YY-LATE,Late,5,T ,2013-07-01,2008-01-01\r\n"
    "x1,AA-BB-C,No id,1,M,2013-01-01,\r\n"
    "218, ,No key,1,M,2013-01-01,\r\n"
)
CATEGORIES = (
    "ID,CAT,SUBCAT,MAINTENANCE\r\nAC_HE,Accessories,Helmets,Yes\r\n"
    "CO_RF,Components,Frames,No\r\nXX_YY,Other,Things,maybe"
)


def deliver(folder, **texts):
    """Write the six source files, some with another content, and name them."""
    written = {
        "crm_cust_info": "\ufeff" + CUSTOMERS, "crm_prd_info": PRODUCTS, "crm_sales_details": SALES,
        "erp_cust_az12": BIRTHS, "erp_loc_a101": PLACES, "erp_px_cat_g1v2": CATEGORIES, **texts,
    }
    paths = {}
    for name, text in written.items():
        path = Path(folder) / f"{name}.csv"
        path.write_bytes(text.encode("utf-8"))
        paths[name] = str(path)
    return paths


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def at(day, hour=0):
    return dt.datetime(2024, 3, day, hour, tzinfo=dt.timezone.utc)
