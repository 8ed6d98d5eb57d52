import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagelake.schemas import RAW_PAGES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("pagelake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="pagelake-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagelake-test-ckpt-"))
    yield s


def page(kind, body, page_key=None, seed_key=None, page_no=0, **kw):
    """One landed page row; ``body`` may be a dict (dumped as JSON) or text."""
    text = body if isinstance(body, str) or body is None else json.dumps(body, ensure_ascii=False)
    row = {f.name: None for f in RAW_PAGES.fields}
    row.update(kind=kind, body=text, page_no=page_no, seed_key=seed_key,
               page_key=page_key or f"{kind}:{seed_key}:{page_no}", http_status=200, attempt=1)
    row.update(kw)
    return row


@pytest.fixture
def pages_df(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r[f.name] for f in RAW_PAGES.fields) for r in rows], RAW_PAGES)
    return make
