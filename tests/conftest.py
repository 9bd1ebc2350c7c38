import pytest

from sitewell.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": str(warehouse)})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    """Rows as plain dicts, decimals as floats, sorted."""
    import decimal
    out = [{k: float(v) if isinstance(v, decimal.Decimal) else v for k, v in r.asDict(recursive=True).items()}
           for r in df.collect()]
    keys = order or df.columns
    return sorted(out, key=lambda r: [(r[k] is None, str(r[k])) for k in keys])
