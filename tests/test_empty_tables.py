"""Every mart query ends on empty tables, with its usual columns."""

import pytest

from martkit.plans import registry
from martkit.sources.tables import TABLES

from .conftest import SF_SMALL

registry.load_all()


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_on_empty_tables(spark, empty_dir, name):
    df = registry.QUERIES[name](spark, empty_dir)
    rows = df.collect()
    if name in ("table_count", "table_size_report", "footer_column_stats"):
        assert {r[1] for r in rows} == {0}
