"""Every query with an oracle gives the oracle's rows; the others run."""

import pytest

from lexgrain.plans import catalog
from tests.oracle import duck_rows, spark_rows, views

FOUND = catalog.all_queries()


@pytest.fixture(scope="module")
def con(data):
    return views(data)


@pytest.mark.parametrize("name", sorted(k for k, v in FOUND.items() if v[1]))
def test_oracle(spark, data, con, name):
    fn, sql = FOUND[name]
    assert spark_rows(fn(spark, data)) == duck_rows(con, sql)


@pytest.mark.parametrize("name", sorted(k for k, v in FOUND.items() if not v[1]))
def test_runs(spark, data, name):
    df = FOUND[name][0](spark, data)
    assert len(set(df.columns)) == len(df.columns)
    # the smallest tables have no query of the stated set; tests/test_flows.py gives these one
    assert df.count() > 0 or name in ("flare_retrieval", "full_retrieval")


def test_wrong_version_ids_are_named(spark, tmp_path):
    rows = [("1:5:abcdef01", 1, "5", "abcdef0123"), ("1:5:other", 1, "5", "abcdef0123"), ("1:5:other", 1, "5", "abcdef0123")]
    spark.createDataFrame(rows, "version_id string, act_id long, section_number string, text_hash string").write.parquet(f"{tmp_path}/section_versions.parquet")
    got = FOUND["version_ids"][0](spark, str(tmp_path)).collect()
    assert [(r["version_id"], r["wanted"]) for r in got] == [("1:5:other", "1:5:abcdef01")]
