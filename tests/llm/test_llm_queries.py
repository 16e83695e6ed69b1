import pytest

from lexgrain.llm import catalog
from tests.oracle import duck_rows, spark_rows, views

COLUMNS = {
    "p1_found": "node left_id right_id", "p2_found": "section_id noise", "p4_found": "left_id right_id", "p5_found": "rec rec_id", "p6_found": "left_vec right_vec",
    "p7_found": "rec rec_id markup", "p8_ids": "doc_id ids", "p10_found": "doc_id kind found",
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_runs(spark, data, name):
    fn, sql = catalog.QUERIES[name]
    df = fn(spark, data)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name].split()
        if name != "p8_ids":
            assert df.count() == df.distinct().count()
    assert df.count() > 0
    if sql:
        assert spark_rows(df) == duck_rows(views(data), sql)
