"""Row ids: by content and number among equal rows."""

from hazardmart.operators import row_ids
from hazardmart.operators.row_ids import content_id, with_row_ids

SCHEMA = "a string, b int"


def test_equal_rows_are_numbered_and_layout_does_not_matter(spark, monkeypatch):
    monkeypatch.setattr(row_ids, "EQUAL_ROWS", 64)
    rows = [("x", 1)] * 1000 + [("x", None), (None, 1), ("", 1), ("1", 1), ("11", None)] + [("y", n) for n in range(50)]
    one = with_row_ids(spark.createDataFrame(rows, SCHEMA).repartition(7), "id").collect()
    other = with_row_ids(spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1), "id").collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, other), key=repr)
    assert len({row["id"] for row in one}) == len(one) == len(rows)
    assert all(row["id"] >= 0 for row in one)
    assert sorted(((row["a"], row["b"]) for row in one), key=repr) == sorted(rows, key=repr)


def test_a_further_copy_leaves_the_ids_of_others(spark):
    def ids(count):
        return {row["id"] for row in with_row_ids(spark.createDataFrame([("x", 1)] * count, SCHEMA), "id").collect()}

    assert ids(3) < ids(4)


def test_a_key_gives_ids_without_a_shuffle(spark):
    from tests.plans import plan_of

    rows = spark.createDataFrame([("x", 1), ("y", 1)], SCHEMA)
    keyed = with_row_ids(rows, "id", unique_key=["a"])
    assert "Exchange" not in plan_of(keyed)
    assert keyed.select("id").collect() == rows.select(content_id(["a"]).alias("id")).collect()


def test_empty_table(spark):
    assert with_row_ids(spark.createDataFrame([], SCHEMA), "id").collect() == []
