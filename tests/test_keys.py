"""Surrogate keys: dense, ordered, stable."""

from pyspark.sql import functions as F

from hazardmart.operators import keys


def frame(spark, values, name="k"):
    return spark.createDataFrame([(value,) for value in values], f"{name} string")


def as_dict(result):
    return {row["k"]: row["id"] for row in result.collect()}


def test_bounded_and_distributed_numbering_agree(spark):
    names = [f"name {i * 7919 % 5000:05d}" for i in range(5000)]
    expected = {name: position for position, name in enumerate(sorted(names), start=1)}
    values = frame(spark, names)
    assert as_dict(keys.number_bounded(values, "k", "id")) == expected
    assert as_dict(keys.number_members(values, "k", "id")) == expected


def test_numbering_does_not_depend_on_the_number_of_ranges_or_the_layout(spark):
    # A long common beginning, so that ranges cannot come from the first characters.
    names = [f"Municipio de la Sierra {i:06d}" for i in range(2000)]
    expected = {name: i + 1 for i, name in enumerate(names)}
    for cuts, tasks in ((1, 1), (7, 5), (255, 16)):
        values = frame(spark, names).repartition(tasks)
        assert as_dict(keys.number_members(values, "k", "id", cuts=cuts)) == expected


def test_ranges_have_like_sizes_and_nothing_runs_while_planning(spark):
    group = "numbering"
    spark.sparkContext.setJobGroup(group, group)
    try:
        values = spark.range(20_000).select(F.format_string("common prefix %08d", "id").alias("k")).distinct()
        numbered = keys.number_members(values, "k", "id", cuts=63)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        result = as_dict(numbered)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(result) == 20_000 and max(result.values()) == 20_000
    lowest = values.orderBy(F.xxhash64("k"), "k").limit(63)
    cuts = sorted(row["k"] for row in lowest.collect())
    places = [0, *[result[cut] - 1 for cut in cuts], 20_000]
    assert max(after - before for before, after in zip(places, places[1:])) < 20_000 / 64 * 8


def test_numbering_follows_code_points(spark):
    names = ["a", "Z", "É", "E", "z", "Ñ", "N"]
    expected = {name: position for position, name in enumerate(sorted(names), start=1)}
    assert as_dict(keys.number_members(frame(spark, names), "k", "id")) == expected


def test_numbering_nothing(spark):
    assert keys.number_members(frame(spark, []), "k", "id").collect() == []


def test_members_drop_nulls_and_repeats(spark):
    rows = frame(spark, ["b", None, "a", "b"])
    assert sorted(row["k"] for row in keys.members(rows, "k").collect()) == ["a", "b"]


def test_insert_if_absent_keeps_ids_and_appends(spark):
    existing = spark.createDataFrame([(1, "m"), (7, "c")], "id int, k string")
    once = keys.insert_if_absent(existing, frame(spark, ["z", "a", "m", None, "a"]), "k", "id")
    assert as_dict(once) == {"m": 1, "c": 7, "a": 8, "z": 9}
    again = keys.insert_if_absent(once, frame(spark, ["z", "a", "c"]), "k", "id")
    assert as_dict(again) == as_dict(once)


def test_insert_into_empty_dimension(spark):
    empty = spark.createDataFrame([], "id int, k string")
    assert as_dict(keys.insert_if_absent(empty, frame(spark, ["b", "a"]), "k", "id")) == {
        "a": 1,
        "b": 2,
    }
