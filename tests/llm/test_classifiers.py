"""Classifiers by their held-out accuracy, and mixing by its shares."""

import math

import numpy as np
from pyspark.sql import functions as F

from hazardmart.llm import mixing, quality, toxicity
from hazardmart.llm.common import read


def held_out(result, labels, column):
    known = {row["doc_id"]: row[column] for row in labels.collect()}
    rows = [(row["score"], row["predicted"], known[row["doc_id"]]) for row in result.collect() if row["held_out"] and row["doc_id"] in known]
    return np.array(rows)


def test_quality_on_held_out_documents(spark):
    docs, labels = (read(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    rows = held_out(quality.score_quality(docs, labels), labels, "quality")
    assert len(rows) > 50 and (rows[:, 1] == rows[:, 2]).mean() >= 0.95


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (read(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = held_out(toxicity.score_toxicity(docs, labels), labels, "toxic")
    assert (rows[:, 1] == rows[:, 2]).mean() >= 0.94
    assert rows[rows[:, 2] == 0][:, 1].mean() <= 0.02  # clean documents stay


def test_odd_documents_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "x\x00" * 9000, 7), (4, "a", 8)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(4, 1, 1), (4, 1, 1), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        for run in (quality.score_quality, toxicity.score_toxicity):
            rows = run(docs, labels).collect()
            assert len(rows) == 4 and all(0 <= row["score"] <= 1 for row in rows)
        assert quality.without_low_quality(docs, labels).columns == docs.columns
        assert toxicity.without_toxic(docs, labels).columns == docs.columns
        assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
        assert quality.score_quality(docs.limit(0), labels).collect() == []


def plain_ftrl(rows, options):
    """The update rule, one coordinate after the other."""
    z, n = {}, {}

    def weight(place):
        if abs(z.get(place, 0.0)) <= options.l1:
            return 0.0
        shrunk = z[place] - math.copysign(options.l1, z[place])
        return -shrunk / ((options.beta + math.sqrt(n[place])) / options.alpha + options.l2)

    for _ in range(options.epochs):
        for text, label in rows:
            own = [(int(p), float(x)) for p, x in zip(*toxicity.example(text, options.bits), strict=True)]
            weights = {place: weight(place) for place, _ in own}
            error = 1 / (1 + math.exp(-sum(weights[place] * x for place, x in own))) - label
            for place, x in own:
                gradient, seen = error * x, n.get(place, 0.0)
                rate_change = (math.sqrt(seen + gradient**2) - math.sqrt(seen)) / options.alpha
                z[place] = z.get(place, 0.0) + gradient - rate_change * weights[place]
                n[place] = seen + gradient**2
    return {place: weight(place) for place in z if weight(place)}


def test_ftrl_equals_a_plain_loop_over_coordinates(spark):
    rows = [(i, ("you awful fool " if i % 3 == 0 else "a fine day ") * (1 + i % 5) + f"word{i % 11} again") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    options = toxicity.ToxicityOptions(l1=0.2, epochs=3)
    places, weights = toxicity.learn(docs, labels, F.lit(True), options)
    order = docs.orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").collect()
    expected = plain_ftrl([(row["text"], int(row["doc_id"] % 3 == 0)) for row in order], options)
    assert expected and places.tolist() == sorted(expected)
    assert np.allclose(weights, [expected[place] for place in sorted(expected)], rtol=1e-5, atol=1e-6)
    dense = toxicity.Scorer(places, weights, options.bits)
    for row in order[:5]:
        own = zip(*toxicity.example(row["text"], options.bits), strict=True)
        logit = sum(expected.get(int(place), 0.0) * float(x) for place, x in own)
        assert abs(dense(row["text"]) - 1 / (1 + math.exp(-logit))) < 1e-5


def test_quality_fit_equals_a_direct_least_squares_solution(spark):
    rows = [(i, ("| # 7 " * (i % 9 + 1)) if i % 2 else f"Some words, {i} of them, that make up a text. " * (i % 6 + 1)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0 or i % 7 == 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    options = quality.QualityOptions(features=40)
    model = quality.learn(docs, labels, F.lit(True), options)
    apart = docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(options.seed)), F.lit(4)) == 0).alias("apart"))
    apart = {row["doc_id"]: row["apart"] for row in apart.collect()}
    matrix = np.array([quality.statistics(text) for _, text in rows])
    assert np.allclose(model.mean, matrix.mean(axis=0)) and np.allclose(model.deviation[0], matrix[:, 0].std())
    fits = np.array([not apart[i] for i, _ in rows])
    target = np.array([float(i % 2 == 0 or i % 7 == 0) for i, _ in rows])
    waves = model.features(matrix)
    # The penalty as further rows of an ordinary least squares problem; the constant has none.
    penalty = np.sqrt(options.ridge * fits.sum()) * np.eye(options.features + 1)[:-1]
    equations = np.vstack([waves[fits], penalty])
    direct = np.linalg.lstsq(equations, np.append(target[fits], np.zeros(options.features)), rcond=None)[0]
    assert np.allclose(waves @ direct, model.raw(matrix), atol=1e-5)
    # Isotonic values by their definition: the greatest least mean over blocks around a place.
    known = np.array([apart[i] for i, _ in rows])
    values, wanted = np.round(model.raw(matrix[known]), 6), target[known]
    distinct = np.unique(values)
    sums = np.array([[wanted[values == v].sum(), (values == v).sum()] for v in distinct])
    below = np.vstack([[0, 0], sums.cumsum(axis=0)])
    mean = lambda first, last: (below[last + 1] - below[first])[0] / (below[last + 1] - below[first])[1]
    count = len(distinct)
    expected = [max(min(mean(j, k) for k in range(i, count)) for j in range(i + 1)) for i in range(count)]
    assert np.allclose(np.interp(distinct, *quality.isotonic(values, wanted)), expected, atol=0.002)


def test_isotonic_fit_never_falls():
    values, labels = np.array([3.0, 1.0, 2.0, 2.0, 5.0, 4.0]), np.array([1, 0, 1, 0, 1, 0])
    places, scores = quality.isotonic(values, labels)
    assert (np.diff(places) >= 0).all() and (np.diff(scores) >= 0).all()


def test_mixing_reaches_given_weights(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id % 10 < 7 THEN 'a' WHEN id % 10 < 9 THEN 'b' END AS source")
    sizes = {row["source"]: row["count"] for row in mixing.mix_sources(docs, weights={"a": 1.0, "b": 3.0}).groupBy("source").count().collect()}
    assert sizes.keys() == {"a", "b"}
    assert abs(sizes["b"] / sum(sizes.values()) - 0.75) < 0.02 and abs(sum(sizes.values()) - 30_000) < 1500
    again = mixing.mix_sources(docs, weights={"a": 1.0, "b": 3.0}).groupBy("source").count()
    assert {row["source"]: row["count"] for row in again.collect()} == sizes


def test_mixing_odd_tables(spark):
    schema = "doc_id long, source string, copy string"
    assert mixing.mix_sources(spark.createDataFrame([], schema)).collect() == []
    rows = mixing.mix_sources(spark.createDataFrame([(None, None, "x")] * 50 + [(1, "s", "y")], schema), total=5000).collect()
    assert {row["source"] for row in rows} == {None, "s"}
    assert max(row["copy"] for row in rows if row["source"] == "s") > 500  # a rate in the hundreds


def test_filters_without_usable_labels_keep_all_documents(spark):
    docs = spark.createDataFrame([(i, f"Document {i} has some words. " * (i % 5 + 1)) for i in range(40)], "doc_id long, text string")
    schema = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, None, None), (None, 1, 0)], [(1000, 1, 0)]):
        labels = spark.createDataFrame(rows, schema)
        assert quality.without_low_quality(docs, labels).count() == 40
        assert toxicity.without_toxic(docs, labels).count() == 40


def test_quality_is_calibrated_without_rows_set_apart(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "IF(id % 2 = 0, repeat('| # ', 50), 'Some words that make up a document.') AS text")
    own = "pmod(xxhash64(doc_id, 3), 4) {} 0 AND crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2"
    for apart in ("<>", "="):  # no labelled row in the calibrating quarter; none outside it
        labels = docs.filter(own.format(apart)).selectExpr("doc_id", "int(doc_id % 2) AS quality", "0 AS toxic")
        kept = {row["doc_id"] for row in quality.without_low_quality(docs, labels).collect()}
        assert kept == {*range(1, 400, 2)}


def test_copies_of_a_sampled_document_count_once(spark):
    rows = [(i, ("you awful fool " if i % 3 == 0 else "a fine day ") * (1 + i % 7) + f"word{i}") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    copied = spark.createDataFrame(rows + [rows[5]] * 300, "doc_id long, text string")
    usable = F.lit(True)
    options = toxicity.ToxicityOptions()
    for one, other in zip(toxicity.learn(once, labels, usable, options), toxicity.learn(copied, labels, usable, options), strict=True):
        assert np.array_equal(one, other)
    models = [quality.learn(docs, labels, usable, quality.QualityOptions()) for docs in (once, copied)]
    assert np.allclose(models[0].mean, models[1].mean) and np.allclose(models[0].deviation, models[1].deviation)
    # Texts of one id: one of them is learnt from, whatever their order.
    more = [*rows, (5, "another text"), (5, None)]
    both = [toxicity.learn(spark.createDataFrame(part, "doc_id long, text string"), labels, usable, options) for part in (more, more[::-1])]
    assert all(np.array_equal(one, other) for one, other in zip(*both, strict=True))
