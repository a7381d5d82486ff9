"""Mixing sources to target weights by Poisson replication.

Every source gets the mean repetition rate at which its expected share of the output is its target
weight. A document's count inverts the Poisson distribution of that rate at a number hashed from
its id, so a rerun draws the same counts. The copies are shuffled globally by a hash of id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardmart.llm.common import spare
from hazardmart.sources.landed import land

# Hexadecimal digits of the uniform number: 52 bits, exact in a double.
DIGITS = 13


def _hash(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) hashed from ``parts``."""
    digits = F.substring(_hash(seed, *parts), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson_tables(rates: DataFrame, key: str = "source") -> DataFrame:
    """Per row of ``rates`` (key, rate) the cumulative Poisson probabilities of 0, 1, 2, ...

    The array ends twelve standard deviations and thirty counts above the mean, where what is left
    is far below the resolution of the uniform numbers. Its length times the documents of a source
    is about the source's share of the output, also for rates in the thousands.
    """
    rate = F.col("rate")
    most = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    counts = rates.select(key, "rate", F.explode(F.sequence(F.lit(0), most)).alias("n"))
    upward = Window.partitionBy(key).orderBy("n")
    log_factorial = F.sum(F.when(F.col("n") > 0, F.ln("n")).otherwise(0.0)).over(upward)
    mass = counts.select(key, "n", F.exp(F.col("n") * F.ln("rate") - rate - log_factorial).alias("mass"))
    summed = mass.select(key, "n", F.sum("mass").over(upward).alias("cumulative"))
    listed = F.sort_array(F.collect_list(F.struct("n", "cumulative")))
    return summed.groupBy(key).agg(listed.getField("cumulative").alias("cumulative"))


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, total: int | None = None
) -> DataFrame:
    """Mean repetitions per document of each source (null is a source of its own).

    Without ``weights`` a source weighs as its document count to the power ``temperature``; with
    them, sources not named weigh nothing. ``total`` is the expected output size (default: input).
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(temperature)))
    else:
        if any(weight < 0 for weight in weights.values()):
            raise ValueError("weights must not be negative")
        given = spark.createDataFrame([*weights.items()], "source string, weight double")
        weighed = sizes.join(given, "source", "left").fillna(0.0, "weight")
    sums = weighed.agg(F.sum("n_docs").alias("n_docs"), F.sum("weight").alias("weight")).first()
    wanted = float(sums["n_docs"] or 0 if total is None else total)
    per_weight = wanted / sums["weight"] if sums["weight"] else 0.0
    rates = weighed.select("source", (F.col("weight") * per_weight / F.col("n_docs")).alias("rate"))
    return rates.filter("rate > 0")


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    total: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """Copies of the documents in which sources have their target weights, globally shuffled.

    Adds ``copy`` (from 0) and ``shuffle_key``; columns so called are replaced. Rows that share a
    doc_id (null included) share their count. An empty table gives an empty result. The rates are
    written first, so that the join broadcasts them only if their file is small.
    """
    kept = [name for name in docs.columns if name.lower() not in {"copy", "shuffle_key"}]
    tables = land(poisson_tables(source_rates(docs, weights, temperature, total)), "poisson")
    origin, shares, drawn_at, zero = (spare(docs, name) for name in ("source_rate", "cumulative", "uniform", "zero"))
    tables = tables.select(F.col("source").alias(origin), F.col("cumulative").alias(shares))
    drawn = docs.select(*kept, uniform(seed, F.col("doc_id")).alias(drawn_at))
    matched = drawn.join(tables, F.col("source").eqNullSafe(F.col(origin)))
    repeats = F.size(F.filter(shares, lambda c: c <= F.col(drawn_at)))
    copies = matched.select(*kept, F.posexplode(F.array_repeat(F.lit(0), repeats)).alias("copy", zero))
    keyed = copies.select(*kept, "copy", _hash(seed + 1, F.col("doc_id"), F.col("copy")).alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def oracle(temperature: float = 0.5, seed: int = 7) -> str:
    """``mix_sources`` without given weights as SQL."""
    return f"""
WITH sizes AS (
  SELECT source, count(*) AS n_docs, pow(count(*)::DOUBLE, {temperature}) AS weight
  FROM documents GROUP BY source
), rates AS (
  SELECT source, weight * (SELECT sum(n_docs) FROM sizes) / (SELECT sum(weight) FROM sizes) / n_docs AS rate
  FROM sizes
), counts AS (
  SELECT source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 30)::INTEGER)) AS n FROM rates
), factorials AS (
  SELECT *, sum(CASE WHEN n > 0 THEN ln(n) ELSE 0 END) OVER (PARTITION BY source ORDER BY n) AS log_factorial
  FROM counts
), cumulated AS (
  SELECT source, n, sum(exp(n * ln(rate) - rate - log_factorial)) OVER (PARTITION BY source ORDER BY n) AS cumulative
  FROM factorials
), tables AS (
  SELECT source, list(cumulative ORDER BY n) AS cumulative FROM cumulated GROUP BY source
), drawn AS (
  SELECT *, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, {DIGITS}))::BIGINT
            / pow(16.0, {DIGITS}) AS uniform_number
  FROM documents
), repeated AS (
  SELECT d.*, len(list_filter(t.cumulative, lambda c: c <= d.uniform_number)) AS repeats
  FROM drawn d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT doc_id, text, lang, source, n_chars, unnest(generate_series(0, repeats - 1))::INTEGER AS copy FROM repeated
)
SELECT *, md5('{seed + 1}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key FROM copies
"""
