"""Distinct counts from stored bitmaps against direct ones."""

from pyspark.sql import functions as F

from ticketlake.operators.distinct import count_cells, distinct_cells, merge_cells


def counts(df):
    return {r[0]: r[1] for r in df.collect()}


def test_cells_of_days_merge_to_any_period(spark):
    ids = F.col("id")
    # Two ids in three lie in one hot group; many come on several days, some are null or far away.
    rows = spark.range(60_000).select(
        F.when(ids % 50 == 0, None).when(ids % 31 == 0, ids + 5_000_000_000).otherwise(ids % 20_000).alias("k"),
        (ids % 7).alias("dia"), F.when(ids % 3 < 2, "a").otherwise(F.concat(F.lit("g"), ids % 5)).alias("g"),
    )
    half = [distinct_cells(rows.filter(F.col("dia") <= 3), F.col("k"), ("dia", "g"))]
    half.append(distinct_cells(rows.filter(F.col("dia") > 3), F.col("k"), ("dia", "g")))
    cells = half[0].unionByName(half[1])
    assert counts(count_cells(cells, ("g",), "n")) == counts(rows.groupBy("g").agg(F.count_distinct("k").alias("n")))
    assert counts(count_cells(cells, ("dia",), "n")) == counts(rows.groupBy("dia").agg(F.count_distinct("k").alias("n")))
    again = merge_cells(cells.unionByName(half[0]), ("g",))  # stored twice by mistake
    assert counts(count_cells(again, ("g",), "n")) == counts(rows.groupBy("g").agg(F.count_distinct("k").alias("n")))


def test_text_ids_no_rows_and_ids_left_out(spark):
    rows = spark.createDataFrame([("a", "7"), ("a", "07"), ("b", None), ("b", "-3")], "g string, k string")
    assert counts(count_cells(distinct_cells(rows, F.col("k"), ("g",)), ("g",), "n")) == {"a": 1}
    assert distinct_cells(rows.limit(0), F.col("k"), ("g",)).count() == 0
