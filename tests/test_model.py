"""Models on rows that are dear to compute."""

from pyspark.sql import functions as F

from pitfeat.operators import model


def test_training_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def dear(i):
        seen.add(1)
        return float(i % 7)

    d = spark.range(300).select(dear("id").alias("x"), F.lit("a").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    model.fit(d, ["x"], ["c"], "y", maxIter=2, maxDepth=2)
    assert seen.value == 300
