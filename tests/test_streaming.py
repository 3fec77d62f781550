from pyspark.sql import functions as F

from assayline.functions import surrogate_key
from assayline.operators.quality import add_anomaly_columns, standardise_date
from assayline.sources.tables import Medallion
from assayline.streaming import append_silver, stream_bronze


def test_new_files_are_appended_once(spark, tmp_path):
    layers = Medallion(spark, str(tmp_path))

    def build(df):
        keyed = df.withColumn("order_key", surrogate_key(F.col("order_id")))
        return standardise_date(add_anomaly_columns(keyed), "day", "ddmmyyyy")

    def batch(start, text):
        return spark.range(start, start + 5).select(
            F.col("id").alias("order_id"), F.lit(text).alias("day")
        )

    def run():
        stream = stream_bronze(layers, "orders", max_files=1)
        append_silver(layers, stream, build, "orders", f"{tmp_path}/checkpoint").awaitTermination(120)
        return layers.read_silver("orders")

    layers.write_table(batch(0, "01/08/2024"), "orders", "bronze")
    assert run().count() == 5
    assert run().count() == 5  # nothing new, nothing twice
    layers.write_table(batch(5, "31/02/2024"), "orders", "bronze", overwrite=False)
    out = run()
    assert out.count() == 10
    bronze = build(layers.read_bronze("orders"))
    assert out.exceptAll(bronze.select(out.columns)).count() == 0
    assert out.where("anomaly_reason_code = 'DATE_PARSE_FAIL'").count() == 5
