"""Row-wise steps run unchanged on a stream; there is nothing stateful to test."""

from __future__ import annotations

import uuid

from conftest import rows
from pyspark.sql import functions as F

from cohortline.functions import pixels as px
from cohortline.functions.classes import argmax, softmax
from cohortline.operators import textscan as ts


def drain(spark, streamed, folder):
    name = "t" + uuid.uuid4().hex
    query = (
        streamed.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{folder}/{name}").start()
    )
    try:
        query.processAllAvailable()
        return rows(spark.table(name))
    finally:
        query.stop()


def test_row_wise_steps_on_a_stream(spark, tmp_path):
    texts = spark.createDataFrame([(1, "see [[a:1, a:2]]"), (2, "mail x@y.org")], "doc_id int, text string")
    logits = spark.createDataFrame([(1, [1.0, 3.0])], "id int, z array<double>")
    images = spark.createDataFrame([(1, (2, 2, [0.0, 1.0, 2.0, 4.0]))], "id int, image struct<height:int,width:int,pixels:array<double>>")
    for name, df in (("texts", texts), ("logits", logits), ("images", images)):
        df.write.parquet(f"{tmp_path}/{name}")

    def stream(name, df):
        return spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}")

    steps = [
        (stream("texts", texts), texts, ts.extract_tags),
        (stream("texts", texts), texts, ts.sensitive_scan),
        (stream("logits", logits), logits, lambda d: d.select("id", argmax(F.col("z")).alias("k"), F.round(F.array_max(softmax(F.col("z"))), 9))),
        (stream("images", images), images, lambda d: d.select("id", F.array_join(px.scale_intensity(F.col("image")).getField("pixels"), ","))),
    ]
    for streamed, batch, step in steps:
        assert drain(spark, step(streamed), tmp_path) == rows(step(batch))
