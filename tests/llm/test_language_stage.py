"""The language stage of the pipeline loses no document that has a letter."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_lettered_documents_stay_where_languages_are_close(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("lang", F.concat(F.lit("l"), F.crc32(F.col("doc_id").cast("string")) % 4))
    words = docs.selectExpr("-doc_id - 1 as doc_id", "regexp_extract(text, '[A-Za-z]+', 0) as text").filter("text <> ''")
    every = docs.unionByName(words, allowMissingColumns=True)
    kept = corpus_pipeline.language_id(spark, every, small).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in every.filter("text rlike '[A-Za-z]'").select("doc_id").collect())


def test_documents_leave_with_the_language_that_was_told(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    unlabelled = docs.where("doc_id % 7 = 3 AND lang IS NOT NULL").select("doc_id", F.col("lang").alias("own"))
    gappy = docs.withColumn("lang", F.when(F.col("doc_id") % 7 != 3, F.col("lang")))
    told = corpus_pipeline.language_id(spark, gappy, small)
    assert told.columns == docs.columns and told.where("lang IS NULL").count() == 0
    labelled = told.select("doc_id", F.col("lang").alias("now")).join(gappy.where("lang IS NOT NULL"), "doc_id")
    assert labelled.where("now <> lang").count() == 0 < labelled.count()
    both = told.join(unlabelled, "doc_id")
    assert both.where("lang = own").count() >= 0.8 * both.count() > 0
    assert "lang" in corpus_pipeline.token_ids(spark, told, small).columns
