from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"

DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                         T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """A documents table from (doc_id, text[, lang[, source]]) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENT)
