"""Nested JSON of which the reader knows nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverframe.sources import nested as N
from riverframe.workload.cases import case


def _records(spark, sf):
    """One JSON text per conversation: two levels of objects, a list of objects of objects, fields that most rows lack, whole and
    fractional numbers in one field, and texts that are no JSON."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", F.length("text").alias("size"))
    # Whole numbers where the size is even, fractions elsewhere: to_json writes what the map holds.
    half = F.when(F.col("size") % 2 == 0, (F.col("size") / 2).cast("bigint").cast("string")).otherwise((F.col("size") / 2).cast("string"))
    author = F.concat(F.lit('{"role":"'), "role", F.lit('"'), F.when(F.col("turn") % 2 == 1, F.concat(F.lit(',"replies_to":'), (F.col("turn") - 1).cast("string"))).otherwise(""), F.lit("}"))
    text = F.concat(F.lit('{"n":'), F.col("turn").cast("string"), F.lit(',"author":'), author, F.lit(',"half":'), half, F.lit("}"))
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", text.alias("t")))).alias("l"), F.count("*").alias("n"), F.sum("size").alias("total"))
    listed = F.concat_ws(",", F.transform("l", lambda x: x["t"]))
    rare = F.when(F.col("conv_id") % 50 == 0, F.concat(F.lit(',"mark":{"by":"'), F.col("conv_id").cast("string"), F.lit('"}'))).otherwise("")
    whole = F.concat(F.lit('{"facts":{"sizes":{"total":'), F.col("total").cast("string"), F.lit('},"turns":'), F.col("n").cast("string"), rare, F.lit('},"turns":['), listed, F.lit("]}"))
    return held.select("conv_id", F.when(F.col("conv_id") % 10 == 3, F.concat(F.lit("<"), whole)).when(F.col("conv_id") % 10 == 7, F.lit("[1, 2]")).otherwise(whole).alias("payload"))


HELD = "c AS (SELECT conv_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS total FROM conversations GROUP BY 1)"


@case(f"""WITH {HELD} SELECT conv_id, CASE WHEN ok THEN total END AS facts_sizes_total, CASE WHEN ok THEN n END AS facts_turns, CASE WHEN ok AND conv_id % 50 = 0 THEN CAST(conv_id AS VARCHAR) END AS facts_mark_by,
  CASE WHEN ok THEN CAST(turn AS BIGINT) END AS turns_n, CASE WHEN ok THEN role END AS turns_author_role, CASE WHEN ok AND turn % 2 = 1 THEN CAST(turn - 1 AS BIGINT) END AS turns_author_replies_to,
  CASE WHEN ok THEN length(text) / 2 END AS turns_half, CASE WHEN ok THEN CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) END AS turns_at
FROM (SELECT *, conv_id % 10 NOT IN (3, 7) AS ok FROM c JOIN conversations USING (conv_id))
QUALIFY ok OR row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""")
def json_flatten_deep(spark, sf):
    """Every field three levels down a column, every turn a row, types found from the texts."""
    return N.flatten_json(_records(spark, sf), "payload", ["conv_id"], ["turns"])


@case("""WITH c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT CASE conv_id % 10 WHEN 3 THEN 'no JSON' ELSE 'no object' END AS reason, count(*) AS n FROM c WHERE conv_id % 10 IN (3, 7) GROUP BY 1""")
def json_invalid(spark, sf):
    return N.invalid_json(_records(spark, sf), "payload")
