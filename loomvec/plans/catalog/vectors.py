"""Vector expressions over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomvec.functions import vectors
from loomvec.plans.catalog.registry import query, rendered, rendered_sql, scaled_sql, table
from loomvec.session import scratch_path
from loomvec.sources import payloads


@query(f"""
    SELECT vec_id, {rendered_sql(scaled_sql("v"))} AS vector
    FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 + label)) AS v FROM embeddings)""")
def l2_normalize(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: x.cast("double") * (1 + F.col("label")))
    return rows.select("vec_id", rendered(vectors.l2_normalize(scaled)).alias("vector"))


@query(f"""
    SELECT vec_id, 16 AS dims, {rendered_sql(scaled_sql("v"))} AS vector
    FROM (SELECT vec_id, embedding[1:16] AS v FROM embeddings)""")
def truncate_embedding(spark, sf_dir):
    short = table(spark, sf_dir, "embeddings").select(
        "vec_id", vectors.truncate_embedding(F.col("embedding"), 16).alias("v")
    )
    return short.select("vec_id", F.size("v").alias("dims"), rendered(F.col("v")).alias("vector"))


@query(f"""
    SELECT vec_id, {rendered_sql("embedding")} AS vector, false AS bad_response FROM embeddings
    UNION ALL SELECT vec_id, NULL, true FROM embeddings""")
def unwrap_embedding(spark, sf_dir):
    v = F.col("embedding")
    # Every vector once in a good response and once in a bad one, which holds it twice.
    both = F.explode(F.array(F.array(v), F.array(v, v)))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", both.alias("response"))
    return rows.select(
        "vec_id",
        rendered(vectors.unwrap_nested(F.col("response"))).alias("vector"),
        vectors.is_bad_nesting(F.col("response")).alias("bad_response"),
    )


@query(f"""
    SELECT vec_id, {rendered_sql("list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE) / 3 AS FLOAT))")} AS vector
    FROM embeddings""")
def cast_float32(spark, sf_dir):
    doubles = F.transform("embedding", lambda x: x.cast("double") / 3)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", rendered(vectors.as_float32(doubles)).alias("vector")
    )


@query(f"""
    SELECT CAST(vec_id AS VARCHAR) AS id, {rendered_sql("embedding")} AS vector,
           {rendered_sql(scaled_sql("embedding[1:16]"))} AS short_vector,
           true AS short_payload_is_smaller
    FROM embeddings""")
def vector_json(spark, sf_dir):
    """Payloads at full and reduced size, parsed back."""
    id_, v = F.col("vec_id").cast("string"), F.col("embedding")
    payloads = table(spark, sf_dir, "embeddings").select(
        vectors.point_json(id_, v).alias("full"),
        vectors.point_json(id_, vectors.truncate_embedding(v, 16)).alias("short"),
    )
    schema = "id string, embedding array<float>"
    parsed = payloads.select(
        "*", F.from_json("full", schema).alias("f"), F.from_json("short", schema).alias("s")
    )
    return parsed.select(
        "f.id",
        rendered(F.col("f.embedding")).alias("vector"),
        rendered(F.col("s.embedding")).alias("short_vector"),
        (F.length("short") < F.length("full")).alias("short_payload_is_smaller"),
    )


@query(f"SELECT CAST(vec_id AS VARCHAR) AS id, {rendered_sql('embedding')} AS vector, true AS within FROM embeddings")
def upload_payloads(spark, sf_dir):
    """Payload files read back: every vector, and no file above the bound."""
    path, most = scratch_path(spark, "payloads"), 20_000
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    payloads.write_payloads(payloads.payloads(rows, most_bytes=most), path)
    points = payloads.read_payloads(spark, path)
    return points.select("id", rendered(F.col("embedding")).alias("vector"), (F.col("length") <= most).alias("within"))


@query("SELECT count(*) AS points, CAST(ceil(count(*) / 50) AS BIGINT) AS files FROM embeddings")
def upload_stream(spark, sf_dir):
    """A stream of vectors into payloads of fifty points; one file at a time, written by one task."""
    base = scratch_path(spark, "payload-stream")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")
    rows.coalesce(1).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    made = payloads.payloads(stream.coalesce(1), most_points=50)
    payloads.payload_stream(made, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return payloads.read_payloads(spark, f"{base}/out").agg(F.count("*").alias("points"), F.count_distinct("file_path").alias("files"))
