"""Responses of model metadata as records: read strictly, within limits, and of the very model and revision that was asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions import jsons


def metadata_records(responses: DataFrame, most_bytes: int, most_total: int) -> DataFrame:
    """(target, outcome, fault, detail, sha256, bytes) of responses(target, model_id, revision, status, content, bytes_before), a row for each.

    A status other than ok is the outcome, with no fault. Content over most_bytes, or that with bytes_before of the target passes most_total, is size_limited, unread. Else it is refused with a
    fault, the first of: not_utf8, not_json, duplicate_key, nonfinite_number, not_an_object, revision_drift, repository_drift; or it is collected, with its digest. A null content counts as empty bytes.
    """
    content = F.coalesce(F.col("content").cast("binary"), F.lit(b""))
    size = F.length(content)
    fits = (size <= most_bytes) & (F.coalesce("bytes_before", F.lit(0)) + size <= most_total)
    read = (F.col("status") == "ok") & fits
    rows = responses.select("target", "model_id", "revision", "status", content.alias("content"), size.cast("long").alias("bytes"), fits.alias("fits"), F.when(read, content).alias("to_read"))
    rows = rows.withColumn("said", jsons.stated_identity(F.col("to_read")))
    said = lambda c: F.col(f"said.{c}")
    drift = F.when(said("sha") != F.col("revision"), "revision_drift").when((said("id") != F.col("model_id")) | (said("model_id") != F.col("model_id")), "repository_drift")
    fault = F.when(F.col("to_read").isNotNull(), F.coalesce(said("kind"), drift))
    outcome = F.when(F.col("status") != "ok", F.col("status")).when(~F.col("fits"), "size_limited").when(fault.isNotNull(), "refused").otherwise("collected")
    rows = rows.select("target", outcome.alias("outcome"), fault.alias("fault"), said("detail").alias("detail"), "bytes", "content")
    return rows.select("target", "outcome", "fault", "detail", F.when(F.col("outcome") == "collected", F.sha2("content", 256)).alias("sha256"), "bytes")
