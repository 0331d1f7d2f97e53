"""Constraints as error rows: each check names what is wrong, and a row without fault gives none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPO = r"^[A-Za-z0-9][\w.-]*/[A-Za-z0-9][\w.-]*$"
COMMIT = "^[0-9a-f]{40}$"


def violations(rows: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, fault) for every check that a row breaks; a check is what must not be, null counts as not broken."""
    faults = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(k)) for k, bad in checks.items()]))
    return rows.select(key, F.explode(faults).alias("fault"))


def target_checks() -> dict[str, Column]:
    c = F.col
    return {
        "model_id_shape": c("model_id").isNull() | ~c("model_id").rlike(REPO) | (F.length("model_id") > 96) | c("model_id").contains("..") | c("model_id").contains("--"),
        "revision_has_at": c("requested_revision").contains("@"),
        "resolved_not_a_commit": c("resolved_revision").isNull() | ~c("resolved_revision").rlike(COMMIT),
    }


def span_checks() -> dict[str, Column]:
    """An evidence span holds text with offsets or a pointer with a fragment; its length is its text's, and a row anchor needs a header."""
    text, pointer = F.col("exact_text").isNotNull(), F.col("json_pointer").isNotNull()
    return {
        "text_or_pointer": text == pointer,
        "offsets_missing": text & (F.col("start").isNull() | F.col("end").isNull()),
        "length_differs": text & (F.col("end") - F.col("start") != F.char_length("exact_text")),
        "fragment_missing": pointer & F.col("fragment").isNull(),
        "row_without_header": F.col("row_anchor").isNotNull() & (F.coalesce(F.size("table_header"), F.lit(0)) == 0),
    }


def binding_checks() -> dict[str, Column]:
    """Unknown or unresolved entities are withheld, an exact target is the card's own, and a score needs scope and anchor."""
    accepted = F.col("action") == "accept"
    score = F.col("field").startswith("evaluation.benchmark_scores")
    return {
        "unknown_not_withheld": accepted & F.col("relation").isin("unknown", "unresolved"),
        "exact_target_is_other": (F.col("relation") == "exact_target") & (F.col("entity") != F.col("target")),
        "score_without_scope": accepted & score & F.col("scope").isNull(),
        "score_without_anchor": accepted & score & F.col("row_anchor").isNull(),
    }


def source_checks() -> dict[str, Column]:
    """Allowed states of a source record: collected ones have content, others a reason."""
    done = F.col("status") == "collected"
    return {
        "collected_without_hash": done & F.col("sha256").isNull(),
        "collected_with_reason": done & F.col("reason").isNotNull(),
        "absent_with_hash": ~done & F.col("sha256").isNotNull(),
        "absent_without_reason": ~done & F.col("reason").isNull(),
        "size_is_negative": F.col("size_bytes") < 0,
    }


def repeated(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are not unique, with how often they stand."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def contract_gaps(cells: DataFrame, policy: DataFrame, key: str) -> DataFrame:
    """Fields of the contract that a card lacks, and fields it has beyond: (key, field, fault)."""
    cards = cells.select(key).distinct()
    have = cells.select(key, "field").distinct()
    need = cards.select(key, F.explode(F.array(*[F.lit(r.field) for r in policy.select("field").collect()])).alias("field"))  # 34 fields
    missing = need.join(have, [key, "field"], "left_anti").withColumn("fault", F.lit("missing"))
    extra = have.join(policy, "field", "left_anti").select(key, "field", F.lit("extra").alias("fault"))
    return missing.unionByName(extra)
