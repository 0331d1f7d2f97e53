"""Bindings: one row for each value that a card accepts or refuses, what becomes of them in review, and the card they project to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as T

# Words for a missing value, fields that hold links, and what a refusal is called by relation.
NOT_SPECIFIED, NOT_APPLICABLE = "Not specified", "Not applicable"
LINKS = ("links.model_card", "links.system_card", "links.tech_report", "links.code_repository", "links.citation")
URL = r"^https?://[^\s<>\"']+$"
BY_RELATION = {
    "exact_target": (True, "llm_bound_exact_target"),
    "family": (True, "family_statement_allowed_for_this_field"),
    "base": (False, "base_model_fact_not_this_checkpoint"),
    "derivative": (False, "base_model_fact_not_this_checkpoint"),
    "sibling_or_comparison": (False, "sibling_or_comparison_not_target"),
    "unknown": (False, "referent_unresolved"),
}


def specified(value: Column) -> Column:
    """False for null, blank and the two words for absence, whatever their case."""
    return F.coalesce(~F.lower(F.trim(value)).isin("not specified", "not applicable", ""), F.lit(False))


def is_url(value: Column) -> Column:
    return F.coalesce(value.rlike(URL), F.lit(False))


def materialize(values: DataFrame) -> DataFrame:
    """A binding for each of values(target, field, idx, value, relation, established, as_checkpoint, unsupported, anchored): binding_id, action and reason beside them.

    The first rule that fits decides: no value, no binding; "Not applicable" is accepted; an established field needs a structured source; then links, leaves without support and score rows without
    an anchor are refused in this order, a family statement written as the checkpoint's own too, and the relation decides the rest. relation null: nothing is cited, no binding.
    """
    c = F.col
    rows = values.where((specified(c("value")) & c("relation").isNotNull()) | (F.trim("value") == NOT_APPLICABLE))
    reason = F.when(F.trim("value") == NOT_APPLICABLE, "not_applicable_for_model_class").when(c("established"), "established_field_without_structured_source")
    reason = reason.when(c("field").isin(*LINKS) & ~is_url(c("value")), "link_field_is_not_a_url").when(c("unsupported"), "leaf_value_not_in_cited_evidence")
    reason = reason.when((c("field") == "evaluation.benchmark_scores") & ~c("anchored"), "score_row_without_table_anchor").when((c("relation") == "family") & c("as_checkpoint"), "family_statement_written_as_the_checkpoint")
    for relation, (_, why) in BY_RELATION.items():
        reason = reason.when(c("relation") == relation, why)
    accepted = [why for keep, why in BY_RELATION.values() if keep] + ["not_applicable_for_model_class"]
    rows = rows.withColumn("reason", reason.otherwise("referent_unresolved"))
    rows = rows.withColumn("action", F.when(c("reason").isin(*accepted), "accept").otherwise("withhold"))
    return rows.withColumn("binding_id", _id())


def _id() -> Column:
    """A binding's id follows from all that it states, its action and reason too."""
    c = F.col
    return T.content_id("bind", c("target").cast("string"), c("field"), c("idx").cast("string"), c("value"), c("relation"), c("action"), c("reason"))


def withhold(bindings: DataFrame, refusals: DataFrame) -> DataFrame:
    """bindings with the accepted ones of each field that refusals(target, field, why) names turned into refused ones, which get new ids as their action and reason are part of them."""
    met = bindings.join(refusals.groupBy("target", "field").agg(F.min("why").alias("why")), ["target", "field"], "left")
    met = met.withColumn("_turned", (F.col("action") == "accept") & F.col("why").isNotNull())
    turned = F.col("_turned")
    new = met.withColumns({"reason": F.when(turned, F.col("why")).otherwise(F.col("reason")), "action": F.when(turned, "withhold").otherwise(F.col("action"))})
    return new.withColumn("binding_id", F.when(turned, _id()).otherwise(F.col("binding_id"))).select(*bindings.columns)


def card_cells(bindings: DataFrame) -> DataFrame:
    """(target, field, at, value, fault) of the card that accepted bindings make: indexed rows closed up from 0, a field as a whole at null.

    fault says whole_and_indexed where a field has both, and unequal_values where one place has several; equal repeats are one.
    """
    kept = bindings.where("action = 'accept'").groupBy("target", "field", "idx").agg(F.min("value").alias("value"), F.max("value").alias("high"))
    field, order = Window.partitionBy("target", "field"), Window.partitionBy("target", "field").orderBy("idx")
    indexed = F.col("idx").isNotNull()
    both = F.max(indexed.cast("int")).over(field) > F.min(indexed.cast("int")).over(field)
    fault = F.when(both, "whole_and_indexed").when(F.col("value") != F.col("high"), "unequal_values")
    return kept.select("target", "field", F.when(indexed, F.row_number().over(order) - 1).alias("at"), "value", fault.alias("fault"))


def export_faults(bindings: DataFrame, policy: DataFrame) -> DataFrame:
    """(binding_id, fault) of accepted bindings that no export may hold: unknown relations, other entities' facts in fields that don't allow them, scores without an anchor."""
    c = F.col
    rows = bindings.where("action = 'accept'").join(policy.select("field", "family_allowed"), "field", "left")
    allowed = F.when(c("relation") == "exact_target", True).when(c("relation") == "base", c("field") == "lineage.base_models").when(c("relation") == "derivative", c("field") == "lineage.derivatives").when(c("relation") == "family", F.coalesce("family_allowed", F.lit(False))).otherwise(False)
    faults = F.array_compact(F.array(
        F.when(F.coalesce(c("relation"), F.lit("unknown")) == "unknown", "unknown_relation"),
        F.when(~allowed & (c("relation") != "unknown"), "relation_not_for_this_field"),
        F.when((c("field") == "evaluation.benchmark_scores") & ~c("anchored"), "score_without_anchor"),
    ))
    return rows.select("binding_id", F.explode(faults).alias("fault"))


def review_faults(events: DataFrame) -> DataFrame:
    """(event_id, fault) of events(event_id, action, corrected, origin): only a reassignment may correct a value, and then by a human's hand."""
    c = F.col
    faults = F.array_compact(F.array(
        F.when(~c("action").isin("accept", "withhold", "reassign"), "unknown_action"),
        F.when(c("corrected") & (c("action") != "reassign"), "correction_without_reassignment"),
        F.when((c("action") == "reassign") & ~c("corrected"), "reassignment_without_correction"),
        F.when(c("corrected") & ~c("origin").eqNullSafe(F.lit("human_corrected")), "correction_of_other_origin"),
    ))
    return events.select("event_id", F.explode(faults).alias("fault"))


def blank(cards: DataFrame, policy: DataFrame, key: str) -> DataFrame:
    """(key, field, value): every field of the contract for every card, the word for absence where the card has none."""
    whole = cards.select(key).distinct().withColumn("field", F.explode(F.array(*[F.lit(r.field) for r in policy.select("field").collect()])))  # 34 fields
    return whole.join(cards.select(key, "field", "value"), [key, "field"], "left").select(key, "field", F.coalesce("value", F.lit(NOT_SPECIFIED)).alias("value"))


def closes_coverage(relation: Column, family_allowed: Column, base_checkpoint: Column, tier: Column) -> Column:
    """True if an item fills its field: the target's own, or a family statement where these are allowed and the family's paper introduces the target."""
    return (relation == "exact_target") | ((relation == "family") & family_allowed & base_checkpoint & (tier == "introduces_target"))
