"""Which statement may fill which field: an ordered table of refusals over records joined with the field policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The public fields by section, and the policy sets.
FIELDS = {
    "identity": ["model_id", "name", "developed_by", "model_type", "license", "release_date", "version", "summary"],
    "lineage": ["base_models", "model_family", "derivatives"],
    "specifications": ["architecture_type", "num_parameters", "context_length", "precision", "model_size", "input_output"],
    "training_context": ["training_data", "training_data_size", "data_cutoff", "adaptations"],
    "access_and_adoption": ["access_type", "downloads", "likes"],
    "evaluation": ["results_summary", "benchmark_scores", "human_evals", "safety_evals"],
    "links": ["model_card", "system_card", "tech_report", "code_repository", "citation"],
    "risks": ["possible_risks"],
}
LISTS = {"lineage.base_models", "lineage.derivatives", "specifications.input_output", "evaluation.benchmark_scores", "risks.possible_risks"}
SCORES = {"evaluation.benchmark_scores", "evaluation.human_evals", "evaluation.safety_evals"}
NUMERIC = {
    "specifications.num_parameters", "specifications.context_length", "specifications.model_size", "training_context.training_data_size",
    "training_context.data_cutoff", "access_and_adoption.downloads", "access_and_adoption.likes",
}
STRUCTURED = {"lineage.base_models", "lineage.derivatives"}
FAMILY_IDENTITY = {"identity.summary", "identity.model_type", "identity.developed_by", "lineage.model_family"}
FAMILY_ALLOWED = FAMILY_IDENTITY | {
    "training_context.training_data", "training_context.training_data_size", "training_context.data_cutoff", "training_context.adaptations",
    "evaluation.results_summary", "links.tech_report", "links.code_repository", "links.system_card", "links.citation",
}
NUMERIC_REFUSED = ("base", "derivative", "sibling_or_comparison", "unknown")


def field_policy(spark: SparkSession) -> DataFrame:
    """(field, section, ordinal, is_list, is_score, is_numeric, is_structured, family_identity, family_allowed): a row for each of the 34 fields."""
    paths = [(f"{s}.{f}", s) for s, fs in FIELDS.items() for f in fs]
    rows = [(p, s, n, p in LISTS, p in SCORES, p in NUMERIC, p in STRUCTURED, p in FAMILY_IDENTITY, p in FAMILY_ALLOWED) for n, (p, s) in enumerate(paths)]
    flags = ["is_list", "is_score", "is_numeric", "is_structured", "family_identity", "family_allowed"]
    return spark.createDataFrame(rows, "field string, section string, ordinal int, " + ", ".join(f"{x} boolean" for x in flags))


def relation_of(node_type: Column) -> Column:
    """The relation to the target of what a referent's node is."""
    return F.when(node_type == "target", "exact_target").when(node_type == "base", "base").when(node_type.isin("sibling", "comparison"), "sibling_or_comparison").when(node_type == "family", "family").otherwise("unknown")


def worst_relation(relations: Column) -> Column:
    """Of several cited items' relations the one farthest from the target."""
    rank = {"exact_target": 0, "family": 1, "base": 2, "derivative": 2, "sibling_or_comparison": 3, "unknown": 4}
    worst = F.array_max(F.transform(relations, lambda r: F.struct(F.element_at(F.create_map(*[x for k, v in rank.items() for x in (F.lit(k), F.lit(v))]), r).alias("rank"), r.alias("relation"))))
    return worst["relation"]


def gate(records: DataFrame, policy: DataFrame) -> DataFrame:
    """records(field, relation, other_stage, roster, has_family, comparison, base_checkpoint, tier, names_target, ...) with gate and reason, both null if kept.

    The first refusal that fits, in this order, decides.
    """
    r, c = F.col("relation"), F.col
    table = [
        (c("is_structured"), "structured_only", F.lit("lineage_is_structured_channel_only")),
        (c("other_stage"), "other_stage", F.lit("sentence_about_the_other_stage")),
        (c("roster") & ~c("has_family") & (r == "exact_target"), "roster_sentence", F.lit("roster_sentence_enumerates_the_family")),
        ((r == "family") & ~c("family_allowed"), "family_field_policy", F.lit("family_statement_not_allowed_for_this_field")),
        ((r == "family") & ~(c("base_checkpoint") & (c("tier") == "introduces_target")) & ~c("family_identity"), "family_not_a_base_checkpoint", F.lit("family_statement_not_this_checkpoint")),
        (c("is_score") & (r != "exact_target"), "score_relation", F.concat(F.lit("score_of_"), r, F.lit("_not_this_checkpoint"))),
        (c("is_score") & c("comparison"), "score_comparison_sentence", F.lit("comparison_sentence_names_another_model_first")),
        ((c("field") == "evaluation.benchmark_scores") & ~c("names_target"), "score_row_anchor", F.lit("score_row_does_not_name_the_target")),
        (c("is_numeric") & r.isin(*NUMERIC_REFUSED), "numeric_relation", F.concat(F.lit("numeric_value_of_"), r, F.lit("_not_this_checkpoint"))),
        (c("is_numeric") & c("comparison"), "numeric_comparison_sentence", F.lit("comparison_sentence_names_another_model_first")),
    ]
    joined = records.join(policy, "field")
    name, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for when, gate_name, why in reversed(table):
        name, reason = F.when(when, gate_name).otherwise(name), F.when(when, why).otherwise(reason)
    return joined.select(*records.columns, name.alias("gate"), reason.alias("reason"))


def lineage_expectation(bindings: DataFrame) -> DataFrame:
    """Accepted lineage bindings whose relation is not the one their field calls for: (field, relation, expected, n)."""
    expected = F.when(F.col("field") == "lineage.base_models", "base").when(F.col("field") == "lineage.derivatives", "derivative")
    return bindings.withColumn("expected", expected).where("expected is not null and relation <> expected").groupBy("field", "relation", "expected").agg(F.count("*").alias("n"))
