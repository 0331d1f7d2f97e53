"""Queries on labels, bindings and choices, registered beside those of the catalogue, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions import names as N
from cardloom.operators import bindings, channels, choices, gates, labels
from cardloom.plans.catalogue import dealt, query, read


def _pick(words: list[str], by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (by % len(words) + 1).cast("int"))


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# ---- labels: parts as models whose names hold a family, a size and a stage ----

_STAGES = ["Base", "Instruct", "chat", "PT", "v1.5", "Thinking"]
_MODEL = f"(SELECT p_partkey, p_size, p_brand, 'org/' || replace(p_brand, '#', '-') || '-' || p_size || 'B-' || ({_list(_STAGES)})[p_partkey % 6 + 1] AS model, p_brand || ' ' || p_size || 'b ' || ({_list(_STAGES)})[p_size % 6 + 1] || CASE WHEN p_partkey % 4 = 0 THEN ' (ours)' WHEN p_partkey % 4 = 1 THEN ' bf16' ELSE '' END AS label FROM part)"


def _models(spark: SparkSession, d: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    model = F.concat(F.lit("org/"), F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("-"), size.cast("string"), F.lit("B-"), _pick(_STAGES, key))
    label = F.concat("p_brand", F.lit(" "), size.cast("string"), F.lit("b "), _pick(_STAGES, size), F.when(key % 4 == 0, " (ours)").when(key % 4 == 1, " bf16").otherwise(""))
    return dealt(spark, d, "part", "p_partkey").select("p_partkey", "p_size", "p_brand", model.alias("model"), label.alias("label"))


_STAGE_SQL = "CASE x " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.STAGE_WORDS.items()) + " END"


def _parts_sql(column: str) -> str:
    found = f"list_filter(list_transform(string_split_regex(lower({column}), '[^a-z0-9.]+'), lambda x: trim(x, '.')), lambda x: x <> '' AND NOT list_contains({_list(labels.PRECISION_WORDS)}, x))"
    size = "(regexp_matches(x, '^[0-9]+(\\.[0-9]+)?[bmk]$') OR regexp_matches(x, '^[0-9]+x[0-9]+(\\.[0-9]+)?[bm]$'))"
    stage = f"list_contains({_list(labels.STAGE_WORDS)}, x)"
    tidy = "list_sort(list_distinct({0}))"
    return ", ".join(
        tidy.format(e) + f" AS {n}"
        for n, e in (("words", f"list_filter({found}, lambda x: NOT {size} AND NOT {stage})"), ("sizes", f"list_filter({found}, lambda x: {size})"), ("stages", f"list_transform(list_filter({found}, lambda x: NOT {size} AND {stage}), lambda x: {_STAGE_SQL})"))
    )


@query(f"SELECT p_partkey, {_parts_sql('label')} FROM {_MODEL}")
def label_parts(spark, d):
    return _models(spark, d).select("p_partkey", labels.parts(F.col("label")).alias("p")).select("p_partkey", "p.*")


_NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH m AS (SELECT p_partkey, label, split_part(model, '/', 2) AS alias, CASE WHEN p_size % 3 = 0 THEN 'base' WHEN p_size % 3 = 1 THEN 'post' END AS stage, p_partkey % 2 = 0 AS own FROM {_MODEL}),
l AS (SELECT p_partkey, {_parts_sql('label')} FROM m), a AS (SELECT p_partkey, words AS aw, sizes AS az, stages AS ag FROM (SELECT p_partkey, {_parts_sql('alias')} FROM m)),
j AS (SELECT m.*, l.*, aw, az, ag, {_NORM.format('label')} AS x, {_NORM.format('alias')} AS y, list_distinct(list_transform(stages, lambda s: CASE WHEN s = 'base' THEN 'base' ELSE 'post' END)) AS coarse,
  list_filter(aw, lambda w: NOT list_contains(words, w)) AS missing, list_filter(words, lambda w: NOT list_contains(aw, w)) AS extra FROM m JOIN l USING (p_partkey) JOIN a USING (p_partkey))
SELECT p_partkey, x = y OR x = y || ' ours' OR x = y || ' this work' OR x = y || ' this model' OR (len(words) > 0 AND len(aw) > 0 AND len(coarse) <= 1 AND sizes = az
  AND CASE WHEN len(ag) > 0 AND len(stages) > 0 THEN ag = stages WHEN len(ag) > 0 THEN false WHEN len(stages) > 0 THEN coalesce(coarse = [stage], false) ELSE true END
  AND (words = aw OR (own AND len(missing) > 0 AND len(extra) = 0 AND len(list_filter(missing, lambda w: NOT regexp_matches(w, '^v?[0-9]+(\\.[0-9]+)*$'))) = 0))) AS names_target FROM j""")
def label_match(spark, d):
    stage = F.when(F.col("p_size") % 3 == 0, "base").when(F.col("p_size") % 3 == 1, "post")
    hit = labels.names_target(F.col("label"), F.substring_index("model", "/", -1), stage, F.col("p_partkey") % 2 == 0)
    return _models(spark, d).select("p_partkey", hit.alias("names_target"))


_TOK = "list_filter(string_split_regex(split_part(model, '/', 2), '[-_ ]+'), lambda x: x <> '')"
_STG = f"list_contains({_list(labels.NAME_STAGES)}, lower(x))"
_FAM = f"array_to_string(list_filter({_TOK}, lambda x: NOT regexp_matches(lower(x), '^[0-9]+(\\.[0-9]+)?[bm]$') AND NOT regexp_matches(x, '^([0-9]{{4}}|[0-9]{{6}}|[0-9]{{8}})$') AND NOT regexp_matches(lower(x), '^[0-9]+x[0-9]+[bm]$') AND NOT {_STG}), ' ')"


@query(f"SELECT p_partkey, {_FAM} AS family, len(list_filter({_TOK}, lambda x: list_contains({_list(labels.DERIVATIVES)}, lower(x)))) > 0 AS derivative, nullif(regexp_replace(model, '[-_ ]+(base|pt)$', '', 'i'), model) AS bare_base, nullif(regexp_replace(model, '[-_ ]+(instruct|it|chat|sft|dpo|rlhf|rlvr)$', '', 'i'), model) AS bare_post FROM {_MODEL}")
def model_names(spark, d):
    m = F.col("model")
    return _models(spark, d).select("p_partkey", labels.family(m).alias("family"), labels.is_derivative(m).alias("derivative"), labels.bare(m, F.lit("base")).alias("bare_base"), labels.bare(m, F.lit("post")).alias("bare_post"))


@query(f"""WITH f AS (SELECT p_partkey, model, p_size || 'B' AS size, {_FAM} AS fam, list_filter({_TOK}, lambda x: {_STG}) AS st FROM {_MODEL}),
s AS (SELECT *, array_to_string(list_concat([size], st), ' ') AS a, array_to_string(list_concat([size], st), '-') AS b, replace(fam, ' ', '-') AS h FROM f)
SELECT p_partkey, len(list_distinct(x))::INT AS n, array_to_string(list_sort(list_distinct(x)), '|') AS aliases FROM (SELECT p_partkey, [model, replace(split_part(model, '/', 2), '-', ' '), fam || ' ' || a, fam || '-' || b, h || '-' || b, h || ' ' || a] AS x FROM s)""")
def target_aliases(spark, d):
    found = F.col("found")
    return _models(spark, d).withColumn("found", labels.aliases(F.col("model"))).select("p_partkey", F.size(found).alias("n"), F.array_join(F.array_sort(found), "|").alias("aliases"))


@query("""WITH t AS (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN 'base' WHEN doc_id % 3 = 1 THEN 'post' END AS stage, text || CASE WHEN doc_id % 5 = 0 THEN ' Base Models' WHEN doc_id % 5 = 1 THEN ' Instruction-tuned results' WHEN doc_id % 5 = 2 THEN ' pretraining and chat models' ELSE '' END AS c FROM documents),
s AS (SELECT doc_id, stage, regexp_matches(c, '(?i)\\b(base model|base models|pre-?training|pretrained model|foundation model)\\b') AS b, regexp_matches(c, '(?i)\\b(post-?training|chat model|chat models|instruct(?:ion)?[- ]tuned|instruction following|aligned model|thinking mode|non-?thinking|reasoning model)\\b') AS p FROM t)
SELECT doc_id, coalesce(CASE WHEN stage = 'base' THEN p AND NOT b WHEN stage IS NOT NULL THEN b AND NOT p ELSE false END, false) AS conflict FROM s""")
def scope_conflicts(spark, d):
    i = F.col("doc_id")
    said = F.concat("text", F.when(i % 5 == 0, " Base Models").when(i % 5 == 1, " Instruction-tuned results").when(i % 5 == 2, " pretraining and chat models").otherwise(""))
    stage = F.when(i % 3 == 0, "base").when(i % 3 == 1, "post")
    return read(spark, d, "documents").select("doc_id", labels.scope_conflict(stage, said).alias("conflict"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN l_quantity::INT || '-shot' WHEN 1 THEN l_linenumber || '-' || l_quantity::INT || ' shot' WHEN 2 THEN 'Not specified' ELSE l_quantity::INT || '-shot CoT' END AS setting,
'MMLU (' || l_suppkey || ')' AS label FROM lineitem""")
def shots_and_labels(spark, d):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    cell = F.when(n % 4 == 0, F.concat(F.lit(" "), q)).when(n % 4 == 1, F.concat(n.cast("string"), F.lit(" - "), q)).when(n % 4 == 2, "  ").otherwise(F.concat(q, F.lit(" shot, CoT")))
    link = F.concat(F.lit("[MMLU][m"), n.cast("string"), F.lit("]  ("), F.lit("["), F.col("l_suppkey").cast("string"), F.lit("](http://x/y))"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", labels.shots(cell).alias("setting"), labels.clean(link).alias("label"))


@query("""WITH t AS (SELECT p_partkey, p_size % 4 AS first, p_partkey % 4 AS k FROM part)
SELECT p_partkey, CASE WHEN k = 0 AND first > 1 THEN 1 WHEN k = 3 AND first > 1 THEN 1 ELSE 0 END AS name, CASE WHEN k = 0 AND first > 0 THEN 0 WHEN k = 1 AND first > 2 THEN 2 END AS metric, CASE WHEN k = 2 AND first > 1 THEN 1 END AS shots FROM t""")
def leading_columns(spark, d):
    """Headers of four kinds: metric first, name first with a metric in third place, shots in second place, and two columns of names, the second of which counts."""
    k = F.col("p_partkey") % 4
    header = F.when(k == 0, F.array(F.lit("Metric"), F.lit("**Benchmark**"), F.lit(""), F.lit("M"))).when(k == 1, F.array(F.lit("Tasks"), F.lit("Lang"), F.lit("metric name"), F.lit("M"))).when(k == 2, F.array(F.lit("Dataset"), F.lit("# Shots"), F.lit("x"), F.lit("M"))).otherwise(F.array(F.lit("Task"), F.lit("Dataset"), F.lit("Task"), F.lit("M")))
    return read(spark, d, "part").select("p_partkey", labels.leading_columns(header, F.col("p_size") % 4).alias("c")).select("p_partkey", "c.*")


@query("""SELECT conv_id AS doc_id, turn * 8 + CASE WHEN role = 'user' THEN 6 ELSE 5 END AS at, CASE WHEN role = 'user' THEN 'Scores of ' || turn ELSE '' END AS caption,
CASE WHEN role = 'user' THEN trim(regexp_replace(text, '\\s+', ' ', 'g')) || ' Table ' || turn || '. Scores of ' || turn ELSE 'Results ' || turn END AS lead_in FROM conversations""")
def table_surroundings(spark, d):
    """Turns as stretches of lines: a text, with a caption or a heading and a sentence under it, blanks, then a table of two lines."""
    turn = F.col("turn").cast("string")
    flat = F.trim(F.regexp_replace("text", r"\s+", " "))
    user = F.array(F.lit("## Part"), F.lit(""), F.concat(flat), F.concat(F.lit("Table "), turn, F.lit(". Scores of "), turn), F.lit(""), F.lit(""), F.lit("| a | b |"), F.lit("|---|---|"))
    other = F.array(flat, F.lit("### Part"), F.lit(""), F.concat(F.lit("Results "), turn), F.lit(" "), F.lit("| a | b |"), F.lit("|---|---|"), F.lit(""))
    rows = read(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.posexplode(F.when(F.col("role") == "user", user).otherwise(other)).alias("n", "line"))
    return labels.around(rows.select("doc_id", (F.col("turn") * 8 + F.col("n")).alias("at"), "line")).select("doc_id", F.col("at").cast("long").alias("at"), "caption", "lead_in")


# ---- bindings: line items as values that a writer composed ----

_VALUES = ["Not specified", "7B", "https://example.org/a", "open weights", "Not applicable", "see https://x y"]
_RELATIONS = ["exact_target", "family", "base", "derivative", "sibling_or_comparison", "unknown"]


def _values(spark: SparkSession, d: str) -> DataFrame:
    fields = [f"{s}.{f}" for s, fs in gates.FIELDS.items() for f in fs]
    key, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    idx = F.when(F.col("l_tax") < 0.05, line)
    return read(spark, d, "lineitem").select(
        key.alias("target"), _pick(fields, part).alias("field"), idx.alias("idx"), _pick(_VALUES, F.col("l_suppkey") + line).alias("value"), F.when(F.col("l_quantity") < 45, _pick(_RELATIONS, part + line)).alias("relation"),
        (F.col("l_discount") > 0.09).alias("established"), (F.col("l_returnflag") == "A").alias("as_checkpoint"), (F.col("l_quantity") < 6).alias("unsupported"), (F.col("l_linestatus") == "O").alias("anchored"),
    )


_PATHS = [f"{s}.{f}" for s, fs in gates.FIELDS.items() for f in fs]
_VALUES_SQL = f"""(SELECT l_orderkey AS target, ({_list(_PATHS)})[l_partkey % 34 + 1] AS field, CASE WHEN l_tax < 0.05 THEN l_linenumber END AS idx, ({_list(_VALUES)})[(l_suppkey + l_linenumber) % 6 + 1] AS value,
CASE WHEN l_quantity < 45 THEN ({_list(_RELATIONS)})[(l_partkey + l_linenumber) % 6 + 1] END AS relation, l_discount > 0.09 AS established, l_returnflag = 'A' AS as_checkpoint, l_quantity < 6 AS unsupported, l_linestatus = 'O' AS anchored FROM lineitem)"""
_BOUND = f"""(SELECT *, 'bind_' || left(sha256(target || chr(10) || field || chr(10) || coalesce(idx::VARCHAR, 'null') || chr(10) || value || chr(10) || coalesce(relation, 'null') || chr(10) || action || chr(10) || reason), 24) AS binding_id FROM (
SELECT *, CASE WHEN reason IN ('not_applicable_for_model_class', 'llm_bound_exact_target', 'family_statement_allowed_for_this_field') THEN 'accept' ELSE 'withhold' END AS action FROM (
SELECT *, CASE WHEN value = 'Not applicable' THEN 'not_applicable_for_model_class' WHEN established THEN 'established_field_without_structured_source' WHEN field LIKE 'links.%' AND NOT regexp_matches(value, '^https?://[^\\s<>"'']+$') THEN 'link_field_is_not_a_url'
 WHEN unsupported THEN 'leaf_value_not_in_cited_evidence' WHEN field = 'evaluation.benchmark_scores' AND NOT anchored THEN 'score_row_without_table_anchor' WHEN relation = 'family' AND as_checkpoint THEN 'family_statement_written_as_the_checkpoint'
 WHEN relation = 'exact_target' THEN 'llm_bound_exact_target' WHEN relation = 'family' THEN 'family_statement_allowed_for_this_field' WHEN relation IN ('base', 'derivative') THEN 'base_model_fact_not_this_checkpoint'
 WHEN relation = 'sibling_or_comparison' THEN 'sibling_or_comparison_not_target' ELSE 'referent_unresolved' END AS reason FROM {_VALUES_SQL} WHERE value = 'Not applicable' OR (value <> 'Not specified' AND relation IS NOT NULL))))"""


@query(f"SELECT target, field, idx, value, action, reason, binding_id FROM {_BOUND}")
def binding_ledger(spark, d):
    return bindings.materialize(_values(spark, d)).select("target", "field", "idx", "value", "action", "reason", "binding_id")


@query(f"""WITH b AS {_BOUND}, r AS (SELECT DISTINCT o_orderkey AS target FROM orders WHERE o_orderpriority LIKE '1%')
SELECT CASE WHEN action = 'accept' AND r.target IS NOT NULL AND field IN ('identity.summary', 'evaluation.results_summary', 'identity.name') THEN 'prose_reproduces_source_excerpt' ELSE reason END AS reason,
  CASE WHEN action = 'accept' AND r.target IS NOT NULL AND field IN ('identity.summary', 'evaluation.results_summary', 'identity.name') THEN 'withhold' ELSE action END AS action, count(*) AS n FROM b LEFT JOIN r USING (target) GROUP BY 1, 2""")
def withheld_after_checks(spark, d):
    urgent = read(spark, d, "orders").where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("target"))
    refusals = urgent.withColumn("field", F.explode(F.array(F.lit("identity.summary"), F.lit("evaluation.results_summary"), F.lit("identity.name")))).withColumn("why", F.lit("prose_reproduces_source_excerpt"))
    return bindings.withhold(bindings.materialize(_values(spark, d)), refusals).groupBy("reason", "action").agg(F.count("*").alias("n"))


@query(f"""WITH b AS {_BOUND}, r AS (SELECT DISTINCT o_orderkey AS target FROM orders WHERE o_orderpriority LIKE '1%'), t AS (SELECT b.*, action = 'accept' AND r.target IS NOT NULL AND field IN ('identity.summary', 'identity.name') AS turned FROM b LEFT JOIN r USING (target))
SELECT target, field, idx, CASE WHEN turned THEN 'bind_' || left(sha256(target || chr(10) || field || chr(10) || coalesce(idx::VARCHAR, 'null') || chr(10) || value || chr(10) || coalesce(relation, 'null') || chr(10) || 'withhold' || chr(10) || 'prose_reproduces_source_excerpt'), 24) ELSE binding_id END AS binding_id FROM t""")
def withheld_binding_ids(spark, d):
    """A binding that a later check turns into a refused one states something else, and so has another id."""
    urgent = read(spark, d, "orders").where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("target"))
    refusals = urgent.withColumn("field", F.explode(F.array(F.lit("identity.summary"), F.lit("identity.name")))).withColumn("why", F.lit("prose_reproduces_source_excerpt"))
    return bindings.withhold(bindings.materialize(_values(spark, d)), refusals).select("target", "field", "idx", "binding_id")


@query(f"""WITH k AS (SELECT target, field, idx, min(value) AS value, max(value) AS high FROM {_BOUND} WHERE action = 'accept' GROUP BY 1, 2, 3)
SELECT target, field, CASE WHEN idx IS NOT NULL THEN (row_number() OVER (PARTITION BY target, field ORDER BY idx NULLS FIRST) - 1)::INT END AS at, value,
 CASE WHEN bool_or(idx IS NULL) OVER f AND bool_or(idx IS NOT NULL) OVER f THEN 'whole_and_indexed' WHEN value <> high THEN 'unequal_values' END AS fault FROM k WINDOW f AS (PARTITION BY target, field)""")
def card_projection(spark, d):
    return bindings.card_cells(bindings.materialize(_values(spark, d)))


@query(f"""WITH b AS (SELECT DISTINCT binding_id, field, relation, anchored FROM {_BOUND} WHERE action = 'accept'),
f AS (SELECT binding_id, 'unknown_relation' AS fault FROM b WHERE coalesce(relation, 'unknown') = 'unknown'
UNION ALL SELECT binding_id, 'relation_not_for_this_field' FROM b WHERE relation <> 'unknown' AND NOT CASE relation WHEN 'exact_target' THEN true WHEN 'base' THEN field = 'lineage.base_models' WHEN 'derivative' THEN field = 'lineage.derivatives' WHEN 'family' THEN list_contains({_list(sorted(gates.FAMILY_ALLOWED))}, field) ELSE false END
UNION ALL SELECT binding_id, 'score_without_anchor' FROM b WHERE field = 'evaluation.benchmark_scores' AND NOT anchored) SELECT fault, count(DISTINCT binding_id) AS n, min(binding_id) AS first_id FROM f GROUP BY 1""")
def export_policy_faults(spark, d):
    found = bindings.export_faults(bindings.materialize(_values(spark, d)), gates.field_policy(spark))
    return found.groupBy("fault").agg(F.count_distinct("binding_id").alias("n"), F.min("binding_id").alias("first_id"))


_EVENT = "(SELECT event_id, CASE event_type WHEN 'view' THEN 'accept' WHEN 'click' THEN 'withhold' WHEN 'error' THEN 'drop' ELSE 'reassign' END AS action, value > 60 AS corrected, CASE WHEN user_id % 3 = 0 THEN 'llm_inferred' WHEN user_id % 3 = 1 THEN 'human_corrected' END AS origin FROM events)"


@query(f"""WITH e AS {_EVENT} SELECT fault, count(*) AS n, min(event_id) AS first_id FROM (SELECT event_id, 'unknown_action' AS fault FROM e WHERE action = 'drop' UNION ALL SELECT event_id, 'correction_without_reassignment' FROM e WHERE corrected AND action <> 'reassign'
UNION ALL SELECT event_id, 'reassignment_without_correction' FROM e WHERE NOT corrected AND action = 'reassign' UNION ALL SELECT event_id, 'correction_of_other_origin' FROM e WHERE corrected AND origin IS DISTINCT FROM 'human_corrected') GROUP BY 1""")
def review_event_faults(spark, d):
    t, u = F.col("event_type"), F.col("user_id") % 3
    action = F.when(t == "view", "accept").when(t == "click", "withhold").when(t == "error", "drop").otherwise("reassign")
    rows = read(spark, d, "events").select("event_id", action.alias("action"), (F.col("value") > 60).alias("corrected"), F.when(u == 0, "llm_inferred").when(u == 1, "human_corrected").alias("origin"))
    return bindings.review_faults(rows).groupBy("fault").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(f"""WITH c AS (SELECT p_brand AS card, ({_list(_PATHS)})[p_partkey % 34 + 1] AS field, min(p_name) AS value FROM part GROUP BY 1, 2), f AS (SELECT unnest({_list(_PATHS)}) AS field)
SELECT b.card, f.field, coalesce(c.value, 'Not specified') AS value FROM (SELECT DISTINCT card FROM c) b CROSS JOIN f LEFT JOIN c ON c.card = b.card AND c.field = f.field""")
def blank_cards(spark, d):
    cells = read(spark, d, "part").groupBy(F.col("p_brand").alias("card"), _pick(_PATHS, F.col("p_partkey")).alias("field")).agg(F.min("p_name").alias("value"))
    return bindings.blank(cells, gates.field_policy(spark), "card")


@query("""SELECT page_id, regexp_matches(url, '^https?://[^\\s<>"'']+$') AS is_url, lower(trim(left(html, 13))) NOT IN ('not specified', 'not applicable', '') AS specified FROM pages""")
def value_predicates(spark, d):
    return read(spark, d, "pages").select("page_id", bindings.is_url(F.col("url")).alias("is_url"), bindings.specified(F.left("html", F.lit(13))).alias("specified"))


@query(f"SELECT relation, field, count(*) FILTER (WHERE relation = 'exact_target' OR (relation = 'family' AND list_contains({_list(sorted(gates.FAMILY_ALLOWED))}, field) AND anchored AND as_checkpoint)) AS closing, count(*) AS n FROM {_VALUES_SQL} WHERE relation IS NOT NULL GROUP BY 1, 2")
def coverage_closing(spark, d):
    rows = _values(spark, d).where("relation is not null").join(F.broadcast(gates.field_policy(spark).select("field", "family_allowed")), "field")  # 34 rows
    closes = bindings.closes_coverage(F.col("relation"), F.col("family_allowed"), F.col("anchored"), F.when(F.col("as_checkpoint"), "introduces_target").otherwise("none"))
    return rows.groupBy("relation", "field").agg(F.count_if(closes).alias("closing"), F.count("*").alias("n"))


# ---- choices ----


@query("""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END, l_orderkey, l_linenumber) = 1""")
def candidate_by_authority(spark, d):
    authority = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2)
    found = choices.by_authority(read(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], authority, F.struct("l_orderkey", "l_linenumber"))
    return found.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@query("""WITH c AS (SELECT p_brand, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part), f AS (SELECT p_brand, lower(name) AS low, min(name) AS name FROM c GROUP BY 1, 2),
h AS (SELECT *, len(list_filter(['widget', 'cold', 'steel', 'large'], lambda t: contains(low, t)))::INT AS hits FROM f)
SELECT p_brand, name, hits, (row_number() OVER (PARTITION BY p_brand ORDER BY hits DESC, length(name), name))::INT AS rank FROM h""")
def repository_rank(spark, d):
    rows = read(spark, d, "part").select("p_brand", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"))
    return choices.by_hits(rows, "p_brand", "name", ["widget", "cold", "steel", "large"])


@query("""SELECT d.doc_id, coalesce(min(CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'bad' END), 'unknown') AS stratum FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def stratum_lookup(spark, d):
    index = read(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").alias("stratum"))
    return choices.lookup(read(spark, d, "documents").select("doc_id").distinct(), index, "doc_id", "stratum", "unknown")


@query("""WITH g AS (SELECT p_brand, list_sort(list_distinct(list(p_name))) AS ids FROM part GROUP BY 1) SELECT p_brand, unnest(ids) AS id, '/risks/' || (generate_subscripts(ids, 1) - 1) AS pointer FROM g""")
def taxonomy_pointers(spark, d):
    lists = read(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_name")).alias("ids"))  # p_name has some dozens of values
    return choices.pointers(lists, "p_brand", "ids", "/risks/")


@query("""WITH k AS (SELECT DISTINCT user_id, props, true AS known FROM events WHERE event_type <> 'error'), r AS (SELECT e.user_id, e.props, e.event_id, known IS NOT NULL AND row_number() OVER (PARTITION BY e.user_id, e.props ORDER BY event_id) = 1 AS good FROM events e LEFT JOIN k ON k.user_id = e.user_id AND k.props = e.props),
b AS (SELECT *, coalesce(sum(good::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r)
SELECT user_id, count(*) FILTER (WHERE good) AS kept, count(*) FILTER (WHERE NOT good) AS invalid FROM b WHERE before < 5 GROUP BY 1""")
def selected_candidates(spark, d):
    e = read(spark, d, "events")
    return choices.selected(e.select("user_id", "props", "event_id"), e.where("event_type <> 'error'"), "user_id", "props", "event_id", 5)


@query("""WITH s AS (SELECT conv_id, turn * 2 + (role = 'user')::INT AS place, text, len(list_filter(['than', 'erst', 'ing', 'stin'], lambda t: contains(lower(text), t)))::INT AS hits FROM conversations),
n AS (SELECT *, least(length(text), 300) AS size FROM s WHERE hits > 0), t AS (SELECT conv_id, place, hits, greatest(0, least(size, 900 - coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY hits DESC, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS taken FROM n)
SELECT * FROM t WHERE taken > 0""")
def gap_excerpts(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", (F.col("turn") * 2 + (F.col("role") == "user").cast("int")).alias("place"), "text")
    return choices.excerpts(rows, "conv_id", "text", "place", F.array(*[F.lit(t) for t in ("than", "erst", "ing", "stin")]), 300, 900)


@query("""SELECT doc_id, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id AND l.quality = 1)""")
def resumed_run(spark, d):
    done = read(spark, d, "labels").where("quality = 1")
    return choices.not_done(read(spark, d, "documents").select("doc_id", "source"), done, ["doc_id"])


@query("""WITH a AS (SELECT doc_id, text, strpos(text, 'er') AS p1 FROM documents), b AS (SELECT *, CASE WHEN p1 > 0 AND strpos(substring(text, p1 + 1), 'er') > 0 THEN p1 + strpos(substring(text, p1 + 1), 'er') END AS p2 FROM a)
SELECT doc_id, (CASE WHEN p2 IS NOT NULL AND strpos(substring(text, p2 + 1), 'er') > 0 THEN p2 + strpos(substring(text, p2 + 1), 'er') END - 1)::INT AS third FROM b""")
def third_occurrence(spark, d):
    return read(spark, d, "documents").select("doc_id", choices.occurrence(F.col("text"), F.lit("er"), 3).cast("int").alias("third"))


# ---- functions and exports of the library that no other query reaches ----


@query("""SELECT page_id, lower(regexp_extract(url, '[^/]*$')) AS card, CASE WHEN length(x) > 40 THEN left(x, 39) || '…' ELSE x END AS short, CASE WHEN regexp_matches(url, '(?i)\\.html?$') THEN 'text/html' WHEN lower(url) LIKE '%.json' THEN 'application/json' WHEN lower(url) LIKE '%.md' THEN 'text/markdown' ELSE 'text/plain' END AS media
FROM (SELECT page_id, url, trim(regexp_replace(url, '\\s+', ' ', 'g')) AS x FROM pages)""")
def page_names(spark, d):
    url = F.col("url")
    return read(spark, d, "pages").select("page_id", N.card_name(url).alias("card"), N.short(url, 40).alias("short"), N.media_type(url).alias("media"))


@query("""SELECT source, substring(source, 1, 24) AS head, count(*) AS n, round(avg(n_chars), 4) AS mean_chars FROM documents GROUP BY 1""")
def rows_by_source(spark, d):
    return read(spark, d, "documents").groupBy("source", F.substring("source", 1, 24).alias("head")).agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"))


# ---- channels: orders as targets, three channels that answer by rules on key and field ----


def _rules(k: str, i: str) -> dict[str, tuple[tuple[int, ...], str, str]]:
    """By channel: the fields it may carry, and what it answers at first and when asked again."""
    return {
        "readme": ((0, 1, 2, 3), f"({k} + {i}) % 3 = 0", f"({k} + {i}) % 4 = 0"),
        "paper": ((0, 1, 2, 3, 4), f"({k} + {i}) % 5 = 0", f"({k} * 2 + {i}) % 3 = 0"),
        "github": ((2, 4), f"({k} + {i}) % 7 = 0", f"{k} % 11 <> 0"),
    }


def _gap_sql() -> str:
    """For each channel its first answers, and those to what is open among the fields of targets that it answered."""
    parts, before = [], []
    for name, (fields, first, again) in _rules("k", "i").items():
        parts.append(f"{name}_1 AS (SELECT k, i FROM q WHERE i IN ({', '.join(map(str, fields))}) AND {first})")
        before.append(f"{name}_1")
        known = " UNION ALL ".join(f"SELECT k, i FROM {b} WHERE (k // 7 + i) % 2 = 0" for b in before)
        parts.append(f"{name}_2 AS (SELECT k, i FROM q WHERE i IN ({', '.join(map(str, fields))}) AND {again} AND k IN (SELECT k FROM {name}_1) AND (k, i) NOT IN ({known}))")
        before.append(f"{name}_2")
    rows = " UNION ALL ".join(f"SELECT k AS target, 'f' || i AS field, '{b[:-2]}' AS channel, {'true' if b.endswith('2') else 'false'} AS again FROM {b}" for b in before)
    return f"WITH q AS (SELECT o_orderkey AS k, unnest(range(5)) AS i FROM orders), {', '.join(parts)} {rows}"


@query(_gap_sql())
def gap_coverage(spark, d):
    """What three channels give for each order's fields, the later asked again only for what is not covered."""
    def channel(name: str, fields: tuple[int, ...], first: str, again: str) -> channels.Channel:
        return channels.Channel(name, tuple(f"f{i}" for i in fields), lambda q: q.where(F.expr(f"if(again, {again}, {first})")).select("target", "field"))

    k, i = "target", "cast(substr(field, 2) as int)"
    asked = read(spark, d, "orders").select(F.col("o_orderkey").alias("target"), F.explode(F.array(*[F.lit(f"f{j}") for j in range(5)])).alias("field"))
    covers = F.expr(f"({k} div 7 + {i}) % 2 = 0")
    return channels.fill_gaps(asked, [channel(n, *r) for n, r in _rules(k, i).items()], covers, channels.shared_folder(spark, "gaps"))
