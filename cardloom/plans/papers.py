"""Queries on papers, repositories and names in texts: parts as models of a family, with titles, README files and links, beside the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions import text as T
from cardloom.operators import frame, occurrences, papers
from cardloom.plans.catalogue import dealt, query, read

# {g} is a generation from 1 to 9. Models by key; titles that meet each of them.
_MODELS = ("org/Nova-{g}-8B", "org/nova{g}.5-0.5b-sft", "org/Meta-Nova-{g}.1-8B", "org/Nova-7B", "org/Nova-V{g}-Base")
_TITLES = ("The Nova {g} Herd of Models", "Nova {g}0 Technical Report", "Nova: Open Models", "Attacks on Nova {g}: Extracting", "Nova-{g}.1-Coder Technical Report", "Introducing Nova{g}.5", "Zeta 2 Report")
_LINKS = ("see https://github.com/org/Nova{g}).", "https://github.com/org/nova-{g}-tools", "https://github.com/x/nova{g}9", "https://github.com/x/peft", "https://GITHUB.com/Org/NOVA{g}.git")


def _filled(text: str) -> Column:
    return F.replace(F.lit(text), F.lit("{g}"), (F.col("p_size") % 9 + 1).cast("string"))


def _each(texts: tuple[str, ...], at: str, name: str) -> Column:
    return F.posexplode(F.array(*[_filled(t) for t in texts])).alias(at, name)


def _models(spark: SparkSession, d: str) -> DataFrame:
    model = F.get(F.array(*[_filled(t) for t in _MODELS]), F.col("p_partkey") % 5)
    bases = F.when(F.col("p_partkey") % 5 == 3, F.array(F.lit("org2/Zeta-2-8B"), F.lit("bare")))
    return dealt(spark, d, "part", "p_partkey").select(F.col("p_partkey").alias("target"), "p_partkey", "p_size", model.alias("model"), bases.alias("bases"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = _models(spark, d).select("*", _each(_TITLES, "seq", "title"))
    abstract = F.when(F.col("seq") == 3, F.concat(F.lit("We study "), F.replace(F.substring_index("model", "/", -1), F.lit("-"), F.lit(" ")), F.lit(" here")))
    return rows.withColumn("abstract", abstract).withColumn("searched", F.col("seq") % 2 == 0).withColumn("origin", F.when(F.col("searched"), "search").otherwise("hf_arxiv_tag")).withColumn("arxiv_id", F.concat_ws(".", "target", "seq"))


def _sql_list(texts: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + t.replace("{g}", "' || g || '") + "'" for t in texts) + "]"


_M = f"m AS (SELECT p_partkey AS target, p_size, p_partkey % 5 AS k, ({_sql_list(_MODELS)})[p_partkey % 5 + 1] AS model, CASE WHEN p_partkey % 5 = 3 THEN ['zeta'] ELSE [] END AS of_bases FROM (SELECT *, p_size % 9 + 1 AS g FROM part)), n AS (SELECT *, p_size % 9 + 1 AS g, lower(replace(model, 'org/', '')) AS low, list_filter(string_split_regex(lower(replace(model, 'org/', '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM m)"
_F = rf"f AS (SELECT *, list_distinct(list_filter(w, lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '\d+[bm]?') AND x NOT IN {papers.GENERIC})) AS fam FROM n)"
_H = r"h AS (SELECT *, list_transform(list_filter(range(1, len(w)), lambda i: list_contains(fam, w[i]) AND regexp_full_match(w[i + 1], '\d+[bm]?')), lambda i: [w[i], w[i + 1]]) AS numbered FROM f)"
_C = f"c AS (SELECT *, title.t AS name_of_title, CASE WHEN title.seq = 3 THEN 'We study ' || replace(replace(model, 'org/', ''), '-', ' ') || ' here' ELSE '' END AS abstract FROM (SELECT *, unnest(list_transform(range(7), lambda i: {{'seq': i, 't': ({_sql_list(_TITLES)})[i + 1]}})) AS title FROM h))"
_T = """t AS (SELECT *, title.seq AS seq, lower(name_of_title || ' ' || abstract) AS text, string_split_regex(lower(name_of_title || ' ' || abstract), '[^a-z0-9]+') AS said FROM c),
r AS (SELECT *, (k IN (0, 2, 4) AND seq = 0) OR (k = 1 AND seq = 5) OR (k = 3 AND seq IN (2, 6)) AS gate,
  CASE WHEN contains(replace(lower(abstract), ' ', '-'), low) OR (len(fam) > 0 AND len(list_filter(fam, lambda x: NOT list_contains(said, x))) = 0 AND (len(list_filter(fam, lambda x: regexp_matches(x, '[0-9]'))) > 0 OR len(numbered) = 0
    OR len(list_filter(numbered, lambda p: contains(text, p[1] || ' ' || p[2]) OR contains(text, p[1] || '-' || p[2]) OR contains(text, p[1] || p[2]))) > 0)) THEN 'introduces_target'
  WHEN list_has_any(list_concat(fam, of_bases), said) THEN 'family_reference' ELSE 'unrelated_tag' END AS tier FROM t)"""
_ALL = f"WITH {_M}, {_F}, {_H}, {_C}, {_T}"


@query(f"""WITH {_M}, {_F}, {_H} SELECT target, coalesce(numbered[1][1], fam[1]) AS head, CASE k WHEN 1 THEN g || '.5' WHEN 2 THEN g || '.1' WHEN 3 THEN NULL ELSE g::VARCHAR END AS generation,
  CASE k WHEN 0 THEN g::VARCHAR WHEN 1 THEN g || '.5' WHEN 4 THEN g::VARCHAR END AS version, array_to_string(flatten(list_transform(numbered, lambda p: [p[1] || ' ' || p[2], p[1] || '-' || p[2], p[1] || p[2]])), '|') AS forms FROM h""")
def family_generations(spark, d):
    """The family word, generation and written forms of each model's name."""
    m = F.col("model")
    named = _models(spark, d).withColumn("head", papers.head_word(m))
    return named.select("target", "head", papers.generation(m, F.col("head")).alias("generation"), papers.version(m).alias("version"), F.array_join(papers.name_forms(m), "|").alias("forms"))


@query(f"{_ALL} SELECT target, seq, gate, tier FROM r")
def paper_titles(spark, d):
    """Whether each title may be a model's report, and how near the paper is."""
    c = [F.col(x) for x in ("model", "title", "abstract", "bases")]
    return _candidates(spark, d).select("target", "seq", papers.title_gate(c[0], c[1], c[3]).alias("gate"), papers.tier(*c).alias("tier"))


@query(f"""{_ALL}, u AS (SELECT target, seq, name_of_title, CASE WHEN seq % 2 = 0 AND NOT gate THEN 'unrelated_tag' ELSE tier END AS tier FROM r)
SELECT target, target || '.' || seq AS arxiv_id, name_of_title AS title, CASE WHEN seq % 2 = 0 THEN 'search' ELSE 'hf_arxiv_tag' END AS origin, tier FROM u WHERE tier <> 'unrelated_tag' QUALIFY row_number() OVER (PARTITION BY target ORDER BY tier <> 'introduces_target', seq) = 1""")
def paper_choice(spark, d):
    """The paper that each model is bound to."""
    return papers.choose_papers(_candidates(spark, d))


@query(f"""WITH {_M}, {_F}, l AS (SELECT *, unnest([{{'seq': 0, 'repo': 'Nova' || g, 'owner': 'org'}}, {{'seq': 1, 'repo': 'nova-' || g || '-tools', 'owner': 'org'}}, {{'seq': 2, 'repo': 'nova' || g || '9', 'owner': 'x'}}]) AS r FROM f)
SELECT target, 'https://github.com/' || r.owner || '/' || r.repo AS url, (row_number() OVER (PARTITION BY target ORDER BY len(list_filter(w, lambda x: contains(lower(r.repo), x))) DESC, length(r.repo), r.seq))::INT AS rank
FROM l WHERE r.seq < 2 OR k IN (2, 3)""")
def own_repositories(spark, d):
    """The repositories that are each model's own, the nearest name first."""
    return papers.own_repositories(_models(spark, d).select("target", "model", _each(_LINKS, "seq", "url")))


@query("""WITH a AS (SELECT p_partkey AS target, unnest([{'o': 1, 'origin': 'hf_arxiv_tag', 'n': CASE WHEN p_partkey % 2 = 0 THEN p_size END}, {'o': 2, 'origin': 'readme_bibtex', 'n': p_partkey % 100}, {'o': 3, 'origin': 'readme_link', 'n': p_partkey % 50}]) AS r FROM part)
SELECT target, '2301.' || lpad(r.n::VARCHAR, 5, '0') AS arxiv_id, r.origin FROM a WHERE r.n IS NOT NULL QUALIFY row_number() OVER (PARTITION BY target, r.n ORDER BY r.o) = 1""")
def arxiv_numbers(spark, d):
    """The arXiv numbers that tags, BibTeX entries and links of each README name."""
    number = lambda n: F.concat(F.lit("2301."), F.lpad(n.cast("string"), 5, "0"))
    key = F.col("p_partkey")
    tags = F.when(key % 2 == 0, F.array(F.lit("text"), F.concat(F.lit("arxiv:"), number(F.col("p_size")), F.lit("v2"))))
    readme = F.concat(F.lit("# A\nSee https://arxiv.org/abs/"), number(key % 50), F.lit("v1.\n@misc{a,\n  eprint = {"), number(key % 100), F.lit("},\n}\nend"))
    return dealt(spark, d, "part", "p_partkey").select(key.alias("target"), F.explode(papers.arxiv_numbers(tags, readme)).alias("x")).select("target", "x.*")


# ---- names in the lines of documents: the languages as targets, each with a model and a base ----

_TARGETS = (("en", "org/the", "x/that"), ("de", "org/der", "x/und"), ("fr", "org/les", "x/dans"), ("es", "org/que", "x/para"))
_MODEL_LIKE = occurrences.MODEL_NAME[1:-1]


def _owned(spark: SparkSession, d: str) -> DataFrame:
    targets = spark.createDataFrame([(t, m, [f"finetune:{b}", "bare"]) for t, m, b in _TARGETS], "target string, model string, bases array<string>")
    lines = read(spark, d, "documents").select("doc_id", F.col("lang").alias("target"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return occurrences.line_owners(lines, targets)


_OWNED = f"""n AS (SELECT * FROM (VALUES {", ".join(map(str, _TARGETS))}) AS t(target, model, base)),
l AS (SELECT doc_id, lang AS target, unnest(list_zip(range(len(string_split(text, chr(10)))), string_split(text, chr(10)))) AS z FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, target, z[1]::INT AS line, z[2] AS text, list_sort(list_filter([{{'p': strpos(z[2], model), 'n': model, 'r': 'target'}}, {{'p': strpos(z[2], replace(model, 'org/', '')), 'n': replace(model, 'org/', ''), 'r': 'target'}}, {{'p': strpos(z[2], base), 'n': base, 'r': 'base'}},
  {{'p': strpos(z[2], replace(base, 'x/', '')), 'n': replace(base, 'x/', ''), 'r': 'base'}}], lambda x: x.p > 0)) AS named FROM l LEFT JOIN n USING (target)),
o AS (SELECT doc_id, target, line, text, coalesce(named[1].r, CASE WHEN len(list_filter(regexp_extract_all(text, '{_MODEL_LIKE}'), lambda x: regexp_matches(x, '[0-9]'))) > 0 THEN 'other' END) AS owner FROM p)"""


@query(f"WITH {_OWNED} SELECT doc_id, line, owner FROM o WHERE owner IS NOT NULL")
def line_owners(spark, d):
    """Which model each line of a document is about, by the names on it."""
    return _owned(spark, d).where("owner is not null").select("doc_id", "line", "owner")


@query(f"""WITH {_OWNED}, w AS (SELECT owner, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{Nd}}]+'))) AS token FROM o),
s AS (SELECT token, coalesce(bool_or(owner = 'target'), false) AS own, count(*) FILTER (WHERE owner <> 'target') AS others FROM w GROUP BY 1), v AS (SELECT DISTINCT lang AS field, unnest(regexp_extract_all(lower(text), '[a-z0-9]{{6,}}')) AS token FROM documents)
SELECT field, token, others, CASE WHEN others >= 3 THEN 'strong' WHEN others = 2 THEN 'moderate' ELSE 'weak' END AS strength FROM v JOIN s USING (token) WHERE NOT own AND others > 0""")
def splice_probes_of_owners(spark, d):
    """Long words of each language that stand, among lines that name a model, only on lines about other models than the target."""
    values = read(spark, d, "documents").select(F.col("lang").alias("field"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]{6,})"), 1))).alias("token")).distinct()
    return frame.splice_probes(values, _owned(spark, d))


# ---- reading views: parts as Markdown ----

_MARKDOWN = "# [{n}](https://a.b/{k}) ![logo {k}](x.png)\n<!-- {n}\nhidden -->**{n}** is __not__ *{k}* of `{n}`, see <https://c.d/{k}> &eacute; &#8212; &amp;lt; a*b*c snake_{k}_case\n```python\n| {n} | <b>{k}</b> |\n```\n- 5 * {k} * 2"
_PLAIN = "# {n} logo {k}\n{n} is not {k} of {n}, see https://c.d/{k} é — &lt; a*b*c snake_{k}_case\n\n| {n} | {k} |\n\n- 5 * {k} * 2"
_NOTES = ("5-shot", "3 shot, chain of thought", "zero shot", "Temperature = 0.7", "pass@10 sampling", "maj@8", "nothing", "non-thinking mode")
_SETTINGS = ("5-shot", "3-shot CoT", "zero shot", "Temperature = 0.7", "pass@10 sampling", "maj@8", "Not specified", "non-thinking")


@query(f"""SELECT p_partkey, replace(replace('{_PLAIN}', '{{n}}', p_name), '{{k}}', p_partkey::VARCHAR) AS view, ({list(_SETTINGS)})[p_partkey % 8 + 1] AS setting FROM part""")
def markdown_view(spark, d):
    """Markdown of each part as it reads, and the setting that a note states."""
    text = F.replace(F.replace(F.lit(_MARKDOWN), F.lit("{n}"), F.col("p_name")), F.lit("{k}"), F.col("p_partkey").cast("string"))
    note = F.get(F.array(*[F.lit(n) for n in _NOTES]), F.col("p_partkey") % 8)
    return dealt(spark, d, "part", "p_partkey").select("p_partkey", T.markdown_plain(text).alias("view"), T.setting(note).alias("setting"))
