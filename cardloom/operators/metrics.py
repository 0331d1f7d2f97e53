"""Totals, rates and comparisons over usage logs, field tables and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ABSENT = ("Not specified", "Not applicable")


def filled(value: Column) -> Column:
    """True unless the value is missing or one of the two signs of absence, alone or as a list's only item."""
    v = F.trim(value.cast("string"))
    return F.coalesce(~v.isin(*ABSENT, "", "[]", "{}", '["Not specified"]'), F.lit(False))


def usage_totals(usage: DataFrame, *by: str) -> DataFrame:
    """calls, input_tokens, output_tokens, cost (rounded to 8) and sorted providers, in all or for each group."""
    return usage.groupBy(*by).agg(
        F.count("*").alias("calls"),
        F.sum(F.coalesce("input_tokens", F.lit(0))).alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).alias("output_tokens"),
        F.round(F.sum("cost"), 8).alias("cost"),
        F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("providers"),
    )


def spend_by_run(usage: DataFrame) -> DataFrame:
    """calls and cost of each run, and of all in a row named TOTAL."""
    out = usage.rollup("run").agg(F.grouping("run").alias("g"), F.count("*").alias("calls"), F.round(F.sum("cost"), 6).alias("cost"))
    return out.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("run")).alias("run"), "calls", "cost")


def tripwire(usage: DataFrame, key: str, order: list[str], cap: float) -> DataFrame:
    """For each key: total, and the number of the first call after which the running cost is above the cap (null if never)."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = usage.select(key, "cost", F.row_number().over(w).alias("call"), F.sum("cost").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("spent"))
    return rows.groupBy(key).agg(F.count("*").alias("calls"), F.round(F.sum("cost"), 6).alias("cost"), F.min(F.when(F.col("spent") > cap, F.col("call"))).alias("stopped_at"))


def unpivot(df: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """(ids..., field, value): one row for each field; null values become the sign of absence."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit(ABSENT[0])).alias("value")) for f in fields])
    return df.select(*ids, F.explode(cells).alias("c")).select(*ids, "c.field", "c.value")


def fill_rate(cells: DataFrame) -> DataFrame:
    """For each field of cells(field, value): n, filled, not_applicable and rate, rounded to 3."""
    n = cells.groupBy("field").agg(F.count("*").alias("n"), F.count_if(filled(F.col("value"))).alias("filled"), F.count_if(F.col("value") == ABSENT[1]).alias("not_applicable"))
    return n.withColumn("rate", F.round(F.col("filled") / F.col("n"), 3))


def coverage(cells: DataFrame, key: str, fields: int) -> DataFrame:
    """The share of a contract's fields that a card fills, rounded to 6."""
    return cells.groupBy(key).agg(F.round(F.count_if(filled(F.col("value"))) / F.lit(float(fields)), 6).alias("coverage"))


def breakdown(df: DataFrame, sets: list[list[str]], measure: Column | None = None) -> DataFrame:
    """One scan, counts by each set of columns: set_id, the columns (null where not of the set), n."""
    names = sorted({c for s in sets for c in s})
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(F.grouping_id().alias("gid"), (measure if measure is not None else F.count("*")).alias("n"))
    ids = {sum((c not in s) << (len(names) - 1 - i) for i, c in enumerate(names)): "+".join(s) or "all" for s in sets}
    label = F.create_map(*[x for k, v in ids.items() for x in (F.lit(k).cast("long"), F.lit(v))])
    return out.select(F.element_at(label, F.col("gid").cast("long")).alias("set_id"), *[F.col(c).cast("string").alias(c) for c in names], "n")


def run_variance(a: DataFrame, b: DataFrame) -> DataFrame:
    """Fields of cards in both runs (slug, field, value): slots, flips between filled and absent, changed values, identical ones and their percentage."""
    both = a.select("slug", "field", F.col("value").alias("x")).join(b.select("slug", "field", F.col("value").alias("y")), ["slug", "field"])
    flip = filled(F.col("x")) != filled(F.col("y"))
    same = F.col("x").eqNullSafe(F.col("y"))
    out = both.groupBy("field").agg(F.count("*").alias("slots"), F.count_if(flip).alias("flips"), F.count_if(~flip & ~same).alias("changes"), F.count_if(same).alias("identical"))
    return out.withColumn("identical_percent", F.round(100 * F.col("identical") / F.col("slots"), 1))


def judge_rates(verdicts: DataFrame, *by: str) -> DataFrame:
    """supported, wrong_entity (of filled) and missed (of absent) rates of verdicts(status, relation, info), null where there is nothing to divide by."""
    is_filled = F.col("status") != "not_specified"
    n, absent = F.count_if(is_filled), F.count_if(~is_filled)
    rate = lambda x, of: F.round(x / F.nullif(of, F.lit(0)), 4)
    return verdicts.groupBy(*by).agg(
        F.count("*").alias("verdicts"),
        n.alias("filled"),
        rate(F.count_if(F.col("status") == "supported"), n).alias("supported_rate"),
        rate(F.count_if(is_filled & (F.col("relation") == "other_entity")), n).alias("wrong_entity_rate"),
        rate(F.count_if(~is_filled & (F.col("info") == "present")), absent).alias("missed_rate"),
    )


def screen_summary(cards: DataFrame) -> DataFrame:
    """Of cards(target, verdict, findings array<string>): for each verdict the cards, findings, findings by card (3 places) and cards that need a fix with their share (4)."""
    per = cards.groupBy("verdict").agg(F.count("*").alias("cards"), F.sum(F.size("findings")).alias("findings"), F.count_if(F.size("findings") > 0).alias("need_fix"))
    return per.withColumns({"findings_per_card": F.round(F.col("findings") / F.col("cards"), 3), "need_fix_rate": F.round(F.col("need_fix") / F.col("cards"), 4)})


def probe_rates(flagged: DataFrame, labelled: DataFrame, by: list[str]) -> DataFrame:
    """flagged(key, ...) against labelled(key, positive): true and false positives, misses, unlabelled flags, detection and false positive rates (4 places)."""
    met = flagged.select(*by, "key", F.lit(True).alias("flag")).join(labelled.select(*by, "key", "positive"), [*by, "key"], "full_outer")
    flag, known, hit = F.col("flag").isNotNull(), F.col("positive").isNotNull(), F.coalesce("positive", F.lit(False))
    n = met.groupBy(*by).agg(F.count_if(flag & hit).alias("tp"), F.count_if(flag & known & ~hit).alias("fp"), F.count_if(~flag & hit).alias("missed"), F.count_if(flag & ~known).alias("unlabelled"))
    return n.withColumns({"detection": F.round(F.col("tp") / F.nullif(F.col("tp") + F.col("missed"), F.lit(0)), 4), "false_rate": F.round(F.col("fp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), 4)})


def pooled(results: DataFrame, by: str) -> DataFrame:
    """Results may be pooled only if one instrument made them: (by, instruments, n, pooled)."""
    return results.groupBy(by).agg(F.countDistinct("instrument").alias("instruments"), F.count("*").alias("n"), (F.countDistinct("instrument") == 1).alias("pooled"))


def estimate_cost(texts: DataFrame, by: str, price_in: float, price_out: float, max_out: int) -> DataFrame:
    """Expected cost of one call for each text(by, text): a quarter of its characters as tokens, and the full output."""
    tokens = F.floor(F.char_length("text") / 4)
    return texts.groupBy(by).agg(F.count("*").alias("calls"), F.sum(tokens).alias("tokens"), F.round(F.sum(tokens * price_in + max_out * price_out), 8).alias("cost"))


def atom_labels(atoms: DataFrame, by: str) -> DataFrame:
    """Counts of claim atoms by what their probability p_true says."""
    p = F.col("p_true")
    label = F.when(p.isNull(), "unscored").when(p < 0.3, "contradicted").when(p == 0.5, "neutral").when(p > 0.5, "supported").otherwise("uncertain")
    return atoms.groupBy(by, label.alias("label")).agg(F.count("*").alias("n"))
