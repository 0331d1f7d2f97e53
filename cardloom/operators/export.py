"""Cards for the public: a Markdown page and its digest for each target, and the guards that hold a card back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions import names as N
from cardloom.functions import text as T
from cardloom.operators.evidence import copied_runs
from cardloom.operators.metrics import filled


# The kinds of sensitive text that hold a card back; addresses of mail and licenses are a card's own business.
WITHHELD = ("path", "folder", "workspace", "secret", "host")


def render(cells: DataFrame, policy: DataFrame) -> DataFrame:
    """(target, markdown, sha256, unavailable): sections and fields in the contract's order, values escaped, absent fields listed at the end."""
    rows = cells.join(policy.select("field", "section", "ordinal"), "field")
    name = F.replace(F.substring_index("field", ".", -1), F.lit("_"), F.lit(" "))
    line = F.when(filled(F.col("value")), F.concat(F.lit("- **"), name, F.lit("**: "), N.escape_markdown(F.col("value"))))
    per = rows.select("target", "section", "ordinal", line.alias("line"), F.col("field"))
    sections = per.groupBy("target", "section").agg(
        F.min("ordinal").alias("first"),
        F.array_join(F.array_compact(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "line"))), lambda x: x["line"])), "\n").alias("body"),
        F.array_compact(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", F.when(F.col("line").isNull(), F.col("field")).alias("field")))), lambda x: x["field"])).alias("absent"),
    )
    title = F.concat(F.lit("## "), F.initcap(F.replace("section", F.lit("_"), F.lit(" "))), F.lit("\n\n"), F.when(F.col("body") == "", "Nothing is known.").otherwise(F.col("body")))
    ordered = F.sort_array(F.collect_list(F.struct("first", title.alias("text"), "absent")))
    page = sections.groupBy("target").agg(ordered.alias("s"))
    absent = F.flatten(F.transform("s", lambda x: x["absent"]))
    text = F.concat(F.lit("# "), "target", F.lit("\n\n"), F.array_join(F.transform("s", lambda x: x["text"]), "\n\n"), F.lit("\n\nUnavailable: "), F.array_join(absent, ", "), F.lit("\n"))
    return page.select("target", text.alias("markdown"), F.size(absent).alias("unavailable")).withColumn("sha256", F.sha2(F.col("markdown").cast("binary"), 256))


def refusals(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """(target, field, reason): cells that hold sensitive text, or prose that runs for twelve words with a source."""
    leaks = cells.where(F.col("value").rlike("(?i)" + "|".join(f"(?:{T.SENSITIVE[k]})" for k in WITHHELD))).select("target", "field", F.lit("sensitive_text").alias("reason"))
    keyed = cells.select(F.to_json(F.struct("target", "field")).alias("value_id"), F.col("value").alias("text"))
    copied = copied_runs(keyed, sources).select(F.from_json("value_id", "target string, field string").alias("k"))
    return leaks.unionByName(copied.select("k.target", "k.field", F.lit("prose_reproduces_source_excerpt").alias("reason")))
