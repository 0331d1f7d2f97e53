"""Mixing sources to target weights by pivotal dependent rounding, with built-in functions only.

A source's target over its size is how many copies of each of its documents the mix needs on average: a whole part, and a fraction that
is rounded for each document. The rounding is dependent: two documents with open fractions trade words, one up and one down by the
same number, until one of them is integral; chance picks the direction so that each document's expectation stays. So the source's words
never move away from its target, and only the last open document is rounded alone: the error is less than that document's size.

The trades run as a reduction tree. Documents are dealt by hash into buckets of about `bucket` of one source; a fold over a bucket leaves at most one
document open, and the open ones of `bucket` buckets meet in one bucket of the next level. A hot source only has more buckets. All chance comes from hashes of
the two documents' keys, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardloom.llm.common import WORD, cut, packed, table, unpacked

BUCKET = 64
SHARE = 1.5
MOST_COPIES = 2
WEIGHTS = (3, 1, 2)
_EPS = 1e-9


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, n_docs, target) of sizes(source, size), a row for each source.

    Sources by code point, null last, weigh weights in turn and share `share` of all words; a target stops at `most` times its source's size
    and the excess is shared again by weight. All capped sources have a smaller cap for their weight than any that is not, so
    one pass over the sources in that order finds the common level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * float(most))
    upto = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before, every = upto.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(every) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    per = per.withColumn("level", level)
    # the first source in this order whose cap is above the level there sets the level for itself and all later ones
    first_free = F.min(F.when(F.col("cap") / F.col("w") > F.col("level"), F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"), F.col("level").alias("level")))).over(every)
    per = per.withColumn("common", first_free["level"])
    target = F.when(F.col("common").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("common")))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def _chance(*of: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


_UNIT = "struct<key:bigint,mass:double,part:double,doc_id:bigint,size:bigint,n:bigint,sure:bigint,version:bigint>"


def _fold(units: Column, level: Column) -> Column:
    """Trades through an array of open units; returns (done: units with part 0 or 1, open: the one still open or null)."""
    none = F.lit(None).cast(_UNIT)
    done = F.array().cast(f"array<{_UNIT}>")

    def part(u: Column, value: Column) -> Column:
        return u.withField("part", F.when(value < _EPS, 0.0).when(value > 1 - _EPS, 1.0).otherwise(value))

    def trade(acc: Column, u: Column) -> Column:
        o = acc["open"]
        up = F.least((1 - o["part"]) * o["mass"], u["part"] * u["mass"])  # words that o can win from u
        down = F.least(o["part"] * o["mass"], (1 - u["part"]) * u["mass"])
        words = F.when(_chance(F.lit("trade"), o["key"], u["key"], level) * (up + down) < down, up).otherwise(-down)
        a, b = part(o, o["part"] + words / o["mass"]), part(u, u["part"] - words / u["mass"])
        is_open = lambda x: (x["part"] > 0) & (x["part"] < 1)
        both = F.array(a, b)
        traded = F.struct(
            F.concat(acc["done"], F.filter(both, lambda x: ~is_open(x))).alias("done"),
            F.get(F.filter(both, is_open), F.lit(0)).alias("open"),
        )
        return F.when(o.isNull(), F.struct(acc["done"].alias("done"), u.alias("open"))).otherwise(traded)

    return F.aggregate(units, F.struct(done.alias("done"), none.alias("open")), trade)


def mix_decisions(documents: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[int, ...] = WEIGHTS, bucket: int = BUCKET) -> DataFrame:
    """(source, doc_id, version, size, n, source_size, target, copies, more): one row for each document, n of which are in documents; each is taken `copies` times, and `more` of the n once more.

    Size is the number of words. Null, empty and blank texts have size 0 and are taken 0 times. Of n rows that repeat one doc_id with the same text in one source the whole part of
    their common fraction is taken for sure, and what is left is rounded like one row's, so repeats miss the target by no more than one of them. Ties need no rule: chance comes from hashes. A null source is a source of its own, the last.
    A table without rows gives none; a null doc_id counts as an id. Columns beside doc_id, text and source aren't read.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), F.xxhash64("text").alias("version"))
    docs = cut(docs.groupBy("doc_id", "source", "size", "version").agg(F.count("*").alias("n")), "sizes")
    targets = cut(source_targets(docs.select("source", (F.col("size") * F.col("n")).alias("size")), share, most, weights), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    of = targets.withColumnRenamed("source", "_of")
    joined = docs.join(of, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    of_all = F.col("n") * F.greatest(rate - F.floor(rate + _EPS), F.lit(0.0))  # how many of the n are to be taken once more, on average
    sure = F.floor(of_all + _EPS)
    joined = joined.withColumns({"sure": sure.cast("long"), "part": F.greatest(of_all - sure, F.lit(0.0)), "buckets": F.ceil(F.col("n_docs") / bucket)})
    key = F.xxhash64(F.lit("unit"), "doc_id", "version", "size")
    unit = F.struct(key.alias("key"), F.col("size").cast("double").alias("mass"), "part", "doc_id", "size", "n", "sure", "version")
    open_ = (F.col("size") > 0) & (F.col("part") > _EPS)
    at = joined.where(open_).select("source", "buckets", F.pmod(key, F.col("buckets")).alias("bucket"), unit.alias("unit"))
    levels, level = [], 0
    rounds = 1
    most_buckets = targets.agg(F.max(F.ceil(F.col("n_docs") / bucket))).first()[0] or 1
    while bucket**rounds < most_buckets * bucket:
        rounds += 1
    for level in range(rounds + 1):
        folded = at.groupBy("source", "buckets", "bucket").agg(F.sort_array(F.collect_list("unit")).alias("units"))
        folded = cut(folded.select("source", "buckets", "bucket", _fold(F.col("units"), F.lit(level)).alias("f")), f"level{level}")
        levels.append(folded.select("source", F.explode("f.done").alias("u")))
        fewer = F.ceil(F.col("buckets") / bucket)
        at = folded.where("f.open is not null").select("source", fewer.alias("buckets"), F.floor(F.col("bucket") / bucket).alias("bucket"), F.col("f.open").alias("unit"))
    last = at.withColumn("unit", F.col("unit").withField("part", F.when(_chance(F.lit("last"), F.col("unit.key")) < F.col("unit.part"), 1.0).otherwise(0.0)))
    levels.append(last.select("source", F.col("unit").alias("u")))
    rounded = levels[0]
    for x in levels[1:]:
        rounded = rounded.unionByName(x)
    rounded = rounded.select("source", "u.doc_id", "u.size", "u.version", "u.n", (F.col("u.sure") + F.col("u.part").cast("long")).alias("more"))
    rest = joined.where(~open_).select("source", "doc_id", "size", "version", "n", F.when(F.col("size") > 0, F.col("sure")).otherwise(0).cast("long").alias("more"))
    copies = rounded.unionByName(rest)
    out = copies.join(of, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + _EPS)).otherwise(0)
    out = out.withColumn("copies", F.when(F.col("size") > 0, whole).otherwise(0).cast("long"))
    return out.select("source", "doc_id", "version", "size", "n", "source_size", "target", "copies", "more")


def mix_sources(documents: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of each row of documents; see mix_decisions."""
    found = mix_decisions(documents, share, most, weights)
    rows = found.withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("copies", F.col("copies") + (F.col("place") <= F.col("more")).cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(documents: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: each row of documents as often as the mix takes it, with all its columns, whatever they are called; edge cases as in mix_decisions."""
    found = mix_decisions(documents, share, most, weights).where("copies > 0 or more > 0")
    found = found.select(F.col("source").alias("of_source"), F.col("doc_id").alias("of_doc"), F.col("version").alias("of"), "copies", "more", "n")
    docs = packed(documents, doc_id=F.col("doc_id").cast("long"), version=F.xxhash64("text"), source=F.col("source"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & F.col("version").eqNullSafe(F.col("of")) & F.col("source").eqNullSafe(F.col("of_source"))
    met = docs.join(found, same)
    alike = met.where((F.col("more") == 0) | (F.col("more") == F.col("n"))).select("row", (F.col("copies") + (F.col("more") > 0).cast("long")).alias("times"))
    # only repeated rows that aren't all treated alike need places
    place = F.row_number().over(Window.partitionBy("doc_id", "version", "source").orderBy(F.xxhash64("row")))
    placed = met.where((F.col("more") > 0) & (F.col("more") < F.col("n"))).withColumn("place", place)
    rows = alike.unionByName(placed.select("row", (F.col("copies") + (F.col("place") <= F.col("more")).cast("long")).alias("times"))).where("times > 0")
    return unpacked(rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))), documents.columns)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much the mix takes of every document; edge cases as in mix_decisions."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
