"""Where many names stand in texts: one pass over each text whatever the number of names."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HITS = "array<struct<at: int, n: int, id: string, type: string>>"
# Numbers, words like identifiers, and words joined like a model's name.
NUMBER = r"(\d[\d,]*(?:\.\d+)?)"
IDENTIFIER = r"(\b[A-Za-z][\w.-]*\b)"
MODEL_NAME = r"(\b[A-Za-z][\w.]*(?:[-_][A-Za-z0-9][\w.]*)+\b)"

Names = list[tuple[str, str | None, str | None]]


def _automaton(names: Names) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for name, id_, type_ in names:
        _, who = found.get(name, (0, set()))
        found.add_word(name, (len(name), who | {(id_, type_)}))
    found.make_automaton()
    return found


def _hits(text: str, automaton: ahocorasick.Automaton, longest: bool) -> list[dict]:
    """The first place of each name's bearer, by place."""
    spans = ((end - n + 1, n, who) for end, (n, who) in automaton.iter(text))
    reached, first = -1, {}
    if longest:
        spans = sorted(spans, key=lambda s: (s[0], -s[1]))
    for at, n, who in spans:
        if longest and at + n <= reached:
            continue
        reached = at + n
        for bearer in who:
            first[bearer] = min(first.get(bearer, (at, n)), (at, n))
    return [{"at": at, "n": n, "id": i, "type": t} for (i, t), (at, n) in sorted(first.items(), key=lambda x: (x[1], x[0][0] or "", x[0][1] or ""))]


def with_names(texts: DataFrame, names: DataFrame, text: str = "text", longest: bool = True, slices: int | None = None) -> DataFrame:
    """texts(target, ...) with `hits`: where each id of names(target, name, id, type) first stands in the column `text`, from 0 in code points, by place.

    With `longest` a name inside a longer one that is also there doesn't count. Names are compared as they are: fold case on both sides before.
    A target's texts are dealt into `slices` parts (the session's shuffle partitions, unless given) and its names to each part that has texts. A part's names come
    first in its partition and are made an automaton; its texts then stream by, so a task holds the names of one target and a batch of texts,
    however many texts a target has. Texts that are null, and those of a null target or one without names, have no hits; null and empty names are left out, repeated ones count once.
    """
    spark = texts.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.select(F.col("target").cast("string").alias("k"), F.pmod(F.xxhash64(text, F.lit(1)), F.lit(slices)).cast("int").alias("s"), F.struct(*[F.col(f"`{c}`") for c in texts.columns]).alias("row"), F.col(text).alias("t"))
    cells = keyed.where("k is not null").select("k", "s").distinct()
    known = names.select(F.col("target").cast("string").alias("k"), "name", F.col("id").cast("string").alias("id"), F.col("type").cast("string").alias("type")).where("name <> ''").distinct()
    each = known.join(cells, "k").select("k", "s", "name", "id", "type", F.lit(None).cast(keyed.schema["row"].dataType).alias("row"), F.lit(None).cast("string").alias("t"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("name", "id", "type")]
    both = each.unionByName(keyed.select("k", "s", *nothing, "row", "t"))
    dealt = both.repartition("k", "s").sortWithinPartitions("k", "s", F.col("name").isNull())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, given, automaton = None, [], None
        for batch in batches:
            k, s, name, id_, type_, t = (batch.column(c).to_pylist() for c in ("k", "s", "name", "id", "type", "t"))
            kept, hits = [], []
            for i in range(batch.num_rows):
                if (k[i], s[i]) != cell:
                    cell, given, automaton = (k[i], s[i]), [], None
                if name[i] is not None:
                    given.append((name[i], id_[i], type_[i]))
                    continue
                if given and automaton is None:
                    automaton = _automaton(given)
                kept.append(i)
                hits.append(_hits(t[i], automaton, longest) if t[i] and automaton else [])
            if kept:
                rows = batch.column("row").take(pa.array(kept))
                yield pa.RecordBatch.from_arrays([rows, pa.array(hits, _HITS_ARROW)], ["row", "hits"])

    shape = T.StructType([T.StructField("row", keyed.schema["row"].dataType), T.StructField("hits", T._parse_datatype_string(HITS))])
    return dealt.select("k", "s", "name", "id", "type", "row", "t").mapInArrow(find, shape).select("row.*", "hits")


_HITS_ARROW = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("id", pa.string()), ("type", pa.string())]))


def declared_names(targets: DataFrame) -> DataFrame:
    """(target, name, id, type) of targets(target, model, bases): the names that a model and its tags ("kind:owner/name") declare, in full and without owner; its own come before those of bases."""
    own = F.array(F.substring_index("model", "/", -1), F.col("model"))
    full = F.filter(F.transform(F.coalesce("bases", F.array().cast("array<string>")), lambda b: F.substring_index(b, ":", -1)), lambda b: F.coalesce(F.contains(b, F.lit("/")), F.lit(False)))
    other = F.array_except(F.flatten(F.transform(full, lambda b: F.array(F.substring_index(b, "/", -1), b))), own)
    role = lambda names, r: F.transform(names, lambda x: F.struct(x.alias("name"), F.lit(r).alias("type")))
    return targets.select("target", F.explode(F.concat(role(own, "target"), role(other, "base"))).alias("x")).select("target", "x.name", F.col("x.name").alias("id"), "x.type").distinct()


def line_owners(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """lines(target, text, ...) with `owner`: target or base by the declared name that stands first (of two at one place the lesser), else other if any name like a model's with a digit stands there that isn't the target's, else null.

    targets(target, model, bases) has one row for each target. Empty and null lines, and lines of unknown targets without such a name, have no owner.
    """
    found = with_names(lines, declared_names(targets), longest=False)
    first = F.array_min(F.transform("hits", lambda h: F.struct(h["at"], h["id"], h["type"])))["type"]
    own = targets.groupBy("target").agg(F.lower(F.substring_index(F.min("model"), "/", -1)).alias("own_"))
    others = F.exists(F.regexp_extract_all("text", F.lit(MODEL_NAME), 1), lambda x: x.rlike(r"\d") & (F.lower(x) != F.coalesce("own_", F.lit(""))))
    owner = F.coalesce(first, F.when(others, "other"))
    return found.join(own, "target", "left").select(*[F.col(f"`{c}`") for c in lines.columns], owner.alias("owner"))


def telling_tokens(value: Column, most: int = 8) -> Column:
    """What finds a value in a source: its numbers of two digits or more, then its words of three signs or more with a digit or an inner capital; each once, the first ones."""
    numbers = F.filter(F.regexp_extract_all(value, F.lit(NUMBER), 1), lambda x: F.length(F.regexp_replace(x, "[,.]", "")) >= 2)
    words = F.filter(F.regexp_extract_all(value, F.lit(IDENTIFIER), 1), lambda x: (F.length(x) >= 3) & x.rlike(r"\d|^.+[A-Z]"))
    return F.slice(F.array_distinct(F.concat(numbers, words)), 1, most)
