"""Papers and repositories of a model: what a name, a title and a repository say of family and generation, and which candidates are the model's own.

Names of models are "owner/name" or bare. Nulls give null or false, as each function says; all work is done by Spark's functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions.text import let
from cardloom.operators import labels

# Words of a name that tell no family, words that may stand before a family in a report's title, tiers from best to worst.
GENERIC = ("base", "instruct", "chat", "hf", "it", "model", "preview", "sft", "dpo", "rl", "v1", "v2", "v3", "mini", "small", "large", "medium")
LEADS = ("the", "a", "an", "introducing", "presenting", "announcing")
TIERS = ("introduces_target", "family_reference", "unrelated_tag")
# Where arXiv numbers stand.
NUMBER = r"(\d{4}\.\d{4,5})(?:v\d+)?"
TAG = rf"(?i)^arxiv:{NUMBER}$"
LINK = rf"https?://arxiv\.org/(?:abs|pdf)/{NUMBER}"
IN_BIBTEX = rf"(?i)(?:eprint\s*=\s*[{{\"']|arxiv[:\s]+){NUMBER}"
BIBTEX = r"(?s)(@[a-zA-Z]+\s*\{.*?\n\})"
REPOSITORY = r"(?i)github\.com/[A-Za-z0-9_.-]+/([A-Za-z0-9_.-]+)"

_GENERATION = r"^v?\d+(\.\d+)*$"


def _low(model: Column) -> Column:
    return F.lower(F.substring_index(model, "/", -1))


def words(text: Column) -> Column:
    """The runs of a-z and digits of a text, lower-cased."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _dotted(model: Column) -> Column:
    """The words of a name, points inside a word kept."""
    return F.filter(F.transform(F.split(_low(model), "[^a-z0-9.]+"), lambda t: F.regexp_replace(t, r"^\.+|\.+$", "")), lambda t: t != "")


def _family(w: Column) -> Column:
    return F.array_distinct(F.filter(w, lambda t: (F.length(t) >= 3) & ~t.rlike(r"^\d+[bm]?$") & ~t.isin(*GENERIC)))


def family_words(model: Column) -> Column:
    """Words of the name that can name its family: three signs or more, no number, size or generic word; each once."""
    return _family(words(_low(model)))


def _parsed(model: Column) -> Column:
    """struct(words, family, numbered, head) of a name: numbered has (word, next) for each family word that a number or size follows; head is the first of these, else the first family word."""
    def numbered(w: Column, family: Column) -> Column:
        pairs = F.transform(w, lambda t, i: F.struct(t.alias("word"), F.get(w, i + 1).alias("next")))
        return F.filter(pairs, lambda p: F.array_contains(family, p["word"]) & F.coalesce(p["next"].rlike(r"^\d+[bm]?$"), F.lit(False)))

    def parts(w: Column, family: Column, pairs: Column) -> Column:
        head = F.coalesce(F.get(pairs, F.lit(0))["word"], F.get(family, F.lit(0)))
        return F.struct(w.alias("words"), family.alias("family"), pairs.alias("numbered"), head.alias("head"))

    return let(words(_low(model)), lambda w: let(_family(w), lambda family: let(numbered(w, family), lambda pairs: parts(w, family, pairs))))


def _forms(numbered: Column) -> Column:
    forms = F.transform(numbered, lambda p: F.transform(F.array(F.lit(" "), F.lit("-"), F.lit("")), lambda j: F.concat(p["word"], j, p["next"])))
    return F.array_distinct(F.flatten(forms))


def name_forms(model: Column) -> Column:
    """How family and number are written together: "nova 3", "nova-3" and "nova3"; empty if no number follows a family word."""
    return _forms(_parsed(model)["numbered"])


def head_word(model: Column) -> Column:
    """The word that names the family: that before a number or size, else the first family word; null if there is none."""
    return _parsed(model)["head"]


def _trailing(word: Column) -> Column:
    return F.regexp_extract(word, r"(\d+)$", 1)


def _joined(*parts: Column) -> Column:
    """Parts joined by points, empty ones left out; empty if all are."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), ".")


def generation(model: Column, word: Column) -> Column:
    """The generation that stands next to a family word: "3.1" of Nova-3.1-8B, "2.5" of nova2.5-7b, "3" of Nova-V3; null for Nova-7B-v0.3, whose number is a size."""
    def hit(w: Column, word: Column) -> Column:
        at = F.transform(w, lambda t, i: F.struct(F.when(F.startswith(t, word), F.substr(t, F.length(word) + 1)).alias("rest"), F.get(w, i + 1).alias("next")))
        return F.get(F.filter(at, lambda p: F.coalesce(p["rest"].rlike(r"^(\.?\d+(\.\d+)*)?$"), F.lit(False))), F.lit(0))

    def told(h: Column, word: Column) -> Column:
        apart = F.coalesce(h["next"].rlike(_GENERATION), F.lit(False))
        return F.when(h["rest"] != "", _joined(_trailing(word), F.regexp_replace(h["rest"], r"^\.", ""))).when(apart, F.regexp_replace(h["next"], "^v", "")).when(h.isNotNull(), _trailing(word))

    return F.nullif(let(word, lambda x: let(let(_dotted(model), lambda w: hit(w, x)), lambda h: told(h, x))), F.lit(""))


def version(name: Column) -> Column:
    """The generation that the first telling word of a name carries, or that follows it; dates of four digits and more are none."""
    def first(w: Column) -> Column:
        told = F.transform(w, lambda t, i: F.struct(t.alias("word"), F.get(w, i + 1).alias("next")))
        return F.get(F.filter(told, lambda p: (F.length(p["word"]) >= 3) & ~p["word"].rlike(r"^(\d+|\d+(\.\d+)?[bm])$") & ~p["word"].isin(*GENERIC)), F.lit(0))

    def read(f: Column) -> Column:
        glued = F.regexp_extract(f["word"], r"^[a-z]+(\d+(\.\d+)?)$", 1)
        apart = f["next"].rlike(r"^v?\d+(\.\d+)?$") & ~f["next"].rlike(r"^\d{4,}$")
        return F.when(glued != "", glued).when(apart, F.regexp_replace(f["next"], "^v", ""))

    return let(let(_dotted(name), first), read)


def _title_pattern(word: Column, own: Column) -> Column:
    """A title whose subject is the family word: nothing but a lead word before it; behind it a generation, then no further name but words of the own name. Group 1 is the generation.

    The generation is an atomic group: what follows may refuse a title, but never make the generation shorter.
    """
    return F.concat(
        F.lit(rf"(?s)^(?:.*?(?<![a-z])(?:{'|'.join(LEADS)}))??[^a-z]*?(?<![a-z0-9-])"), word,
        F.lit(r"(?>(?:[.\-\s]?v?(\d+(?:\.\d+)*)(?![bm\d]))?)(?![a-z0-9])(?!-(?!(?:"), F.array_join(own, "|"), F.lit(")(?![a-z0-9]))[a-z0-9])"),
    )


def title_names(model: Column, title: Column) -> Column:
    """True if the title's subject is the model's family in the model's generation or an earlier part of it; a title of no generation suits only a name of none."""
    def agree(low: Column, pattern: Column, name: Column) -> Column:
        # a match holds the family word, so it is never empty; null in, null out
        group = lambda n: F.call_function("regexp_extract", low, pattern, F.lit(n))
        stated = let(_joined(_trailing(name["head"]), group(1)), lambda x: F.when(x == "", name["mine"] == "").otherwise(F.startswith(F.concat(name["mine"], F.lit(".")), F.concat(x, F.lit(".")))))
        return F.when(group(0) != "", stated)

    def told(n: Column) -> Column:
        return F.struct(n["head"].alias("head"), F.coalesce(generation(model, n["head"]), F.lit("")).alias("mine"), _title_pattern(n["head"], n["words"]).alias("pattern"))

    return F.coalesce(let(let(_parsed(model), told), lambda x: agree(F.lower(title), x["pattern"], x)), F.lit(False))


def _owners(model: Column, bases: Column) -> Column:
    """The model and those of its bases that have an owner."""
    return F.concat(F.array(model), F.filter(F.coalesce(bases, F.array().cast("array<string>")), lambda b: F.coalesce(F.contains(b, F.lit("/")), F.lit(False))))


def title_gate(model: Column, title: Column, bases: Column) -> Column:
    """True if a paper found by search may be the model's: its title names the model or one of its bases."""
    return F.exists(_owners(model, bases), lambda m: title_names(m, title))


def tier(model: Column, title: Column, abstract: Column, bases: Column) -> Column:
    """How near a paper is: introduces_target if the abstract has the name, or title and abstract have all family words and a form with the number; family_reference if they have a family word of the model or a base; else unrelated_tag."""
    abstract = F.lower(F.coalesce(abstract, F.lit("")))
    text = F.concat_ws(" ", F.lower(F.coalesce(title, F.lit(""))), abstract)
    name = _low(model)

    def near(said: Column, text: Column, n: Column) -> Column:
        mine, forms = n["family"], _forms(n["numbered"])
        named = (name != "") & F.contains(F.replace(abstract, F.lit(" "), F.lit("-")), name)
        told = F.exists(mine, lambda t: t.rlike(r"\d")) | (F.size(n["numbered"]) == 0) | F.exists(forms, lambda f: F.contains(text, f))
        whole = (F.size(mine) > 0) & (F.size(F.array_except(mine, said)) == 0) & told
        of_family = F.exists(_owners(model, bases), lambda m: F.arrays_overlap(family_words(m), said))
        return F.when(named | whole, TIERS[0]).when(of_family, TIERS[1]).otherwise(TIERS[2])

    return let(text, lambda t: let(words(t), lambda said: let(_parsed(model), lambda n: near(said, t, n))))


def searches(model: Column, bases: Column, most: int = 3) -> Column:
    """What to search for, the most telling first: reports of the family, then of the families of its bases; each once whatever its case."""
    family = labels.family(model)
    others = F.filter(F.transform(F.slice(_owners(model, bases), F.lit(2), F.greatest(F.size(_owners(model, bases)) - 1, F.lit(0))), labels.family), lambda f: F.lower(f) != F.lower(family))
    asked = F.concat(F.array(F.concat(family, F.lit(" technical report")), F.concat(family, F.lit(" language model"))), F.transform(others, lambda f: F.concat(f, F.lit(" technical report"))))
    low = F.transform(asked, F.lower)
    return F.slice(F.filter(asked, lambda q, i: F.array_position(low, F.lower(q)) == i + 1), 1, most)


def arxiv_numbers(tags: Column, readme: Column) -> Column:
    """array of struct(arxiv_id, origin): the numbers of tags, then of BibTeX entries, then of links; each once, where it stands first."""
    def numbers(texts: Column, pattern: str, origin: str) -> Column:
        found = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(pattern), 1)))
        return F.transform(found, lambda x: F.struct(x.alias("arxiv_id"), F.lit(origin).alias("origin")))

    text = F.coalesce(readme, F.lit(""))
    entries = F.regexp_extract_all(text, F.lit(BIBTEX), 1)
    in_entries = F.flatten(F.transform(entries, lambda e: F.concat(numbers(F.array(e), LINK, "readme_bibtex"), numbers(F.array(e), IN_BIBTEX, "readme_bibtex"))))
    given = F.array_compact(F.coalesce(tags, F.array().cast("array<string>")))
    every = F.concat(numbers(given, TAG, "hf_arxiv_tag"), in_entries, numbers(F.array(text), LINK, "readme_link"))
    ids = F.transform(every, lambda x: x["arxiv_id"])
    return F.filter(every, lambda x, i: F.array_position(ids, x["arxiv_id"]) == i + 1)


def choose_papers(candidates: DataFrame) -> DataFrame:
    """One paper for each target of candidates(target, model, bases, seq, arxiv_id, title, abstract, origin, searched): (target, arxiv_id, title, origin, tier).

    The first by seq that introduces the target, else the first that speaks of its family. A searched one must pass the title gate.
    Of rows with equal seq the one with the smallest arxiv_id is first. Targets without a usable paper give no row; null titles and abstracts count as empty.
    """
    near = F.when(F.coalesce(F.col("searched"), F.lit(False)) & ~title_gate(F.col("model"), F.col("title"), F.col("bases")), TIERS[2]).otherwise(tier(F.col("model"), F.col("title"), F.col("abstract"), F.col("bases")))
    first = F.min(F.when(F.col("tier") != TIERS[2], F.struct((F.col("tier") != TIERS[0]).alias("far"), "seq", "arxiv_id", "title", "origin", "tier"))).alias("f")  # a filter on the tier would work it out twice
    return candidates.withColumn("tier", near).groupBy("target").agg(first).where("f is not null").select("target", "f.arxiv_id", "f.title", "f.origin", "f.tier")


def own_repository(model: Column, url: Column) -> Column:
    """True if a repository is the model's: its name holds a family word, with or without the word's number, and if both names have a generation, its first number agrees."""
    repo = F.regexp_replace(F.lower(F.regexp_extract(url, REPOSITORY, 1)), r"\.git$", "")
    major = lambda v: F.substring_index(v, ".", 1)

    def agree(own: Column, repo: Column) -> Column:
        family = F.filter(F.concat(own, F.transform(own, lambda t: F.regexp_replace(t, r"\d+$", ""))), lambda t: F.length(t) >= 3)
        return F.exists(family, lambda t: F.contains(repo, t)) & F.coalesce(major(version(F.substring_index(model, "/", -1))) == major(version(repo)), F.lit(True))

    return F.coalesce(let(repo, lambda r: let(family_words(model), lambda own: agree(own, r))), F.lit(False))


def own_repositories(links: DataFrame) -> DataFrame:
    """links(target, model, seq, url) that are the model's own: (target, url, rank), each once whatever its case; the names that hold most words of the model's first, then the shorter, then the earlier."""
    url = F.concat(F.lit("https://"), F.regexp_replace(F.regexp_extract("url", REPOSITORY, 0), r"(?i)^github\.com", "github.com"))
    clean = F.regexp_replace(F.regexp_replace(url, r"[.,;:)\]\"']+$", ""), r"\.git$", "")
    own = links.where(F.coalesce(F.col("url").rlike(REPOSITORY), F.lit(False))).withColumn("url", clean).where(own_repository(F.col("model"), F.col("url")))
    first = own.groupBy("target", "model", F.lower("url").alias("low")).agg(F.min(F.struct("seq", "url")).alias("f"))
    repo = F.element_at(F.split("low", "/"), -1)
    hits = F.size(F.filter(words(_low(F.col("model"))), lambda t: F.contains(repo, t)))
    rank = F.row_number().over(Window.partitionBy("target").orderBy(F.desc(hits), F.length(repo), "f.seq", "low"))
    return first.select("target", F.col("f.url").alias("url"), rank.alias("rank"))
