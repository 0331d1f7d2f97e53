"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are the runs of letters of a text in lower case and, for words longer than that, their first five letters, which catch inflected and compounded words. All terms of a text weigh
in its vector: (1 + log count) times the inverse document frequency, counted over all documents, times how well the term tells the classes apart in the labelled sample,
LEAST_WEIGHT + chi2 / (chi2 + 30). By plain TF-IDF a long text's nearest examples are those on its subject: held out on the given tables that finds a third of the toxic texts; with
the third factor it finds nine in ten. No term is dropped; one that no example holds counts in the text's length only, with the frequency of a term of one document.

Examples lie in blocks of the index, like ones together. Terms that over an eighth of the examples hold are kept as rows of a matrix, whose part in all cosines is one product for a batch of
texts. All other terms have postings, and for each term and block the largest weight is kept: the sum of these and the largest part from common terms
bound every cosine in a block, so blocks are scored best bound first until no bound can reach the k-th cosine found. A text with at most DIRECT postings has them all added at once, as its
bounds would cost more than they save; both ways give the same. The k nearest vote with the square of their cosine, and a
logistic curve fitted to the examples' leave-one-out votes turns votes into probabilities. A text without neighbours gets the share of toxic ones among the labelled texts without terms.

The fit reads a bounded sample, at most `per_class` labelled texts of each class by the smallest hash of their id, so the index has a bounded size and may be broadcast.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, done_with, held_out, lowest, mix, packed, table, unpacked
from cardloom.llm.lines import ranges

PER_CLASS = 2048
LEAST_WEIGHT = 0.05
HALF_CHI2 = 30.0
STEM = 5
NEIGHBOURS = 15
BLOCK = 64
FIRST_BLOCKS = 4
MOST_SHOWN = 3
#: Postings of a text up to which they are added without bounds.
DIRECT = 1 << 17
#: Texts whose common terms are multiplied at once.
TOGETHER = 64
#: Examples of one class that share this much of their terms are copies.
COPY = 0.8

_LETTER: list[np.ndarray] = []
#: Code points and places in a word whose hashes are kept.
_CODES, _PLACES = 1 << 10, 32
_SIGN_HASHES: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTER[0]


def _sign_hashes(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash of each code point and its place in its word; those of most scripts are looked up."""
    if not _SIGN_HASHES:
        _SIGN_HASHES.append(mix((np.arange(_CODES, dtype=np.uint64) | np.arange(_PLACES, dtype=np.uint64)[:, None] << np.uint64(32)).ravel()))
    if codes.max() < _CODES and place.max() < _PLACES:
        return _SIGN_HASHES[0][place * _CODES + codes]
    return mix(codes | place.astype(np.uint64) << np.uint64(32))


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a text as sorted 64-bit hashes, and how often each stands there; a long word's beginning is a term of its own kind."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.zeros(len(codes) + 2, bool)
    letter[1:-1] = _letters()[codes]
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    n = ends - starts
    first = np.cumsum(n) - n
    place = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
    total = np.zeros(len(place) + 1, np.uint64)
    np.cumsum(_sign_hashes(codes[letter[1:-1]], place), out=total[1:])
    long = n > STEM
    words = mix(total[first + n] - total[first] ^ n.astype(np.uint64), 1)
    stems = mix(total[first[long] + STEM] - total[first[long]], 2)
    return np.unique(np.r_[words, stems].view(np.int64), return_counts=True)


def sketch(f: np.ndarray) -> int:
    """Two MinHash values of a set of terms in one: texts that share most terms mostly share it, others rarely do."""
    if not len(f):
        return 0
    low = [mix(f.view(np.uint64), salt).min() for salt in (1, 2)]
    return int(np.array([low[0] ^ low[1] << np.uint64(1)], np.uint64).view(np.int64)[0])


class Space:
    """The examples' terms, sorted; their places there are their numbers. Each has a weight, and the last weight is that of all other terms."""

    def __init__(self, known: np.ndarray, weight: np.ndarray) -> None:
        self.known, self.weight = known, weight

    def numbers(self, f: np.ndarray) -> np.ndarray:
        """The terms' numbers; terms of no example have the number behind the last."""
        at = np.searchsorted(self.known, f)
        return np.where(self.known[np.minimum(at, len(self.known) - 1)] == f, at, len(self.known)) if len(self.known) else at

    def vector(self, f: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The known terms' numbers and their weights in the vector of unit length of all terms."""
        f = self.numbers(f)
        w = (1 + np.log(n)) * self.weight[f]
        known = f < len(self.known)
        return f[known], w[known] / (np.sqrt((w * w).sum()) or 1)


class Index:
    """Example vectors: a matrix of the common terms, and postings of the others with the largest weight of each term in each block."""

    def __init__(self, n_terms: int, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        """examples: (doc_id, toxic, terms, weights)."""

        def strongest(x: tuple) -> tuple:
            top = np.lexsort((x[2], -x[3]))[:3]
            return (*x[2][top].tolist(), x[0])

        # examples with like strong terms lie in one block, which makes its bounds sharp
        examples = sorted(examples, key=strongest)
        self.ids = np.array([x[0] for x in examples], np.int64)
        self.toxic = np.array([x[1] for x in examples], np.int64)
        self.blocks = -(-len(examples) // BLOCK)
        of = np.repeat(np.arange(len(examples)), [len(x[2]) for x in examples])
        term = np.concatenate([np.empty(0, np.int64), *(x[2] for x in examples)])
        weight = np.concatenate([np.empty(0), *(x[3] for x in examples)])
        common = np.flatnonzero(np.bincount(term, minlength=n_terms) * 8 > len(examples))
        self.row = np.full(n_terms, -1)
        self.row[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), self.blocks * BLOCK))
        often = self.row[term] >= 0
        self.matrix[self.row[term[often]], of[often]] = weight[often]
        term, of, weight = term[~often], of[~often], weight[~often]
        order = np.argsort(term, kind="stable")
        term, self.at, self.weight = term[order], of[order].astype(np.int32), weight[order]
        block = self.at // BLOCK
        begins = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])][: len(term)])
        self.of_term = np.searchsorted(term, np.arange(n_terms + 1))
        # one entry for each term and block: its postings, the block and the largest weight
        self.start, self.n = begins, np.diff(np.r_[begins, len(term)])
        self.block = block[begins]
        self.bound = np.maximum.reduceat(self.weight, begins) if len(begins) else np.empty(0)
        self.first = np.searchsorted(term[begins], np.arange(n_terms + 1))

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[list[int]] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector (terms, weights) the k examples of largest cosine (ties: first in the index) and their cosines; exact."""
        out = []
        for lo in range(0, len(vectors), TOGETHER):
            part = vectors[lo : lo + TOGETHER]
            common = np.zeros((len(part), len(self.matrix)))
            for i, (f, w) in enumerate(part):
                row = self.row[f]
                common[i, row[row >= 0]] = w[row >= 0]
            base = common @ self.matrix
            out += [self._nearest(f, w, b, k, without[lo + i] if without else []) for i, ((f, w), b) in enumerate(zip(part, base, strict=True))]
        return out

    def _nearest(self, f: np.ndarray, w: np.ndarray, base: np.ndarray, k: int, without: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """base: what the common terms add to each cosine. The best bounded blocks are scored first; they set the floor that decides which others are scored at all."""
        found, score = np.empty(0, np.int64), np.empty(0)
        n = self.of_term[f + 1] - self.of_term[f]
        if n.sum() <= DIRECT:
            posting = ranges(self.of_term[f], n)
            return self._best(np.bincount(self.at[posting], np.repeat(w, n) * self.weight[posting], minlength=len(base)) + base, k, without, found, score)
        n = self.first[f + 1] - self.first[f]
        entry, of = ranges(self.first[f], n), np.repeat(w, n)
        block = self.block[entry]
        bound = np.bincount(block, of * self.bound[entry], minlength=self.blocks) + base.reshape(-1, BLOCK).max(axis=1)
        order = np.argsort(-bound, kind="stable")
        for blocks in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
            blocks = blocks[bound[blocks] > 0]
            if len(found) == k:
                blocks = blocks[bound[blocks] >= score[-1] - 1e-12]
            if not len(blocks):
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[blocks] = True
            take = chosen[block]
            count = self.n[entry[take]]
            posting = ranges(self.start[entry[take]], count)
            c = np.bincount(self.at[posting], np.repeat(of[take], count) * self.weight[posting], minlength=len(base)) + base
            c[np.repeat(~chosen, BLOCK)] = 0
            found, score = self._best(c, k, without, found, score)
        return found, score

    def _best(self, c: np.ndarray, k: int, without: list[int], found: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best of those found so far and of the examples with cosines c, 0 for those that aren't scored."""
        c[without] = 0
        floor = max(np.partition(c, len(c) - k)[len(c) - k] - 1e-9, score[-1] - 1e-9 if len(found) == k else 0) if len(c) > k else 0
        near = np.flatnonzero(c > max(floor, 0))
        found, score = np.r_[found, near], np.r_[score, c[near]]
        best = np.lexsort((found, -np.round(score, 12)))[:k]
        return found[best], score[best]


class Model:
    """The terms, the index and the curve; `bare` is the score of a text without neighbours."""

    def __init__(self, space: Space | None, index: Index | None, class_weight: tuple[float, float], bare: float, k: int) -> None:
        self.space, self.index, self.class_weight, self.bare, self.k = space, index, np.array(class_weight), bare, k
        self.slope, self.shift = 8.0, -4.0

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        toxic = self.index.toxic[found]
        w = cosines**2 * self.class_weight[toxic]
        return float((w * toxic).sum() / w.sum()) if w.sum() > 0 else self.bare

    def calibrate(self, votes: np.ndarray, y: np.ndarray) -> None:
        """Platt's logistic curve on leave-one-out votes, its targets drawn in so that separable votes don't run away."""
        if len(np.unique(y)) < 2:
            return
        n = [(y == 0).sum(), (y == 1).sum()]
        target = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
        weight = self.class_weight[y]
        x = np.c_[votes, np.ones(len(votes))]
        beta = np.array([self.slope, self.shift])
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ beta))
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (weight * (target - p)) - 1e-3 * beta)
            beta = beta + np.clip(step, -2, 2)
        if beta[0] > 0:
            self.slope, self.shift = map(float, beta)

    def scores(self, texts: list[str]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        """For each text its probability and the nearest examples as (doc_id, cosine, toxic)."""
        if not self.index:
            return [(self.bare, [])] * len(texts)
        out = []
        for found, cosines in self.index.nearest([self.space.vector(*term_counts(x)) for x in texts], self.k):
            p = 1 / (1 + np.exp(-(self.slope * self.vote(found, cosines) + self.shift))) if len(found) else self.bare
            out.append((float(p), [(int(self.index.ids[e]), float(c), int(self.index.toxic[e])) for e, c in zip(found[:MOST_SHOWN], cosines, strict=False)]))
        return out


def _examples(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, toxic, terms, counts) of the chosen labelled texts, one of each class's near copies: a large group of them would else make its own words telling."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(x.as_py() or "") for x in batch.column("text")]
            cells = [batch.column("doc_id"), batch.column("toxic"), pa.array([sketch(f) for f, _ in found], pa.int64()), *(pa.array([x[i] for x in found], pa.list_(pa.int64())) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(cells, ["doc_id", "toxic", "sketch", "terms", "counts"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept = None, []  # of a few thousand rows at most, those of one sketch and class that are no copies of each other
        for batch in batches:
            stays = []
            for key, names in zip(zip(batch.column("sketch").to_pylist(), batch.column("toxic").to_pylist(), strict=True), batch.column("terms").to_pylist(), strict=True):
                if key != at:
                    at, kept = key, []
                mine = set(names)
                stays.append(not any(len(mine & x) >= COPY * len(mine | x) for x in kept))
                if stays[-1]:
                    kept.append(mine)
            yield batch.filter(pa.array(stays, pa.bool_()))

    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 * per_class rows at most, but for repeated ids
    fields = "doc_id long, toxic int, sketch long, terms array<long>, counts array<long>"
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text").mapInArrow(bags, fields)
    return rows.repartition("sketch", "toxic").sortWithinPartitions("sketch", "toxic", "doc_id", "terms").mapInArrow(alone, fields).drop("sketch")


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> Model:
    """A model from labels(doc_id, toxic) and the texts of documents(doc_id, text) that they name.

    A doc_id with several labels is toxic if one of them says so; null ids and labels say nothing. What comes to the driver is the sample's: its terms, vectors and votes.
    """
    spark = documents.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model(None, None, (1.0, 1.0), float(1 in totals), k)
    chosen = lowest(known, ["toxic"], [F.xxhash64("doc_id"), F.col("doc_id")], per_class)
    sample = cut(_examples(documents, chosen), "examples")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Model(None, None, (1.0, 1.0), totals[1] / sum(totals.values()), k)
    counts = sample.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).toArrow().sort_by("term")
    terms = counts.column("term").to_numpy()
    p1, p0 = counts.column("a").to_numpy() / n[1], counts.column("b").to_numpy() / n[0]
    p = (p1 * n[1] + p0 * n[0]) / (n[0] + n[1])
    chi2 = np.divide((p1 - p0) ** 2, p * (1 - p) * (1 / n[0] + 1 / n[1]), out=np.zeros(len(p)), where=(p > 0) & (p < 1))
    shared_terms = spark.sparkContext.broadcast(terms)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, rows = Space(shared_terms.value, np.empty(0)), 0
        seen = np.zeros(len(space.known) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                seen[space.numbers(term_counts(text.as_py() or "")[0])] += 1
                rows += 1
        seen[-1] = rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["term", "n"])

    df = documents.select("text").mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(len(terms) + 1)
    seen[df.column("term").to_numpy()] = df.column("n").to_numpy()
    rows, seen[-1] = seen[-1], 1
    idf = np.log((1 + rows) / (1 + seen)) + 1
    space = Space(terms, idf * (LEAST_WEIGHT + np.r_[chi2 / (chi2 + HALF_CHI2), 0]))
    shared_space = spark.sparkContext.broadcast(space)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared_space.value.vector(f.values.to_numpy(), n.values.to_numpy()) for f, n in zip(batch.column("terms"), batch.column("counts"), strict=True)]
            cells = [pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *cells], ["doc_id", "toxic", "f", "w"])

    vector_rows = cut(sample.mapInArrow(vectors, "doc_id long, toxic int, f array<long>, w array<double>"), "vectors")
    got = vector_rows.toArrow()
    examples = [(d, y, f.values.to_numpy(), w.values.to_numpy()) for d, y, f, w in zip(got.column("doc_id").to_pylist(), got.column("toxic").to_pylist(), got.column("f"), got.column("w"), strict=True)]
    weight = (totals[0] / n[0], totals[1] / n[1])
    bare = [sum(1 for x in examples if not len(x[2]) and x[1] == y) * weight[y] for y in (0, 1)]
    prior = totals[1] / sum(totals.values())
    index = Index(len(terms), [x for x in examples if len(x[2])])
    model = Model(space, index, weight, (bare[1] + prior) / (sum(bare) + 1), k)
    shared_model = spark.sparkContext.broadcast(model)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        places: dict[int, list[int]] = {}
        for i, d in enumerate(model.index.ids.tolist()):
            places.setdefault(d, []).append(i)
        for batch in batches:
            found = [(f.values.to_numpy(), w.values.to_numpy()) for f, w in zip(batch.column("f"), batch.column("w"), strict=True)]
            near = model.index.nearest(found, model.k, [places.get(d, []) for d in batch.column("doc_id").to_pylist()])
            out = [model.vote(*x) if len(f) else None for x, (f, _) in zip(near, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(out, pa.float64())], ["toxic", "vote"])

    found = vector_rows.repartition(spark.sparkContext.defaultParallelism).mapInArrow(votes, "toxic int, vote double").where("vote is not null").toArrow().sort_by([("vote", "ascending"), ("toxic", "ascending")])
    model.calibrate(found.column("vote").to_numpy(), found.column("toxic").to_numpy().astype(np.int64))
    for x in (shared_terms, shared_space, shared_model):
        x.unpersist()
    done_with(sample, vector_rows)
    return model


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def _scored(documents: DataFrame, train_documents: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(row, score, predicted, evidence): documents packed, with their scores."""
    model = fit(train_documents, labels, per_class)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, shown = [], []
            for lo in range(0, batch.num_rows, TOGETHER):
                for p, near in model.scores([x or "" for x in batch.column("text").slice(lo, TOGETHER).to_pylist()]):
                    scores.append(p)
                    shown.append([{"doc_id": d, "cosine": c, "toxic": y} for d, c, y in near])
            cells = [batch.column("row"), pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32()), pa.array(shown, _EVIDENCE)]
            yield pa.RecordBatch.from_arrays(cells, ["row", "score", "predicted", "evidence"])

    rows = packed(documents, text=F.col("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")


def score_toxicity(documents: DataFrame, train_documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """documents(doc_id, text, ...) with score, predicted and evidence (nearest examples: doc_id, cosine, toxic); columns of these names are replaced, all others stay.

    Null and empty texts have no terms and get the score of such texts; long ones are scored whole. Without labels of both classes every score is 0, or 1 if
    all labels are toxic. Ties of cosines go to the example that stands first in the index, repeated rows get equal scores, a table without
    rows gives none, and only doc_id and text are read.
    """
    out = _scored(documents, train_documents, labels, per_class)
    return unpacked(out, documents.columns, score=F.col("score"), predicted=F.col("predicted"), evidence=F.col("evidence"))


def clean(documents: DataFrame, train_documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of documents that are not predicted toxic, with all their columns and no other."""
    return unpacked(_scored(documents, train_documents, labels, per_class).where("predicted = 0"), documents.columns)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, learnt from the labelled ones that are not held out; edge cases as in score_toxicity."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = held_out(F.col("doc_id"))
    return score_toxicity(docs.select("doc_id", held.alias("held_out"), "text"), docs, labels.where(~held)).drop("text")
