"""Language ID with a string kernel: presence of character n-grams, Nystroem landmarks and one-versus-rest kernel ridge regression.

The blended-spectrum presence kernel of two texts is the number of 1- to 4-grams that both hold over the geometric mean of
how many each holds. n-grams are kept in a table of `bits` hashed places, so a text is a row of bits and a batch's kernel against the landmarks is one matrix product.
Landmarks are texts of the training sample, as many of each language; the Nystroem map turns kernel rows into features, on
which ridge regression of each language against the rest has a closed form. A text's language is the one with the largest margin.

The fit reads a bounded sample of every language that has a text: at most `per_language` texts of each, and MOST_TEXTS in all as long as no more languages are there, those with the smallest hash of their id. All texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import held_out, lowest, mix, table, unpacked

BITS = 1 << 14
PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 40
#: With many languages each has fewer texts and landmarks, one at least, so that these are all there are.
MOST_TEXTS = 6400
MOST_LANDMARKS = 1024
RIDGE = 1e-3
UNDETERMINED = "und"
_SLICE = 1 << 19


def presence(texts: list[str], bits: int = BITS) -> np.ndarray:
    """A row of 0 and 1 for each text: which hashed 1- to 4-grams of its letters in lower case it holds; each other character counts as a blank. Letters are a to z and, for speed, all characters from U+00C0 on."""
    out = np.zeros((len(texts), bits), np.uint8)
    mask = np.uint64(bits - 1)
    for i, text in enumerate(texts):
        whole = text.lower()
        for lo in range(0, len(whole), _SLICE):  # long texts in slices that overlap by three characters
            codes = np.frombuffer(whole[lo : lo + _SLICE + 3].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            ascii_letter = (codes >= 97) & (codes <= 122)
            codes = np.where(ascii_letter | (codes >= 192), codes, np.uint64(32))
            row = out[i]
            gram = codes
            for n in range(1, 5):
                if n > 1:
                    gram = gram[: len(gram) - 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
                if not len(gram):
                    break
                row[(mix(gram, n) >> np.uint64(20)) & mask] = 1
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    """Landmarks, the Nystroem map and the ridge weights: with MOST_LANDMARKS landmarks 64 MB of these in `marks` and 8 MB in `root`."""

    def __init__(self, rows: np.ndarray, labels: list[str], landmarks: np.ndarray, ridge: float) -> None:
        self.languages = sorted(set(labels))
        self.marks = rows[landmarks].astype(np.float32).T.copy()
        self.mark_norm = np.sqrt(np.maximum(self.marks.sum(axis=0), 1))
        values, vectors = np.linalg.eigh(self.kernel(rows[landmarks]).astype(np.float64))
        good = values > 1e-8 * values.max()
        self.root = vectors[:, good] / np.sqrt(values[good])
        x = self.kernel(rows) @ self.root
        self.mean = x.mean(axis=0)
        x = x - self.mean
        y = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        self.offset = y.mean(axis=0)
        self.weights = np.linalg.solve(x.T @ x + ridge * len(x) * np.eye(x.shape[1]), x.T @ (y - self.offset))

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.int64), 1))
        common = np.concatenate([rows[lo : lo + 256].astype(np.float32) @ self.marks for lo in range(0, len(rows), 256)])
        return common / norm[:, None] / self.mark_norm

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        margin = (self.kernel(rows) @ self.root - self.mean) @ self.weights + self.offset
        e = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
        best = margin.argmax(axis=1)
        return [self.languages[b] for b in best], e[np.arange(len(best)), best] / e.sum(axis=1)


def fit(train: DataFrame, bits: int = BITS, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model | None:
    """A model from train(doc_id, text, lang); None if no row has a text with a letter and a language."""
    spark = train.sparkSession
    known = train.where("text is not null and lang is not null")
    languages = known.select("lang").distinct().count()
    if not languages:
        return None
    per_language, landmarks = max(1, min(per_language, MOST_TEXTS // languages)), max(1, min(landmarks, MOST_LANDMARKS // languages))
    key = F.xxhash64("doc_id", "text")
    chosen = lowest(known.where(F.col("text").rlike(r"\p{L}")).select("lang", F.col("doc_id"), key.alias("key")), ["lang"], [F.col("key"), F.col("doc_id")], per_language)
    picked = known.withColumn("key", key).join(F.broadcast(chosen.select("key").distinct()), "key", "left_semi")
    picked = picked.groupBy("lang", "key").agg(F.first("text").alias("text"))  # repeated rows are one before they leave their tasks

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, key in zip(*(batch.column(k) for k in ("lang", "text", "key")), strict=True):
                if has_letter(text.as_py()):
                    row = np.packbits(presence([text.as_py()], bits)[0]).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()], pa.string()), pa.array([key.as_py()], pa.int64()), pa.array([row], pa.binary())], ["lang", "key", "row"])

    # at most MOST_TEXTS rows of bits / 8 bytes, or one for each language
    found = sorted({(r.lang, r.key, bytes(r.row)) for r in picked.select("lang", "text", "key").mapInArrow(bits_of, "lang string, key long, row binary").collect()})
    if not found:
        return None
    rows = np.stack([np.unpackbits(np.frombuffer(r[2], np.uint8)) for r in found])
    labels = [r[0] for r in found]
    marks, count = [], {}
    for i, lang in enumerate(labels):
        count[lang] = count.get(lang, 0) + 1
        if count[lang] <= landmarks:
            marks.append(i)
    return Model(rows, labels, np.array(marks), ridge)


def identify(documents: DataFrame, train: DataFrame, bits: int = BITS, batch_rows: int = 128) -> DataFrame:
    """Replaces text by lang_pred and score in documents(doc_id, text, ...), learning from train(doc_id, text, lang); columns of these names are replaced, all others stay.

    Null texts and texts without a letter are "und" with score 0, and so is every text if there is nothing to learn from. Texts of any length are scored whole. Ties of the margin go to the first language
    by name. Repeated rows get equal results. A table without rows gives none. Rows of train without text or language teach nothing; a
    null doc_id is an id like any other.
    """
    model = fit(train, bits)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = [n for n in documents.columns if n != "text"]
    rows = documents.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, batch_rows):
                part = batch.slice(lo, batch_rows)
                texts = [x.as_py() or "" for x in part.column("text")]
                sure = [i for i, x in enumerate(texts) if model and has_letter(x)]
                found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                if sure:
                    for i, name, score in zip(sure, *model.predict(presence([texts[i] for i in sure], bits)), strict=True):
                        found[i], scores[i] = name, float(score)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")
    return unpacked(out, names, lang_pred=F.col("lang_pred"), score=F.col("score"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out; edge cases as in identify."""
    docs = table(spark, sf_dir, "documents")
    held = held_out(F.col("doc_id"))
    train = docs.where(~held).select("doc_id", "text", "lang")
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), train)
