"""Language identification by hierarchical discrimination.

A text is described by the relative frequencies of its character n-grams (one to three bytes of UTF-8 of the
lower-case text, runs of non-letters as one space), hashed to `FEATURES` numbers. A linear one-versus-rest model predicts the
language family; within a family one-versus-one linear support vector machines vote between its languages. All models
are trained in numpy by averaged stochastic subgradient steps on the hinge loss.

Training takes about `TRAIN_ROWS` documents of each language at most, those with the smallest hash of doc_id and
text, of `TRAIN_LANGS` languages, and about `TRAIN_TOTAL` in all (documented bounds on a sample of labelled rows). Prediction reads every whole text.

Defined cases: texts that are null or have no letter are `und` with score 0; documents without lang are predicted but
not learned from; repeated rows are predicted alike and learned from once; without any labelled text all is `und`; languages
outside `FAMILIES` are a family of their own each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

FEATURE_BITS = 12
FEATURES = 1 << FEATURE_BITS
TRAIN_ROWS = 1_000  # labelled documents of each language at most
TRAIN_LANGS = 1_000  # languages learned at most, those with most documents
TRAIN_TOTAL = 20_000  # labelled documents of all languages at most, shared out evenly
EPOCHS = 6
UNDETERMINED = "und"

# Language families by ISO 639-1 code
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indo-aryan": ("hi", "bn", "ur", "mr", "pa", "gu"),
    "semitic": ("ar", "he", "mt", "am"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTER = regex.compile(r"\p{L}")  # `\w` would take fractions and raised digits for letters
_OTHER = re.compile(r"[\W\d_]+")
_A = np.uint32(0x9E3779B1)  # odd multipliers of the n-gram hash
_B = np.uint32(0x85EBCA77)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0], f"other:{lang}")


def features(text: str | None) -> np.ndarray | None:
    """Unit-length square roots of hashed n-gram frequencies; None if the text has no letter."""
    if not text or not _LETTER.search(text):
        return None
    raw = np.frombuffer((" " + _OTHER.sub(" ", text.lower()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.zeros(FEATURES)
    for lo in range(0, len(raw), 1 << 20):  # blocks overlap by two bytes, so every n-gram counts once
        part = raw[lo:lo + (1 << 20) + 2]
        one = part * _A
        two = (one[:-1] ^ (part[1:] + np.uint32(257))) * _B
        three = (two[:-1] ^ (part[2:] + np.uint32(521))) * _A
        own = 1 << 20
        for grams in (one[:own], two[:own], three[:own]):
            counts += np.bincount(grams >> np.uint32(32 - FEATURE_BITS), minlength=FEATURES)
    vector = np.sqrt(counts)
    return (vector / np.linalg.norm(vector)).astype(np.float32)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, out = [], []
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            vector = features(text)
            if vector is not None:
                langs.append(lang)
                out.append(vector.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "vector"])


def _svm(x: np.ndarray, y: np.ndarray, seed: int = 0, epochs: int = EPOCHS, rate: float = 2.0, reg: float = 1e-4) -> np.ndarray:
    """Averaged weights of a linear SVM without bias; y is +1 or -1, both classes with the same total weight."""
    rng = np.random.default_rng(seed)
    n = len(y)
    weight = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum())))
    w, total, steps = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(n), max(1, n // 64)):
            margin = y[batch] * (x[batch] @ w)
            active = margin < 1
            steps += 1
            lr = rate / np.sqrt(steps)
            w = w * (1 - lr * reg) + lr * ((weight[batch] * y[batch] * active) @ x[batch]) / len(batch)
            total += w
    return (total / max(1, steps)).astype(np.float32)


class Hierarchy:
    """Families by one-versus-rest, languages of a family by one-versus-one votes."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        of = np.array([family_of(lang) for lang in langs])
        names = np.array(langs)
        self.families = sorted(set(of.tolist()))
        self.members = {f: [lang for lang in self.langs if family_of(lang) == f] for f in self.families}
        self.family_weights = np.stack([_svm(x, np.where(of == f, 1.0, -1.0)) for f in self.families]) if len(self.families) > 1 else None
        self.pairs = {}
        for members in self.members.values():
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    some = (names == a) | (names == b)
                    self.pairs[a, b] = _svm(x[some], np.where(names[some] == a, 1.0, -1.0))

    def predict(self, v: np.ndarray) -> tuple[str, float]:
        """Language and score: the family's share of the margins' softmax times the mean of its won duels."""
        family, p = self.families[0], 1.0
        if self.family_weights is not None:
            margins = 4 * (self.family_weights @ v)
            shares = np.exp(margins - margins.max())
            best = int(shares.argmax())
            family, p = self.families[best], float(shares[best] / shares.sum())
        members = self.members[family]
        if len(members) == 1:
            return members[0], min(1.0, p)
        wins = {lang: [0, 0.0] for lang in members}  # duels won, sum of their logistic margins
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                pa_ = 1 / (1 + np.exp(-4 * float(self.pairs[a, b] @ v)))
                wins[a][0] += pa_ >= 0.5
                wins[b][0] += pa_ < 0.5
                wins[a][1] += pa_
                wins[b][1] += 1 - pa_
        lang = max(members, key=lambda m: (*wins[m], m))
        return lang, float(min(1.0, max(0.0, p * wins[lang][1] / (len(members) - 1))))


def training_sample(documents: DataFrame, rows: int = TRAIN_ROWS, langs: int = TRAIN_LANGS) -> DataFrame:
    """About `rows` documents of each language, chosen by hash before any shuffle.

    The share of a language whose hash falls below a threshold follows from the languages' counts. The thresholds, at most `langs` rows
    whatever the corpus, go to all tasks; only the texts that are drawn are shuffled (to count repeated ones once).
    """
    texts = documents.where("lang is not null and text is not null").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sizes = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lang").limit(langs).collect()
    limits = documents.sparkSession.createDataFrame([(r["lang"], rows / r["_n"]) for r in sizes], "lang string, _share double")
    unit = F.pmod(F.xxhash64(F.col("doc_id"), F.xxhash64("text")), F.lit(1 << 40)) / float(1 << 40)
    drawn = texts.join(F.broadcast(limits), "lang").where(unit < F.col("_share"))
    return drawn.select("lang", "text").distinct()


def train(documents: DataFrame, rows: int = TRAIN_ROWS, langs: int = TRAIN_LANGS) -> Hierarchy | None:
    """A model from the labelled texts of `documents` (lang, text); None if there are none.

    The driver receives the sample's feature vectors only: about `rows` times the number of languages, 8 KB each, and never more than
    about `TRAIN_TOTAL`, as `rows` is lowered for many languages.
    """
    ship(documents.sparkSession)
    some = documents.where("lang is not null and text is not null").select("lang").distinct().limit(langs).count()
    rows = max(1, min(rows, TRAIN_TOTAL // max(1, some)))
    vectors = training_sample(documents, rows, langs).mapInArrow(_vectors, "lang string, vector binary")
    names, data = [], []
    for lang, vector in vectors.toLocalIterator():
        names.append(lang)
        data.append(np.frombuffer(vector, np.float32).astype(np.float16))
    if not names:
        return None
    order = sorted(range(len(names)), key=lambda i: (names[i], data[i].tobytes()))  # the same model in any order of arrival
    return Hierarchy(np.stack([data[i] for i in order]).astype(np.float32), [names[i] for i in order])


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Hierarchy | None = shared.value
        for batch in batches:
            langs, scores = [], []
            texts = batch.column("text")
            for i in range(len(texts)):
                vector = features(texts[i].as_py()) if model is not None else None
                lang, score = model.predict(vector) if vector is not None else (UNDETERMINED, 0.0)
                langs.append(lang)
                scores.append(score)
            keep = [k for k, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*(batch.schema.names[k] for k in keep), "lang_pred", "score"])

    return run


def predict(documents: DataFrame, model: Hierarchy | None) -> DataFrame:
    """One row per document: doc_id, lang_pred, score; only texts are looked at."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES floats for each family and each pair of related languages
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")
