"""Language identification by the nearest of several clustered centroids per language.

A text becomes counts of its hashed character bigrams and trigrams, over lower-cased
letters with anything ASCII else as one space. The vector log(1 + tf) * idf is
normalised and compared by cosine with the centroids; the language of the nearest is
the prediction, its cosine the score. A text whose distance 1 - cosine from every
centroid is above ``max_distance`` is rejected, and so is one above the distance learned
for its length: hashed features collide, so a long text of any script or of random
letters comes nearer to a centroid than a short one.

The learned distances come from the cosines of all labelled texts to their own language,
by length class: ``SLACK`` of the cosine that ``QUANTILE`` of the texts of the class lie
below. A class of under ``ENOUGH`` texts takes its neighbours in, until it has enough or all there are.

The document frequencies come from all labelled texts. The centroids come from a
sample of about ``sample`` different labelled texts a language, chosen by a hash of id and text: equal rows
count once, rows that share an id are sampled like any others, and a language has one text at least.

Defined results: a null text and one without a letter are ``und``, score 0, rejected;
a null label teaches nothing; with no labelled text at all every text is ``und``;
repeated rows each get a row; equal cosines go to the first language in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import materialize

BITS = 14
DIM = 1 << BITS
#: Labelled texts a language, on average, that centroids are clustered from; centroids a language.
SAMPLE, CENTROIDS = 500, 4
#: A text of a known language shares some common n-gram with a centroid; below a cosine of 0.03 it shares next to none.
MAX_DISTANCE = 0.97
#: New texts lie a little further off than those learned from, hence the slack.
QUANTILE, SLACK, ENOUGH = 0.005, 2 / 3, 200
#: Length classes (doublings of the number of n-grams) and steps of the cosine that are counted.
CLASSES, STEPS = 33, 1000
UNKNOWN = "und"
#: Labels, at most: a model has CENTROIDS rows of DIM numbers for each, which every task gets.
MOST_LANGUAGES = 1000


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, count) of a whole text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.where((c >= 128) | ((c >= 97) & (c <= 122)), c, 32).astype(np.uint32)
    c = np.concatenate(([32], c, [32])).astype(np.uint32)
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] + c[2:] * np.uint32(0xC2B2AE3D)
    # A multiply and shift after the sum spreads neighbouring letters over all features.
    code = np.concatenate(((two ^ (two >> 15)) * np.uint32(0x2C1B3C6D), (three ^ (three >> 15)) * np.uint32(0x297A2D39))) >> np.uint32(32 - BITS)
    count = np.bincount(code, minlength=DIM)
    at = np.flatnonzero(count)
    return at, count[at]


@dataclass
class Model:
    """langs[k] is the language of centroids[k], a unit row; least[c] the cosine that a text of length class c needs."""

    langs: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def cosines(self, text: str | None) -> tuple[np.ndarray, int] | None:
        """The cosine with each centroid, and the length class; None without a letter or a centroid."""
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return None
        at, n = ngrams(text)
        v = np.log1p(n) * self.idf[at]
        length = np.sqrt((v * v).sum())
        cos = self.centroids[:, at] @ (v / length) if length else np.zeros(len(self.langs))
        return cos, min(int(n.sum()).bit_length(), CLASSES - 1)

    def judge(self, text: str | None, max_distance: float = MAX_DISTANCE) -> tuple[str, float, bool]:
        """Language, score and whether the text is rejected."""
        found = self.cosines(text)
        if found is None:
            return UNKNOWN, 0.0, True
        cos, size = found
        k = int(cos.argmax())
        score = float(min(max(cos[k], 0.0), 1.0))
        return self.langs[k], score, score < max(1 - max_distance, self.least[size])

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]


def least_cosines(count: np.ndarray) -> np.ndarray:
    """For each length class the cosine below which texts are rejected, from counts by class and step of the cosine."""
    out = np.zeros(CLASSES)
    enough = min(ENOUGH, count.sum())
    for c in range(CLASSES if enough else 0):
        for d in range(CLASSES):
            near = count[max(c - d, 0) : c + d + 1].sum(axis=0)
            if near.sum() >= enough:
                out[c] = SLACK * np.searchsorted(near.cumsum(), QUANTILE * near.sum(), "right") / STEPS
                break
    return out


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k unit centroids (fewer, if there are fewer different rows) of unit rows x, by cosine."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < k and near.min() < 1 - 1e-6:  # the row furthest from those chosen
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        of = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[of == j].sum(axis=0) if (of == j).any() else c[j] for j in range(len(c))])
        c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return c


def fit(docs: DataFrame, where: Column | None = None, sample: int = SAMPLE, centroids: int = CENTROIDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of docs' labelled texts, those where ``where`` holds.

    Only what has a fixed size reaches the driver: a number for each feature, the
    centroids of each language, and counts by length class and step of the cosine.
    """
    known = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    taught = docs.filter(known if where is None else known & where)
    taught = taught.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIM + 1, np.int64)  # the last counts texts
        for b in batches:
            for text in b.column(0):
                df[ngrams(text.as_py())[0]] += 1
                df[DIM] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["feature", "n"])

    rows = taught.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIM + 1)
    for r in rows:
        df[r.feature] = r.n
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1e-3

    taught = taught.withColumn("place", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)))
    # A language's sample are the places below a bound, or its first place; equal rows have one place, so they count once.
    share = taught.select("lang", "place").distinct().groupBy("lang").agg((F.lit(float(sample) * (1 << 30)) / F.count("place")).alias("share"), F.min("place").alias("first"))
    share = materialize(share.select("lang", F.greatest("share", F.col("first") + 1).alias("below")), "languages")
    if share.count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} labels: these are not languages")
    # Texts are sampled where they are read, so those of a frequent language never come together.
    some = taught.join(F.broadcast(share), "lang").filter(F.col("place") < F.col("below")).select("lang", "id", "text").distinct()

    def learn(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("id", "ascending"), ("text", "ascending")])  # whatever order the rows came in
        x = np.zeros((t.num_rows, DIM), np.float32)
        for row, text in zip(x, t.column("text"), strict=True):
            at, n = ngrams(text.as_py())
            row[at] = np.log1p(n) * idf[at]
        length = np.linalg.norm(x, axis=1)
        x = x[length > 0] / length[length > 0, None]
        c = cluster(x, centroids) if len(x) else x
        return pa.table({"lang": pa.array([key[0].as_py()] * len(c), pa.string()), "centroid": pa.array(list(c.astype(np.float32)), pa.list_(pa.float32()))})

    found = sorted(some.groupBy("lang").applyInArrow(learn, "lang string, centroid array<float>").collect(), key=lambda r: r.lang)
    c = np.array([r.centroid for r in found], np.float32).reshape(-1, DIM)
    model = Model([r.lang for r in found], c, idf, np.zeros(CLASSES))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        of = {lang: np.flatnonzero(np.array(m.langs) == lang) for lang in m.langs}
        count = np.zeros(CLASSES * (STEPS + 1), np.int64)
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1), strict=True):
                rows, got = of.get(lang.as_py()), m.cosines(text.as_py())
                if rows is not None and got is not None:
                    count[got[1] * (STEPS + 1) + int(min(max(got[0][rows].max(), 0.0), 1.0) * STEPS)] += 1
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["step", "n"])

    count = np.zeros(CLASSES * (STEPS + 1), np.int64)
    if model.langs:
        for r in taught.select("text", "lang").mapInArrow(own, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect():
            count[r.step] = r.n
    model.least = least_cosines(count.reshape(CLASSES, STEPS + 1))
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text", max_distance: float = MAX_DISTANCE) -> DataFrame:
    """docs with lang_pred, score and rejected (columns of these names are replaced). One pass, no shuffle."""
    docs = docs.drop("lang_pred", "score", "rejected")
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.judge(text.as_py(), max_distance) for text in b.column(at)]
            lang, score, far = ([x[k] for x in found] for k in range(3))
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "lang_pred", "score", "rejected"])

    schema = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text, modulo 5, is 0 (a null id's is too)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_distance: float = MAX_DISTANCE) -> DataFrame:
    """docs without those that are rejected; the labels taught are those of documents not held out."""
    model = fit(docs, ~held_out(id_col), id_col=id_col, text_col=text_col)
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[text_col].alias("text"))
    return predict(whole, model, "text", max_distance).filter("not rejected").select("doc.*")
