"""Language identification by nearest centroid.

A text is a vector of byte 1- to 3-gram counts of its letters, hashed into `DIMENSIONS`, weighted by 1 + log(count) times the inverse
document frequency, of length one. Each language has several centroids (spherical k-means); a text gets the language
of the nearest one by cosine. A text farther from all centroids than nearly all training texts of the language that were
held back from its clusters are, by a margin, is rejected.

The classifier is fitted on a bounded sample: about `PER_LANGUAGE` labelled rows of each language, drawn by a hash of the id
(so the same rows whatever the partitioning). Vectors are made in tasks and only the sample's reach the driver. Prediction
reads whole texts in Arrow batches and needs no shuffle; the fitted model is DIMENSIONS floats a centroid.

Defined cases: null texts, empty texts and texts without a letter are `und` with score 0 and rejected; without any
training rows all are; ties go to the language first in order; one row out for each row in, equal texts alike; other
columns are ignored by `identify` and kept by `keep_identified`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteconcord.llm.batches import chunks

PER_LANGUAGE = 400
CENTROIDS = 3
DIMENSIONS = 4096
# A cluster has at least this part of an even share of its language's training texts.
LEAST_SHARE = 0.2
TRIES = 8
# A text is rejected below this part of a low quantile of the cosines of its language's training texts, one in HELD_BACK
# of which are held back from the clusters for it.
MARGIN = 0.5
QUANTILE = 0.02
HELD_BACK = 5
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    of: np.ndarray  # language number of each centroid
    centroids: np.ndarray  # rows of length one
    idf: np.ndarray
    least: np.ndarray  # lowest cosine accepted, per language


class _Folded(dict):
    """Code point to its lower-case letter, or to a space; filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = c.lower() if c.isalpha() else " "
        return self[code]


_FOLD = _Folded()


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None without a letter."""
    folded = " ".join(text.translate(_FOLD).split())
    if not folded:
        return None
    raw = np.frombuffer(f" {folded} ".encode(), np.uint8).astype(np.uint32)
    two = (raw[:-1] << 8) | raw[1:]
    three = (two[:-1] << 8) | raw[2:]
    out = np.zeros(DIMENSIONS, np.int64)
    for order, grams in enumerate((raw, two, three), 1):
        hashed = (grams + np.uint32(order << 25)) * np.uint32(2654435761)
        out += np.bincount(hashed >> np.uint32(20), minlength=DIMENSIONS)
    return out


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0) * idf
    length = np.sqrt((vector * vector).sum(-1, keepdims=True))
    return vector / np.where(length > 0, length, 1)


# --- fitting ----------------------------------------------------------------------------------------------------------


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """About `per_language` rows of each language of `labelled` (doc_id, text, lang)."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return rows.limit(0)
    scale = 1 << 30
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(scale))
    keep = F.lit(False)
    for lang, total in sorted(totals.items()):
        keep = keep | ((F.col("lang") == lang) & (drawn < min(scale, -(-per_language * scale // total))))
    return rows.filter(keep)


def _vectors(rows: DataFrame) -> list[tuple[str, np.ndarray]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                langs, made = [], []
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    vector = counts(text)
                    if vector is not None:
                        langs.append(lang)
                        made.append(vector.astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(made, pa.binary())], ["lang", "vector"])

    found = rows.mapInArrow(count, "lang string, vector binary").collect()
    return sorted((r["lang"], bytes(r["vector"])) for r in found)


def _seeds(vectors: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Rows drawn as k-means++ does, by their distance from the nearest seed."""
    seeds = [int(draw.integers(len(vectors)))]
    away = 1 - vectors @ vectors[seeds[0]]
    while len(seeds) < min(k, len(vectors)) and (weight := np.where(away > 1e-9, away, 0)).sum() > 0:
        seeds.append(int(draw.choice(len(vectors), p=weight / weight.sum())))
        away = np.minimum(away, 1 - vectors @ vectors[seeds[-1]])
    return vectors[seeds]


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """The centroids of the best of TRIES starts, the same ones each time: the most clusters, then the nearest rows."""
    draw = np.random.default_rng(0)
    tries = [_settle(vectors, _seeds(vectors, k, draw), k) for _ in range(TRIES)]
    return max(tries, key=lambda centres: (len(centres), float((vectors @ centres.T).max(1).sum())))


def _settle(vectors: np.ndarray, centres: np.ndarray, k: int, rounds: int = 12, least: float = LEAST_SHARE) -> np.ndarray:
    """Spherical k-means; a cluster with less than `least` of an even share gives way, its rows go to the others."""
    while True:
        for _ in range(rounds):
            chosen = np.argmax(vectors @ centres.T, 1)
            sums = np.stack([vectors[chosen == i].sum(0) if (chosen == i).any() else centres[i] for i in range(len(centres))])
            centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        sizes = np.bincount(np.argmax(vectors @ centres.T, 1), minlength=len(centres))
        smallest = int(np.argmin(sizes))
        if len(centres) == 1 or sizes[smallest] >= least * len(vectors) / k:
            return centres
        centres = np.delete(centres, smallest, 0)


def _limit(vectors: np.ndarray, k: int, margin: float) -> float:
    """`margin` of a low quantile of the cosines of texts that are held back from the clusters."""
    back = np.arange(len(vectors)) % HELD_BACK == HELD_BACK - 1
    centres = _cluster(vectors[~back], k)
    tried = vectors[back] if back.any() else vectors
    return margin * float(np.quantile((tried @ centres.T).max(1), QUANTILE))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, margin: float = MARGIN) -> Model:
    found = _vectors(sample(labelled, per_language))
    languages = sorted({lang for lang, _ in found})
    if not languages:
        return Model([], np.zeros(0, int), np.zeros((0, DIMENSIONS)), np.zeros(DIMENSIONS), np.zeros(0))
    counted = np.stack([np.frombuffer(v, "<i4") for _, v in found])
    idf = np.log((1 + len(counted)) / (1 + (counted > 0).sum(0))) + 1
    vectors = weighted(counted, idf)
    own = np.array([languages.index(lang) for lang, _ in found])
    centres, of, least = [], [], []
    for number in range(len(languages)):
        rows = vectors[own == number]
        made = _cluster(rows, centroids)
        centres.append(made)
        of += [number] * len(made)
        least.append(_limit(rows, centroids, margin))
    return Model(languages, np.array(of), np.concatenate(centres), idf, np.array(least))


# --- prediction -------------------------------------------------------------------------------------------------------


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Per text: language, cosine, rejected."""
    langs, scores, rejected = [], [], []
    for text in texts:
        count = counts(text) if text and model.languages else None
        if count is None:
            langs.append(UNDETERMINED)
            scores.append(0.0)
            rejected.append(True)
            continue
        used = np.flatnonzero(count)
        vector = (1 + np.log(count[used])) * model.idf[used]
        near = model.centroids[:, used] @ vector / max(float(np.sqrt(vector @ vector)), 1e-300)
        best = int(np.argmax(near))
        cosine = min(1.0, max(0.0, float(near[best])))
        langs.append(model.languages[model.of[best]])
        scores.append(cosine)
        rejected.append(cosine < model.least[model.of[best]])
    return langs, scores, rejected


def _plain(model: Model) -> tuple:
    """What a broadcast carries: values any worker can read."""
    return (model.languages, model.of, model.centroids, model.idf, model.least)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected): one row per row of `docs` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(_plain(model))
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*sent.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                langs, scores, rejected = classify(fitted, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {doc_id}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is identified."""
    sent = docs.sparkSession.sparkContext.broadcast(_plain(model))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*sent.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                rejected = classify(fitted, part.column("text").to_pylist())[2]
                yield part.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(keep, T.StructType(docs.schema.fields))


def held_out(doc_id: str = "doc_id"):
    """Fixed rule of the query contract: rows kept out of training."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2
