"""Operator 2: quality by nearest-neighbour voting over broadcast latent-semantic vectors.

Terms are hashed trigrams of character classes plus buckets of how well a text compresses (repetition);
a truncated singular value decomposition of a labelled sample maps them to latent dimensions. Every
document is compared with every labelled vector by blocked cosine products, and its nearest neighbours
vote with their similarity as weight, times the labelled documents that a sampled one stands for.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigraph.llm.common import map_columns

#: Labelled documents that the model is fitted on: at most this many of each label, those whose id hashes lowest.
MAX_LABELLED = 1500
DIMENSIONS, TERMS, NEIGHBOURS, POWER = 48, 1536, 21, 8
#: A document is kept from this score on.
THRESHOLD = 0.7
#: Documents whose products with all labelled vectors are held at once.
BLOCK = 256
#: Buckets of the compression ratio, and how much one weighs against the trigrams.
BUCKETS, BUCKET_WEIGHT = 24, 0.35


def _classes() -> np.ndarray:
    """A class for each byte: letters by case, digits, blanks, line ends, each other ASCII mark alone; bytes of other letters count as small letters."""
    c = np.zeros(256, np.int64)
    c[65:91], c[48:58] = 1, 2
    c[[32, 9]], c[[10, 11, 12, 13]] = 3, 4
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    c[marks] = 5 + np.arange(len(marks))
    return c


CLASSES = _classes()
_SIDE = int(CLASSES.max()) + 1
#: Trigram to term, by a multiplicative hash.
SLOTS = ((np.arange(_SIDE**3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(TERMS)).astype(np.int64)


def term_counts(text: str | None) -> np.ndarray:
    """Weights of the terms of a text: log-scaled trigram counts of length one, then the compression buckets."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(TERMS + BUCKETS, np.float32)
    if not data:
        return out
    c = CLASSES[np.frombuffer(b"\n" + data + b"\n", np.uint8)]
    grams = np.bincount(SLOTS[(c[:-2] * _SIDE + c[1:-1]) * _SIDE + c[2:]], minlength=TERMS)
    out[:TERMS] = np.log1p(grams)
    out[:TERMS] /= np.linalg.norm(out[:TERMS])
    ratio = len(zlib.compress(data, 1)) / (len(data) + 12)
    at = min(BUCKETS - 1, int(ratio * BUCKETS))
    out[TERMS + at] = BUCKET_WEIGHT
    out[TERMS + max(0, at - 1)] += BUCKET_WEIGHT / 2
    out[TERMS + min(BUCKETS - 1, at + 1)] += BUCKET_WEIGHT / 2
    return out


class Model:
    """Labelled latent vectors of length one and the map that takes terms there."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, shares: tuple[float, float] = (1.0, 1.0)):
        """shares: what a vote for label 0 and one for label 1 counts."""
        df = (counts > 0).sum(axis=0)
        self.weights = np.log((1 + len(counts)) / (1 + df)) + 1
        x = counts * self.weights
        _, vectors = np.linalg.eigh(x.T @ x)
        self.project = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions]) * self.weights[:, None]
        self.vectors = self._unit(counts)
        self.labels = labels.astype(np.float64)
        self.votes = np.asarray(shares, np.float64)[labels.astype(np.int64)]
        self.prior = float((self.votes * self.labels).sum() / self.votes.sum())

    def _unit(self, counts: np.ndarray) -> np.ndarray:
        v = counts @ self.project
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def similarities(self, counts: np.ndarray) -> np.ndarray:
        """Cosines of at most BLOCK documents with all labelled vectors, to nine digits. Every product has the same shape, so that a text gets the same numbers beside any others."""
        full = np.zeros((BLOCK, counts.shape[1]))
        full[: len(counts)] = counts
        return np.round(self._unit(full) @ self.vectors.T, 9)[: len(counts)]

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The share of label 1, weighted by similarity and by what its label counts, among the nearest labelled vectors, all of which are compared.

        Of equally near ones those that come first in the model are taken. A document that is not near to any
        labelled vector, as one without terms, gets the share of label 1 in all of them. Six digits.
        """
        out = []
        k = min(neighbours, len(self.labels))
        for i in range(0, len(counts), BLOCK):
            near = self.similarities(counts[i : i + BLOCK])
            last = np.partition(near, near.shape[1] - k, axis=1)[:, -k, None]
            above, level = near > last, near == last
            best = above | level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True))
            w = np.where(best, np.maximum(near, 0.0), 0.0) ** POWER * self.votes
            total = w.sum(axis=1)
            out.append(np.where(total > 0, (w * self.labels).sum(axis=1) / np.where(total > 0, total, 1.0), self.prior))
        return np.round(np.concatenate(out), 6) if out else np.empty(0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model | None:
    """A model from at most max_labelled documents of each label; None without labelled documents.

    `labels` holds the rows that may be learnt from. The sample is those ids whose hash is lowest, whatever
    the size of the table; only their term weights come to the driver (max_labelled * 2 rows of fixed width).
    Where a label has more documents than are picked, each vote for it counts as many labelled documents as it
    stands for, so that scores mean the same whatever part of a label is in the sample.
    """
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label")).where("l_id is not null and label in (0, 1)")
    known = known.groupBy("l_id").agg(F.max("label").alias("label"))
    ranked = known.withColumn("at", F.xxhash64("l_id"))
    picked = [ranked.where(F.col("label") == v).orderBy("at", "l_id").limit(max_labelled) for v in (0, 1)]
    sample = picked[0].union(picked[1])
    of_label = dict(known.groupBy("label").count().collect())
    shares = tuple(max(1.0, of_label.get(v, 0) / max_labelled) for v in (0, 1))
    texts = docs.join(F.broadcast(sample), F.col(id_col) == F.col("l_id")).select("l_id", "label", F.col(text_col).alias("text"))

    def run(ids, label, texts_):
        return [ids, label, [term_counts(t).tobytes() for t in texts_]]

    rows = map_columns(texts, run, "l_id long, label int, counts binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["l_id", "counts"]).drop_duplicates("l_id")  # of rows with one id the same one in every run
    return Model(np.stack([np.frombuffer(c, np.float32) for c in rows["counts"]]), rows["label"].to_numpy(), shares=shares)


def score_quality(docs: DataFrame, model: Model | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """The keep columns and a score (double): every whole text from 0 to 1, higher where label 1 is likelier.

    The model travels as a broadcast of fixed size. Null and empty texts have no terms, so that their score is
    the share of label 1 among the labelled documents. Without a model every score is 0.5. A score depends on
    the text and the model alone, so repeated rows give equal scores; an empty table gives an empty result. `out` names the score where docs
    has a column of that name; columns outside keep are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(*cols):
        *kept, texts = cols
        if shared.value is None:
            return [*kept, [0.5] * len(texts)]
        scores = []
        for i in range(0, len(texts), BLOCK):
            scores += shared.value.scores(np.stack([term_counts(t) for t in texts[i : i + BLOCK]])).astype(float).tolist()
        return [*kept, scores]

    picked = docs.select(*[docs[c] for c in keep], docs[text_col].alias("text to score"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return map_columns(picked, run, f"{types}, `{out}` double")


def held_out(doc_id):
    """Rows that no model learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, fit(docs, labels.where(~held_out(F.col("doc_id")))))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
