"""Operator 9, toxicity: a bag of subword embeddings averaged into a linear softmax (Joulin et al. 2016).

A word is the mean of the embeddings of its hashed character n-grams and of itself, a text the mean of its words, a
linear softmax over both classes reads it; embeddings and softmax are trained jointly by Adagrad. A misspelling that
training has not met shares most n-grams with its word. As all is linear, a trained model gives each word one number,
and a text's log odds are the mean of its words' numbers plus a bias: scoring reads each word once.

It is fitted on at most `sample` toxic documents and three times as many clean ones, those with the least hashes of
their ids. Their bags are made in tasks; of these only buckets that several documents have come to the task that learns.
"""

from __future__ import annotations

import math
import string
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common

BUCKETS = 1 << 17
DIM = 12
SAMPLE = 1500
EPOCHS = 10
#: A bucket that fewer documents of the sample have keeps no embedding, so no document is learned by heart.
LEAST_DOCS = 5
#: By which share a step draws the embeddings it touches towards 0.
DECAY = 2e-4
THRESHOLD = 0.7
#: Means of some hundred words are small numbers; the softmax reads them this many times enlarged.
SCALE = 30.0
#: Stripped from the ends of a word.
MARKS = string.punctuation + "«»“”„‘’‚…–—¿¡"
#: Documents of a training step.
BATCH = 4
CACHE_WORDS, CACHE_TRAINING = 400_000, 100_000
#: Characters above which a word's n-grams are counted rather than listed, and those counted at a time.
LONG_WORD, RUN_CHUNK = 1000, 1 << 16


def grams_of(marked: str, first: int, end: int) -> list[int]:
    """Buckets of the n-grams of 3 to 5 characters that begin at first and before end."""
    part = marked if first == 0 and end >= len(marked) else marked[first : end + 4]
    n = len(part)
    own = min(end - first, n)
    if part.isascii():
        raw = part.encode()
        grams = [raw[i : i + k] for k in (3, 4, 5) for i in range(min(own, n - k + 1))]
    else:
        grams = [part[i : i + k].encode("utf-8", "surrogatepass") for k in (3, 4, 5) for i in range(min(own, n - k + 1))]
    return [zlib.crc32(g) % BUCKETS for g in grams]


def core_of(word: str) -> str:
    return word.lower().strip(MARKS) or word


def whole(core: str) -> int:
    """Bucket of a word itself."""
    return zlib.crc32(f"<<{core}>>".encode("utf-8", "surrogatepass")) % BUCKETS


def subwords(word: str) -> list[int]:
    """Buckets of a word: itself and its n-grams of 3 to 5 characters, its ends marked."""
    core = core_of(word)
    ids = grams_of(f"<{core}>", 0, len(core) + 2)
    ids.append(whole(core))
    return ids


def counted(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of subwords(word) and how often each is in it; for long runs without white space, whose n-grams
    are never held at once."""
    core = core_of(word)
    marked, counts = f"<{core}>", np.zeros(BUCKETS, np.int64)
    for i in range(0, len(marked), RUN_CHUNK):
        counts += np.bincount(np.array(grams_of(marked, i, i + RUN_CHUNK), np.int64), minlength=BUCKETS)
    counts[whole(core)] += 1
    at = np.flatnonzero(counts)
    return at, counts[at]


class Subwords(dict):
    """Remembers the buckets of words, forgetting all when it holds CACHE_TRAINING."""

    def __missing__(self, word: str) -> array:
        if len(self) >= CACHE_TRAINING:
            self.clear()
        self[word] = out = array("i", subwords(word))
        return out


def features(text: str | None, known: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights in its mean."""
    counts = Counter((text or "").split())
    n = sum(counts.values())
    ids, weights = [], []
    for word, c in counts.items():
        if len(word) > LONG_WORD:
            own, times = counted(word)
            ids += own.tolist()
            weights += (c / n * times / times.sum()).tolist()
            continue
        own = known[word]
        ids += own
        weights += [c / (n * len(own))] * len(own)
    buckets, at = np.unique(np.array(ids, np.int64), return_inverse=True)
    return buckets.astype(np.int32), np.bincount(at, weights, len(buckets)).astype(np.float32)


@dataclass
class Model:
    """One number for each bucket and a bias: all that scoring needs of embeddings and softmax."""

    numbers: np.ndarray
    bias: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer(dict):
    """Scores texts; maps a word to its number, forgetting all when it holds CACHE_WORDS."""

    def __init__(self, model: Model):
        super().__init__()
        self.array, self.numbers, self.bias = model.numbers.astype(np.float64), model.numbers.tolist(), model.bias

    def __missing__(self, word: str) -> float:
        if len(word) > LONG_WORD:
            # Not remembered: such runs are large and seldom come again.
            ids, times = counted(word)
            return float(self.array[ids] @ times / times.sum())
        ids = subwords(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = sum(map(self.numbers.__getitem__, ids)) / len(ids)
        return out

    def score(self, text: str | None) -> float:
        words = text.split() if text else ()
        logit = self.bias + (sum(map(self.__getitem__, words)) / len(words) if words else 0.0)
        return 1 / (1 + math.exp(-logit)) if logit > -700 else 0.0


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS, rate: float = 0.2, seed: int = 9
) -> Model:
    """Joint training on bags (buckets, weights), BATCH documents a step; with no labels of one class the model is the
    share of the other. bags is emptied on the way, to hold them only once."""
    positive = sum(labels)
    if not 0 < positive < len(labels):
        share = min(max(positive / len(labels), 0.01), 0.99) if labels else 0.5
        return Model(np.zeros(BUCKETS, np.float32), math.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    # Buckets that occur are numbered anew, so that what training touches lies together.
    occurs = np.zeros(BUCKETS, bool)
    for ids, _ in bags:
        occurs[ids] = True
    used, place = np.flatnonzero(occurs), np.cumsum(occurs, dtype=np.int32) - 1
    marks, batches = np.array(labels), []
    order = rng.permutation(len(bags))
    for lo in range(0, len(order), BATCH):
        chosen = order[lo : lo + BATCH]
        ids = np.concatenate([bags[i][0] for i in chosen])
        touched, at = np.unique(place[ids], return_inverse=True)
        sizes = [len(bags[i][0]) for i in chosen]
        w = np.concatenate([bags[i][1] for i in chosen])
        batches.append((marks[chosen], touched, at.astype(np.min_scalar_type(len(touched))), sizes, w))
        for i in chosen:
            bags[i] = None
    bags.clear()
    embedding = rng.uniform(-1 / DIM, 1 / DIM, (len(used), DIM)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.3, (2, DIM)).astype(np.float32), np.zeros(2, np.float32)
    seen, seen_softmax, seen_bias = np.full(len(used), 1e-6, np.float32), np.full((2, DIM), 1e-6), np.full(2, 1e-6)
    weight = np.array([len(labels) / (2 * (len(labels) - positive)), len(labels) / (2 * positive)])
    for _ in range(epochs):
        for i in rng.permutation(len(batches)).tolist():
            classes, touched, at, sizes, w = batches[i]
            mean, doc = np.zeros((len(classes), len(touched)), np.float32), np.repeat(np.arange(len(classes)), sizes)
            mean[doc, at] = SCALE * w
            rows = embedding[touched]
            hidden = mean @ rows
            z = hidden @ softmax.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            error = p / p.sum(1, keepdims=True)
            error[np.arange(len(classes)), classes] -= 1
            error *= weight[classes][:, None]
            back = (error @ softmax).astype(np.float32)
            step = error.T @ hidden
            seen_softmax += (error**2).T @ hidden**2
            softmax -= (0.1 * rate * step / np.sqrt(seen_softmax)).astype(np.float32)
            seen_bias += (error**2).sum(0)
            bias -= (0.1 * rate * error.sum(0) / np.sqrt(seen_bias)).astype(np.float32)
            seen[touched] += (back**2).mean(1) @ mean**2
            pull = rate / np.sqrt(seen[touched])
            embedding[touched] = rows * (1 - DECAY) - pull[:, None] * (mean.T @ back)
    direction = softmax[1] - softmax[0]
    numbers = np.zeros(BUCKETS, np.float32)
    numbers[used] = SCALE * embedding @ direction
    return Model(numbers, float(bias[1] - bias[0]))


def bags_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, toxic, ids (32-bit) and weights (32-bit floats) of one text of each chosen document, without buckets that
    fewer than LEAST_DOCS of them have."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Subwords()
        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                ids, w = features(text, known)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in (ids, w)]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns[:2], *lists], names=["doc_id", "toxic", "ids", "w"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    bags = rows.mapInArrow(make, "doc_id long, toxic int, ids array<int>, w array<float>")
    bags = common.materialize(common.one_of_each(bags, "doc_id"), "bags")
    counts = bags.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    frequent = np.zeros(BUCKETS, bool)
    frequent[[r["id"] for r in counts.filter(F.col("n") >= LEAST_DOCS).collect()]] = True

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            arrays = [(np.array(ids, np.int32), np.array(w, np.float32)) for ids, w in pairs]
            kept = [(ids[at], w[at]) for ids, w in arrays for at in [frequent[ids]]]
            packed = [pa.array([x[k].tobytes() for x in kept], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *packed], names=["doc_id", "toxic", "ids", "w"])

    return bags.mapInArrow(narrow, "doc_id long, toxic int, ids binary, w binary")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 9) -> Model:
    """Train on labelled documents: docs (doc_id, text), labels (doc_id, toxic).

    Null ids and labels are left out; a document labelled both ways is toxic, and of rows that repeat an id one is read.
    At most `sample` documents a class, the clean ones three times as many, are read, and come to one task as bags of at
    most BUCKETS numbers.
    """
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    hashed = marked.withColumn("_h", common.sample_hash("doc_id", seed))
    chosen = hashed.filter("toxic = 1").orderBy("_h").limit(sample)
    chosen = chosen.union(hashed.filter("toxic = 0").orderBy("_h").limit(3 * sample)).select("doc_id", "toxic")
    rows = bags_of(docs.withColumn("doc_id", F.col("doc_id").cast("long")), chosen)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, marks, ids = [], [], []
        for batch in batches:
            for doc, toxic, *bag in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(doc)
                marks.append(toxic)
                bags.append((np.frombuffer(bag[0], np.int32), np.frombuffer(bag[1], np.float32)))
        order = np.argsort(np.array(ids, np.int64), kind="stable").tolist()
        bags, marks = [bags[i] for i in order], [marks[i] for i in order]
        model = train(bags, marks, seed=seed)
        yield pa.RecordBatch.from_arrays([pa.array([model.numbers.tobytes()], pa.binary()), pa.array([model.bias])], names=["numbers", "bias"])
        common.release_memory()

    # One task learns from the sample: the driver, which has the least memory, gets the model alone.
    found = rows.repartition(1).mapInArrow(learn, "numbers binary, bias double").first()
    return Model(np.frombuffer(found["numbers"], np.float32), found["bias"]) if found else train([], [])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds toxicity (0 to 1) to every row, from its whole text; a null or empty text has the bias alone."""

    def make():
        scorer = model.scorer()
        return lambda texts: [pa.array([scorer.score(t) for t in texts], pa.float64())]

    return common.append_columns(docs, "text", make, [("toxicity", "double")])
