"""Toxicity by multiple-instance learning (operator 1).

A document is a bag of sentences. A linear model of hashed words and beginnings
of words, which inflected forms share, gives each sentence the chance that it is toxic, and a document is toxic unless all its
sentences are clean: 1 - prod(1 - p), the noisy-or. The model is trained from
document labels alone, through that product; afterwards the sentences' own
chances say which of them gave the document away.

Training uses at most about ``max_labelled`` labelled rows, drawn by a hash of
the id; it runs as Spark jobs over their stored features, each of which sends one
gradient per partition to the driver. Every text is scored whole.

Defined results: null and empty texts have no sentences and get the chance of
one sentence without known words; equal texts get equal scores; labels without a
document, or null ones, are not used; without any label all weights stay at the
start; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unit

SLOTS = 1 << 18
#: Features of a word: all of it, and its first four and six bytes.
PREFIXES = (4, 6)
PER_WORD = 1 + len(PREFIXES)
#: Sentence ends become line feeds, other punctuation blanks; bytes from 128 on stay.
_ENDS, _DROP = b".!?\n\r", b"\"#$%&'()*+,-/:;<=>@[\\]^_`{|}~\t\x0b\x0c"
_TABLE = bytes(10 if b in _ENDS else 32 if b in _DROP else b for b in range(256))
_SENTENCE = re.compile(r"[^.!?\n\r]+")


def sentences(text: str) -> list[list[bytes]]:
    """Words of each sentence that has any."""
    lines = text.encode("utf-8", "replace").lower().translate(_TABLE).split(b"\n")
    return [w for w in map(bytes.split, lines) if w]


def _features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all words, slots per sentence, sentences per text (one, without words, if empty)."""
    all_words, lengths, counts = [], [], []
    for text in texts:
        bags = sentences(text) if isinstance(text, str) else []
        for bag in bags:
            all_words.extend(bag)
            lengths.append(PER_WORD * len(bag))
        if not bags:
            lengths.append(0)
        counts.append(max(len(bags), 1))
    slots = np.empty((len(all_words), PER_WORD), np.uint32)
    slots[:, 0] = np.fromiter(map(crc32, all_words), np.uint32, len(all_words))
    for k, n in enumerate(PREFIXES, 1):
        slots[:, k] = np.fromiter((crc32(w[:n], n) for w in all_words), np.uint32, len(all_words))
    return (slots.ravel() & (SLOTS - 1)).astype(np.int32), np.array(lengths, np.int64), np.array(counts, np.int64)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups, which may be empty."""
    upto = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(lengths)
    return upto[ends] - upto[ends - lengths]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, slots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self.bias + _sums(self.weights[slots], lengths)

    def chances(self, logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Noisy-or; log(1 - p) of a sentence is -softplus of its logit."""
        return -np.expm1(-_sums(np.logaddexp(0, logits), counts))


def _bags(rows: DataFrame, partitions: int) -> DataFrame:
    schema = "toxic double, slots array<int>, lengths array<long>, counts array<long>"

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                bags = [_features([t]) for t in part["text"]]
                cols = list(zip(*bags, strict=True)) or [[], [], []]
                yield pd.DataFrame({"toxic": part["toxic"].to_numpy(float), "slots": list(cols[0]), "lengths": list(cols[1]), "counts": list(cols[2])})

    return stored(rows.select("toxic", "text").repartition(partitions).mapInPandas(extract, schema))


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    rounds: int = 40,
    partitions: int = 6,
    common: float = 0.3,
    rare: float = 0.002,
    decay: float = 0.2,
) -> Model:
    """Noisy-or model of labelled documents.

    Words in over ``common`` or under ``rare`` of them, or in fewer than five,
    are not used; ``decay`` pulls weights to zero.
    """
    spark = docs.sparkSession
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("double").alias("toxic"))
    known = known.where(~is_held_out(F.col("doc_id")))
    total = known.count()
    known = known.where(unit(F.col("doc_id"), F.lit("labelled")) < max_labelled / max(total, 1))
    # About ``max_labelled`` rows of two numbers, so small enough for every executor.
    bags = _bags(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"), partitions)
    model = Model(np.zeros(SLOTS), -5.0)

    def summed(step, *more) -> np.ndarray:
        """Sum of one vector a partition."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros(SLOTS + 2)
            for batch in batches:
                out += step(batch, *[m.value for m in more])
            yield pd.DataFrame({"sum": [out.tobytes()]})

        return sum((np.frombuffer(r[0]) for r in bags.mapInPandas(run, "sum binary").collect()), np.zeros(SLOTS + 2))

    def seen(batch: pd.DataFrame) -> np.ndarray:
        out = np.zeros(SLOTS + 2)
        for slots in batch["slots"]:
            out[np.unique(slots)] += 1
        out[-1] = len(batch)
        return out

    found = summed(seen)
    n, used = found[-1], found[:SLOTS]
    if not n:
        return model
    usable = (used >= max(5, rare * n)) & (used <= common * n)
    scale = np.where(usable, np.log((n + 1) / (used + 1)) / np.log(n + 1), 0.0)

    def gradient(batch: pd.DataFrame, now: Model) -> np.ndarray:
        slots, lengths, counts = (np.concatenate([np.asarray(x, np.int64) for x in batch[c]]) for c in ("slots", "lengths", "counts"))
        y = batch["toxic"].to_numpy()
        logits = now.logits(slots, lengths)
        clean = np.exp(-_sums(np.logaddexp(0, logits), counts))
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        each = np.repeat(pull, counts) * np.exp(-np.logaddexp(0, -logits))
        out = np.zeros(SLOTS + 2)
        out[:SLOTS] = np.bincount(slots, np.repeat(each, lengths), SLOTS)
        out[SLOTS] = each.sum()
        return out

    size = np.zeros(SLOTS + 1)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(Model(model.weights * scale, model.bias))
        g = summed(gradient, sent)[: SLOTS + 1]
        sent.unpersist()
        g[:SLOTS] = g[:SLOTS] * scale + decay * model.weights
        size += g * g
        # Few documents move a word little: the constant damps what rests on one or two.
        step = g / np.sqrt(size + 16.0)
        model = Model(model.weights - 2.0 * step[:SLOTS], model.bias - 0.5 * step[SLOTS])
    return Model(model.weights * scale, model.bias)


class WordLogits(dict):
    """What each word adds to a sentence's logit, worked out once for each word in sight."""

    def __init__(self, model: Model, most: int = 200_000):
        super().__init__()
        self.model, self.most = model, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        slots = [crc32(word), *(crc32(word[:n], n) for n in PREFIXES)]
        self[word] = value = float(sum(self.model.weights[s & (SLOTS - 1)] for s in slots))
        return value

    def chances(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Chance of each text, and the logit of its worst sentence."""
        values, lengths, counts = [], [], []
        for text in texts:
            bags = sentences(text) if isinstance(text, str) else []
            for bag in bags:
                values.extend(map(self.__getitem__, bag))
            lengths.extend(map(len, bags) if bags else [0])
            counts.append(max(len(bags), 1))
        lengths, counts = np.array(lengths, np.int64), np.array(counts, np.int64)
        logits = self.model.bias + _sums(np.array(values), lengths)
        return self.model.chances(logits, counts), np.maximum.reduceat(logits, np.cumsum(counts) - counts)

    def located(self, text: str, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, chance) of the sentences that are toxic with a chance of ``least`` or more."""
        found = []
        for m in _SENTENCE.finditer(text):
            if any(sentences(m[0])):
                chance = float(self.chances([m[0]])[0][0])
                if chance >= least:
                    found.append((m.start(), m.end(), chance))
        return found


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Each document's score and the spans of its offending sentences.

    ``sentences`` holds start:end of sentences that are toxic by themselves.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordLogits(sent.value)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                chance, worst = known.chances(part["text"])
                spans = [
                    ",".join(f"{s}:{e}" for s, e, _ in known.located(t)) if w >= 0 and isinstance(t, str) else ""
                    for w, t in zip(worst, part["text"], strict=True)
                ]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "score": chance.clip(0, 1), "sentences": spans})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, score double, sentences string")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = score(docs.select("doc_id", "text"), train(docs, labels))
    held_out = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return got.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences")
