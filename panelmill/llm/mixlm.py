"""Language-model scores by online logistic context mixing (operator 3).

A text is its words, A-Z in lower case, and an end. Every word is a path of bits
through a Huffman tree over the most frequent repeated training words; any other is
an escape and its bytes, as paths through a tree of bytes. Three predictors give
each bit a probability: counts of its node alone (for bytes: with the byte
before), and two tables of hashed contexts, the word before and the two words
before (for bytes: the three bytes before, and the word's beginning). Their logits
are added with weights chosen by a gate, which says how much each hashed context
has been seen. Within a text the weights are refined after every segment by the
errors they made there, so the text adapts them to itself, in order. The cost of
all bits is the text's total, from which log10 probability and bits per byte come.

All counts are taken from all training texts. The two hashed tables have a number
of slots that grows with the corpus up to 2**``BITS``, and the tree the ``WORDS``
most frequent words, so a model has a bounded size; words beyond the tree are
counted exactly in a table that stays on the cluster and meets the texts in a join.

Defined results: null and empty texts are an end alone; equal texts of the same
fold have equal scores; without training texts every bit costs one, and the base
score is what its formula gives with no counts; an empty table gives an empty one;
rows with equal ids stay separate; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import most_frequent, stored
from .hashing import ODD, mix, spans

WORDS, BITS, CHUNKS = 1 << 18, 22, 32
#: No word holds a blank, so it stands for the end of a text, and of a spelled word.
END = b" "
#: Words after which weights are refined: 16, 32 more, and so on up to this many.
SEGMENT, TOKENS = 256, 20_000
#: First say of each hashed context by how often it was seen (never, 1-2, 3-15,
#: more) against 1 for the node alone: for bits of words, and of bytes.
SAY = (((0.0, 0.1, 0.35, 1.0), (0.0, 0.25, 0.8, 1.6)), ((0.0, 0.2, 0.6, 1.5), (0.0, 0.5, 1.2, 2.0)))


_LOGITS = ((np.arange(256) - 128) / 16).astype(np.float32)


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []


def huffman(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Paths of a code: for each symbol its start and length in (nodes, bits); chance of a 1 at each node."""
    n = len(weights)
    heap = [(int(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side, ones, total = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int8), np.zeros(n), np.zeros(n)
    for node in range(n, 2 * n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i], parent[j], side[j] = node, node, 1
        ones[node - n], total[node - n] = b, a + b
        heapq.heappush(heap, (a + b, node))
    root = 2 * n - 2
    depth = np.zeros(2 * n, np.int64)
    for node in range(root - 1, -1, -1):
        depth[node] = depth[parent[node]] + 1
    length = depth[:n]
    start = np.cumsum(length) - length
    nodes, bits = np.zeros(int(length.sum()), np.int32), np.zeros(int(length.sum()), np.int8)
    at, left = np.arange(n), length.copy()
    while (going := left > 0).any():
        where = start[going] + left[going] - 1
        bits[where], nodes[where] = side[at[going]], parent[at[going]] - n
        at[going], left[going] = parent[at[going]], left[going] - 1
    return start, length, nodes, bits, (ones + 0.4) / (total + 0.8)


@dataclass
class Code:
    """Trees of words and bytes. Symbols: words, the end, the escape, then the bytes."""

    index: dict[bytes, int]
    start: np.ndarray
    length: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    word_chance: np.ndarray
    log_base: np.ndarray

    @property
    def escape(self) -> int:
        return len(self.index)

    @property
    def byte_base(self) -> int:
        return len(self.index) + 1


def make_code(words: list[bytes], counts: np.ndarray, ends: int, rest: int) -> Code:
    index = {w: i for i, w in enumerate([*words, END])}
    w = huffman(np.concatenate([counts, [max(ends, 1), max(rest, 1)]]).astype(np.int64))
    seen = np.ones(256)
    for word, c in zip(words[-65536:], counts[-65536:], strict=True):
        np.add.at(seen, np.frombuffer(word + END, np.uint8), c)
    b = huffman(seen.astype(np.int64))
    return Code(
        index,
        np.concatenate([w[0], b[0] + len(w[2])]),
        np.concatenate([w[1], b[1]]),
        np.concatenate([w[2], b[2] + len(words) + 2]),
        np.concatenate([w[3], b[3]]),
        w[4],
        np.empty(0),
    )


def symbols(code: Code, texts: list[list[bytes]]):
    """Symbols of texts with their contexts: arrays sym, offset, one, two, token; tokens' ids and texts."""
    flat = [t for text in texts for t in (*text, END)]
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    ids = np.fromiter(map(code.index.get, flat, repeat(code.escape)), np.int64, len(flat))
    rare = np.flatnonzero(ids == code.escape)
    spelled = [flat[i] for i in rare]
    own = mix(ids.astype(np.uint64) + np.uint64(1))
    own[rare] = mix(np.fromiter(map(crc32, spelled), np.uint64, len(rare)) + np.uint64(1 << 33))
    first = np.diff(doc, prepend=-1) != 0
    one = np.where(first, np.uint64(7), np.roll(own, 1))
    two = mix(one * ODD + np.where(first, np.uint64(7), np.roll(one, 1)))
    size = np.ones(len(flat), np.int64)
    size[rare] += np.fromiter(map(len, spelled), np.int64, len(rare)) + 1
    token = np.repeat(np.arange(len(flat)), size)
    at = np.cumsum(size) - size
    sym, offset, c1, c2 = np.empty(len(token), np.int64), np.zeros(len(token), np.int64), np.empty(len(token), np.uint64), np.empty(len(token), np.uint64)
    sym[at], c1[at], c2[at] = ids, one, two
    if len(rare):
        raw = np.frombuffer(END.join(spelled) + END, np.uint8)
        inside = np.ones(len(token), bool)
        inside[at] = False
        begin = np.repeat(np.cumsum(size[rare] - 1) - (size[rare] - 1), size[rare] - 1)
        here = np.arange(len(raw))
        back = [np.where(here - k >= begin, raw[here - k], 32).astype(np.uint64) for k in (1, 2, 3)]
        sym[inside] = raw.astype(np.int64) + code.byte_base
        offset[inside] = back[0].astype(np.int64) * 256
        c1[inside] = mix(back[0] | back[1] << np.uint64(8) | back[2] << np.uint64(16) | np.uint64(1 << 40))
        c2[inside] = mix(spans(raw, begin, here) + np.uint64(1 << 41))
    return sym, offset, c1, c2, token, doc, ids, flat


def bits_of(code: Code, sym: np.ndarray, offset: np.ndarray, c1: np.ndarray, c2: np.ndarray, size: int):
    """Bits of each symbol, and for every bit its node, value and slots in both hashed tables of 2**size slots."""
    length = code.length[sym]
    upto = np.cumsum(length)
    flat = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(code.start[sym] - upto + length, length)
    node, bit = code.nodes[flat], code.bits[flat]
    spread = node.astype(np.uint64) * ODD
    shift = np.uint64(64 - size)
    one = ((np.repeat(c1, length) ^ spread) * np.uint64(0xBF58476D1CE4E5B9)) >> shift
    two = ((np.repeat(c2, length) ^ spread) * np.uint64(0x94D049BB133111EB)) >> shift
    return length, node + np.repeat(offset, length), bit, one.view(np.int64), two.view(np.int64)


def _parts(texts, most: int = TOKENS) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Runs of rows with at most about ``most`` words, one longer text at a time."""
    rows, held, n = [], [], 0
    for row, text in enumerate(texts):
        got = tokens(text)
        if held and n + len(got) > most:
            yield rows, held
            rows, held, n = [], [], 0
        rows.append(row)
        held.append(got)
        n += len(got) + 1
    if held:
        yield rows, held


def _count_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        frame = lambda: pd.DataFrame({"word": pd.Series([w.decode() for w in seen], dtype=object), "c": np.array(list(seen.values()), np.int64)})
        for batch in batches:
            for text in batch["text"]:
                seen.update(tokens(text))
                if len(seen) > 200_000:
                    yield frame()
                    seen.clear()
        yield frame()

    return stored(docs.select("text").mapInPandas(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")))


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _tables(docs: DataFrame, code: Code, size: int) -> list[np.ndarray]:
    """Logits, in 16ths, and how often seen, of the byte nodes' table and both hashed ones.

    Tasks count into whole tables and send them in chunks; the sums of a chunk are
    formed where its parts meet, and only the finished logits go to the driver.
    """
    cells = [1 << 17, 2 << size, 2 << size]
    base = len(code.word_chance)
    sent = docs.sparkSession.sparkContext.broadcast(code)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, sums = sent.value, [np.zeros(n, np.uint32) for n in cells]
        for batch in batches:
            for _, texts in _parts(batch["text"], 4 * TOKENS):
                got = symbols(code, texts)
                _, node, bit, one, two = bits_of(code, *got[:4], size)
                byte = node >= base
                for total, slot, b in ((sums[0], node[byte] - base, bit[byte]), (sums[1], one, bit), (sums[2], two, bit)):
                    np.add.at(total, 2 * slot + b, np.uint32(1))
        for t, total in enumerate(sums):
            for k, part in enumerate(np.split(total, CHUNKS)):
                yield pd.DataFrame({"part": [t * CHUNKS + k], "counts": [_pack(part)]})

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch["part"], batch["counts"], strict=True):
                got = _unpack(packed, np.uint32).astype(np.int64)
                sums[part] = sums[part] + got if part in sums else got
        for part, total in sums.items():
            n0, n1 = total[::2], total[1::2]
            logit = np.clip(np.rint(16 * np.log((n1 + 0.4) / (n0 + 0.4))), -127, 127).astype(np.int16) + 128
            seen = np.searchsorted([1, 3, 16], n0 + n1, side="right").astype(np.int16)
            yield pd.DataFrame({"part": [part], "cells": [_pack(logit | seen << 8)]})

    parts = docs.select("text").mapInPandas(count, "part int, counts binary").repartition(CHUNKS, "part")
    got = dict(map(tuple, parts.mapInPandas(finish, "part int, cells binary").collect()))
    blank = lambda n: np.full(n // 2 // CHUNKS, 128, np.int16)
    chunk = lambda t, k: _unpack(got[t * CHUNKS + k], np.int16) if t * CHUNKS + k in got else blank(cells[t])
    return [np.concatenate([chunk(t, k) for k in range(CHUNKS)]) for t in range(len(cells))]


@dataclass
class Model:
    code: Code
    size: int
    alone: np.ndarray
    one: np.ndarray
    two: np.ndarray
    say: tuple = SAY

    def cost(self, texts: list[list[bytes]]) -> np.ndarray:
        """Natural-log cost of each text; its weights start anew and follow its own errors."""
        code = self.code
        sym, offset, c1, c2, token, doc, ids, _ = symbols(code, texts)
        within = np.arange(len(doc)) - np.repeat(np.flatnonzero(np.diff(doc, prepend=-1)), np.bincount(doc))
        limits = [16, 48, 112, 240]
        segment = np.where(within < limits[-1], np.searchsorted(limits, within, side="right"), 4 + (within - limits[-1]) // SEGMENT)
        order = np.argsort(segment[token].astype(np.int16), kind="stable")
        bounds = np.cumsum(np.bincount(segment[token]))
        sym, offset, c1, c2, owner = sym[order], offset[order], c1[order], c2[order], doc[token[order]]
        start = []
        for one, two in self.say:
            one, two = np.repeat(one, 4), np.tile(two, 4)
            start.append(np.stack([np.ones(16), one, two]) / (1 + one + two))
        gates = 32
        weights = np.tile(np.concatenate(start, axis=1), (1, len(texts))).astype(np.float32)
        seen = np.zeros(gates * len(texts))
        total = np.zeros(len(texts))
        low = 0
        for high in bounds:
            pick, low = slice(low, high), high
            if pick.start == high:
                continue
            length, node, bit, one, two = bits_of(code, sym[pick], offset[pick], c1[pick], c2[pick], self.size)
            v1, v2 = self.one[one], self.two[two]
            x = (self.alone[node], _LOGITS[v1 & 255], _LOGITS[v2 & 255])
            whose = np.repeat(owner[pick], length)
            gate = whose * gates + ((node >= len(code.word_chance)) * np.int16(16) + (v1 >> 8) * np.int16(4) + (v2 >> 8))
            logit = sum(weights[k][gate] * x[k] for k in range(3))
            sign = (2 * bit - 1).astype(np.float32)
            chance = 1 / (1 + np.exp(-sign * np.clip(logit, -40, 40)))
            there = np.flatnonzero(np.diff(whose, prepend=-1))
            total[whose[there]] -= np.add.reduceat(np.log(chance), there, dtype=np.float64)
            error = sign * (1 - chance)
            seen += np.bincount(gate, minlength=len(seen))
            for k in range(3):
                weights[k] += (np.bincount(gate, error * x[k], len(seen)) / (0.5 * seen + 20)).astype(np.float32)
        return total


def train(docs: DataFrame) -> tuple[Model, DataFrame, int, int]:
    """Model of all given texts, their words' counts, and the numbers of all and of distinct tokens."""
    counted = _count_words(docs)
    ends = docs.count()
    found = counted.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = (found["n"] or 0) + ends, found["v"] + (ends > 0)
    # Words seen once are spelled out, which teaches the byte nodes what new words look like.
    top = most_frequent(counted.where("c > 1"), "c", WORDS).toPandas().sort_values(["c", "word"], ascending=[False, True])
    words, counts = [w.encode() for w in top["word"]], top["c"].to_numpy(np.int64)
    code = make_code(words, counts, ends, n - ends - int(counts.sum()))
    code.log_base = np.log10((np.concatenate([counts, [ends]]) + 0.5) / (n + 0.5 * (v + 1)))
    size = min(BITS, max(12, math.ceil(math.log2(max(n, 1)))))
    byte, one, two = _tables(docs, code, size)
    alone = np.log(code.word_chance / (1 - code.word_chance))
    alone = np.concatenate([alone, ((byte & 255) - 128) / 16]).astype(np.float32)
    return Model(code, size, alone, one, two), counted, n, v


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, trained: tuple[Model, DataFrame, int, int]) -> DataFrame:
    """Scores of every document: the model's, the unigram base's, and bits per byte."""
    model, counted, n, v = trained
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "row long, doc_id long, n_tokens long, n_known long, base double, score double, bits_per_byte double, rare array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            for rows, texts in _parts(batch["text"]):
                cost = model.cost(texts)
                get, escape, base = model.code.index.get, model.code.escape, np.append(model.code.log_base, 0.0)
                out = []
                for text, c in zip(texts, cost, strict=True):
                    ids = np.fromiter(map(get, [*text, END], repeat(escape)), np.int64, len(text) + 1)
                    rare = [text[i].decode() for i in np.flatnonzero(ids == escape)]
                    known = len(ids) - len(rare) - (n == 0)
                    size = sum(map(len, text)) + len(text) + 1
                    out.append((len(ids), known, base[ids].sum(), -c / math.log(10), c / math.log(2) / size, rare))
                made = pd.DataFrame(out, columns=["n_tokens", "n_known", "base", "score", "bits_per_byte", "rare"])
                made.insert(0, "row", batch["row"].to_numpy()[rows])
                made.insert(1, "doc_id", batch["doc_id"].astype("Int64").to_numpy()[rows])
                yield made

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(rows.mapInPandas(run, schema))
    rare = rows.select("row", F.explode("rare").alias("word")).join(counted, "word", "left")
    c = F.coalesce("c", F.lit(0))
    more = rare.groupBy("row").agg(
        F.sum(F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("_base"), F.sum((c > 0).cast("long")).alias("_known")
    )
    got = rows.drop("rare").join(more, "row", "left")
    return got.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"), "score", "bits_per_byte",
    )


def op3_mixlm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").cast("string").alias("text"))
    got = score(docs, train(docs.where(~is_held_out(F.col("doc_id")))))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    return got.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), *columns)
