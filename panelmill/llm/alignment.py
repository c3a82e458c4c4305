"""Alignment of two tokenizers by inverted pair bitmaps (operator 13).

Each text is encoded by a byte-level BPE model (A) and a SentencePiece model (B).
Byte offsets where tokens of both end cut the text into groups; at each of them one
A token and one B token end together, which is a link of their ids.

Links are kept as an inverted index from id pairs to documents. Documents of a task
form containers of at most ``DOCS``. A pair's documents in a container are OR-ed into one
bitmap, plane 0; how often a document repeats the pair, less one, stands in the
multiplicity planes 1, 2, 4 and so on. A bitmap is stored as the list of its
documents or as bits, whichever is shorter. Popcounts of plane 0 sum up to a pair's
documents, weighted popcounts of all planes to its links. Postings then meet their
pair's count in a join and bring it back to the documents of their container.

Texts are cut before white space, where no token of either model reaches across (a
SentencePiece model that does is refused), so each distinct word is encoded and
aligned once as long as a worker remembers it. A text with a word whose tokens do not
give back its bytes is encoded whole.

Defined results: null and empty texts, and texts that either model changes, have no
tokens, groups or links, and an empty checksum; equal texts have equal results; rows
with equal ids stay separate rows; texts and words of any length are aligned whole; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Recent, stored

#: Documents and links of a container at most (one longer document stands alone), and words that a worker remembers.
SLOT_BITS = 13
DOCS, LINKS, KEPT = 1 << SLOT_BITS, 1 << 21, 1 << 18
#: A list of places takes two bytes each, bits take one byte for eight documents.
DENSE = DOCS // 16
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NO_RETURN = _WHITE.replace(r"\t-\r", r"\t-\x0c")
#: White space and what follows it, on to the next white space; pieces of B reach across carriage returns.
_WORD = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+(?:\r[{_WHITE}]*[^{_WHITE}]*)*|[{_WHITE}]+")
_ACROSS = re.compile(rf"[^{_WHITE}][{_NO_RETURN}]")
_CUT = re.compile(rf"(?<=[^{_WHITE}])[{_NO_RETURN}]")
#: A long text is taken in parts of about so many characters.
PART = 1 << 20


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_sign() -> dict[str, int]:
    """Byte of each sign of byte-level vocabularies: printable Latin-1 signs stand for themselves, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both models, the bytes of their tokens, and the alignments of words seen."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_file(path_a)
        # Special tokens' strings in a text are plain text.
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        signs, vocabulary = byte_of_sign(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any(_ACROSS.search(p.replace("▁", " ")) for p in pieces):
            raise ValueError("a SentencePiece model with pieces across white space is not supported")
        self.blank = self.b.piece_to_id("▁")
        self.many_b = len(pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        self.recent = Recent(KEPT)

    def learn(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both models, as 32-bit numbers, of words with the white space in front of them; none if they do not give back the word."""
        together = sorted([w for w in words if not w.isspace()], key=lambda w: w[0] != " ")
        found = dict(zip(together, self._learn_run(together), strict=True)) if together and together[0][0] == " " else {}
        return [found[w] if w in found else self._learn_one(w) for w in words]

    def _learn_run(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Words in one text, the first with a blank; each begins with white space and ends otherwise, so its tokens are its own."""
        text = "".join(words)
        got = self._whole(text[1:])
        if got is None:
            return [self._learn_one(w) for w in words]
        ends = np.cumsum([len(w.encode("utf-8", "replace")) for w in words])
        upto_a, upto_b = (np.searchsorted(np.cumsum(size[ids]), ends) + 1 for size, ids in zip((self.size_a, self.size_b), got, strict=True))
        raw_a, raw_b = got[0].tobytes(), got[1].tobytes()
        a = [raw_a[4 * i : 4 * j] for i, j in pairwise([0, *upto_a.tolist()])]
        b = [raw_b[4 * i : 4 * j] for i, j in pairwise([0, *upto_b.tolist()])]
        return list(zip(a, b, strict=True))

    def _learn_one(self, word: str) -> tuple[bytes, bytes] | None:
        """A word alone. B adds a blank of its own, so one that is there is left out, and one too many goes."""
        a = self.a.encode(word, add_special_tokens=False).ids
        b = [self.blank] if word == " " else self.b.encode(word[1:], num_threads=1) if word[0] == " " else self.b.encode(word, num_threads=1)[1:]
        got = self._same(word, a, b)
        return got and (got[0].tobytes(), got[1].tobytes())

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text by both models; none if either changes it."""
        parts_a, parts_b = [], []
        for part in parts(f" {text}"):
            words = _WORD.findall(part)
            of = self.recent.of(words, self.learn)
            found = [of[w] for w in words]
            if None in found:
                return self._whole(text)
            parts_a.extend([x[0] for x in found])
            parts_b.extend([x[1] for x in found])
        return np.frombuffer(b"".join(parts_a), "<i4"), np.frombuffer(b"".join(parts_b), "<i4")

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text as it stands."""
        return self._same(f" {text}", self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text, num_threads=1))

    def _same(self, text: str, a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids, if both give back the text's bytes."""
        same = b"".join(map(self.bytes_a.__getitem__, a)) == text.encode("utf-8", "replace") == b"".join(map(self.bytes_b.__getitem__, b))
        return (np.array(a, "<i4"), np.array(b, "<i4")) if same else None

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many A and B tokens lie before the end of each group."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # Ends are unique and rise, as no token is empty.
        both = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        return np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1


#: Numbers of digits, and the digits from the last on, of all ids of a vocabulary.
@lru_cache(maxsize=1)
def _digits(most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    ids = np.arange(most, dtype=np.int32)
    size = np.char.str_len(ids.astype(str)).astype(np.int64)
    return size, [(ord("0") + ids // 10**k % 10).astype(np.uint8) for k in range(int(size.max()))]


def written(a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> bytes:
    """Groups as text: A ids, a bar, B ids; a semicolon between groups, commas between ids."""
    n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    # A group's A ids come before its B ids.
    place_a = np.arange(len(a)) + np.repeat(upto_b - n_b, n_a)
    place_b = np.arange(len(b)) + np.repeat(upto_a, n_b)
    ids, sign = np.empty(len(a) + len(b), np.int32), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    sign[place_a[upto_a - 1]], sign[place_b[upto_b - 1]] = ord("|"), ord(";")
    sizes, digits = _digits(1 << max(16, int(ids.max()).bit_length()))
    size = sizes[ids]
    end = np.cumsum(size + 1)
    out = np.empty(int(end[-1]), np.uint8)
    out[end - 1] = sign
    out[end - 2] = digits[0][ids]
    for k in range(1, int(size.max())):
        some = np.flatnonzero(size > k)
        out[end[some] - 2 - k] = digits[k][ids[some]]
    return out[:-1].tobytes()


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Aligner:
    """One for each worker and pair of files."""
    return Aligner(path_a, path_b)

def parts(text: str) -> Iterator[str]:
    """A text in parts that begin where a word begins."""
    low = 0
    while len(text) - low > PART and (cut := _CUT.search(text, low + PART)):
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:]


def bitmaps(links: np.ndarray, slots: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes]]]:
    """plane, pairs, whether bits, and bitmaps of a container's links and their documents' places in it.

    Plane 0 holds the documents of a pair, plane k those where bit k - 1 of the
    number of repeats is set.
    """
    held, times = np.unique(links << SLOT_BITS | slots, return_counts=True)
    repeats = times - 1
    for plane in range(1 + int(repeats.max(initial=0)).bit_length()):
        chosen = held if plane == 0 else held[repeats >> (plane - 1) & 1 == 1]
        if not len(chosen):
            continue
        pair, slot = chosen >> SLOT_BITS, (chosen & (DOCS - 1)).astype("<u2")
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        end = np.append(start[1:], len(pair))
        raw = slot.tobytes()
        found = [raw[2 * a : 2 * b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        dense = end - start > DENSE
        for k in np.flatnonzero(dense):
            bits = np.zeros(DOCS, np.uint8)
            bits[slot[start[k] : end[k]]] = 1
            found[k] = np.packbits(bits, bitorder="little").tobytes()
        yield plane, pair[start], dense, found


def places(bits: list[bytes], dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents' places of several bitmaps in a row, and how many each has."""
    lists = [np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little")).astype("<u2").tobytes() if d else b for b, d in zip(bits, dense, strict=True)]
    return np.frombuffer(b"".join(lists), "<u2").astype(np.int64), np.fromiter(map(len, lists), np.int64, len(lists)) // 2


SCHEMA = (
    "container long, slot int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "pair long, plane int, dense boolean, bits binary"
)


def index(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Rows of documents (container, slot, doc_id, n_a, n_b, n_groups, groups_sha256) and of
    postings (container, pair, plane, dense, bits), those with a plane, in one stored table."""
    path_a, path_b = (given or own for given, own in zip((path_a, path_b), default_paths(), strict=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path_a, path_b)
        container, slot, held, own = TaskContext.get().partitionId() << 33, 0, 0, []

        def close() -> Iterator[pd.DataFrame]:
            if held:
                slots = np.repeat([s for s, _ in own], [len(x) for _, x in own])
                for plane, pair, dense, bits in bitmaps(np.concatenate([x for _, x in own]), slots):
                    for low in range(0, len(pair), 50_000):
                        here = slice(low, low + 50_000)
                        yield filled({"container": container, "pair": pair[here], "plane": plane, "dense": dense[here], "bits": bits[here]})

        for batch in batches:
            out = []
            ids = batch["doc_id"].astype("Int64")
            for doc_id, text in zip(ids, batch["text"], strict=True):
                got = model.ids(text) if isinstance(text, str) and text else None
                n_a, n_b, groups, links = 0, 0, "", np.empty(0, np.int64)
                if got:
                    upto = model.aligned(*got)
                    n_a, n_b, groups = *map(len, got), hashlib.sha256(written(*got, *upto)).hexdigest()
                    links = got[0][upto[0] - 1].astype(np.int64) * model.many_b + got[1][upto[1] - 1]
                if slot == DOCS or (held and held + len(links) > LINKS):
                    yield from close()
                    container, slot, held, own = container + 1, 0, 0, []
                out.append((container, slot, doc_id, n_a, n_b, len(links), groups))
                if len(links):
                    own.append((slot, links))
                    held += len(links)
                slot += 1
            names = ["container", "slot", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield filled(dict(zip(names, zip(*out, strict=True), strict=True)) if out else {})
        yield from close()

    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def filled(columns: dict) -> pd.DataFrame:
        """All columns, those not given as nulls."""
        n = max([len(c) for c in columns.values() if not isinstance(c, int)], default=0)
        frame = {c: pd.Series(list(columns[c]) if isinstance(columns[c], tuple) else columns[c], index=range(n)) if c in columns else None for c in names}
        frame = pd.DataFrame(frame, index=range(n), columns=names)
        for c in ("slot", "doc_id", "n_a", "n_b", "n_groups", "pair", "plane"):
            frame[c] = frame[c].astype("Int64")
        return frame

    # The table is written once: containers and places are made by the tasks.
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, SCHEMA))


def popcount(bits: Column, dense: Column) -> Column:
    return F.when(dense, F.bitmap_count(bits)).otherwise(F.length(bits) / 2).cast("long")


def weight(plane: Column) -> Column:
    """What a document of a plane counts."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(plane - 1, F.lit(0)))


def pair_counts(indexed: DataFrame) -> DataFrame:
    """pair, n_docs and n_links: in how many documents an id pair is linked, and how often."""
    posts = indexed.where("plane is not null")
    n = popcount(F.col("bits"), F.col("dense"))
    return posts.groupBy("pair").agg(F.sum(F.when(F.col("plane") == 0, n)).alias("n_docs"), F.sum(n * weight(F.col("plane"))).alias("n_links"))


def split_pair(pairs: DataFrame, many_b: int) -> DataFrame:
    """With a_id and b_id in place of the pair."""
    a, b = F.expr(f"pair div {many_b}").cast("int").alias("a_id"), (F.col("pair") % many_b).cast("int").alias("b_id")
    return pairs.select(a, b, *[c for c in pairs.columns if c != "pair"])


def scores(indexed: DataFrame, many_b: int) -> DataFrame:
    """container, slot, n_best and count_sum of every document with links, from its pairs' postings."""
    pairs = pair_counts(indexed).withColumn("b_id", F.col("pair") % many_b)
    # One row for each id of B, whose number the model fixes.
    best = pairs.groupBy("b_id").agg(F.max("n_links").alias("most"))
    pairs = pairs.join(F.broadcast(best), "b_id").select("pair", "n_links", (F.col("n_links") == F.col("most")).alias("is_best"))
    posts = indexed.where("plane is not null").select("container", "pair", weight(F.col("plane")).alias("weight"), "dense", "bits")
    posts = posts.join(pairs, "pair").drop("pair").repartition("container").sortWithinPartitions("container")

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sums = None, np.zeros((2, DOCS), np.int64)

        def out() -> pd.DataFrame:
            slot = np.flatnonzero(sums[0])
            return pd.DataFrame({"container": np.int64(now or 0), "slot": slot.astype(np.int32), "count_sum": sums[0][slot], "n_best": sums[1][slot]})

        for batch in batches:
            for container, rows in batch.groupby("container", sort=False):
                if container != now:
                    yield out()
                    now, sums = container, np.zeros((2, DOCS), np.int64)
                slot, size = places(list(rows["bits"]), rows["dense"].to_numpy(bool))
                times = rows["weight"].to_numpy(np.int64)
                np.add.at(sums[0], slot, np.repeat(times * rows["n_links"].to_numpy(np.int64), size))
                np.add.at(sums[1], slot, np.repeat(times * rows["is_best"].to_numpy(np.int64), size))
        yield out()

    return posts.mapInPandas(add, "container long, slot int, count_sum long, n_best long")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document its tokens, groups and links, and what the corpus says of its links."""
    path_b = path_b or default_paths()[1]
    indexed = index(docs, path_a, path_b)
    own = indexed.where("plane is null").select("container", "slot", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    got = own.join(scores(indexed, _size(path_b)), ["container", "slot"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    # One A and one B token end together at the end of each group.
    n_links = F.col("n_groups").alias("n_links")
    return got.select("doc_id", "n_a", "n_b", "n_groups", n_links, zero("n_best"), zero("count_sum"), "groups_sha256")


def _size(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
