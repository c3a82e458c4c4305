"""SentencePiece encoding and decoding as a relational lattice (operator 6).

Texts are cut where no piece can reach across: before a run of blanks, around line
ends and digits, and between Latin letters and ASCII signs; a model with a piece across
such a place is refused. What lies between is called a word here. Each distinct
word is encoded once. All substrings up to the longest
piece's length are exploded and equi-joined to the piece table; what matches is
the word's lattice. Its edges are grouped by word and folded by Spark's
``aggregate``:

* ``merge_fold`` for BPE models, the kind of the public model: edges come by
  priority, and one is taken if it joins two neighbouring pieces. For such models
  the path of the best sum, which Viterbi finds, is another segmentation than
  SentencePiece's own, so the lattice is folded by priority instead. Some pieces of
  several blanks rank before the parts they are made of, which one fold in order
  cannot follow, and a fold copies a long word's mask for each edge; words with blanks
  in a row or of more than ``LONG`` characters are merged by a heap (``Pieces.merged``).
* ``viterbi_fold`` for unigram models: edges come by their end, and each position
  keeps the best sum of scores that reaches it.

Characters without a piece become byte pieces. The piece table has a fixed size
and is broadcast. The most frequent words, ``HOT`` of them, are numbered by their rank.
Tasks that read documents write a text as these numbers, packed, and its other words in
full; those meet their ids in a join, and the numbers are written as ids at the end.

Defined results: null and empty texts have no pieces; equal texts have equal
results; white space is kept, so decoding gives back the text; characters outside
the pieces cost one piece a byte; an empty table gives an empty one; rows with
equal ids stay separate rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import most_frequent, small_batches, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
HOT = 1 << 18
#: Longer words are merged by a heap.
LONG = 240
_LETTER, _SIGN = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~"
_OTHER = rf"[^ \n\d{_LETTER}{_SIGN}]"
#: Letters or signs, unless another character follows, which pieces may join to either.
_CHUNK = re.compile(rf" *(?:[{_LETTER}]++(?!{_OTHER})|[{_SIGN}]++(?!{_OTHER})|\d|[^ \n\d]+)| +|\n")
_RUN = re.compile(" *[^ ]+| +")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Pieces:
    """Piece table of a model file: ids and scores of normal pieces, ids of byte pieces."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        normal = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.texts = [model.id_to_piece(i) for i in every]
        self.ids = {self.texts[i]: i for i in normal}
        self.scores = {self.texts[i]: model.get_score(i) for i in normal}
        self.bytes = {int(_BYTE.fullmatch(self.texts[i])[1], 16): i for i in every if model.is_byte(i)}
        self.longest = max(map(len, self.ids))
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.is_byte = np.array([model.is_byte(i) for i in every])
        self.plain = [t.replace(BLANK, " ") for t in self.texts]
        #: Ids are stored as numbers of this kind.
        self.number = np.dtype(np.uint16 if len(self.texts) < 0xFFFF else np.uint32)
        if any(BLANK in t.lstrip(BLANK) or len(_CHUNK.findall(t.replace(BLANK, " "))) > 1 for t in self.ids):
            raise ValueError("pieces that reach across words are not supported")

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, score, rank); rank 0 is the best score. The empty piece gives every word an edge."""
        ranks = {s: r for r, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        rows = [(t, float(s), ranks[s]) for t, s in self.scores.items()] + [("", 0.0, 0)]
        return spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "score", "rank"]))

    def of(self, word: str, mask: str) -> list[int]:
        """Ids of a word cut where the mask has a 1."""
        cuts = [i for i, x in enumerate(mask) if x == "1"]
        found = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = word[a:b]
            if part in self.ids:
                found.append(self.ids[part])
            else:
                found.extend(self.bytes[x] for x in part.encode("utf-8", "replace"))
        return found

    def merged(self, word: str) -> str:
        """Mask of the cuts of a word: always the best of all joins that its pieces allow, then the leftmost."""
        after, before = list(range(1, len(word) + 2)), list(range(-1, len(word)))
        joins: list[tuple[float, int, int, int]] = []

        def offer(a: int) -> None:
            if 0 <= a < len(word) and (mid := after[a]) < len(word) and (found := self.scores.get(word[a : after[mid]])) is not None:
                heapq.heappush(joins, (-found, a, mid, after[mid]))

        cuts = [1] * (len(word) + 1)
        for a in range(len(word)):
            offer(a)
        while joins:
            _, a, mid, b = heapq.heappop(joins)
            if cuts[a] and cuts[mid] and cuts[b] and after[a] == mid and after[mid] == b:
                cuts[mid], after[a], before[b] = 0, b, a
                offer(before[a])
                offer(a)
        return "".join(map(str, cuts))

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        bytewise, ids = self.is_byte[ids].any(), ids.tolist()
        if not bytewise:
            return "".join(map(self.plain.__getitem__, ids))
        raw = b"".join(bytes([self.byte_of[i]]) if i in self.byte_of else self.texts[i].encode() for i in ids)
        return raw.decode("utf-8", "replace").replace(BLANK, " ")

    def decode_text(self, ids) -> str:
        """A whole text: its words without the blank in front."""
        return self.decode(ids)[1:]


def chunks(text: str | None) -> list[str]:
    """Words of a text, which the model reads with one more blank in front."""
    return _CHUNK.findall(f" {text}") if text and isinstance(text, str) else []


def runs(text: str | None) -> list[str]:
    """A text between its blanks, each run without the first blank before it: its words are the words of its runs."""
    if not text or not isinstance(text, str):
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [run[1:] for run in _RUN.findall(f" {text}")]
    return text.split(" ")


def chunks_of_run(run: str) -> list[str]:
    return _CHUNK.findall(f" {run}")


def _counted(docs: DataFrame) -> DataFrame:
    """Distinct words of all texts with their numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def out() -> pd.DataFrame:
            # Runs come again and again, so each is cut into words once.
            found: Counter = Counter()
            for text, n in seen.items():
                for word in chunks_of_run(text):
                    found[word] += n
            seen.clear()
            return pd.DataFrame({"word": pd.Series(list(found), dtype=object), "n": np.array(list(found.values()), np.int64)})

        for batch in batches:
            for text in batch["text"]:
                seen.update(runs(text))
                if len(seen) > 100_000:
                    yield out()
        yield out()

    found = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def lattice(words: DataFrame, pieces: DataFrame, longest: int, edge: Column, shortest: int, fits: Column | None = None) -> DataFrame:
    """word, n and the edges of each word as ``edge`` writes them; blanks count as their own sign.

    ``edge`` may use the piece's ``score`` and ``rank``, its ``start`` and ``size``. A word that
    does not fit has the empty edge alone.
    """
    last = F.length("word") if fits is None else F.when(fits, F.length("word")).otherwise(0)
    at = F.explode(F.sequence(F.lit(0), last)).alias("start")
    # A word's rows stay together and in order of its number, so grouping finds them sorted.
    words = words.withColumn("_id", F.monotonically_increasing_id())
    starts = words.select("_id", "word", "n", F.translate("word", " ", BLANK).alias("_w"), at)
    room = F.least(F.lit(longest), F.length("_w") - F.col("start"))
    sizes = F.when(F.col("start") == last, F.array(F.lit(0))).when(room >= shortest, F.sequence(F.lit(shortest), room))
    every = starts.select("_id", "word", "n", "_w", "start", F.explode(sizes).alias("size"))
    every = every.select("_id", "word", "n", "start", "size", F.substring(F.col("_w"), F.col("start") + 1, F.col("size")).alias("piece"))
    # The piece table's size is fixed by the model.
    edges = every.join(F.broadcast(pieces), "piece")
    return edges.groupBy("_id", "word", "n").agg(F.collect_list(edge).alias("edges")).drop("_id")


def merge_edge() -> Column:
    """An edge of the merge fold in one number: rank, start and size, so numbers sort by priority."""
    return F.shiftleft(F.col("rank").cast("long"), 36) + F.shiftleft(F.col("start").cast("long"), 8) + F.col("size")


def merge_fold(edges: Column, length: Column) -> Column:
    """Mask of the cuts between pieces of a BPE model.

    Edges come by score and then from the left. One is taken if both its ends are
    cuts and exactly one cut lies between them, which then goes. Words of up to 60
    characters hold their cuts as the bits of a number, longer ones as text.
    """
    ordered = F.sort_array(F.filter(edges, lambda e: e.bitwiseAND(255) > 1))
    left = lambda c, n: F.call_function("shiftleft", c, n)
    right = lambda c, n: F.call_function("shiftright", c, n)
    one = F.lit(1).cast("long")

    def place(e: Column) -> tuple[Column, Column]:
        return F.shiftright(e, 8).bitwiseAND((1 << 28) - 1).cast("int"), e.bitwiseAND(255).cast("int")

    def bits(mask: Column, e: Column) -> Column:
        start, size = place(e)
        seen = right(mask, start).bitwiseAND(left(one, size + 1) - 1)
        inner = seen - 1 - left(one, size)
        joins = (seen.bitwiseAND(1) == 1) & (right(seen, size) == 1) & (F.bit_count(inner) == 1)
        return F.when(joins, mask.bitwiseXOR(left(inner, start))).otherwise(mask)

    def step(mask: Column, e: Column) -> Column:
        start, size = place(e)
        seen = F.substring(mask, start + 1, size + 1)
        joins = (F.left(seen, F.lit(1)) == "1") & (F.right(seen, F.lit(1)) == "1") & (F.length(F.replace(seen, F.lit("0"), F.lit(""))) == 3)
        merged = F.concat(F.left(mask, start + 1), F.repeat(F.lit("0"), size - 1), F.substring(mask, start + size + 1, F.length(mask)))
        return F.when(joins, merged).otherwise(mask)

    short = F.reverse(F.bin(F.aggregate(ordered, left(one, length + 1) - 1, bits)))
    return F.when(length <= 60, short).otherwise(F.aggregate(ordered, F.repeat(F.lit("1"), length + 1), step))


def viterbi_fold(edges: Column, length: Column, unknown: float) -> Column:
    """Mask of the cuts on the path of the best sum of scores.

    A position holds the best sum that reaches it and the cuts on the way there;
    a character without a piece costs ``unknown``.
    """
    single = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.struct(F.lit(unknown).alias("score"), i.alias("start"), F.lit(1).alias("size")))
    plain = F.transform(F.filter(edges, lambda e: e["size"] > 0), lambda e: F.struct(e["score"].alias("score"), e["start"].alias("start"), e["size"].alias("size")))
    ordered = F.array_sort(F.transform(F.concat(plain, single), lambda e: F.struct((e["start"] + e["size"]).alias("b"), e["start"].alias("a"), e["score"].alias("score"))))
    first = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit("1").alias("mask")))

    def step(best: Column, e: Column) -> Column:
        behind = F.get(best, e["a"])
        mask = F.concat(behind["mask"], F.repeat(F.lit("0"), e["b"] - e["a"] - 1), F.lit("1"))
        made = F.struct((behind["sum"] + e["score"]).alias("sum"), mask.alias("mask"))
        held = F.get(best, e["b"])
        better = F.when(held["sum"] >= made["sum"], held).otherwise(made)
        return F.concat(F.slice(best, F.lit(1), e["b"]), F.array(better))

    return F.when(length < 1, F.lit("1")).otherwise(F.element_at(F.aggregate(ordered, first, step), -1)["mask"])


def encode_words(words: DataFrame, pieces: Pieces, kind: str = "bpe") -> DataFrame:
    """word, n and ids of distinct words, the ids as bytes of the piece table's kind of number."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(pieces)
    lowest = min(pieces.scores.values()) - 10.0
    edge, shortest = (merge_edge(), 2) if kind == "bpe" else (F.struct("score", "start", "size"), 1)
    # One fold in order cannot follow blanks in a row, and copies the mask of a long word for each of its edges.
    fits = (F.length("word") <= LONG) & ~F.contains("word", F.lit("  ")) if kind == "bpe" else F.lit(True)
    grown = lattice(words, pieces.table(spark), pieces.longest, edge, shortest, fits)
    mask = merge_fold(F.col("edges"), F.length("word")) if kind == "bpe" else viterbi_fold(F.col("edges"), F.length("word"), lowest)

    @F.pandas_udf("binary")
    def finish(word: pd.Series, mask: pd.Series) -> pd.Series:
        table = sent.value
        signs = [w.replace(" ", BLANK) for w in word]
        mask = [table.merged(w) if m is None else m for w, m in zip(signs, mask, strict=True)]
        return pd.Series([np.array(table.of(w, m), table.number).tobytes() for w, m in zip(signs, mask, strict=True)], dtype=object)

    return grown.select("word", "n", F.when(fits, mask).alias("mask")).select("word", "n", finish("word", "mask").alias("ids"))


def sha_of(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "replace")).digest()


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of words, all first bytes before all second ones, which packs ranks of frequent words well."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Ranked:
    """Ids of the frequent words, the one of rank r at r + 1; 0 stands for a word that is still to come."""

    def __init__(self, ids: list[bytes], number: np.dtype):
        self.sizes = np.array([0] + [len(x) // number.itemsize for x in ids], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.frombuffer(b"".join(ids) or bytes(number.itemsize), number)
        self.number = number

    def of(self, numbers: np.ndarray, parts: list[bytes]) -> np.ndarray:
        """Ids of a text, ``parts`` in the places of the words to come."""
        gaps = np.flatnonzero(numbers == 0)
        if len(gaps) != len(parts):
            raise ValueError(f"{len(gaps)} words without ids, {len(parts)} found")
        sizes = self.sizes[numbers]
        sizes[gaps] = [len(x) // self.number.itemsize for x in parts]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        ids = self.ids.take(at, mode="clip")
        if len(gaps):
            ids[np.repeat(numbers == 0, sizes)] = np.frombuffer(b"".join(parts), self.number)
        return ids


def _whole(docs: DataFrame, pieces: Pieces, kind: str, hot: int) -> DataFrame:
    """doc_id, n_chars, n_words, ids of every document, and whether they decode to its whole text.

    A text travels as one array of bytes, so that both readers below need the same rows
    and share one shuffle: its numbers, its hash and length, its doc_id, its other words.
    """
    spark = docs.sparkSession
    # Both functions below hold a batch of whole texts or ids, when the caller uses the result.
    small_batches(spark)
    words = stored(encode_words(_counted(docs), pieces, kind))
    # At most ``hot`` words go to the driver and on to the tasks.
    top = most_frequent(words, "n", hot).toPandas().sort_values(["n", "word"], ascending=[False, True])
    known = spark.sparkContext.broadcast(dict(zip(top["word"], range(1, len(top) + 1), strict=True)))
    sent = spark.sparkContext.broadcast((pieces, Ranked([bytes(x) for x in top["ids"]], pieces.number)))

    @F.pandas_udf("array<binary>")
    def begin(texts: pd.Series, doc_id: pd.Series) -> pd.Series:
        table = known.value
        out = []
        for text, i in zip(texts, doc_id, strict=True):
            text = text if isinstance(text, str) else ""
            found = chunks(text)
            numbers = np.fromiter(map(table.get, found, repeat(0)), np.uint32, len(found))
            head = [packed(numbers), sha_of(text) + len(text).to_bytes(8, "big"), i.encode() if isinstance(i, str) else None]
            out.append(head + [found[k].encode() for k in np.flatnonzero(numbers == 0).tolist()])
        return pd.Series(out, dtype=object)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("string").alias("_id"))
    rows = rows.select("row", begin("text", "_id").alias("_b")).repartition("row")
    # The outer form, as Spark would filter the other's input and so shuffle it once more.
    rare = rows.select("row", F.posexplode_outer(F.slice("_b", F.lit(4), F.size("_b"))).alias("at", "word")).where("word IS NOT NULL")
    rare = rare.join(words.select(F.col("word").cast("binary").alias("word"), F.col("ids").alias("more")), "word")
    more = F.transform(F.array_sort(F.collect_list(F.struct("at", "more"))), lambda x: x["more"])
    got = rows.join(rare.groupBy("row").agg(more.alias("more")), "row", "left")

    @F.pandas_udf("struct<n_chars:long,n_words:long,ids:array<int>,lossless:boolean>")
    def finish(raw: pd.Series, head: pd.Series, more: pd.Series) -> pd.DataFrame:
        table, ranked = sent.value
        out = []
        for text, known_by, parts in zip(raw, head, more, strict=True):
            numbers = unpacked(text)
            ids = ranked.of(numbers, [] if parts is None else list(parts))
            lossless = sha_of(table.decode_text(ids)) == bytes(known_by[:32])
            out.append((int.from_bytes(known_by[32:], "big"), len(numbers), ids.astype(np.int32), lossless))
        return pd.DataFrame(out, columns=["n_chars", "n_words", "ids", "lossless"])

    part = lambda i: F.get("_b", F.lit(i))
    doc_id = part(2).cast("string").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return got.select(doc_id, finish(part(0), part(1), "more").alias("_f")).select("doc_id", "_f.*")


def encode(docs: DataFrame, pieces: Pieces | None = None, kind: str = "bpe", hot: int = HOT) -> DataFrame:
    """doc_id and ids of every document, in full."""
    return _whole(docs, pieces or Pieces(), kind, hot).select("doc_id", "ids")


def decode(encoded: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """doc_id and text of every row of ids."""
    sent = encoded.sparkSession.sparkContext.broadcast(pieces or Pieces())

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: sent.value.decode_text(x), na_action="ignore")

    return encoded.select("doc_id", text("ids").alias("text"))


def digest(docs: DataFrame, pieces: Pieces | None = None, hot: int = HOT) -> DataFrame:
    """Encoding of every document: its ids, their number and checksum, and whether they decode to its text."""
    got = _whole(docs.withColumn("doc_id", F.col("doc_id").cast("long")), pieces or Pieces(), "bpe", hot)
    n_pieces, check = F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_check")
    return got.select("doc_id", "n_chars", "n_words", n_pieces, check, "lossless", "ids")


def op6_pieces(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
