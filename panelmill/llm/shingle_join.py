"""Jaccard join of word shingles by PartEnum signatures (operator 9).

Two sets r and s of at least 0.75 Jaccard likeness differ in at most
k = (|r| + |s|) / 7 elements. Within a band of set sizes the feature domain is
partitioned into groups of two halves. If there are more than k / 2 groups that
matter, some group holds at most one difference, so one of its halves is equal in
both sets: the halves are the enumerated subsets, and their elements' hash is the
signature. A set signs for its own band, and for the next one if it can be the
smaller partner of a set there.

What would make signatures too common is kept out without losing a pair:

* Shingles that very many documents share (hashed counts over the whole corpus
  say which) are left out of the domain. That only lowers the number of
  differences, and both sides leave out the same ones.
* Empty halves are not signed. A set signs groups until it has k / 2 + 1 with
  both halves filled; in the first group that is filled for either partner and
  has at most one difference, both sign the equal half.
* A set that has too few such groups (small sets, sets of common shingles) signs
  its first k + 1 shingles instead, rare ones first; partners of it that have
  enough are met by their own groups, the others here.

Candidates are pairs with the bucket's centre, so a bucket gives as many pairs as
it has members. A parity sketch, whose distance is never more than the sets'
difference, rejects most; the others are compared in full. After links have been
turned into components, only buckets that still hold several components are looked
at again, for the pairs across components. Small buckets are joined with
themselves; larger ones are cut into blocks, and each tile of two blocks compares
longer sketches by bit counts, so that only pairs close to the limit become rows.

Sets with equal elements are one class from the start. Hashes have 64 bits.

Defined results: null and empty texts, and texts of white space, have no shingles
and are their own component; texts under five words have their whole sequence as
one shingle; rows with equal ids are compared like any others; a null id is never
the smallest of a component unless all are null; an empty table gives an empty
one; other columns are ignored by ``join`` and kept by ``deduplicate``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stored
from .hashing import ODD, SPACE, mix, spans

SHINGLE = 5
#: Ratio of sizes within a band; sets under SMALL elements sign single shingles.
BAND, SMALL = 1.8, 24
#: Hashed counts that tell common shingles, in chunks; a count is high if over
#: twice the mean plus COMMON.
SLOTS, CHUNKS, COMMON = 1 << 22, 32, 64
BLOOM = 1 << 24
#: Buckets with up to this many pairs across components for each member are joined
#: in full; others are compared in tiles of two blocks of about this many members.
FULL, BLOCK = 16, 1024

def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles."""
    raw = np.frombuffer(text.encode("utf-8", "replace").lower() if isinstance(text, str) else b"", np.uint8)
    edges = np.flatnonzero(np.diff(SPACE[raw], prepend=True, append=True))
    if not len(edges):
        return np.empty(0, np.uint64)
    w = spans(raw, edges[::2], edges[1::2])
    width = min(len(w), SHINGLE)
    h = np.full(len(w) - width + 1, width, np.uint64)
    for j in range(width):
        h = h * ODD + w[j : len(w) - width + 1 + j]
    h = mix(h)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def class_of(found: np.ndarray) -> int:
    """Equal sets' common id, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).astype(np.int64))


def most_different(a: int, b: int) -> int:
    """Most elements in which sets of these sizes can differ and still be linked.

    Linked: 100 * both >= 75 * either, where either = (a + b + d) / 2 and both = (a + b - d) / 2.
    """
    return (a + b) // 7


def sketch(found: np.ndarray, cells: int = 2) -> bytes:
    """Parity of the number of elements in each of at least ``cells`` times as many cells."""
    bits = 1 << max(6, int(cells * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_different(a: bytes, b: bytes) -> int:
    """Lower bound of the difference of two sets; longer sketches fold by xor."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def signatures(found: np.ndarray, common: np.ndarray, seed: int) -> np.ndarray:
    """PartEnum signatures of a set; ``common`` is a bit set of hashed shingles."""
    n = len(found)
    slot = (found >> np.uint64(8)) & np.uint64(SLOTS - 1)
    high = (common[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
    spread = mix(found ^ np.uint64((seed * 0xD1B54A32D192ED03) & (2**64 - 1)))
    rare = spread[high == 0]
    order = None
    out = []
    own = int(np.log(n) / np.log(BAND) + 1e-9)
    for band in range(own, int(np.log(n / 0.75) / np.log(BAND) + 1e-9) + 1):
        top = BAND ** (band + 1)
        k = most_different(n, int(min(top, n / 0.75)) + 1)
        tag = np.uint64(seed * 4096 + band * 2)
        groups = int(0.18 * top + 0.4 * top**0.5) + 1
        need, filled = k // 2 + 1, 0
        if top >= SMALL:
            part = ((rare >> np.uint64(16)) % np.uint64(2 * groups)).astype(np.int64)
            count = np.bincount(part, minlength=2 * groups)
            both = np.cumsum((count.reshape(groups, 2) > 0).all(axis=1))
            filled = int(both[-1])
        if top >= SMALL:
            sums = np.zeros(2 * groups, np.uint64)
            np.add.at(sums, part, rare)
            signed = np.flatnonzero(count)
            if filled >= need:
                signed = signed[signed < 2 * (int(np.searchsorted(both, need)) + 1)]
            out.append(mix(sums[signed] + signed.astype(np.uint64) * ODD + tag))
        if filled < need:
            order = np.lexsort((spread, high)) if order is None else order
            out.append(mix(spread[order[: k + 1]] + np.uint64(1) + tag))
    return np.concatenate(out)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _scan(docs: DataFrame) -> DataFrame:
    """Each row's class, size and sketch, and hashed counts of all shingles by chunk."""
    schema = "doc_id long, class long, n long, sketch binary, chunk int, counts binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            sets = [shingles(t) for t in batch["text"]]
            slots = ((np.concatenate([np.empty(0, np.uint64), *sets]) >> np.uint64(8)) & np.uint64(SLOTS - 1)).astype(np.int64)
            np.add.at(counts, slots, np.uint32(1))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "class": [class_of(s) for s in sets],
                    "n": [len(s) for s in sets],
                    "sketch": [sketch(s) if len(s) else b"" for s in sets],
                    "chunk": pd.array([None] * len(sets), "Int32"),
                    "counts": None,
                }
            )
        parts = [zlib.compress(c.tobytes(), 1) for c in np.split(counts, CHUNKS)]
        yield pd.DataFrame(
            {"doc_id": pd.array([None] * CHUNKS, "Int64"), "class": 0, "n": 0, "sketch": None, "chunk": pd.array(range(CHUNKS), "Int32"), "counts": parts}
        )

    return stored(_read(docs).select("doc_id", "text").mapInPandas(run, schema))


def _common(scanned: DataFrame) -> np.ndarray:
    """Bit set of the slots with high counts: 512 KB, whatever the corpus."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(batch["chunk"], batch["counts"], strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.int64)
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        yield pd.DataFrame({"chunk": list(sums), "counts": [zlib.compress(s.tobytes(), 1) for s in sums.values()]})

    parts = scanned.where("chunk IS NOT NULL").select("chunk", "counts").repartition(CHUNKS, "chunk").mapInPandas(add, "chunk int, counts binary")
    parts = stored(parts)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"total": [int(np.frombuffer(zlib.decompress(p), np.int64).sum()) for p in batch["counts"]]})

    total = parts.select("counts").mapInPandas(whole, "total long").agg(F.sum("total")).first()[0] or 0
    limit = 2 * total / SLOTS + COMMON

    def flags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(zlib.decompress(p), np.int64) > limit, bitorder="little").tobytes() for p in batch["counts"]]
            yield pd.DataFrame({"chunk": batch["chunk"], "bits": bits})

    got = dict(map(tuple, parts.mapInPandas(flags, "chunk int, bits binary").collect()))
    blank = bytes(SLOTS // CHUNKS // 8)
    return np.frombuffer(b"".join(got.get(c, blank) for c in range(CHUNKS)), np.uint8)


def _each_class(docs: DataFrame, schema: str, made: Callable, wanted: np.ndarray | None = None) -> DataFrame:
    """``made(class, set)`` of each class that a task sees, once.

    ``wanted`` is a bit set of hashed ids; other rows are passed over unread.
    """
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    names = [c.split()[0] for c in schema.split(", ")]

    def frame(out: list) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(names, zip(*out, strict=True), strict=True)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, bits = set(), sent.value
        for batch in batches:
            texts = batch["text"]
            if bits is not None:
                at = _spread_ids(batch["id"])
                texts = texts[((bits[at >> 3] >> (at & 7)) & 1).astype(bool)]
            out = []
            for text in texts:
                found = shingles(text)
                key = class_of(found)
                if not len(found) or key in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(key)
                out.append(made(key, found))
                if len(out) >= 256:
                    yield frame(out)
                    out = []
            if out:
                yield frame(out)

    return docs.select(_id(), F.col("text").cast("string").alias("text")).mapInPandas(run, schema)


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id")


def _spread_ids(ids: pd.Series) -> np.ndarray:
    return (mix(ids.to_numpy(np.int64).view(np.uint64)) & np.uint64(BLOOM - 1)).astype(np.int64)


def _bits_of(ids: DataFrame) -> np.ndarray:
    """Bit set of hashed ids, of a fixed size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(BLOOM, bool)
        for batch in batches:
            bits[_spread_ids(batch["id"])] = True
        yield pd.DataFrame({"bits": [zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)]})

    out = np.zeros(BLOOM // 8, np.uint8)
    for row in ids.select("id").coalesce(4).mapInPandas(run, "bits binary").collect():
        out |= np.frombuffer(zlib.decompress(row[0]), np.uint8)
    return out


def _buckets(docs: DataFrame, common: np.ndarray, seed: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(signature, class) of all signatures."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def made(key: int, found: np.ndarray):
        got = signatures(found, sent.value, seed).view(np.int64)
        return got, np.full(len(got), key, np.int64)

    return _each_class(docs, "signature long, class long", made, wanted)


def _shared(buckets: DataFrame) -> DataFrame:
    """Rows of buckets with two classes or more, each with its centre, the least class.

    A class comes once a bucket, however many tasks saw copies of it; rows stay where
    the window has put them.
    """
    whole = W.partitionBy("signature")
    got = buckets.withColumn("centre", F.min("class").over(whole)).withColumn("_max", F.max("class").over(whole))
    return got.where("centre < _max").drop("_max").dropDuplicates(["signature", "class"])


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the candidate pairs (a, b) whose sets are alike enough."""

    @F.pandas_udf("boolean")
    def possible(na: pd.Series, a: pd.Series, nb: pd.Series, b: pd.Series) -> pd.Series:
        each = zip(na, a, nb, b, strict=True)
        return pd.Series([least_different(x, y) <= most_different(m, n) for m, x, n, y in each], dtype=bool)

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: bytes, y: bytes) -> bool:
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= 75 * (len(x) + len(y) - both)

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    side = lambda s: classes.select(F.col("class").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.where(F.col("na") * 75 <= F.col("nb") * 100).where(F.col("nb") * 75 <= F.col("na") * 100)
    near = stored(near.where(possible("na", "sa", "nb", "sb")).select("a", "b"))
    wanted = stored(near.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(classes.select("class", "id"), "class"))
    bits = _bits_of(wanted)
    if not bits.any():
        return near.limit(0)
    made = lambda key, found: (np.array([key], np.int64), np.array([found.tobytes()], object))
    sets = _each_class(docs, "class long, elements binary", made, bits).join(wanted.select("class"), "class", "left_semi")
    sets = stored(sets.dropDuplicates(["class"]))
    side = lambda s: sets.select(F.col("class").alias(s), F.col("elements").alias(f"e{s}"))
    return stored(near.join(side("a"), "a").join(side("b"), "b").where(alike("ea", "eb")).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(class, component): the least class that links lead to, for all classes in (a, b).

    Every round lets each class take the least label among its neighbours and
    then the label of its label, until nothing changes.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("class")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        seen = both.join(labels.select(F.col("class").alias("b"), F.col("component").alias("_next")), "b")
        least = seen.groupBy(F.col("a").alias("class")).agg(F.min("_next").alias("_next"))
        new = labels.join(least, "class").select("class", "component", F.least("component", "_next").alias("_low"))
        jump = labels.select(F.col("class").alias("_low"), F.col("component").alias("_far"))
        new = new.join(jump, "_low", "left").select("class", F.col("component").alias("_old"), F.coalesce("_far", "_low").alias("component"))
        new = stored(new)
        changed = new.where("component < _old").limit(1).count()
        labels = new.select("class", "component")
        if not changed:
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links."""
    named = lambda s: labels.select(F.col("class").alias(s), F.col("component").alias(f"c{s}"))
    met = links.join(named("a"), "a", "left").join(named("b"), "b", "left")
    met = met.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct()
    more = components(met)
    known = links.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(labels, "class", "left_anti")
    every = labels.union(known.select("class", F.col("class").alias("component")))
    up = more.select(F.col("class").alias("component"), F.col("component").alias("_top"))
    return stored(every.join(up, "component", "left").select("class", F.coalesce("_top", "component").alias("component")))


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components: signature, class, component, few.

    ``few``: the bucket has at most FULL pairs across components for each member.
    """
    whole = W.partitionBy("signature")
    got = shared.select("signature", "class").join(labels, "class", "left")
    got = got.withColumn("component", F.coalesce("component", "class"))
    got = got.withColumn("_same", F.count("*").over(W.partitionBy("signature", "component")))
    got = got.withColumn("_all", F.count("*").over(whole)).where("_same < _all")
    across = F.col("_all") * F.col("_all") - F.sum("_same").over(whole)
    return stored(got.select("signature", "class", "component", (across <= 2 * FULL * F.col("_all")).alias("few")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _across(rows: DataFrame) -> DataFrame:
    """All pairs of a bucket from different components."""
    one = lambda s: rows.select("signature", F.col("class").alias(s), F.col("component").alias(f"c{s}"))
    return _ordered(one("a").join(one("b"), "signature").where("a < b AND ca <> cb").select("a", "b"))


def _tiled(docs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs of a bucket from different components that long sketches cannot tell apart enough.

    A bucket's members are dealt to blocks; every two blocks, and each block with
    itself, meet in a tile of their own. A pair comes from the first of its common
    buckets only.
    """
    wanted = rows.select("class").distinct().join(classes.select("class", "id", "n"), "class")
    wanted = stored(wanted)
    made = lambda key, found: (np.array([key], np.int64), np.array([sketch(found, 8)], object))
    long = _each_class(docs, "class long, long binary", made, _bits_of(wanted)).dropDuplicates(["class"])
    buckets = rows.groupBy("class").agg(F.array_sort(F.collect_list("signature")).alias("buckets"))
    rows = rows.join(wanted.select("class", "n"), "class").join(long, "class").join(buckets, "class")
    blocks = F.ceil(F.count("*").over(W.partitionBy("signature")) / BLOCK).cast("int")
    rows = rows.withColumn("_of", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("_of")).cast("int"))
    rows = rows.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    tile = F.xxhash64("signature", F.least("block", "_with"), F.greatest("block", "_with"))
    rows = rows.select(tile.alias("tile"), "signature", "block", "class", "component", "n", "long", "buckets")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            every = pd.concat(held)
            last = every["tile"].iloc[-1] if len(every) else None
            for _, tile in every[every["tile"] != last].groupby("tile", sort=False):
                yield _near(tile)
            held = [every[every["tile"] == last]]
        for tile in held:
            if len(tile):
                yield _near(tile)

    got = rows.repartition("tile").sortWithinPartitions("tile", "class").mapInPandas(compare, "a long, b long")
    return _ordered(got)


def _near(tile: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a tile that may be linked, by the bit counts of their sketches."""
    size = tile["long"].map(len).min()

    def fold(x: bytes) -> np.ndarray:
        x = np.frombuffer(x, np.uint64)
        while 8 * len(x) > size:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        return x

    bits = np.stack([fold(x) for x in tile["long"]])
    key, component, n, block = (tile[c].to_numpy(np.int64) for c in ("class", "component", "n", "block"))
    own, here = tile["buckets"].to_list(), tile["signature"].iloc[0]
    a, b = [], []
    for i in range(len(tile) - 1):
        others = np.flatnonzero((component[i + 1 :] != component[i]) & ((block[i + 1 :] != block[i]) | (block.min() == block.max()))) + i + 1
        apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
        hits = others[apart <= (n[others] + n[i]) // 7]
        hits = hits[[np.intersect1d(own[i], own[j], assume_unique=True)[0] == here for j in hits]] if len(hits) else hits
        a.append(np.full(len(hits), key[i]))
        b.append(key[hits])
    none = np.empty(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})


def class_components(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """(class, component) of all classes that have a link."""
    common = _common(scanned)
    filled = scanned.where("n > 0").select("class", "n", "sketch", _id())
    first = F.min(F.struct("id", "n", "sketch")).alias("_first")
    classes = stored(filled.groupBy("class").agg(first).select("class", "_first.*"))
    shared = stored(_shared(_buckets(docs, common, 0)))
    pairs = stored(_ordered(shared.select(F.col("centre").alias("a"), F.col("class").alias("b"))))
    labels = components(linked(docs, classes, pairs))
    rows = _open(shared, labels)
    crowded = rows.where(~F.col("few"))
    rest = _across(rows.where("few"))
    if crowded.limit(1).count():
        rest = rest.union(_tiled(docs, classes, crowded)).distinct()
    return _merged(labels, linked(docs, classes, rest.join(pairs, ["a", "b"], "left_anti")))


def labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, n, class and component of documents with shingles; doc_id, n, class of the others."""
    scanned = _scan(docs)
    rows = scanned.where("chunk IS NULL").select("doc_id", "n", "class")
    labels = class_components(docs, scanned)
    filled = rows.where("n > 0").join(labels, "class", "left")
    return filled.withColumn("component", F.coalesce("component", "class")), rows.where("n = 0")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class and component_id of every document."""
    filled, empty = labelled(docs)
    least = filled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    filled = filled.join(least, "component")
    empty = empty.withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "class", "component_id"]
    return filled.select(*columns).union(empty.select(*columns))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents, all columns as they were.

    The one with the least id stays, a null id only if there is no other; of rows
    with that id and set, the least text. Rows without shingles stay all.
    """
    filled, _ = labelled(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class")).alias("_first")
    keep = filled.groupBy("component").agg(least).select("_first.doc_id", F.col("_first.class").alias("_class"))

    @F.pandas_udf("long")
    def class_of_text(texts: pd.Series) -> pd.Series:
        sets = (shingles(t) for t in texts)
        return pd.Series([class_of(s) if len(s) else None for s in sets], dtype="Int64")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), class_of_text(text).alias("_class"), F.xxhash64(text).alias("_tie"))
    keep = keep.select(F.col("_class"), F.col("doc_id").alias("_keep"))
    same = (rows["_class"] == keep["_class"]) & rows["_id"].eqNullSafe(keep["_keep"])
    first = F.row_number().over(W.partitionBy("_class").orderBy("_tie"))
    kept = rows.where("_class IS NOT NULL").join(keep, same, "left_semi").withColumn("_at", first).where("_at = 1")
    return kept.select("_row.*").union(rows.where("_class IS NULL").select("_row.*"))


def op9_jaccard(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT rid, list_aggregate(w[i:i + 4], 'string_agg', chr(31)) AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
c AS (SELECT a.rid AS x, b.rid AS y, count(*) AS cnt FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.rid = x JOIN n q ON q.rid = y WHERE 100 * cnt >= 75 * (p.n + q.n - cnt)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT rid AS start, rid AS at FROM n UNION SELECT r.start, e.y FROM r JOIN e ON e.x = r.at),
m AS (SELECT start AS rid, min(doc_id) AS component_id FROM r JOIN d ON d.rid = r.at GROUP BY start)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)
"""
