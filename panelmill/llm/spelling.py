"""Grouping of spelling variants by a trie of letter-group counts (operator 12).

Letters are dealt to ``GROUPS`` groups, by falling frequency to the lightest group. A word's
counts of the groups, one after the other, are its way through a trie. An insertion
adds one to a count, a deletion takes one away, a replacement does both or neither; so
the search from a word goes down the trie depth first with a budget of one surplus and one
deficit, and only the words of the leaves it reaches are compared letter by letter.

The top of the trie is laid over the cluster. A node with more than ``NODE`` words is
split by the next group's count, down to the last group; a word belongs to one node, and
asks every node that its budget allows. Each node's part of the trie is then searched in
one task, for all words that ask there at once: the words that reach a node of the trie
go on together. Nodes that many words ask, and nodes that no further group can
split, are divided, so a task holds a bounded number of words.

A word's form is its most frequent near word, if that comes at least twice as often. Counts
thus double along forms, so chains are short; they are followed by doubling steps.

Defined results: null and empty texts have no words, a null doc_id counts as an empty one;
words that no other is near have n_near 0, form null and themselves as root; equal counts
are told apart by code points; words of any length take part; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hashing import ODD, mix

GROUPS, FIRST = 16, 3
#: Words of a node, and words that ask it, in one task; distinct words that a task holds before it passes their counts on.
NODE, HELD = 8192, 400_000
#: A node's words times asking words up to this are compared at once, without going further down.
SMALL = 1 << 14
#: Words up to this length are compared as rows of a matrix.
WIDTH = 32
LEAST_LENGTH, LEAST_TIMES, DROP = 5, 3, 97

#: Latin-1 bytes: letters, A-Z in lower case, everything else as a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def words_of(doc_id: str | None, text: str | None) -> Iterator[tuple[bytes, int]]:
    """Distinct runs of letters as Latin-1 with their numbers; a run that its hash marks has lost a letter."""
    if not isinstance(text, str):
        return
    begun = crc32(f"{doc_id if isinstance(doc_id, str) else ''}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), begun)
        if h % DROP == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n: words of at least ``LEAST_LENGTH`` letters that come at least ``LEAST_TIMES`` times."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def out() -> pd.DataFrame:
            found = {w.decode("latin-1"): n for w, n in seen.items()}
            seen.clear()
            return pd.DataFrame({"word": pd.Series(list(found), dtype=object), "n": np.array(list(found.values()), np.int64)})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                for word, n in words_of(doc_id, text):
                    if len(word) >= LEAST_LENGTH:
                        seen[word] += n
                if len(seen) > HELD:
                    yield out()
        yield out()

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_TIMES)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each Latin-1 letter: by falling frequency, to the group with the least so far."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer("".join(batch["word"]).encode("latin-1"), np.uint8), minlength=256)
        yield pd.DataFrame({"letter": np.arange(256), "n": total})

    # At most 256 rows.
    found = words.select("word").mapInPandas(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    group, load = np.zeros(256, np.int64), [(0, g) for g in range(groups)]
    for row in sorted(found, key=lambda r: (-r["n"], r["letter"])):
        weight, g = heapq.heappop(load)
        group[row["letter"]] = g
        heapq.heappush(load, (weight + row["n"], g))
    return group


def vectors(words: list[str], group: np.ndarray, groups: int) -> np.ndarray:
    """Counts of the letter groups of each word."""
    raw = [w.encode("latin-1") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    letters = group[np.frombuffer(b"".join(raw), np.uint8)]
    place = np.repeat(np.arange(len(raw)), size) * groups + letters
    return np.bincount(place, minlength=len(raw) * groups).reshape(len(raw), groups).astype(np.int32)


def _signs(groups: int) -> np.ndarray:
    """Odd multipliers, one a group: the key of a node is the sum of its counts times these."""
    return mix((np.arange(groups, dtype=np.uint64) + np.uint64(1)) * ODD) | np.uint64(1)


def _node_keys(counts: np.ndarray, depth: int) -> np.ndarray:
    """Key of each word's node at a depth."""
    keys = (counts[:, :depth].astype(np.uint64) * _signs(depth)).sum(axis=1, dtype=np.uint64)
    return (keys + mix(np.array([depth], np.uint64))).view(np.int64)


def _budgets(depth: int) -> np.ndarray:
    """All changes of the first counts that one surplus and one deficit allow."""
    one = np.eye(depth, dtype=np.int64)
    both = [one[i] - one[j] for i in range(depth) for j in range(depth) if i != j]
    return np.array([np.zeros(depth, np.int64), *one, *-one, *both])


def _asked_keys(counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the nodes that each word's budget reaches at a depth, each key once a word."""
    change = _budgets(depth)
    shift = (change.astype(np.uint64) * _signs(depth)).sum(axis=1, dtype=np.uint64)
    possible = np.ones((len(counts), len(change)), bool)
    for g in range(depth):
        possible &= counts[:, g : g + 1] + change[:, g] >= 0
    keys = _node_keys(counts, depth).view(np.uint64)[:, None] + shift
    # Equal hashes of two nodes would ask the same words twice.
    keys[~possible] = keys[np.nonzero(~possible)[0], 0]
    keys.sort(axis=1)
    keep = np.ones(keys.shape, bool)
    keep[:, 1:] = keys[:, 1:] != keys[:, :-1]
    row, column = np.nonzero(keep)
    return row, keys[row, column].view(np.int64)


def search(targets: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asking word, target) whose counts differ by at most one surplus and one deficit of the target.

    Goes down the trie of the targets' counts depth first; the words that reach a node
    go on together, each with what is left of its budget. Targets come sorted by their counts.
    """
    levels = targets.shape[1]
    every = np.arange(len(asking))
    none = np.zeros(len(asking), np.int8)
    stack = [(0, 0, len(targets), every, none, none)]
    while stack:
        level, low, high, who, surplus, deficit = stack.pop()
        if not len(who) or low == high:
            continue
        if level == levels or (high - low) * len(who) <= SMALL:
            step = max(1, SMALL // (high - low))
            for at in range(0, len(who), step):
                here = slice(at, at + step)
                change = targets[low:high, level:][None] - asking[who[here], level:][:, None]
                more = np.maximum(change, 0).sum(axis=2) + surplus[here, None]
                less = np.maximum(-change, 0).sum(axis=2) + deficit[here, None]
                # A target that is shorter finds the asking word itself.
                row, column = np.nonzero((more <= 1) & (less <= more))
                yield who[here][row], low + column
            continue
        column = targets[low:high, level]
        starts = np.flatnonzero(np.diff(column, prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], high - low), strict=True):
            change = column[a] - asking[who, level]
            more, less = surplus + (change == 1), deficit + (change == -1)
            going = (np.abs(change) <= 1) & (more <= 1) & (less <= 1)
            stack.append((level + 1, low + a, low + b, who[going], more[going], less[going]))


def is_near(a: bytes, b: bytes) -> bool:
    """Whether b is a with one letter inserted, or replaced and the later of the two."""
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if len(a) == len(b):
        return a < b and a[at + 1 :] == b[at + 1 :]
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.array([w if len(w) <= WIDTH else b"" for w in words], f"S{WIDTH + 1}").view(np.uint8).reshape(len(words), WIDTH + 1), size


def verified(asking: list[bytes], targets: list[bytes], found: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the found pairs that one insertion or replacement tells apart, each unordered pair once."""
    own, own_size = _matrix(asking)
    other, other_size = _matrix(targets)
    rows, columns = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def check(i: np.ndarray, j: np.ndarray) -> None:
        long = own_size[i] >= WIDTH
        if long.any():
            keep = np.array([is_near(asking[x], targets[y]) for x, y in zip(i[long], j[long], strict=True)], bool)
            rows.append(i[long][keep])
            columns.append(j[long][keep])
            i, j = i[~long], j[~long]
        a, b = own[i], other[j]
        differs = a != b
        at = differs.argmax(axis=1)
        here = np.arange(len(i))
        replaced = (own_size[i] == other_size[j]) & (differs.sum(axis=1) == 1) & (a[here, at] < b[here, at])
        moved = (a[:, :-1] == b[:, 1:]) | (np.arange(WIDTH) < at[:, None])
        inserted = (own_size[i] + 1 == other_size[j]) & moved.all(axis=1)
        rows.append(i[replaced | inserted])
        columns.append(j[replaced | inserted])

    held, n = [], 0
    for i, j in found:
        held.append((i, j))
        n += len(i)
        if n > 200_000:
            check(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            held, n = [], 0
    if held:
        check(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
    return np.concatenate(rows), np.concatenate(columns)


def near_pairs(words: DataFrame, groups: int = GROUPS, node: int = NODE, first: int = FIRST) -> DataFrame:
    """a, a_n, b, b_n: all pairs of words that differ by one letter inserted, deleted or replaced, each once.

    ``words`` is a stored table of (word, n).
    """
    spark = words.sparkSession
    group = letter_groups(words, groups)
    words = words.select("word", "n")

    def own_keys(depth: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch[["word", "n"]].assign(key=_node_keys(vectors(list(batch["word"]), group, groups), depth))

        return run

    def asked(depth: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for low in range(0, len(batch), 2000):
                    part = batch.iloc[low : low + 2000]
                    row, key = _asked_keys(vectors(list(part["word"]), group, groups), depth)
                    yield part.iloc[row].assign(key=key)

        return run

    keyed = "word string, n long, key long"
    targets, asks, rest = [], [], words
    for depth in range(min(first, groups), groups + 1):
        here = stored(rest.mapInPandas(own_keys(depth), keyed))
        sizes = stored(here.groupBy("key").agg(F.count("*").alias("size")))
        # Nodes that no further group can split are divided into blocks.
        done = sizes.withColumn("blocks", F.ceil(F.col("size") / node)) if depth == groups else sizes.where(F.col("size") <= node).withColumn("blocks", F.lit(1).cast("long"))
        block = F.pmod(F.xxhash64("word"), F.col("blocks")).alias("block")
        targets.append(here.join(done, "key").select("key", block, "word", "n"))
        reach = words.mapInPandas(asked(depth), keyed).join(done, "key")
        asks.append(reach.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "word", "n"))
        if depth == groups or not sizes.where(F.col("size") > node).head(1):
            break
        rest = here.join(sizes.where(F.col("size") > node).select("key"), "key").select("word", "n")
    of = lambda frames: frames[0] if len(frames) == 1 else of([frames[0].unionByName(frames[1]), *frames[2:]])
    asked_all, held = stored(of(asks)), of(targets)
    # Many words may ask one node; they are divided, and its words go to each division.
    many = asked_all.groupBy("key", "block").agg(F.ceil(F.count("*") / (32 * node)).alias("slices"))
    left = asked_all.join(many, ["key", "block"]).withColumn("slice", F.pmod(F.xxhash64("word", F.lit(1)), F.col("slices")))
    right = held.join(many, ["key", "block"]).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))

    def compare(asking: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
        counts = vectors(list(targets["word"]), group, groups)
        order = np.lexsort(counts.T[::-1])
        targets = targets.iloc[order]
        a, b = ([w.encode("latin-1") for w in side["word"]] for side in (asking, targets))
        i, j = verified(a, b, search(counts[order], vectors(list(asking["word"]), group, groups)))
        one, two = asking.iloc[i], targets.iloc[j]
        return pd.DataFrame({"a": one["word"].to_numpy(object), "a_n": one["n"].to_numpy(np.int64), "b": two["word"].to_numpy(object), "b_n": two["n"].to_numpy(np.int64)})

    keys = ["key", "block", "slice"]
    left, right = left.select(*keys, "word", "n"), right.select(*keys, "word", "n")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a string, a_n long, b string, b_n long")


def group_variants(docs: DataFrame, groups: int = GROUPS, node: int = NODE, first: int = FIRST) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    words = stored(vocabulary(docs))
    pairs = near_pairs(words, groups, node, first)
    sides = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    near = pairs.select(sides.alias("_s")).select("_s.*")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left").withColumn("_n", -F.col("best.less"))
    taken = F.col("_n") >= 2 * F.col("n")
    known = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.near")).alias("form"), F.when(taken, F.col("_n")).alias("form_n")))
    return known.join(roots(known), "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(known: DataFrame) -> DataFrame:
    """word and root of the words with a form: the last of the forms that follow from it."""
    steps = known.where("form is not null").select("word", F.col("form").alias("root"))
    # Counts double along forms, so a chain has at most log2 of their range, and each round doubles its reach.
    ends = known.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    longest = max(1, int(ends["most"] // ends["least"]).bit_length()) if ends["most"] else 1
    reach = 1
    while reach < longest:
        steps = stored(steps)
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = steps.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        reach *= 2
    return steps


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    got = group_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("word", "form", "root", "n", "n_near", "form_n")
