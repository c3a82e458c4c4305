"""Token counts of texts by their distinct pre-tokens (operator 11).

For a tokenizer that drops white space, pieces never reach across it, so a pre-token
here is a run without ASCII white space. (The tokenizer cuts some of them further; that
is left to the library.) Pieces are counted once for each distinct pre-token of the
corpus, on the cluster; a document is its pre-tokens' frequencies, and its count is the
sum of frequency times pieces. No document's ids are made.

The pieces of the most frequent pre-tokens, at most ``HOT`` of them, go to the tasks
that read documents, which add them up at once. All others leave a task as
(document, pre-token, frequency) and meet their counts in a join; none of those
stands for more than about one in ``HOT`` of all pre-tokens, so no key is hot.

Strings of special tokens inside texts count as one token, as in the library's
default; no begin, end or other tokens are added, nothing is cut off or padded.

Defined results: null and empty texts have no bytes and no tokens; equal texts have
equal counts; rows with equal ids stay separate rows; texts and words of any length
are counted whole; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import most_frequent, stored

HOT = 1 << 17
LIMIT = 2048
#: Distinct pre-tokens that a task holds before it passes their counts on.
HELD = 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=1)
def load(path: str):
    """The tokenizer of a file, one for each worker; one thread, as Spark has a task for each core."""
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = tokenizers.Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    added = made.get_added_tokens_decoder().values()
    if any(t.normalized or t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added):
        raise ValueError("special tokens that depend on what stands around them are not supported")
    ids = lambda text: made.encode(text, add_special_tokens=False).ids
    if ids("ab, c\n\t d") != [*ids("ab,"), *ids("c"), *ids("d")]:
        raise ValueError("tokenizers that keep white space are not supported")
    return made


def pretokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if isinstance(text, str) else []


def _texts(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    return docs.select(F.monotonically_increasing_id().alias("row"), doc_id, text)


def pretoken_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """pretoken, n and pieces: every distinct pre-token of all texts, how often it comes, and its number of pieces."""
    path = path or default_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def out() -> pd.DataFrame:
            found = pd.DataFrame({"pretoken": pd.Series([w.decode() for w in seen], dtype=object), "n": np.array(list(seen.values()), np.int64)})
            seen.clear()
            return found

        for batch in batches:
            for text in batch["text"]:
                seen.update(pretokens(text))
                if len(seen) > HELD:
                    yield out()
        yield out()

    @F.pandas_udf("int")
    def pieces(distinct: pd.Series) -> pd.Series:
        return pd.Series(list(map(len, load(path).encode_batch_fast(list(distinct), add_special_tokens=False))), dtype="int32")

    counted = _texts(docs).select("text").mapInPandas(run, "pretoken string, n long")
    counted = counted.groupBy("pretoken").agg(F.sum("n").alias("n"))
    return counted.withColumn("pieces", pieces("pretoken"))


def count_tokens(docs: DataFrame, path: str | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document."""
    distinct = stored(pretoken_pieces(docs, path))
    # At most ``hot`` pre-tokens go to the driver and on to the tasks.
    top = most_frequent(distinct, "n", hot).select("pretoken", "pieces").toPandas()
    sent = docs.sparkSession.sparkContext.broadcast({w.encode(): int(n) for w, n in zip(top["pretoken"], top["pieces"], strict=True)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                total, rare = 0, {}
                for word, n in Counter(pretokens(text)).items():
                    if word in known:
                        total += n * known[word]
                    else:
                        rare[word] = n
                size = len(text.encode("utf-8", "replace")) if isinstance(text, str) else 0
                out.append((size, total, [w.decode() for w in rare], list(rare.values())))
            made = pd.DataFrame(out, columns=["n_bytes", "known", "pretokens", "times"])
            made.insert(0, "row", batch["row"].to_numpy())
            made.insert(1, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield made

    schema = "row long, doc_id long, n_bytes long, known long, pretokens array<string>, times array<long>"
    rows = stored(_texts(docs).mapInPandas(run, schema))
    rare = rows.select("row", F.explode(F.arrays_zip("pretokens", "times")).alias("_p"))
    rare = rare.select("row", F.col("_p.pretokens").alias("pretoken"), F.col("_p.times").alias("times"))
    more = rare.join(distinct.select("pretoken", "pieces"), "pretoken").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
    n_tokens = (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    return rows.drop("pretokens", "times").join(more, "row", "left").select("doc_id", "n_bytes", n_tokens)


def op11_token_counts(spark, sf_dir: str, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
