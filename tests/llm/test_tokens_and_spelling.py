"""Token counts, spelling variants and tokenizer alignment against brute force on small and odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from panelmill.llm import alignment, spelling, token_counts

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n long, word string, pair long, container long, row long"
WORDS = "colour color colours colors centre center centres theatre theater grey-green été étés naïve harbour harbor".split()
ODD = [
    None, "", " \n\t ", "a", "one  two   three ", " lead", "x\r\ny);\r\nz", "tab\t\tend\r", "nb\xa0\xa0 sp  x \x85 y", "\x1c\x1d a\x00b",
    "<|startoftext|>hi<|endoftext|> </s><s>[INST] <|ENDOFTEXT|> <unk>", "1234 5,678.90 don't we'LL I'm", "日本語テキスト 한국어 \U0001f600\U0001f600 é İ",
    "meta▁sign and plain", "x" * 5000, "ab" * 3000 + " " + "9" * 700, "!?" * 900, "▁", "  ", "\n\n\n", "à́ ̈́ ẞ ﬁ",
]


def texts(seed=1, n=120):
    r = random.Random(seed)
    blank = lambda: r.choice([" "] * 9 + ["  ", "\n", "\t", "\r\n", "\xa0", ", "])
    made = ["".join(r.choice(WORDS) + r.choice(["", "", "", "s", "x", "'s", "7"]) + blank() for _ in range(r.randint(1, 60))) for _ in range(n)]
    return [*ODD, *made, *made[:10]]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, columns with clashing names."""
    rows = [(None if k == 30 else k // 2, t, 5, "clash", 1, 2, 3) for k, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_token_counts_equal_the_library(spark, docs, none):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    count = lambda t: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
    for frame in (docs, spark.read.parquet(f"{SMALL}/documents.parquet")):
        want = sorted((str(r.doc_id), *count(r.text)) for r in frame.collect())
        for hot in (1, 40, 1 << 15):
            got = token_counts.count_tokens(frame, hot=hot)
            assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
            assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert token_counts.count_tokens(none).collect() == []


def test_token_counts_of_the_query(spark):
    got = token_counts.op11_token_counts(spark, SMALL, limit=500)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    rows = got.collect()
    assert any(r.over_limit for r in rows) and all(r.over_limit == (r.n_tokens > 500) for r in rows)


def test_long_words_are_counted_and_aligned(spark):
    frame = spark.createDataFrame([(1, "ab1" * 70_000), (2, "x" * 200_000 + " y")], "doc_id long, text string")
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame).collect()}
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in frame.collect()}
    assert digests(alignment.align(frame)) == aligned_by_brute_force([(r.doc_id, r.text) for r in frame.collect()])


def aligned_by_brute_force(rows):
    a_model = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    signs = alignment.byte_of_sign()

    def one(text):
        if not text:
            return None
        a, b = a_model.encode(f" {text}", add_special_tokens=False), b_model.encode(text)
        piece = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
        raw_a, raw_b = [bytes(signs[c] for c in t) for t in a.tokens], [piece(i) for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == f" {text}".encode():
            return None
        ends = lambda raw: np.cumsum([len(x) for x in raw]).tolist()
        ends_a, ends_b = ends(raw_a), ends(raw_b)
        both = sorted(set(ends_a) & set(ends_b))
        groups, i, j, ids = [], 0, 0, a.ids
        for end in both:
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((ids[i:x], b[j:y]))
            i, j = x, y
        return len(ids), len(b), groups

    made = [(i, one(t)) for i, t in rows]
    links = Counter((g[0][-1], g[1][-1]) for _, x in made if x for g in x[2])
    most = defaultdict(int)
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    out = []
    for i, x in made:
        if x is None:
            out.append((str(i), 0, 0, 0, 0, 0, 0, ""))
            continue
        own = [(g[0][-1], g[1][-1]) for g in x[2]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in x[2])
        best, total = sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own)
        out.append((str(i), x[0], x[1], len(own), len(own), best, total, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def digests(frame):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r.doc_id), *[r[c] for c in columns]) for r in frame.collect())


def test_alignment_by_brute_force(spark, docs, none, monkeypatch):
    for frame in (docs, spark.read.parquet(f"{SMALL}/documents.parquet")):
        assert digests(alignment.align(frame)) == aligned_by_brute_force([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])
    assert alignment.align(none).collect() == []
    assert any(r[1] == 0 and r[7] == "" for r in digests(alignment.align(docs)))


def test_pair_counts(spark):
    """Documents and links of pairs, some in most documents and often in one."""
    r = random.Random(3)
    rows = [(i, " ".join(["the"] * r.randint(0, 9) + ["of"] * (i % 2) + [f"w{i}"])) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    indexed = alignment.index(frame)
    assert indexed.where("dense").count() > 0 and indexed.where("plane > 2").count() > 0
    got = alignment.split_pair(alignment.pair_counts(indexed), 32000).collect()
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {b_model.id_to_piece(x.b_id): (x.n_docs, x.n_links) for x in got}
    assert found["▁the"] == (sum("the" in t for _, t in rows), sum(t.split().count("the") for _, t in rows))
    assert found["▁of"] == (750, 750)


def test_bitmaps_give_their_links_back():
    r = np.random.default_rng(1)
    links, slots = r.integers(0, 6, 30_000), np.minimum(r.geometric(0.002, 30_000), alignment.DOCS - 1)
    want = Counter(zip(links.tolist(), slots.tolist(), strict=True))
    got = Counter()
    for plane, pair, dense, bits in alignment.bitmaps(links, slots):
        place, size = alignment.places(bits, dense)
        for p, s in zip(np.repeat(pair, size).tolist(), place.tolist(), strict=True):
            got[p, s] += 1 if plane == 0 else 1 << (plane - 1)
    assert got == want
    assert list(alignment.bitmaps(np.empty(0, np.int64), np.empty(0, np.int64))) == []


def variants_by_brute_force(rows, least=3):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 5 and c >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    sides = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in sides.items() if v}
    form = {w: f for w, f in best.items() if n[f] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(sides[w]), n.get(form.get(w))) for w in n)


def variants(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def words_of(seed, n):
    """Texts of words over few letters, so that many are near and many share their letters."""
    r = random.Random(seed)
    pool = ["".join(r.choice("abé") for _ in range(r.randint(4, 7))) for _ in range(150)] + ["z" * 40, "z" * 41, "y" + "z" * 40, "×÷ABC"]
    chain = ["bbbbb"] * 400 + ["bbbbc"] * 150 + ["bbbcc"] * 60
    draw = lambda: pool[min(int(r.expovariate(0.015)), len(pool) - 1)]
    return [" ".join(chain), *(" ".join(draw() for _ in range(r.randint(0, 50))) for _ in range(n))]


def test_variants_by_brute_force(spark, none):
    rows = [(k // 2 if k else None, t) for k, t in enumerate([None, "", "  ", "12", *words_of(5, 150)])]
    frame = spark.createDataFrame([(i, t, 5, "clash", 1, 2, 3) for i, t in rows], DOCS).repartition(4)
    want = variants_by_brute_force(rows)
    assert sum(w[1] is not None for w in want) > 8 and any(w[1] != w[2] and w[1] for w in want)
    assert variants(spelling.group_variants(frame)) == want
    # Nodes that are split, down to blocks of one node, and divided among many asking words.
    assert variants(spelling.group_variants(frame, groups=2, node=3, first=1)) == want
    assert variants(spelling.group_variants(frame, groups=6, node=5, first=2)) == want
    assert spelling.group_variants(none).collect() == []


def test_variants_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = spelling.op12_spelling(spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants(got) == variants_by_brute_force(rows)


def test_near_words():
    r = random.Random(9)
    for _ in range(3000):
        a, b = ("".join(r.choice("ab") for _ in range(r.randint(1, 6))) for _ in range(2))
        at = lambda x, y: any(y[:k] + y[k + 1 :] == x for k in range(len(y)))
        want = (len(a) == len(b) and a < b and sum(x != y for x, y in zip(a, b, strict=True)) == 1) or (len(b) == len(a) + 1 and at(a, b))
        assert spelling.is_near(a.encode(), b.encode()) == want
        if want:
            one, two = [a.encode()], [b.encode()]
            every = iter([(np.zeros(1, np.int64), np.zeros(1, np.int64))])
            assert len(spelling.verified(one, two, every)[0]) == 1
