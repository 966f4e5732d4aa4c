"""Collocations, token counts and periodic runs against plain restatements."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from urllib.parse import urlparse
from urllib.request import url2pathname
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from limnos.llm import collocations, repetitions, token_counts
from limnos.llm.queries import TOKENIZER
from limnos.llm.shared import saved

ALL = ["documents", "edges", "nothing"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def name(lang):
    return "und" if lang is None else lang


def plain_collocations(rows, longest, least, top, percent=50):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[name(lang)] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[name(lang), tuple(words[i : i + k])] += 1
    counts = {p: f for p, f in counts.items() if f >= least}
    found = {}
    for (lang, p), a in counts.items():
        if len(p) < 2:
            continue
        around = [f for (other, q), f in counts.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * f >= percent * a for f in around):
            continue
        score, _, left, right = min((1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for lang, ps in found.items() for i, (s, a, p, left, right) in enumerate(sorted(ps)[:top]))


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 2, 50), (2, 3, 2000), (4, 2, 2000)])
def test_collocations_on_small_texts(spark, longest, least, top):
    rng = random.Random(longest)
    rows = [(rng.choice(["en", "de", None, ""]), "".join(rng.choice("AaBbcé") + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "!x", "-"]) for _ in range(rng.randrange(60)))) for _ in range(60)]
    rows += [("en", None), ("en", ""), (None, None), ("en", "a b c")] + [("fr", "one two three one two")] * 20
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = [tuple(r) for r in collocations.collocations(docs, longest, least, top, block_words=40).collect()]
    assert sorted(got) == plain_collocations(rows, longest, least, top)
    assert got


@pytest.mark.parametrize("which", ["edges", "nothing"])
def test_collocations_of_edge_rows(request, which):
    docs = request.getfixturevalue(which)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=2).collect())
    assert got == plain_collocations([(r.lang, r.text) for r in docs.collect()], 3, 2, 2000)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_019
    one = spark.createDataFrame([("en", "a", big), ("en", "b", big + 2)], "lang string, phrase string, f bigint")
    two = spark.createDataFrame([("en", "a b", big - 1)], "lang string, phrase string, f bigint")
    row = collocations._scored([one, two], 2).first()
    assert (row.l, row.r, row.score) == (big, big + 2, 1000000 * (big - 1) ** 2 // (big * (big + 2)))


def test_a_task_meets_few_blocks(spark):
    relation = spark.createDataFrame([(b, "en", ["a", "b"], [2, 1], [0, 1, 0, -1]) for b in range(64)], collocations.WORDS)
    words = spark.createDataFrame([("en", "a", 128, 0), ("en", "b", 64, 1)], "lang string, phrase string, f bigint, id int")
    pairs = collocations.word_pairs(relation, words).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.block for r in pairs) == list(range(64))
    assert all(r.counts == [1, 1] for r in pairs)
    assert max(Counter(r.task for r in pairs).values()) <= 5 * collocations.TASK_BLOCKS


def test_files_of_blocks_have_small_row_groups(spark):
    """However many blocks a task writes: each row here holds 2 MB that do not compress."""
    wide = spark.range(0, 40, 1, 1).select("id", F.transform(F.sequence(F.lit(1), F.lit(250_000)), lambda i: F.xxhash64("id", i)).alias("places"))
    files = [url2pathname(urlparse(f).path) for f in saved(wide, "blocks", **collocations.BLOCK_FILES).inputFiles()]
    groups = [meta.row_group(i) for meta in map(pq.read_metadata, files) for i in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 40
    assert max(g.num_rows for g in groups) <= 6


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def whole():
    return token_counts.whole_tokens(TOKENIZER)


@pytest.fixture(scope="module")
def counter(whole):
    return token_counts.TokenCounter(TOKENIZER, whole)


def test_whole_tokens_are_merged_to_one(library, whole):
    assert len(whole) > 49_000 and "<|endoftext|>" not in whole
    assert all(len(library.model.tokenize(letters)) == 1 for letters in whole)


@settings(max_examples=500, deadline=None)
@given(text=st.one_of(st.text(), st.text(st.sampled_from(" \n\t\r\x1c\x1f\x85\xa0 　​'sdrelm aA1²٣é中😀,.!")),
                      st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "the", "don't", "<|endoftext", "x\n", "\ny", "é."])).map("".join)))
def test_counts_are_the_librarys(counter, library, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_memory_is_bounded(whole, library, monkeypatch):
    monkeypatch.setattr(token_counts, "GENERATION", 3)
    small = token_counts.TokenCounter(TOKENIZER, whole)
    for text in ["unheardof wordings here", "and more of unheardof wordings", "a b c d e f g", "unheardof b"] * 3:
        assert small.count(text) == len(library.encode(text, add_special_tokens=False).ids)
        assert len(small.after_blank) <= 3 + len(text.split()) and len(small.pieces) <= 3 + len(text.split())


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.whole_tokens(TOKENIZER.replace("byte_bpe_50k", "word_bpe_49k"))


@pytest.mark.parametrize("which", ALL)
def test_token_counts_of_whole_texts(request, which, library):
    docs = request.getfixturevalue(which)
    want = []
    for r in docs.select("doc_id", "text").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((str(r.doc_id), len((r.text or "").encode()), n, n > 1024))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, TOKENIZER).collect()) == sorted(want)


def plain_runs(words):
    found, codes = {}, np.unique(words, return_inverse=True)[1] if words else []
    for q in range(1, len(words) // 4 + 1):
        edges = np.diff(np.concatenate([[0], codes[:-q] == codes[q:], [0]]))
        for start, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            if end - start + q >= max(6, 4 * q):
                found.setdefault((start, end - start + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


WORDS = st.one_of(
    st.lists(st.sampled_from("ab"), max_size=70), st.lists(st.sampled_from("abc"), max_size=70),
    st.tuples(st.lists(st.sampled_from("abc"), max_size=8), st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 12), st.lists(st.sampled_from("abc"), max_size=8))
    .map(lambda t: [*t[0], *(t[1] * t[2]), *t[3]]))


@settings(max_examples=400, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=5))
def test_runs_of_small_texts(texts):
    assert repetitions.runs_of(texts) == [plain_runs(words) for words in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=120), st.data())
def test_grammar_gives_the_agreement_of_places(words, data):
    sequence = np.array([*words, 9])
    grammar = repetitions.Grammar(sequence)
    x, y = data.draw(st.lists(st.integers(0, len(words)), min_size=2, max_size=2, unique=True))
    onward = next(k for k in range(len(sequence) + 1) if max(x, y) + k >= len(sequence) or sequence[x + k] != sequence[y + k])
    before = next(k for k in range(len(sequence) + 1) if min(x, y) - k <= 0 or sequence[x - k - 1] != sequence[y - k - 1])
    assert grammar.agreement(np.array([x]), np.array([y])).tolist() == [onward]
    assert grammar.agreement_before(np.array([x]), np.array([y])).tolist() == [before]


def test_long_texts_of_one_word_and_of_hard_words():
    fibonacci, shorter = ["a"], ["b"]
    while len(fibonacci) < 30_000:
        fibonacci, shorter = fibonacci + shorter, fibonacci
    assert repetitions.runs_of([["w"] * 200_000, fibonacci, ["x", "y", "z"] * 20_000]) == [[(0, 200_000, 1)], [], [(0, 60_000, 3)]]


def planted(doc_id, words):
    h = None if doc_id is None else crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("which", [*ALL, "more"])
def test_runs_of_whole_texts(spark, request, which):
    if which == "more":  # enough ids for planted runs of empty and null texts too
        rng = random.Random(5)
        docs = spark.createDataFrame([(i, rng.choice([None, "", " ", "one", "a b", *["".join(rng.choice("ab") + rng.choice("  \t\n\x0b") for _ in range(80))] * 4])) for i in range(400)], "doc_id bigint, text string")
    else:
        docs = request.getfixturevalue(which)
    want = []
    for r in docs.select("doc_id", "text").collect():
        words = planted(r.doc_id, [w for w in re.split("[ \t-\r]", r.text or "") if w])
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((str(r.doc_id), len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    got = repetitions.digest(repetitions.periodic_runs(repetitions.with_planted_runs(docs))).collect()
    assert sorted(((str(r.doc_id), *r[1:]) for r in got), key=repr) == sorted(want, key=repr)
    if which == "more":
        assert sum(r.n_runs > 0 for r in got) > 20
