"""Groups and counts against aligning each text with both public tokenizers and counting pairs in one place."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sediment.llm import token_alignment as alignment
from sediment.llm.queries import QUERIES

SCHEMA = "doc_id int, text string, block string, pair string, `a.b` int"
PARTS = [
    "a", "B", " ", "  ", "\n", "\t", "'s", "’", "é", "ß", "漢字", "😀", "▁", "\x00", "\x0b", "\xa0", "　", "12", "²",
    "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\r\n", "́", "!", "...", " x", " the", " zzz", "aaaa",
]


@pytest.fixture(scope="module")
def plainly():
    """Groups of a text, as lists of ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    both = alignment.vocabularies()

    def ends(ids, pieces):
        return np.cumsum([len(pieces[k]) for k in ids]).tolist()

    def groups(text):
        if not text:
            return []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        whole = (" " + text).encode()
        for ids, pieces in ((a, both.first_pieces), (b, both.second_pieces)):
            if b"".join(pieces[k] for k in ids) != whole:
                return []
        ends_a, ends_b = ends(a, both.first_pieces), ends(b, both.second_pieces)
        out, low = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            out.append(
                ([k for k, e in zip(a, ends_a, strict=True) if low < e <= cut], [k for k, e in zip(b, ends_b, strict=True) if low < e <= cut])
            )
            low = cut
        return out

    return groups


def written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def numbers(texts, plainly):
    """n_a, n_b, n_groups, n_links, n_best, count_sum and text of each."""
    all_groups = [plainly(text) for text in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in all_groups]
    count = Counter(pair for own in links for pair in own)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [
        (
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            sum(own.values()),
            sum(n for pair, n in own.items() if count[pair] == most[pair[0]]),
            sum(n * count[pair] for pair, n in own.items()),
            written(groups),
        )
        for groups, own in zip(all_groups, links, strict=True)
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def test_groups_of_any_text(plainly):
    draw = random.Random(11)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(25))) for _ in range(1500)]
    texts += ["a" * 700, "é" * 700, " " * 700, "ab " * 300, None, ""]
    found = alignment.align_texts([None if t is None else t.encode() for t in texts], alignment.vocabularies())
    assert found.written(alignment.vocabularies()).to_pylist() == [written(plainly(text)) for text in texts]


def test_cuts_are_the_shared_ends():
    draw = random.Random(5)
    for _ in range(300):
        last = draw.randrange(1, 200)
        ends = [sorted({*(draw.randrange(1, last + 1) for _ in range(draw.randrange(1, 60))), last}) for _ in range(2)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        roots = sorted({last, *draw.sample(shared, draw.randrange(len(shared) + 1))})
        sizes = alignment.leaf_groups(*map(np.array, ends), np.array(roots))
        for side, size in zip(ends, sizes, strict=True):
            assert [side[k - 1] for k in np.cumsum(size)] == shared


def test_large_groups_count_like_small_ones(monkeypatch):
    draw = np.random.default_rng(3)
    n = np.array([40, 30])
    found = alignment.Aligned(*(draw.integers(0, 6, 70) for _ in range(2)), n, n, n, n, np.array([1, 1]))

    def totals():
        out = Counter()
        for owner, pair, weight in zip(*(part.tolist() for part in found.links()), strict=True):
            out[owner, pair] += weight
        return out

    small, docs = totals(), [x.tolist() for x in found.distinct_pairs()]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 10)
    assert totals() == small and [x.tolist() for x in found.distinct_pairs()] == docs
    assert sum(small.values()) == 40 * 40 + 30 * 30 == found.n_links().sum()


def test_query_equals_counting_in_one_place(spark, sf_dir, tables, plainly):
    docs = tables("documents").collect()
    wanted = numbers([row["text"] for row in docs], plainly)
    found = {row["doc_id"]: row for row in QUERIES["op13_alignment"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for row, own in zip(docs, wanted, strict=True):
        digest = hashlib.sha256(own[-1].encode()).hexdigest() if own[0] else ""
        assert tuple(found[row["doc_id"]][name] for name in [*NAMES[:-1], "groups_sha256"]) == (*own[:-1], digest)


@pytest.mark.parametrize("block_bytes", [1, 300, 8 << 20])
def test_edges_in_blocks_of_any_size(spark, plainly, block_bytes):
    texts = [None, "", "a ▁ b", "the end", "the end", "x" * 3000, "the " * 2000, "été\nà la fin"]
    ids = [1, 2, None, 3, 3, 4, 5, None]
    frame = spark.createDataFrame([(k, t, "b", "p", 1) for k, t in zip(ids, texts, strict=True)], SCHEMA)
    found = alignment.link_counts(frame, block_bytes=block_bytes).collect()
    wanted = [(k, *own) for k, own in zip(ids, numbers(texts, plainly), strict=True)]
    assert sorted(((r["_id"], *(r[n] for n in NAMES)) for r in found), key=str) == sorted(wanted, key=str)
    plain = alignment.align(frame).collect()
    assert sorted((str(r["_id"]), r["n_links"], r["groups"]) for r in plain) == sorted((str(w[0]), w[4], w[7]) for w in wanted)


def test_tables_without_rows_or_tokens(spark):
    frame = spark.createDataFrame([(1, None, "b", "p", 1), (2, "", "b", "p", 1)], SCHEMA)
    assert alignment.link_counts(frame.limit(0)).collect() == [] == alignment.align(frame.limit(0)).collect()
    rows = alignment.link_counts(frame).collect()
    assert sorted((r["_id"], r["n_a"], r["n_best"], r["count_sum"], r["groups"]) for r in rows) == [(1, 0, 0, 0, ""), (2, 0, 0, 0, "")]


def test_blocks_are_dealt_and_tokenised_once(spark, sf_dir):
    frame = QUERIES["op13_alignment"](spark, sf_dir)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2
