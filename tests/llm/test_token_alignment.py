"""Alignment of two tokenizers against a plain version that walks over token bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pairloom.llm import token_alignment
from pairloom.llm.bpe import byte_names
from pairloom.llm.queries import PIECES, QUERIES, VOCABULARY

from llm.llm_cases import SF, docs_of

NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    names = byte_names()

    def of_a(text):
        return [(i, bytes(names[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def of_b(text):
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        return [(i, bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]

    return of_a, of_b


def plain(sides, texts):
    """Per text: n_a .. count_sum and the groups."""
    rows, all_links = [], []
    for text in texts:
        tokens = [side(text) for side in sides] if text else [[], []]
        if any(b"".join(t for _, t in side) != (" " + text).encode() for side in tokens if text):
            tokens = [[], []]
        owner = [[k for k, (_, t) in enumerate(side) for _ in t] for side in tokens]  # of every byte
        links = sorted(set(zip(*owner)))
        groups, group, at = [], ([], []), [0, 0]
        for n in range(len(owner[0])):
            ends = [n + 1 == len(o) or o[n + 1] != o[n] for o in owner]
            for side, end in enumerate(ends):
                if end:
                    group[side].append(str(tokens[side][owner[side][n]][0]))
            if all(ends):
                groups.append("|".join(map(",".join, group)))
                group = ([], [])
        rows.append([len(tokens[0]), len(tokens[1]), len(groups), len(links), ";".join(groups)])
        all_links.append([(tokens[0][i][0], tokens[1][j][0]) for i, j in links])
    counts = Counter(p for links in all_links for p in links)
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(highest.get(j, 0), n)
    return [(*r[:4], sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), r[4])
            for r, links in zip(rows, all_links)]


def check_query(spark, sides, sf_dir):
    docs = docs_of(sf_dir)
    got = [(r.doc_id, *[r[c] for c in NUMBERS], r.groups_sha256) for r in QUERIES["op11_token_alignment"](spark, sf_dir).collect()]
    want = [(doc, *r[:6], hashlib.sha256(r[6].encode()).hexdigest() if r[6] else "")
            for (doc, _), r in zip(docs, plain(sides, [t for _, t in docs]))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_given_documents(spark, sides):
    check_query(spark, sides, SF)


def test_hard_documents(spark, sides, hard_dir):
    check_query(spark, sides, hard_dir)


def test_small_slices_and_blocks(spark, sides, monkeypatch):
    """Documents in many slices and blocks, null and repeated ids, clashing columns, groups as text."""
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 150)
    rnd = random.Random(7)
    bits = ["hello", " World", "  ", "\t", "\n\n", "naïve", "日本語", "▁", "<|endoftext|>", "</s>", "12345", "don't", " ", "ﬁ", "é", "x" * 60]
    texts = [None, "", " ", "  ", "\n", "\x00", *["".join(rnd.choices(bits, k=rnd.randint(1, 25))) for _ in range(150)]]
    ids = [str(i) if i % 9 else None for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in zip(ids, texts)], "id string, body string, doc int, pairs string").coalesce(2)
    got = token_alignment.align_tokens(df, "id", "body", public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES), block_bytes=700)
    assert got.columns == ["id", *NUMBERS, "groups"]
    want = [(i, *r) for i, r in zip(ids, plain(sides, texts))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(r[1] == 0 and t for r, t in zip(want, texts)) and any(r[1] for r in want)


def test_long_text_without_spaces(spark, sides):
    texts = ["ab1" * 3000, "é" * 5000, "日本" * 2500, "word " * 4000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    got = token_alignment.align_tokens(df, "id", "body", public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))
    assert sorted(map(tuple, got.collect())) == [(i, *r) for i, r in enumerate(plain(sides, texts))]
