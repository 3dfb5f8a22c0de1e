"""Greedy word-piece lengths against longest-first search."""

import base64
import random

import numpy as np
import public_tokenizers

from surgeflow.llm import wordpiece_count as W

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def lengths(a, words, first=0):
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words], np.int64)
    return a.lengths(data, np.cumsum(sizes) - sizes, sizes, first).tolist()


def test_small_vocabularies_with_unknown_words():
    rng = random.Random(4)
    for _ in range(60):
        def pieces(n):
            return {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(n)}
        initial, inner = pieces(rng.randint(1, 12)), pieces(rng.randint(1, 12))
        a = W.Automaton(initial, inner)
        words = [bytes(rng.choice(b"abcd" if rng.random() < 0.1 else b"abc") for _ in range(rng.randint(1, 14))) for _ in range(200)]
        assert lengths(a, words) == [W.brute_force(w, initial, inner) for w in words]


def test_long_words_step_on_their_own(monkeypatch):
    initial, inner = {b"a", b"ab", b"abab"}, {b"ba", b"bab", b"a", b"b"}
    a = W.Automaton(initial, inner)
    words = [b"ab" * k for k in (1, 3, 127, 128, 129, 4000)]
    assert lengths(a, words) == [W.brute_force(w, initial, inner) for w in words]


def test_documents_against_longest_first_search(docs, rows):
    with open(PATH, "rb") as f:
        vocabulary = [base64.b64decode(line.split()[0]) for line in f]
    initial, inner = {p for p in vocabulary if p[:1] == b" "}, {p for p in vocabulary if p[:1] != b" "}
    limit = max(map(len, vocabulary))

    def pieces(word):
        at, n, known, word = 0, 0, initial, b" " + word
        while at < len(word):
            at += next(k for k in range(min(limit, len(word) - at), 0, -1) if word[at:at + k] in known)
            n, known = n + 1, inner
        return n

    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in W.count_tokens(docs, PATH).collect()}
    for d, text, *_ in rows:
        words = (text or "").encode().split()
        assert got[d] == (len(words), sum(map(pieces, words)), 0), d


def test_odd_and_empty(odd, nothing):
    got = W.count_tokens(odd, PATH).collect()
    assert len(got) == odd.count() and sorted(r.n_words for r in got) == [0, 0, 0, 3, 3, 3]
    assert W.count_tokens(nothing, PATH).collect() == []
