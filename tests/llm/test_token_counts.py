import random

from rosterlake.llm.token_counts import LongestMatch, token_counts
from rosterlake.llm.words import pieces_of_vocabulary, split_words, vocabulary_path


def greedy(word, tokens, longest):
    symbols = list(word)
    symbols[-1] += 256
    at = count = 0
    while at < len(symbols):
        size = next(n for n in range(min(longest, len(symbols) - at), 0, -1) if tuple(symbols[at : at + n]) in tokens)
        at, count = at + size, count + 1
    return count


def test_automaton_equals_greedy_search():
    tokens = set(pieces_of_vocabulary(vocabulary_path()))
    longest = max(map(len, tokens))
    random.seed(5)
    words = [bytes(random.choice(b"abcdethinorsl\xc3\xa9!") for _ in range(random.randint(1, 14))) for _ in range(2000)]
    assert LongestMatch(list(tokens)).count(words).tolist() == [greedy(w, tokens, longest) for w in words]


def test_small_vocabulary_with_failures():
    single = [(s,) for s in range(512)]
    extra = [tuple(b"abcd"), tuple(b"bc"), (98, 99, 100, 101 + 256)]
    automaton = LongestMatch(single + extra)
    tokens = set(single + extra)
    for word in (b"abce", b"abcd", b"abcde", b"aabcdbcde", b"bcde", b"b"):
        assert automaton.count([word])[0] == greedy(word, tokens, 4)


def test_counts_of_documents(spark, documents):
    tokens = set(pieces_of_vocabulary(vocabulary_path()))
    longest = max(map(len, tokens))
    rows = documents.limit(25).collect()
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts(documents).collect()}
    for row in rows:
        words = [w.encode() for w in split_words(row.text.lower())]
        assert got[row.doc_id] == (len(words), sum(greedy(w, tokens, longest) for w in words))


def test_awkward_rows(spark, awkward, nothing):
    found = token_counts(awkward)
    assert found.count() == awkward.count() and token_counts(nothing).count() == 0
    rows = {(r.doc_id, r.n_words): r.n_tokens for r in found.collect()}
    assert rows[(1, 0)] == rows[(2, 0)] == rows[(3, 0)] == 0
    text = awkward.filter("doc_id = 5").first().text
    n_words = len(split_words(text))
    assert rows[(5, n_words)] >= n_words > 100_000
