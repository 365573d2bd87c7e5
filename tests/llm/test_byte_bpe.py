import base64
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanmill.llm import byte_bpe, token_histogram
from tests.llm.conftest import rows

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def known():
    import public_tokenizers

    content = byte_bpe._content(None)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return byte_bpe.Vocabulary(content), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(words, texts):
    raw = [t.encode() for t in texts]
    ids, at = words.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab cdest'''\n\t.,019éß漢 \U0001f600rvlm"), max_size=40), max_size=8))
def test_equal_to_the_library(known, texts):
    words, library = known
    assert encoded(words, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_runs_and_memory(known, monkeypatch):
    words, library = known
    monkeypatch.setattr(byte_bpe, "MEMORY_BYTES", 3)
    texts = ["a" * 20000, "ab" * 3000, " " * 4000 + "x", "<|endoftext|>", "one two three four five six", ""]
    assert encoded(words, texts) == [library.encode_ordinary(t) for t in texts]
    assert words.one_word(b"abababa") == library.encode_ordinary("abababa")


def test_documents(spark, edge, empty, known):
    _, library = known
    expected = sorted(
        (-1 if r[0] is None else r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())
        for r in rows()
        for ids in [library.encode_ordinary(r[1] or "")]
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digests(edge).collect())
    assert got == expected
    assert byte_bpe.digests(empty).count() == 0


def test_histogram(spark, edge, empty, known):
    _, library = known
    lengths = [len(library.encode_ordinary(r[1] or "")) for r in rows()]
    limits = token_histogram.context_limits(token_histogram.histogram(byte_bpe.encode(edge, with_ids=False)))
    found = {r.context_limit: r for r in limits.collect()}
    assert set(found) == set(lengths)
    for limit, r in found.items():
        assert r.docs_upto == sum(x <= limit for x in lengths) and r.docs_longer == sum(x > limit for x in lengths)
        assert r.tokens_truncated == sum(min(x, limit) for x in lengths) and r.tokens_lost == sum(max(0, x - limit) for x in lengths)
        assert r.tokens_upto == sum(x for x in lengths if x <= limit) and r.tokens_total == sum(lengths)
        assert r.permille == -(-1000 * r.docs_upto // len(lengths))
    asked = [0, 1, 5, 37, 4096, 10**9]
    told = {r.context_limit: (r.docs_upto, r.tokens_truncated) for r in token_histogram.at_limits(limits, asked).collect()}
    assert told == {a: (sum(x <= a for x in lengths), sum(min(x, a) for x in lengths)) for a in asked}
    assert token_histogram.context_limits(token_histogram.histogram(byte_bpe.encode(empty, with_ids=False))).count() == 0
