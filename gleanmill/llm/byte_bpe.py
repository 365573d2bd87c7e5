"""Byte-level BPE encoding and decoding by corpus-level merge replay.

1. Every task splits its texts into words and gives the distinct words of each
   slice that are no tokens themselves, if several slices have them. Counted over
   all texts, the commonest of them, at most ``CORPUS_WORDS`` of at most
   ``WORD_BYTES`` bytes, are the words of the corpus.
2. The merges are replayed once over these words: an inverted index maps each
   mergeable pair to the positions where it stands, ranks are taken in ascending
   order, every position of the pair is merged at once, and only the pairs with
   the left and right neighbours are looked up again and filed under their ranks.
   The words are dealt to tasks by hash, each with its own part of the index.
3. Texts are encoded by looking their words up in the table, which is broadcast
   (its size is bounded by 1.). Words beyond it are replayed in the same way
   where they occur, all distinct ones of a slice together, and kept for the
   later rows of the task up to ``MEMORY_BYTES``; that bound changes no result,
   for a word's ids don't depend on other words.

``encode`` may also be called without the table (one pass over the texts), and
``digests`` encodes, decodes and hashes in one pass, so that ids stay in the task.

Defined results: null and empty texts have no ids; bytes that are not UTF-8 are
read as U+FFFD; special-token strings are ordinary text; repeated rows repeat
their result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import release, slices
from gleanmill.llm.shingles import spans_hashed
from gleanmill.session import table

#: Most words of the corpus table, and the longest; as ids and bytes it stays below some 15 MB.
CORPUS_WORDS = 100_000
WORD_BYTES = 64
#: Bytes of rarer words that a task remembers.
MEMORY_BYTES = 3 << 20
#: Bytes of text encoded at a time; the arrays take some forty times as much.
SLICE = 3 << 18
DEFAULT_RANKS = "byte_bpe_multi_50k.tiktoken"

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: Unicode White_Space.
SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


#: The split pattern that ``word_starts`` follows; any other goes through the regex library.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_pattern() -> str:
    """The split pattern of the installed vocabularies."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def default_path() -> str:
    """The installed rank file; other files are given by their path."""
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_RANKS)


def classes() -> np.ndarray:
    """Class of every code point: letter, number, white space, or anything else."""
    import regex

    of = np.zeros(0x110000, np.uint8)
    every = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype(np.uint32)
    text = every.tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, text):
            of[every[m.start() : m.end()]] = kind
    of[list(SPACES)] = SPACE
    return of


def word_starts(points: np.ndarray, docs: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Indices where the words of the split pattern start; ``docs`` has each text's first index.

    The pattern takes contractions, then runs of letters, of numbers and of
    other signs with one space before them, then white space up to the last
    sign before a word.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = of[points]
    first = np.zeros(n + 1, bool)
    first[docs] = True
    first[n] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    quote = np.flatnonzero((points == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    one = points[quote + 1]
    short = np.isin(one, [ord(c) for c in "stmd"])
    two = np.where((quote + 2 < n) & ~first[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for hits, size in ((quote[short], 2), (quote[long & ~short], 3)):
        for j in range(1, size):
            start[hits + j] = False
        after = hits[hits + size < n] + size
        start[after[(kind[after] == LETTER) & ~first[after]]] = True
    return np.flatnonzero(start)


def pattern_starts(raw: np.ndarray, offsets: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of the words that any split pattern gives, and of what lies between them, as (starts, is a word)."""
    import regex

    split, data = regex.compile(pattern), raw.tobytes()
    starts, words = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        at, done = a, 0
        text = data[a:b].decode("utf-8")
        for m in split.finditer(text):
            if m.end() == m.start():
                continue
            for part, word in ((text[done : m.start()], False), (m[0], True)):
                if part:
                    starts.append(at)
                    words.append(word)
                    at += len(part.encode())
            done = m.end()
        if at < b:
            starts.append(at)
            words.append(False)
    return np.array(starts, np.int64), np.array(words, bool)


def tokens_of(content: bytes) -> list[bytes]:
    """The token of each rank."""
    pairs = [line.split() for line in content.splitlines() if line.strip()]
    tokens = [b""] * (max(int(b) for _, b in pairs) + 1)
    for a, b in pairs:
        tokens[int(b)] = base64.b64decode(a)
    return tokens


def _steps(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of spans, one after the other."""
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - upto + sizes, sizes)


class Words:
    """Distinct words and their ids as flat arrays; a word is found by its hash and confirmed byte by byte."""

    def __init__(self, words: list[bytes], ids: np.ndarray, at: np.ndarray) -> None:
        self.data, self.ids, self.at = np.frombuffer(b"".join(words), np.uint8), ids.astype(np.int32), at.astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
        hashes = spans_hashed(self.data, self.offsets)
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.keys = hashes[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each word of a flat buffer, -1 for one that is not here."""
        if not len(self.keys):
            return np.full(len(starts), -1, np.int64)
        i = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        number = np.where(self.keys[i] == hashes, self.order[i], -1).astype(np.int64)
        number[(number >= 0) & (np.diff(self.offsets)[number] != sizes)] = -1
        there = np.flatnonzero((number >= 0) & (sizes > 0))
        if len(there):
            same = data[_steps(starts[there], sizes[there])] == self.data[_steps(self.offsets[number[there]], sizes[there])]
            number[there[~np.logical_and.reduceat(same, np.cumsum(sizes[there]) - sizes[there])]] = -1
        return number


class Vocabulary:
    """Ranks of a rank file, its pairs, and the words seen so far."""

    def __init__(self, content: bytes, pattern: str = SPLIT) -> None:
        self.pattern = pattern
        self.ranks = {token: rank for rank, token in enumerate(tokens_of(content)) if token}
        self.size = max(self.ranks.values()) + 1
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.single < 0).any():
            raise ValueError("a byte-level vocabulary needs all 256 single bytes")
        keys, values = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys, self.pair_ranks = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        self.of = classes()
        #: A word that is a token is that token.
        self.tokens = Words(list(self.ranks), np.array(list(self.ranks.values())), np.arange(len(self.ranks) + 1))
        self.drop()

    def forget(self) -> None:
        """Keep no words but the tokens and those of the corpus table."""
        self.recent: list[Words] = []
        self.held = 0

    def drop(self) -> None:
        """Keep only the tokens: an idle worker needs no words."""
        self.known = [self.tokens]
        self.forget()

    def take(self, words: list[bytes], ids: np.ndarray, at: np.ndarray) -> None:
        """Use a corpus table: distinct words, their ids and where each word's ids begin."""
        self.known = [self.tokens, Words(words, ids, at)]
        self.forget()

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it can't merge."""
        key = left * self.size + right
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[i] == key, self.pair_ranks[i], -1)

    def one_word(self, word: bytes) -> list[int]:
        """The ids of one word by its own heap of (rank, position)."""
        ids, n = [int(self.single[b]) for b in word], len(word)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        spans = [word[i : i + 1] for i in range(n)]
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] < 0 or j >= n or self.ranks.get(spans[i] + spans[j]) != rank:
                continue
            spans[i], ids[i], ids[j], nxt[i] = spans[i] + spans[j], rank, -1, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := self.ranks.get(spans[i] + spans[nxt[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if prv[i] >= 0 and (r := self.ranks.get(spans[prv[i]] + spans[i])) is not None:
                heapq.heappush(heap, (r, prv[i]))
        return [x for x in ids if x >= 0]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of distinct words that are no tokens themselves, by merge replay."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        symbol = self.single[np.frombuffer(b"".join(words), np.uint8)]
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends - 1] = -1
        prv[ends - sizes] = -1
        rank = np.full(n, -1, np.int64)
        open_ = np.flatnonzero(nxt >= 0)
        rank[open_] = self.pair(symbol[open_], symbol[nxt[open_]])
        mark = np.zeros(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(at: np.ndarray) -> None:
            """File positions under the rank of the pair that starts there."""
            at = at[rank[at] >= 0]
            if not len(at):
                return
            at = at[np.argsort(rank[at], kind="stable")]
            ranks = rank[at]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        file(open_)
        odd: set[int] = set()
        while heap:
            r = heapq.heappop(heap)
            filed = index.pop(r)
            at = np.unique(np.concatenate(filed)) if len(filed) > 1 else filed[0]
            at = at[rank[at] == r]
            if not len(at):
                continue
            right = nxt[at]
            mark[at] = True
            clash = mark[right].any()
            mark[at] = False
            if clash:  # of places that share a symbol the left one is merged
                taken, chosen = set(), []
                for p, q in zip(at.tolist(), right.tolist(), strict=True):
                    if p not in taken:
                        taken.add(q)
                        chosen.append(p)
                at = np.array(chosen)
                right = nxt[at]
            after = nxt[right]
            symbol[at] = r
            symbol[right] = -1
            rank[right] = -1
            nxt[at] = after
            has = after >= 0
            prv[after[has]] = at[has]
            rank[at[~has]] = -1
            before = prv[at]
            touched = np.concatenate([at[has], before[before >= 0]])
            if len(touched):
                rank[touched] = self.pair(symbol[touched], symbol[nxt[touched]])
                lower = touched[(rank[touched] >= 0) & (rank[touched] < r)]
                if len(lower):  # its place in the order has passed: such words are done again on their own
                    odd.update(np.searchsorted(ends, lower, "right").tolist())
                file(touched)
        alive = symbol >= 0
        counts = np.add.reduceat(alive, ends - sizes)
        ids = symbol[alive]
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for w in odd:
                parts[w] = np.array(self.one_word(words[w]), np.int64)
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def learn(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of distinct words; those never met are replayed together and kept."""
        data, offsets = _flat(words)
        starts, sizes, hashes = offsets[:-1], np.diff(offsets), spans_hashed(data, offsets)
        if self.held > MEMORY_BYTES:
            self.forget()
        open_ = np.arange(len(words))
        counts = np.zeros(len(words), np.int64)
        pieces: list[tuple[np.ndarray, np.ndarray]] = []

        def put(at: np.ndarray, found: Words, number: np.ndarray) -> None:
            counts[at] = np.diff(found.at)[number]
            pieces.append((at, found.ids[_steps(found.at[number], counts[at])]))

        for held in (*self.known, *self.recent):
            number = held.find(data, starts[open_], sizes[open_], hashes[open_])
            there = number >= 0
            put(open_[there], held, number[there])
            open_ = open_[~there]
        if len(open_):
            fresh = words.take(pa.array(open_)).to_pylist()
            new = Words(fresh, *self.replay(fresh))
            self.recent.append(new)
            self.held += sum(map(len, fresh))
            put(open_, new, np.arange(len(open_)))
        at = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(at[-1], np.int32)
        for words_at, part in pieces:
            ids[_steps(at[words_at], counts[words_at])] = part
        return ids, at

    def split(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray | None, np.ndarray]:
        """The words of the texts in a flat UTF-8 buffer, dictionary encoded, and each text's first word; null is no word."""
        if self.pattern == SPLIT:
            points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            byte = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
            docs = np.searchsorted(byte, offsets)
            found = word_starts(points, docs[docs < len(points)], self.of)
            starts, words, first = byte[found], None, np.searchsorted(found, docs)
        else:
            starts, words = pattern_starts(raw, offsets, self.pattern)
            first = np.searchsorted(starts, offsets)
        if not len(starts):
            return None, first
        bounds = np.append(starts, len(raw)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
        if words is not None and not words.all():
            column = pa.compute.if_else(pa.array(words), column, pa.nulls(len(column), pa.large_binary()))
        return column.dictionary_encode(), first

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts in a flat UTF-8 buffer."""
        coded, first = self.split(raw, offsets)
        if coded is None:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        indices = coded.indices
        there = None
        if indices.null_count:
            there = ~np.asarray(indices.is_null())
            indices = indices.fill_null(0)
        ids, begin = self.learn(coded.dictionary)
        number = indices.to_numpy()
        size = np.diff(begin)[number]
        if there is not None:
            size = size * there
        upto = np.concatenate([[0], np.cumsum(size)])
        return ids[_steps(begin[number], size)], upto[first]

    def no_tokens(self, raw: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The distinct words of the texts that must be merged."""
        coded, _ = self.split(raw, offsets)
        if coded is None:
            return []
        data, offsets = _flat(coded.dictionary)
        number = self.tokens.find(data, offsets[:-1], np.diff(offsets), spans_hashed(data, offsets))
        return coded.dictionary.filter(pa.array(number < 0)).to_pylist()


def _flat(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of words without nulls."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(content: bytes, pattern: str = SPLIT) -> Vocabulary:
    """The vocabulary of a rank file's content, read once in a Python worker."""
    key = hashlib.sha256(content).hexdigest(), pattern
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(content, pattern)
    return _LOADED[key]


def _content(path: str | None) -> bytes:
    with open(path or default_path(), "rb") as f:
        return f.read()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def corpus_words(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> pa.Table:
    """(word, ids) of the commonest words of ``docs`` that are no tokens, by replaying all merges over them.

    What comes back is bounded by ``CORPUS_WORDS`` and ``WORD_BYTES``, whatever the corpus.
    """
    spark, pattern = docs.sparkSession, pattern or default_pattern()
    content = spark.sparkContext.broadcast(_content(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(content.value, pattern)
        held: Counter[bytes] = Counter()
        size = 0
        for _, raw, offsets in slices(batches, "text", SLICE):
            found = [w for w in words.no_tokens(raw, offsets) if w and len(w) <= WORD_BYTES]
            size += sum(len(w) for w in found if w not in held)
            held.update(found)
            if size > MEMORY_BYTES:
                yield told(held)
                held, size = Counter(), 0
        yield told(held)
        held = Counter()
        release()

    def told(held: Counter[bytes]) -> pa.RecordBatch:
        """Words that were met in several slices; others are not common."""
        often = {w: n for w, n in held.items() if n > 1}
        return pa.RecordBatch.from_arrays([pa.array(often, pa.binary()), pa.array(often.values(), pa.int64())], ["word", "n"])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [w for batch in batches for w in batch.column(0).to_pylist()]
        if found:
            ids, at = vocabulary(content.value, pattern).replay(found)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(np.split(ids.astype(np.int32), at[1:-1]), pa.list_(pa.int32()))], ["word", "ids"])

    counted = _texts(docs).select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    common = counted.orderBy(F.col("n").desc(), "word").limit(CORPUS_WORDS).select("word")
    tasks = min(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return common.repartition(tasks, "word").mapInArrow(replay, "word binary, ids array<int>").toArrow()


class _Shipped:
    """A vocabulary and a corpus table for the tasks."""

    def __init__(self, docs: DataFrame, path: str | None, pattern: str | None, words: pa.Table | None) -> None:
        context = docs.sparkSession.sparkContext
        self.pattern = pattern or default_pattern()
        self.content = context.broadcast(_content(path))
        self.words = None
        if words is not None and words.num_rows:
            table = words.combine_chunks()
            lists = table.column("ids").chunk(0)
            self.words = context.broadcast((table.column("word").to_pylist(), lists.values.to_numpy(), lists.offsets.to_numpy()))

    def load(self) -> Vocabulary:
        found = vocabulary(self.content.value, self.pattern)
        if self.words is not None:
            found.take(*self.words.value)
        else:
            found.drop()
        return found


def encode(docs: DataFrame, path: str | None = None, with_ids: bool = True, pattern: str | None = None, words: pa.Table | None = None) -> DataFrame:
    """doc_id, n_tokens and, unless left out, ids: little-endian unsigned 32-bit integers as binary.

    The rank file (under a megabyte, whatever the documents) is read by the
    driver from ``path`` and broadcast, as is ``words``, the table of ``corpus_words``.
    """
    shipped = _Shipped(docs, path, pattern, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shipped.load()
        for rows, raw, offsets in slices(batches, "text", SLICE):
            ids, at = found.encode(raw, offsets)
            columns = [rows.column(0), pa.array(np.diff(at), pa.int64())]
            if with_ids:
                packed = ids.astype("<u4")
                columns.append(pa.array([packed[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"][: len(columns)])
        found.drop()
        release()

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long" + ", ids binary" * with_ids)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the bytes that the ids stand for, as binary column decoded."""
    content = encoded.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens_of(content.value).__getitem__
        for rows, raw, offsets in slices(batches, "ids", SLICE, binary=True):
            ids, at = raw.view("<u4").tolist(), (offsets // 4).tolist()
            texts = [b"".join(map(token, ids[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes; ids and bytes stay in their task."""
    shipped = _Shipped(docs, path, pattern, corpus_words(docs, path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shipped.load()
        token = tokens_of(shipped.content.value).__getitem__
        for rows, raw, offsets in slices(batches, "text", SLICE):
            ids, at = found.encode(raw, offsets)
            packed, n = ids.astype("<u4"), np.diff(at)
            every, edges = ids.tolist(), at.tolist()
            told = [[], []]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                told[0].append(hashlib.sha256(packed[a:b]).hexdigest())
                told[1].append(hashlib.sha256(b"".join(map(token, every[a:b]))).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64()), *(pa.array(x, pa.string()) for x in told)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        found.drop()
        release()

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document."""
    return digests(table(spark, sf_dir, "documents"))
