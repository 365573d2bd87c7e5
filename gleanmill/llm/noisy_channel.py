"""Toxicity after noisy-channel deobfuscation.

1. A character language model of words (four-grams with backing off to shorter
   ones) is counted over all texts: boundary, a to z, any other letter. Tokens with
   signs or in several parts don't count, so that bent words don't teach it. A task
   sends its counts; their number is bounded by the alphabet.
2. Every token is a lattice: a sign may stay or be one of the letters it looks
   like, a star between letters may be any letter, a separator inside a token may
   stay or go, a letter that repeats the one before may go, and letters set apart one by one
   ("s t u p i d") are one token. The path of least cost under the language model
   and the costs of the channel is found by Viterbi decoding over the last three
   symbols. A token whose lattice has one path is left as it is.
3. The restored text is scored by logistic regression on the presence of words
   and of four and five letters inside them, hashed. Features are chosen by the
   chi-square of a feature with the label and weights are
   learned (follow the regularised leader, then a temperature and a shift on
   every fifth row) on a sample of at most twice ``SAMPLE_ROWS`` different labelled
   texts, spread evenly by hash, so that copies of a text count once.

Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0; a
score uses nothing but the text.

Defined results: null and empty texts are scored as texts without features; equal
texts get equal scores; without labels to learn from every score is 0, with one kind
of label only it is the smoothed share of toxic rows; a null id is neither held out nor learned
from; a text labelled both ways counts once for each. Repeated rows repeat their
result, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import release, slices
from gleanmill.llm.byte_bpe import LETTER, classes
from gleanmill.llm.frames import kept
from gleanmill.session import ensure_checkpoint_dir, table

#: Different labelled texts that the classifier learns from: about so many, at most twice as many.
SAMPLE_ROWS = 12_000
#: Hashed features, the most that the classifier has, and the least chi-square of one.
BUCKETS = 1 << 20
FEATURES = 4096
CHI = 12.0
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1.0
#: Costs of the channel: a sign for a letter, a sign that is meant, a star for any letter, a separator put in, a letter repeated.
SIGN_COST, KEEP_COST, STAR_COST, APART_COST, AGAIN_COST = (float(-np.log(p)) for p in (0.05, 0.2, 0.002, 0.03, 0.05))
#: Symbols: 0 boundary, 1 to 26 letters, 27 other letters.
SYMBOLS = 28
OTHER = 27
#: Weight of the shorter context while counting is scarce.
BACK = 4.0
#: Decoded tokens that a task remembers; the bound changes no result.
REMEMBERED = 100_000

# What signs and letters of other scripts look like.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "а": "a", "в": "b", "е": "e", "і": "i", "к": "k", "м": "m", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
}
STARS = "*#"
APART = ".-_'~*,;:/"

_SIGNS = re.escape("".join(LOOKS))
_BETWEEN = re.escape(APART + STARS)
#: What gives a token more than one path: a repeated letter, a sign, a separator that is not at its ends.
_AMBIGUOUS = re.compile(rf"([a-z])\1|[{_SIGNS}]|(?<=[^{re.escape(APART)}])[ {_BETWEEN}](?=.)", re.DOTALL)
#: A whole token of that kind in a text; all others are passed over without a call.
_TOKEN = re.compile(rf"(?<!\S)\S*?(?:([a-z])\1|[{_SIGNS}]|(?<=[^\s{re.escape(APART)}])[{_BETWEEN}](?=\S))\S*")
_LETTER = re.compile(r"[a-z]")
#: Letters and signs that stand alone, three or more of them with one blank between.
_SPACED = re.compile(rf"(?<!\S)[a-z{_SIGNS}](?: [a-z{_SIGNS}]){{2,}}(?!\S)")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else OTHER if c.isalpha() else 0


class _Symbols(dict):
    """Symbols of characters, filled as they are met."""

    def __missing__(self, c: str) -> int:
        self[c] = out = _symbol(c)
        return out


def _of_bytes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every byte of UTF-8: its symbol in lower case (255 for bytes that continue a letter), whether it is a sign or star, white space."""
    symbols = np.array([_symbol(chr(b).lower()) if b < 128 else 255 if b < 0xC0 else OTHER for b in range(256)], np.uint8)
    chars = [chr(b) if b < 128 else "" for b in range(256)]
    return symbols, np.array([c != "" and c in LOOKS or c in STARS and c != "" for c in chars]), np.array([c.isspace() for c in chars])


_BYTES = _of_bytes()


def word_grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of all four-grams of symbols of words that make up a token; what stands before a word's first letter is boundary."""
    raw = np.insert(raw, offsets[:-1], 32) if len(offsets) > 1 else np.zeros(0, np.uint8)
    of, sign, space = (x[raw[_BYTES[0][raw] < 255]] for x in _BYTES)
    of = np.append(of, 0).astype(np.int32)
    said = of > 0
    token = np.cumsum(np.append(space, True))
    first = said.copy()
    first[1:] &= ~said[:-1]
    parts = np.bincount(token[first], minlength=token[-1] + 1) + 2 * np.bincount(token[:-1][sign], minlength=token[-1] + 1)
    of[(parts > 1)[token]] = 0
    said = of > 0
    keep = said.copy()
    keep[1:] |= said[:-1]  # of what stands between words one boundary stays
    s = np.concatenate([np.zeros(3, np.int32), of[keep]])
    a, b, c, d = s[:-3], s[1:-2], s[2:-1], s[3:]
    b = np.where(c > 0, b, 0)
    a = np.where(b > 0, a, 0)
    return ((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d


def _counted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**4, np.int64)
    for _, raw, offsets in slices(batches, "text"):
        total += np.bincount(word_grams(raw, offsets), minlength=SYMBOLS**4)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])
    release()


def language_model(docs: DataFrame) -> np.ndarray:
    """Cost (negative logarithm of the probability) of every symbol after every three, from all texts."""
    grams = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted_grams, "gram long, n long")
    found = grams.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # at most 28^4 rows
    counts = np.zeros(SYMBOLS**4)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return costs(counts)


def costs(counts: np.ndarray) -> np.ndarray:
    """Costs from counts of four-grams: every order backs off to the next shorter one."""
    n = counts.reshape((SYMBOLS,) * 4)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, 5):
        some = n.sum(axis=tuple(range(4 - order))) if order < 4 else n
        p = (some + BACK * p) / (some.sum(-1, keepdims=True) + BACK)
    return -np.log(p).astype(np.float32).ravel()


class Restorer:
    """Viterbi decoding of tokens under a language model."""

    def __init__(self, cost: np.ndarray) -> None:
        self.cost = array("f", cost.tobytes())
        self.known: dict[str, str] = {}
        self.symbols = _Symbols()

    def decoded(self, token: str) -> str:
        """The path of least cost through the lattice of a lower-cased token."""
        cost, full, symbols = self.cost, SYMBOLS**3, self.symbols
        # All paths share what stands before the first choice.
        first = found.start() if (found := _AMBIGUOUS.search(token)) else 0
        context = 0
        for c in token[max(0, first - 3) : first]:
            symbol = symbols[c]
            context = (context * SYMBOLS + symbol) % full if symbol else 0
        if found and found.group(1) and not _AMBIGUOUS.search(token, first + 1):
            return self._paired(token, first, context)
        states: dict[int, tuple[float, tuple | None]] = {context: (0.0, (None, token[:first]))}  # last three symbols of the word: cost, what was said
        last = len(token) - 1
        for i in range(first, len(token)):
            c = token[i]
            symbol = symbols[c]
            moves = [(symbol, c, 0.0 if symbol or c not in LOOKS else KEEP_COST)]
            if symbol == 0 or symbol > 26:
                for x in LOOKS.get(c, ""):
                    moves.append((ord(x) - 96, x, SIGN_COST))
                if 0 < i < last and (c == " " or c in APART or c in STARS) and token[i - 1] not in APART:
                    moves.append((-1, "", APART_COST))
                    if c in STARS and symbols[token[i - 1]] and symbols[token[i + 1]]:
                        moves += [(x, chr(96 + x), STAR_COST) for x in range(1, 27)]
            elif i and c == token[i - 1]:
                moves.append((-1, "", AGAIN_COST))
            elif len(states) == 1 and not _AMBIGUOUS.search(token, i):
                # One path so far and none to choose from here on.
                ((_, said),) = states.values()
                return self._said((said, token[i:]))
            new: dict[int, tuple[float, tuple | None]] = {}
            for context, (before, said) in states.items():
                for symbol, text, extra in moves:
                    key, total = context, before + extra
                    if symbol > 0:
                        total += cost[context * SYMBOLS + symbol]
                        key = (context * SYMBOLS + symbol) % full
                    elif symbol == 0:
                        total += cost[context * SYMBOLS] if context else 0.0
                        key = 0
                    if key not in new or total < new[key][0]:
                        new[key] = (total, (said, text))
            states = new
        return self._said(min(((total + (cost[context * SYMBOLS] if context else 0.0), said) for context, (total, said) in states.items()), key=lambda x: x[0])[1])

    def _paired(self, token: str, first: int, context: int) -> str:
        """A token whose one choice is whether the letter after ``first`` repeats it: two paths, compared until they meet."""
        cost, full, symbols = self.cost, SYMBOLS**3, self.symbols
        letter = symbols[token[first]]
        short = (context * SYMBOLS + letter) % full
        long, more = (short * SYMBOLS + letter) % full, cost[short * SYMBOLS + letter] - AGAIN_COST
        for c in token[first + 2 :]:
            if long == short:
                break
            symbol = symbols[c]
            more += cost[long * SYMBOLS + symbol] - cost[short * SYMBOLS + symbol]
            long, short = ((long * SYMBOLS + symbol) % full, (short * SYMBOLS + symbol) % full) if symbol else (0, 0)
        if long != short:
            more += cost[long * SYMBOLS] - cost[short * SYMBOLS]
        return token if more <= 0 else token[: first + 1] + token[first + 2 :]

    @staticmethod
    def _said(said: tuple | None) -> str:
        out = []
        while said is not None:
            said, text = said
            out.append(text)
        return "".join(reversed(out))

    def token(self, token: str) -> str:
        """A token with choices, decoded; without a letter it is a number or the like and stays."""
        found = self.known.get(token)
        if found is None:
            found = self.decoded(token) if _LETTER.search(token) else token
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(token) < 64:
                self.known[token] = found
        return found

    def text(self, text: str) -> str:
        """A text in lower case with its tokens restored; white space stays."""
        text = text.lower()
        if _SPACED.search(text):
            text = _SPACED.sub(lambda m: self.decoded(m.group()), text)
        token = self.token
        return _TOKEN.sub(lambda m: token(m.group()), text)


_IS_LETTER: list[np.ndarray] = []
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_PLACES = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(31)).astype(np.uint32) | np.uint32(1)
_SHIFT = np.uint32(12)


def _finished(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * _MIX[1]
    h = (h ^ (h >> np.uint32(13))) * _MIX[2]
    return ((h ^ (h >> np.uint32(16))) >> _SHIFT).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and of every four and five letters within a word, with repeats."""
    if not _IS_LETTER:
        _IS_LETTER.append(classes() == LETTER)
    points = np.frombuffer("".join(f"{t} " for t in texts).encode("utf-32-le", "replace"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    letter = _IS_LETTER[0][points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    signs, doc = np.concatenate([np.zeros(1, np.uint32), np.where(letter, points, np.uint32(0))[keep]]), np.concatenate([[0], doc[keep]])
    inside = signs > 0
    at, found = [], []
    if inside.any():
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        word = np.cumsum(inside & ~np.concatenate([[False], inside[:-1]]))[inside] - 1
        place = np.flatnonzero(inside) - starts[word]
        sums = np.add.reduceat(signs[inside] * _PLACES[place % 64] + np.uint32(1), np.searchsorted(word, np.arange(len(starts))), dtype=np.uint32)
        at.append(doc[starts])
        found.append(_finished(sums ^ _MIX[0]))
    for n in (4, 5):
        if len(signs) < n:
            continue
        part = [signs[i : len(signs) - n + 1 + i] for i in range(n)]
        whole = np.logical_and.reduce([p > 0 for p in part[1:-1]]) & ((part[0] > 0) | (part[-1] > 0))
        h = np.full(len(whole), np.uint32(n))
        for p in part:
            h = h * _MIX[0] + p
        at.append(doc[1 : len(whole) + 1][whole])
        found.append(_finished(h[whole]))
    return (np.concatenate(at), np.concatenate(found)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Classifier:
    """Weights of the chosen buckets."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    constant: float | None = None
    at: np.ndarray | None = field(default=None, repr=False)

    def chosen(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of feature), each pair once, in order."""
        if self.at is None:
            self.at = np.full(BUCKETS, -1, np.int32)
            self.at[self.buckets] = np.arange(len(self.buckets))
        doc, bucket = features(texts)
        number = self.at[bucket]
        pairs = np.unique(doc[number >= 0] * max(len(self.buckets), 1) + number[number >= 0])
        return pairs // max(len(self.buckets), 1), pairs % max(len(self.buckets), 1)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        doc, number = self.chosen(texts)
        return 1 / (1 + np.exp(-np.clip(np.bincount(doc, self.weights[number], len(texts)) + self.bias, -500, 500)))


def learned(rows: list[tuple[int, np.ndarray]], k: int) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, numbers of features); the order of the rows is part of the result."""
    z, n = np.zeros(k + 1), np.zeros(k + 1)

    def solve(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) > L1, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2), 0.0)

    rows = [(label, np.append(numbers, k)) for label, numbers in rows]
    fit = [r for i, r in enumerate(rows) if i % 5 != 4 or len(rows) < 50]
    apart = [r for i, r in enumerate(rows) if i % 5 == 4 and len(rows) >= 50]
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in order.permutation(len(fit)):
            label, at = fit[i]
            zz, nn = z[at], n[at]
            w = solve(zz, nn)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -500, 500))) - label
            z[at] = zz + g - (np.sqrt(nn + g * g) - np.sqrt(nn)) / ALPHA * w
            n[at] = nn + g * g
    w = solve(z, n)
    if len({label for label, _ in apart}) < 2:
        return w[:-1], float(w[-1])
    # Slope and shift by Newton steps on the rows kept apart, with smoothed targets.
    s = np.array([w[at].sum() for _, at in apart])
    label = np.array([x for x, _ in apart])
    target = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    ab = np.array([1.0, 0.0])
    x = np.stack([s, np.ones(len(s))], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (ab - [1.0, 0.0]))
        ab = ab - step
        if np.abs(step).max() < 1e-9:
            break
    slope = float(np.clip(ab[0], 0.2, 5.0))
    return w[:-1] * slope, float(w[-1] * slope + ab[1])


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """text, toxic of at most 2 * sample_rows different labelled texts; only ids and hashes are shuffled to find them."""
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1)).distinct()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key")).distinct()
    once = kept(keyed.join(told, "doc_id").groupBy("key", "toxic").agg(F.min("doc_id").alias("doc_id")))
    share = min(1.0, sample_rows / max(once.count(), 1))
    drawn = once.withColumn("at", F.xxhash64("key", F.lit(5))).filter(F.pmod("at", F.lit(1 << 30)) < share * (1 << 30))
    chosen = drawn.orderBy("at", "toxic").limit(2 * sample_rows).select("doc_id", "key", "toxic")
    rows = docs.withColumn("key", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "key"])  # at most 2 * sample_rows narrow rows
    return rows.dropDuplicates(["key", "toxic"]).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, cost: np.ndarray, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Learn from labelled texts that are not held out."""
    shipped = docs.sparkSession.sparkContext.broadcast(cost)

    def restored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shipped.value)
        for rows, _, _ in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array([restorer.text(t) for t in rows.column(0).to_pylist()], pa.string()), rows.column(1)], ["text", "toxic"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for rows, _, _ in slices(batches, "text"):
            label = rows.column(1).to_numpy()
            doc, bucket = features(rows.column(0).to_pylist())
            pairs = np.unique(doc * BUCKETS + bucket)
            of = label[pairs // BUCKETS]
            for k in (0, 1):
                total[k] += np.bincount(pairs[of == k] % BUCKETS, minlength=BUCKETS)
        some = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], ["bucket", "clean", "bad"])
        release()

    rows = sample(docs, labels, sample_rows).mapInArrow(restored_rows, "text string, toxic int").checkpoint()
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, bad = sizes.get(0, 0), sizes.get(1, 0)
    none = np.zeros(0, np.int64)
    if not clean or not bad:
        return Classifier(none, np.zeros(0), 0.0, (bad + 1) / (clean + bad + 2) if clean + bad else 0.0)
    counts = rows.mapInArrow(counted, "bucket long, clean long, bad long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    # Chi-square of presence and label, with half a row less between seen and expected.
    n, seen = clean + bad, F.col("clean") + F.col("bad")
    apart = F.greatest(F.abs(F.col("bad") * float(n) - seen * float(bad)) - n / 2, F.lit(0.0))
    chi = apart * apart * float(n) / (seen * float(clean) * float(bad) * F.greatest(F.lit(float(n)) - seen, F.lit(0.5)))
    top = counts.select("bucket", chi.alias("chi")).filter(F.col("chi") >= CHI).orderBy(F.desc("chi"), "bucket").limit(FEATURES).collect()
    model = Classifier(np.array(sorted(r["bucket"] for r in top), np.int64), np.zeros(len(top)), 0.0)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in slices(batches, "text"):
            doc, number = model.chosen(part.column(0).to_pylist())
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array([number[a:b].astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], ["toxic", "numbers"])

    made = sorted((r["toxic"], r["numbers"]) for r in rows.mapInArrow(numbered, "toxic int, numbers binary").collect())
    spread = np.random.default_rng(3).permutation(len(made))
    weights, bias = learned([(made[i][0], np.frombuffer(made[i][1], "<i4").astype(np.int64)) for i in spread], len(top))
    return Classifier(model.buckets, weights, bias)


def restored(docs: DataFrame, cost: np.ndarray | None = None) -> DataFrame:
    """doc_id and text in lower case with its tokens restored; null stays null."""
    cost = language_model(docs) if cost is None else cost
    shipped = docs.sparkSession.sparkContext.broadcast(cost)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shipped.value)
        for rows, _, _ in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([None if t is None else restorer.text(t) for t in rows.column(1).to_pylist()], pa.string())], ["doc_id", "text"])
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text string")


def scored(docs: DataFrame, cost: np.ndarray, model: Classifier) -> DataFrame:
    """doc_id, score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast((cost, model.buckets, model.weights, model.bias, model.constant))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, *parts = shipped.value
        restorer, own = Restorer(cost), Classifier(*parts)
        for rows, _, _ in slices(batches, "text", SLICE):
            texts = [restorer.text(t or "") for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(own.scores(texts))], ["doc_id", "score"])
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


#: Bytes of text scored at a time; the arrays take some thirty times as much.
SLICE = 1 << 20


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    ensure_checkpoint_dir(docs.sparkSession)
    cost = language_model(docs)
    rows = scored(docs, cost, fit(docs, labels, cost, sample_rows))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labels."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
