"""Keyword lists of thousands of terms: one pass over a text whatever the number of terms.

A pass per term, as ``functions.text`` has it, is native and best for some ten
terms. Here all terms form an Aho-Corasick automaton, which is broadcast (its size
is that of the keyword file) and walked once per text. Scores, lists and topics
are the same as the native ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmill.functions import text
from gleanmill.operators.batches import sliced


class Terms:
    """Distinct terms as an automaton; built once in a task from the terms alone."""

    def __init__(self, terms: list[str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.automaton.add_word(term, (i, len(term)))
        if terms:
            self.automaton.make_automaton()
        self.n = len(terms)

    def counts(self, t: str) -> dict[int, int]:
        """Occurrences of each term that occurs, from the left and without overlap."""
        if not self.n:
            return {}
        out: dict[int, int] = {}
        free: dict[int, int] = {}  # where a term may begin again
        for end, (i, length) in self.automaton.iter(t):
            if end - length + 1 >= free.get(i, 0):
                out[i] = out.get(i, 0) + 1
                free[i] = end + 1
        return out


def _once(terms: list[str]) -> tuple[list[str], np.ndarray]:
    """Different terms, and for each place of the list the number of its term."""
    number: dict[str, int] = {}
    places = np.array([number.setdefault(t, len(number)) for t in terms], np.int64)
    return list(number), places


def scored(rows: DataFrame, value: Column, keywords: list[str], keys: list[str]) -> DataFrame:
    """(keys, score, found): the keyword score of a text and its keywords in the order of the list.

    The score is the sum of 1 + ln(occurrences) over the places of the list, a keyword that
    stands there twice counts twice, by the length of the list, at most 1 and rounded to four
    decimals; null texts are empty, an empty keyword never occurs.
    """
    terms, places = _once(keywords)
    real = [t for t in terms if t]
    shipped = rows.sparkSession.sparkContext.broadcast(real)
    weight = np.bincount(places, minlength=len(terms)) if len(places) else np.zeros(0, np.int64)
    weight = weight[[i for i, t in enumerate(terms) if t]] if terms else weight
    place_of = {t: i for i, t in enumerate(real)}
    order = [place_of[t] for t in keywords if t]
    at: dict[int, list[int]] = {}
    for place, i in enumerate(order):
        at.setdefault(i, []).append(place)
    shown = [t for t in keywords if t]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Terms(shipped.value)
        logs = 1 + np.log(np.arange(1, 4097))
        for batch in sliced(batches, "__gm_text"):
            totals, found = [], []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                counts = walk.counts(t)
                total = 0.0
                for i in sorted(counts):
                    n = counts[i]
                    total += float(logs[n - 1] if n <= 4096 else 1 + np.log(n)) * int(weight[i])
                totals.append(total)
                found.append([shown[p] for p in sorted(p for i in counts for p in at[i])])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(totals, pa.float64()), pa.array(found, pa.list_(pa.string()))], [*batch.schema.names[:-1], "total", "found"])

    chosen = rows.select(*keys, F.lower(F.coalesce(value, F.lit(""))).alias("__gm_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    out = chosen.mapInArrow(run, f"{schema}, total double, found array<string>")
    score = F.round(F.least(F.col("total") / float(len(keywords)), F.lit(1.0)), 4) if keywords else F.lit(0.0)
    return out.select(*keys, score.alias("score"), "found")


def on_topics(rows: DataFrame, value: Column, topics: dict[str, list[list[str]]], keys: list[str]) -> DataFrame:
    """(keys, topics): the names, sorted, of the topics whose every group has a term in the text.

    The terms of all topics are looked for in one pass. As in ``text.matches_topic``
    an empty group fails, a topic without groups passes, and blanks and case don't matter.
    """
    clean = lambda t: " ".join(t.lower().split())
    terms = sorted({clean(t) for groups in topics.values() for g in groups for t in g if t.strip()})
    number = {t: i for i, t in enumerate(terms)}
    needed = {name: [frozenset(number[clean(t)] for t in g if t.strip()) for g in groups] for name, groups in sorted(topics.items())}
    shipped = rows.sparkSession.sparkContext.broadcast((terms, needed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, needed = shipped.value
        walk = Terms(terms)
        always = [name for name, groups in needed.items() if not groups]
        of_term: dict[int, set[str]] = {}
        for name, groups in needed.items():
            if groups and all(groups):
                for i in min(groups, key=len):  # a topic is looked at if its shortest group has a term
                    of_term.setdefault(i, set()).add(name)
        for batch in sliced(batches, "__gm_text"):
            told = []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                seen = {i for _, (i, _) in walk.automaton.iter(t)} if walk.n else set()
                asked = {name for i in seen for name in of_term.get(i, ())}
                told.append(sorted([*always, *(name for name in asked if all(g & seen for g in needed[name]))]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(told, pa.list_(pa.string()))], [*batch.schema.names[:-1], "topics"])

    chosen = rows.select(*keys, text.normalise(F.coalesce(value, F.lit(""))).alias("__gm_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{schema}, topics array<string>")
