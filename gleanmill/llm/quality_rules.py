"""Quality rules whose cutoffs carry a statistical guarantee (DataFrame functions only).

Each rule compares one measurement of a document with a cutoff. Cutoffs are not
guessed: for every stratum (language) and rule, the cutoffs of a fixed grid are
tested on the labelled good documents of that stratum. The null hypothesis is
"this cutoff rejects more than its share of ``alpha`` of the good documents"; its
p-value is the exact binomial tail P(Bin(n, share) <= k), with k of n good
documents rejected. A grid is ordered, so its cutoffs are tested in a fixed
sequence from the most lenient one and only as long as they pass, which needs no
correction within the grid; a Bonferroni correction over the (stratum, rule)
pairs keeps the chance that any certified cutoff breaks its promise below
``delta``. The strictest cutoff reached is used; a rule without one stays off in
that stratum. With ``alpha`` split over the rules, the documents lost to all
rules of a stratum together stay below ``alpha``.

Defined results: null or empty text has no words and fails the base rules; a
null language is a stratum of its own; a stratum without labels has no learned
cutoffs, so only the base rules apply there; labels that are null, or that name
no document, do not count; a document labelled more than once counts once per
label row. Rows are judged one by one, so repeated rows and extra columns pass
through unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.session import ensure_checkpoint_dir, table

WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Reject a document whose ``measure`` exceeds the cutoff; grid from strict to lenient."""

    name: str
    measure: str
    grid: tuple[float, ...]


#: Measures are SQL over the base columns, in hundredths where they are shares.
RULES = (
    Rule("symbols", "100.0D * n_symbols / n_words", tuple(float(x) for x in (2, 5, 10, 15, 20, 30, 40, 60, 80, 100, 150, 200))),
    Rule("dup_lines", "100.0D * n_dup_lines / n_lines", tuple(float(x) for x in (5, 10, 15, 20, 25, 30, 40, 50, 60, 70, 80, 90))),
    Rule("repeats", "100.0D * n_repeat_words / n_words", tuple(float(x) for x in (5, 10, 15, 20, 25, 30, 35, 40, 45))),
    Rule("word_length", "1.0D * word_chars / n_words", tuple(float(x) for x in (6, 7, 8, 9, 10, 12, 15, 20, 30))),
)

ALPHA = 0.02
DELTA = 0.05
MIN_WORDS = 50


def _let(value: Column, body) -> Column:
    """Bind a value once per row: lambda bodies would otherwise evaluate it per element."""
    return F.transform(F.array(value), body)[0]


def _neighbours_equal(ordered: Column, key) -> Column:
    """Elements of a sorted array whose key equals that of a neighbour."""
    return _let(
        ordered,
        lambda a: F.filter(a, lambda x, i: ((i > 0) & (key(F.get(a, i - 1)) == key(x))) | (key(F.get(a, i + 1)) == key(x))),
    )


def _covered(starts: Column) -> Column:
    """Word positions under three-word windows that begin at the sorted ``starts``."""
    return _let(
        starts,
        lambda s: F.aggregate(
            s,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
            lambda acc: acc["n"],
        ),
    )


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text.

    A first pass sorts plain longs made of 40 hash bits and 24 position bits, so
    a text without repeats costs one primitive sort. Windows that share hash
    bits are then compared by their words, which makes the count exact. Texts
    of 2**24 words or more skip the first pass.
    """

    def window(w: Column, i: Column) -> Column:
        return F.concat_ws(" ", F.slice(w, i + 1, F.lit(3)))

    mask = F.lit((1 << 24) - 1).cast("long")

    def hashed(w: Column) -> Column:
        packed = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(-(1 << 24)).cast("long")).bitwiseOR(i.cast("long")),
        )
        return F.transform(_neighbours_equal(F.sort_array(packed), lambda x: F.shiftright(x, 24)), lambda x: x.bitwiseAND(mask).cast("int"))

    def exact(w: Column, candidates: Column) -> Column:
        grouped = F.array_sort(F.transform(candidates, lambda i: F.struct(window(w, i).alias("g"), i.alias("i"))))
        return F.transform(_neighbours_equal(grouped, lambda x: x["g"]), lambda x: x["i"])

    def counted(w: Column) -> Column:
        candidates = F.when(F.size(w) < (1 << 24), hashed(w)).otherwise(F.sequence(F.lit(0), F.size(w) - 3))
        return _let(candidates, lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(_covered(F.sort_array(exact(w, c)))))

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(counted(words))


def measurements(text: Column) -> Column:
    """Struct of the base measurements of one text; every row is handled on its own."""
    whole = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return _let(
        F.struct(words.alias("w"), lines.alias("l")),
        lambda s: F.struct(
            F.size(s["w"]).cast("long").alias("n_words"),
            F.char_length(F.array_join(s["w"], "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            F.size(s["l"]).cast("long").alias("n_lines"),
            (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(s["w"]).alias("n_repeat_words"),
        ),
    )


def base_failed(m: str = "") -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    return F.expr(f"{m}n_words < {MIN_WORDS} OR 100 * {m}n_repeat_words > 50 * {m}n_words")


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact up to rounding, summed in log space.

    The mode of the distribution lies near n * p; a tail that reaches it is at
    least a third and is returned as 1 without summing, for it never passes a test.
    """
    odds, none = math.log(p) - math.log1p(-p), math.log1p(-p)
    start = F.struct((n.cast("double") * F.lit(none)).alias("term"), (n.cast("double") * F.lit(none)).alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1).cast("double") / i.cast("double")) + F.lit(odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return _let(term, lambda t: F.struct(t.alias("term"), (F.greatest(acc["total"], t) + F.log1p(F.exp(F.least(acc["total"], t) - F.greatest(acc["total"], t)))).alias("total")))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * F.lit(p), F.lit(1.0)).otherwise(F.exp(F.aggregate(steps, start, step, lambda acc: acc["total"])))


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the base measurements of every row; the text goes no further."""
    return docs.select("doc_id", _stratum(stratum).alias("stratum"), _once(measurements(F.col("text"))).alias("m")).select("doc_id", "stratum", "m.*")


def _once(value: Column) -> Column:
    """A generator of one row: filters and fields above it don't pull the expression up and evaluate it again."""
    return F.explode(F.array(value))


def _stratum(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def certified_cutoffs(measures: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(stratum, cut_<rule>...): the certified cutoff of each rule, null where none is.

    Only good labels (quality = 1) of documents that pass the base rules count;
    all of them do. One pass counts all grids with conditional sums, so the
    shuffle carries one row per stratum and task; the counts are written once.
    One row per stratum results.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__gm_id"))
    held = good.join(measures, F.col("__gm_id") == F.col("doc_id")).filter(~base_failed())
    sums = [F.count_if(F.expr(rule.measure) > F.lit(cut)).alias(f"{rule.name}_{j}") for rule in rules for j, cut in enumerate(rule.grid)]
    counted = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *sums).checkpoint()
    strata = counted.agg(F.count(F.lit(1)).alias("n_strata"))
    level = F.lit(delta / len(rules)) / F.col("n_strata")
    share = alpha / len(rules)

    def strictest(rule: Rule) -> Column:
        passed = F.array(*[binomial_tail(F.col(f"{rule.name}_{j}"), F.col("n_good"), share) <= level for j in range(len(rule.grid))])
        cuts = F.array(*[F.lit(cut) for cut in rule.grid])
        # The grid runs from strict to lenient: the first cutoff of which this and all later ones pass.
        return _let(passed, lambda p: F.get(F.filter(cuts, lambda _, i: F.forall(F.slice(p, i + 1, F.lit(len(rule.grid))), lambda x: x)), F.lit(0)))

    return counted.join(F.broadcast(strata)).select("stratum", *[strictest(rule).alias(f"cut_{rule.name}") for rule in rules])  # one row is broadcast


#: Up to this many strata the cutoffs are broadcast; beyond, they are joined by a shuffle.
BROADCAST_STRATA = 10_000
BROADCAST_LABELS = 1_000_000


def verdicts(rows: DataFrame, cuts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rows`` (with stratum and the base measurements) plus base_failed, n_failed_rules and kept."""
    cuts = cuts.withColumnRenamed("stratum", "__gm_stratum").checkpoint()
    side = F.broadcast(cuts) if cuts.count() <= BROADCAST_STRATA else cuts
    joined = rows.join(side, F.col("stratum") == F.col("__gm_stratum"), "left").withColumn("base_failed", base_failed())
    broken = sum((F.coalesce(F.when(~F.col("base_failed"), F.expr(rule.measure) > F.col(f"cut_{rule.name}")), F.lit(False)).cast("int") for rule in rules), F.lit(0))
    return (
        joined.withColumn("n_failed_rules", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_failed_rules") == 0))
        .drop("__gm_stratum", *[f"cut_{rule.name}" for rule in rules])
    )


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, rules: tuple[Rule, ...] = RULES, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Cutoffs come from the labelled documents alone, which are measured first;
    then every document is measured once, as it is judged. Up to
    ``BROADCAST_LABELS`` labelled ids go to the texts; beyond, both are shuffled.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__gm_label")).distinct().checkpoint()
    good = F.broadcast(good) if good.count() <= BROADCAST_LABELS else good
    labelled = docs.join(good, F.col("doc_id") == F.col("__gm_label"), "left_semi")
    cuts = certified_cutoffs(measured(labelled, stratum), labels, alpha, delta, rules)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("__gm_row"), _stratum(stratum).alias("stratum"), _once(measurements(F.col("text"))).alias("m")).select("__gm_row", "stratum", "m.*")
    return verdicts(rows, cuts, rules).filter("kept").select("__gm_row.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every document; the measurements are taken once and written to the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    measures = measured(table(spark, sf_dir, "documents")).checkpoint()
    cuts = certified_cutoffs(measures, table(spark, sf_dir, "labels"))
    return verdicts(measures, cuts).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_failed_rules", "kept")


def _oracle() -> str:
    share = ALPHA / len(RULES)

    def tail(k: str) -> str:
        term = f"exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({share!r}) + (n_good - i) * ln(1 - {share!r}))"
        return f"CASE WHEN {k} >= n_good * {share!r} THEN 1.0 ELSE list_sum(list_transform(range(0, {k} + 1), lambda i: {term})) END"

    counts = ", ".join(f"count(*) FILTER (WHERE {rule.measure.replace('D ', '::DOUBLE ')} > {cut}) AS {rule.name}_{j}" for rule in RULES for j, cut in enumerate(rule.grid))
    level = f"({DELTA / len(RULES)!r} / (SELECT count(*) FROM counted))"
    cuts = ", ".join(
        f"CASE {' '.join(f'WHEN {chr(32).join(f"{tail(f'{rule.name}_{k}')} <= {level} AND" for k in range(j, len(rule.grid)))} true THEN {cut}::DOUBLE' for j, cut in enumerate(rule.grid))} END AS cut_{rule.name}"
        for rule in RULES
    )
    hits = " + ".join(f"coalesce((NOT base_failed AND {rule.measure.replace('D ', '::DOUBLE ')} > cut_{rule.name})::INT, 0)" for rule in RULES)
    return f"""
    WITH split AS (
      SELECT doc_id, CASE WHEN lang IS NULL THEN 'null' ELSE '=' || lang END AS stratum, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM documents
    ), windows AS (
      SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 'g': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}}), recursive := true) FROM split
    ), marked AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM windows
    ), covered AS (
      SELECT doc_id, least(3, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -3)) AS words FROM marked WHERE times > 1
    ), repeats AS (
      SELECT doc_id, sum(words) AS n FROM covered GROUP BY doc_id
    ), base AS (
      SELECT s.doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM split s LEFT JOIN repeats r ON s.doc_id = r.doc_id
    ), failing AS (
      SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM base
    ), counted AS (
      SELECT stratum, count(*) AS n_good, {counts} FROM failing JOIN labels USING (doc_id) WHERE quality = 1 AND NOT base_failed GROUP BY stratum
    ), cuts AS (
      SELECT stratum, {cuts} FROM counted
    ), judged AS (
      SELECT f.*, {hits} AS n_failed_rules FROM failing f LEFT JOIN cuts c ON f.stratum = c.stratum
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_failed_rules::INT AS n_failed_rules,
           (NOT base_failed AND n_failed_rules = 0) AS kept
    FROM judged
    """


ORACLE_SQL = _oracle()
