"""Quality rules with thresholds learned from the corpus, in DataFrame functions only.

Each document gets a few integer measures. Three ratios of them are summarised per language and source in
quantile sketches: counts of a fixed-width bucketing of the ratio, so that sketches of shards, sources or days
merge by adding counts, give the same result in any order, and place a quantile within one bucket width.
The sketches are of documents that pass the base rule. A document passes when no ratio lies beyond its group's limit: the
ratio that 15 of 16 documents of the group stay within or, where that is larger, the median of those that have any, if
at least one in 64 has (ratios are mostly zero, and what is usual in a group is no fault). No limit is fixed. A group with few documents
borrows the sketch of its language, and that of all documents where the language is small too.

Defined results: a null or empty text has zero measures and fails the base rule; null language or source is a
group of its own; repeated rows count as often as they occur; an empty table gives an empty table; columns
other than id, text, language and source are ignored, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# The ratio's numerator and denominator, in thousandths.
RATIOS = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


@dataclass(frozen=True)
class Rules:
    """Fixed part of the rules; the thresholds themselves come from the corpus."""

    min_words: int = 10
    max_repeat_percent: int = 20
    # The share of a group's documents (numerator, denominator) that its limits leave in, ratio by ratio.
    within: tuple[int, int] = (15, 16)
    # A ratio is usual in a group where one document in so many has any of it.
    usual: int = 64
    # Groups with fewer documents use the next wider sketch.
    min_group: int = 200


def _bind(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`: a lambda variable is not recomputed for each element."""
    return F.transform(F.array(value), body)[0]


def _covered(places: Column) -> Column:
    """How many words lie in windows that start at the given ascending places."""

    def count(p: Column) -> Column:
        return F.aggregate(
            p,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("free")),
            lambda state, at: F.struct(
                (state["n"] + at + WINDOW - F.greatest(at, state["free"])).cast("long").alias("n"),
                (at + WINDOW).cast("int").alias("free"),
            ),
            lambda state: state["n"],
        )

    return count(places)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text."""
    zero = F.lit(0).cast("long")

    def of_words(w: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        )
        return _bind(keys, of_keys)

    def of_keys(k: Column) -> Column:
        # Most texts repeat nothing: one hash set tells, and the sort is left out.
        return F.when(F.size(F.array_distinct(k)) == F.size(k), zero).otherwise(
            _bind(F.sort_array(F.transform(k, lambda x, i: F.struct(x.alias("k"), i.alias("i")))), of_sorted)
        )

    def of_sorted(s: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(s, at)["k"] == x["k"], F.lit(False))
        twice = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return _covered(F.sort_array(F.transform(twice, lambda x: x["i"])))

    return F.when(F.size(words) <= WINDOW, zero).otherwise(_bind(words, of_words))


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Columns `keep` and the integer measures of each text."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split("_body", SPACES), lambda w: w != "")
    lines = F.filter(F.split("_body", "\n"), lambda line: F.trim(line, F.lit(SPACE_CHARS)) != "")
    bare = F.length(F.translate("_body", SPACE_CHARS, "")).cast("long")
    long = lambda c: c.cast("long")
    found = F.struct(
        bare.alias("word_chars"),
        long(F.length("_body") - F.length(F.translate("_body", SYMBOLS, ""))).alias("n_symbols"),
        _bind(words, lambda w: F.struct(long(F.size(w)).alias("n_words"), _repeat_words(w).alias("n_repeat_words"))).alias("w"),
        _bind(
            lines,
            lambda x: F.struct(
                long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")
            ),
        ).alias("l"),
    )
    # One generated element keeps the optimiser from copying the measures into each later expression.
    once = docs.select(*keep, body.alias("_body")).select(*keep, F.explode(F.array(found)).alias("_m"))
    return once.select(
        *keep,
        F.col("_m.w.n_words").alias("n_words"),
        F.col("_m.word_chars").alias("word_chars"),
        F.col("_m.n_symbols").alias("n_symbols"),
        F.col("_m.l.n_lines").alias("n_lines"),
        F.col("_m.l.n_dup_lines").alias("n_dup_lines"),
        F.col("_m.w.n_repeat_words").alias("n_repeat_words"),
    )


def _permille(part: str, whole: str) -> Column:
    return F.expr(f"case when {whole} > 0 then 1000 * {part} div {whole} else 0 end")


def sketches(measured: DataFrame, group: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per group, ratio and bucket, with the number of documents; merge by adding `n`."""
    ratios = F.array(
        *[F.struct(F.lit(r).alias("ratio"), _permille(a, b).alias("bucket")) for r, (a, b) in RATIOS.items()]
    )
    rows = measured.select(*group, F.explode(ratios).alias("_r"))
    return rows.groupBy(*group, F.col("_r.ratio").alias("ratio"), F.col("_r.bucket").alias("bucket")).agg(
        F.count("*").alias("n")
    )


def merge(sketch: DataFrame, *group: str) -> DataFrame:
    """The sketch of wider groups, from that of narrower ones."""
    return sketch.groupBy(*group, "ratio", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, rules: Rules, *group: str) -> DataFrame:
    """Limits per group, one column per ratio, with the number of documents.

    A group has at most 1001 buckets a ratio (a ratio above 1 falls into the last), so gathering them is bounded.
    """
    top = F.least("bucket", F.lit(1000))
    capped = sketch.select(*group, "ratio", top.alias("bucket"), "n")
    capped = capped.groupBy(*group, "ratio", "bucket").agg(F.sum("n").alias("n"))
    each = capped.groupBy(*group, "ratio").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("b")
    )

    def quantile(buckets: Column, part: int, whole: int) -> Column:
        """The first bucket whose running count reaches the part of all."""
        total = F.aggregate(buckets, F.lit(0).cast("long"), lambda c, x: c + x["n"])
        state = F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("long").alias("q"))

        def step(s: Column, x: Column, enough: Column) -> Column:
            c = s["c"] + x["n"]
            reached = s["q"].isNull() & (whole * c >= enough)
            return F.struct(c.alias("c"), F.when(reached, x["bucket"]).otherwise(s["q"]).alias("q"))

        return _bind(part * total, lambda enough: F.aggregate(buckets, state, lambda s, x: step(s, x, enough), lambda s: s["q"]))

    upper = quantile(F.col("b"), *rules.within)
    some = F.filter("b", lambda x: x["bucket"] > 0)
    having = F.aggregate(some, F.lit(0).cast("long"), lambda c, x: c + x["n"])
    usual = F.when(rules.usual * having >= F.col("n"), quantile(some, 1, 2))
    fence = each.withColumn("fence", F.greatest(upper, F.coalesce(usual, F.lit(0).cast("long"))))
    picks = [F.max(F.when(F.col("ratio") == r, F.col("fence"))).alias(f"max_{r}") for r in RATIOS]
    return fence.groupBy(*group).agg(F.max("n").alias("n"), *picks)


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """doc_id, the measures, base_failed and kept, one row per input row."""
    measured = stored(measures(docs, text), "quality")
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    fine = stored(sketches(measured.where(~failed)), "sketch")
    by_lang = merge(fine, "lang")
    names = [f"max_{r}" for r in RATIOS]

    def named(frame: DataFrame, tag: str) -> DataFrame:
        return frame.select(
            *[F.col(c).alias(f"_{tag}_{c}") for c in frame.columns if c in ("lang", "source")],
            F.when(F.col("n") >= rules.min_group, F.struct(*names)).alias(f"_{tag}"),
        )

    one = named(fences(fine, rules, "lang", "source"), "one")
    lang = named(fences(by_lang, rules, "lang"), "lang")
    # One row for all documents; without any there is nothing to limit.
    every = fences(merge(fine), rules).first()
    every = F.struct(*[F.lit((every[c] or 0) if every else 0).cast("long").alias(c) for c in names])
    # One row per group that occurs, with the limits it uses; then one join of the documents with it.
    limits = (
        one.join(lang, F.col("_one_lang").eqNullSafe(F.col("_lang_lang")), "left")
        .select("_one_lang", "_one_source", F.coalesce(F.col("_one"), F.col("_lang"), every).alias("_limit"))
    )
    at = measured.join(
        limits,
        F.col("lang").eqNullSafe(F.col("_one_lang")) & F.col("source").eqNullSafe(F.col("_one_source")),
        "left",
    )
    within = F.lit(True)
    for ratio, (part, whole) in RATIOS.items():
        within = within & (_permille(part, whole) <= F.col(f"_limit.max_{ratio}"))
    return at.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(within, F.lit(True))).alias("kept"),
    )
