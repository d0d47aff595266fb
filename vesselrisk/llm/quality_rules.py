"""Quality rules by distribution divergence, in DataFrame operations only.

Base rules count words, symbols, repeated lines and words in repeated three-word
windows. The verdict of a document that passes them compares two of its histograms
with the reference of its language by Jensen-Shannon distance (base 2, 0 to 1):
characters by class, and common words (function words of four languages, all other
words together). A reference is the mean of the histograms of all documents of the
language that pass the length guard, so no long document or source outweighs others;
it is gathered from the whole corpus with partial sums before the shuffle. The mean of the
whole corpus goes into each reference with the weight of ``MIN_REFERENCE`` documents.
Texts under the length guards have no distance and are left to the base rules.

How far a document's words may be from its reference depends on its language and length.
The same sums give, for each word, the variance of its share between the documents of the
language; with the sampling variance of a share among n words this gives the squared
distance that n words of a usual document have on average. A text goes if its distance
exceeds the root of that by over ``SIGMAS`` relative standard deviations, so short texts,
in which a share may be far off by chance, have the wider limit. There is no fixed word cutoff.

Everything of a document is worked out inside its row, so texts are never shuffled, and once:
counts and histograms are written as slim rows, from which the references are gathered and
which are judged. Windows are compared by 64-bit hashes, within one text.

Defined results: a null text has no words and fails the base rules; null languages are
a language of their own; an empty table gives an empty one; repeated rows are judged
alike; input columns called like a result column are replaced, others stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, replaced, shared_path, word_array

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "the of and to in is that for it as was with be by on not he his at are this have from or had an they which "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "de la le et les en un une du que est pour qui dans par plus pas au sur avec "
    "el y a los se del las por con no su para al lo como más pero sus una"
).split()
MAX_COMMON = 7  # the longest common word and two marks
SYMBOLS = "#*$%&|<>"
N_CLASSES = 6
MIN_WORDS = 50
MIN_CHARS = 200
MIN_REFERENCE = 20
MAX_CHAR_DISTANCE = 0.30
SIGMAS = 3
STEPS = 4  # word limits are worked out for MIN_WORDS * 2**(k / STEPS) words
N_LIMITS = 100
BROADCAST_LANGUAGES = 10_000
OUTPUTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows(words: Column) -> Column:
    """Hashes of the three-word windows in order of the text, from ``words`` or hashes of them."""
    n = F.size(words)
    zipped = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(n, F.lit(1))).alias("b"), F.slice(words, 3, F.greatest(n, F.lit(1))).alias("c"))
    return F.transform(F.slice(zipped, 1, F.greatest(n - 2, F.lit(0))), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))


def placed(hashes: Column) -> Column:
    """(hash, position), sorted, if any window occurs twice; else nothing."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def repeated_at(sorted_windows: Column) -> Column:
    """Sorted positions of the windows that occur twice or more."""

    def same(x, i):
        before, after = F.get(sorted_windows, i - 1)["h"], F.get(sorted_windows, i + 1)["h"]
        return before.eqNullSafe(x["h"]) | after.eqNullSafe(x["h"])

    return F.sort_array(F.transform(F.filter(sorted_windows, same), lambda x: x["i"]))


def covered(positions: Column, width: int = 3) -> Column:
    """Words that windows of ``width`` words at the given sorted positions cover."""
    own = F.transform(positions, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(positions, k + 1) - p, F.lit(width))))
    return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)


def n_of(text: Column, chars: str) -> Column:
    """How often the given characters occur in the text."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def char_counts(rare: Column) -> dict[str, Column]:
    """How many characters of each class but white space and all others.

    ``rare`` is the text without the runs of lower-case letters and blanks that make up most of it.
    """
    return {
        "n_upper": F.regexp_count(rare, F.lit("\\p{Lu}")),
        "n_digits": n_of(rare, "0123456789"),
        "n_punct": n_of(rare, ".,;:!?'\"()-"),
        "n_marks": n_of(rare, "#*$%&|<>@^~_=+/\\{}[]"),
    }


def char_histogram(n: Column, word_chars: Column) -> Column:
    """Shares of: upper case, digits, punctuation, symbols, white space, all other characters; from the columns of ``char_counts``."""
    space = n - word_chars
    rest = n - F.col("n_upper") - F.col("n_digits") - F.col("n_punct") - F.col("n_marks") - space
    return F.array(*[x / F.greatest(n, F.lit(1)) for x in (F.col("n_upper"), F.col("n_digits"), F.col("n_punct"), F.col("n_marks"), space, rest)])


def histograms(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``chars`` (array) and ``common`` ((word, share) array; ``""`` stands for all words that are not common)."""
    t = F.coalesce(F.col(text), F.lit(""))
    is_common = lambda w: w.isin(COMMON_WORDS)
    plain = lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))
    count = F.transform("distinct", lambda v: F.struct(v.alias("w"), (F.size("hits") - F.size(F.array_remove("hits", v))).alias("c")))
    others = F.struct(F.lit("").alias("w"), (F.col("n_words") - F.size("hits")).cast("int").alias("c"))
    # One step a column: an expression that is used inside a lambda would be worked out for each element.
    return (
        docs.withColumn("words", word_array(F.col(text)))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("rare", F.regexp_replace(t, "[a-z\\u00df-\\u00ff \\n]++", ""))
        .withColumns(char_counts(F.col("rare")))
        .withColumn("n_all", F.length(t))
        .withColumn("chars", char_histogram(F.col("n_all"), F.col("word_chars")))
        .withColumn("hits", F.filter(F.transform(F.filter("words", lambda w: F.length(w) <= MAX_COMMON), plain), is_common))
        .withColumn("distinct", F.array_distinct("hits"))
        .withColumn("counts", F.concat(count, F.array(others)))
        .withColumn("common", F.transform("counts", lambda x: F.struct(x["w"].alias("w"), (x["c"] / F.greatest(F.col("n_words"), F.lit(1))).alias("p"))))
        .withColumn("long_enough", (F.col("n_words") >= MIN_WORDS) & (F.col("n_all") >= MIN_CHARS))
        .drop("hits", "distinct", "counts", "n_upper", "n_digits", "n_punct", "n_marks", "n_all")
    )


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """As ``references_of`` for documents."""
    return references_of(histograms(docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")), "text"))


def references_of(counted: DataFrame) -> DataFrame:
    """One row per language, and one with ``whole`` for the corpus: mean histograms over its documents that are long enough, and word limits by length.

    ``counted`` has ``lang`` and the columns of ``histograms``.
    """
    each = counted.where("long_enough").withColumnRenamed("lang", "r_lang")
    # One pass: words as they are, character classes as "#0", "#1" .., the documents themselves as "#n".
    classes = F.transform("chars", lambda p, i: F.struct(F.concat(F.lit("#"), i.cast("string")).alias("w"), p.alias("p")))
    entries = F.concat("common", classes, F.array(F.struct(F.lit("#n").alias("w"), F.lit(1.0).alias("p"))))
    shares = each.select("r_lang", "n_words", F.explode(entries).alias("x")).select("r_lang", "x.w", "x.p", "n_words")
    # Sums of the shares, of their squares, and of their sampling variances as each document estimates them.
    moments = F.sum("p").alias("p"), F.sum(F.col("p") * F.col("p")).alias("pp"), F.sum(F.col("p") * (1 - F.col("p")) / (F.col("n_words") - 1)).alias("v")
    sums = cut_lineage(shares.groupBy("r_lang", "w").agg(*moments).withColumn("whole", F.lit(False)))
    corpus = sums.groupBy("w").agg(*[F.sum(c).alias(c) for c in ("p", "pp", "v")])
    corpus = corpus.select(F.lit(None).cast("string").alias("r_lang"), "w", "p", "pp", "v", F.lit(True).alias("whole"))
    as_map = F.map_from_entries(F.collect_list(F.struct("w", F.struct("p", "pp", "v").alias("s")))).alias("m")
    each_lang = sums.unionByName(corpus).groupBy("whole", "r_lang").agg(as_map).withColumn("n", F.element_at("m", "#n")["p"])
    prior = corpus.agg(as_map).select(F.col("m").alias("c"))  # one row

    def mean(w: Column, of: str) -> Column:
        own, usual = F.coalesce(F.element_at("m", w)[of], F.lit(0.0)), F.element_at("c", w)[of] / F.element_at("c", F.lit("#n"))["p"]
        return (own + MIN_REFERENCE * usual) / (F.col("n") + MIN_REFERENCE)

    def usual(w: Column) -> Column:
        between = F.greatest(mean(w, "pp") - mean(w, "p") * mean(w, "p") - mean(w, "v"), F.lit(0.0))
        return F.struct(w.alias("w"), mean(w, "p").alias("q"), between.alias("b"))

    words = F.transform(F.filter(F.map_keys("c"), lambda w: ~w.startswith("#")), usual)
    return (
        each_lang.crossJoin(F.broadcast(prior))
        .withColumn("words", words)
        .withColumn("r_chars", F.array(*[mean(F.lit(f"#{i}"), "p") for i in range(N_CLASSES)]))
        .withColumn("r_words", F.map_from_entries(F.transform("words", lambda x: F.struct(x["w"], x["q"]))))
        .withColumn("r_limits", word_limits(F.col("words")))
        .select("r_lang", "whole", "n", "r_chars", "r_words", "r_limits")
    )


def word_limits(words: Column) -> Column:
    """The greatest word distance that is not unusual for a text of ``MIN_WORDS * 2**(k / STEPS)`` words, k from 0.

    ``words`` has (w, q: mean share, b: variance of the share between documents).
    """

    def part(x: Column, n: Column) -> Column:
        # Var / (8 ln 2 q) for small deviations; q at most, for a word that a short text hardly ever has.
        var = x["q"] * (1 - x["q"]) / n + x["b"]
        return F.when(var > 0, var / (8 * math.log(2) * x["q"] + var / x["q"])).otherwise(F.lit(0.0))

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    common = F.filter(words, lambda x: x["w"] != "")
    total, squares = add(F.transform(common, lambda x: x["q"])), add(F.transform(common, lambda x: x["q"] * x["q"]))
    # Degrees of freedom: the effective number of common words. The root of a chi-square of k has the relative deviation 1 / sqrt(2k).
    freedom = F.when(squares > 0, total * total / squares).otherwise(F.lit(1.0))
    lengths = F.array(*[F.lit(float(MIN_WORDS) * 2 ** (k / STEPS)) for k in range(N_LIMITS)])
    return F.transform(lengths, lambda n: F.sqrt(add(F.transform(words, lambda x: part(x, n)))) * (1 + SIGMAS / F.sqrt(2 * freedom)))


def _js_arrays(p: Column, q: Column) -> Column:
    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _js_entries(p: Column, q: Column) -> Column:
    """As ``_js_arrays`` for the non-zero entries of ``p``; what ``q`` has besides counts in full."""

    def term(x):
        y = x["y"]
        m = (x["p"] + y) / 2
        return F.when(x["p"] > 0, x["p"] * F.log2(x["p"] / m) + F.when(y > 0, y * F.log2(y / m) - y).otherwise(F.lit(0.0))).otherwise(F.lit(0.0))

    both = F.transform(p, lambda x: F.struct(x["p"].alias("p"), F.coalesce(F.element_at(q, x["w"]), F.lit(0.0)).alias("y")))  # one look-up a word
    total = F.aggregate(F.transform(both, term), F.lit(1.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", refs: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) with the counts, ``base_failed``, both distances (null under the guards) and ``kept``."""
    held = [F.col(f"`{c}`") for c in keep if c.lower() not in OUTPUTS] if keep is not None else replaced(docs, OUTPUTS)
    packed = docs.select(F.struct(F.lit(True).alias("vr_in"), *held).alias("row"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in OUTPUTS]
    t = F.coalesce(F.col("text"), F.lit(""))
    path = shared_path(docs.sparkSession, "counted")
    (
        histograms(packed, "text")
        .withColumn("windows", windows(F.col("words")))
        .withColumn("placed", placed(F.col("windows")))
        .withColumn("starts", repeated_at(F.col("placed")))
        .withColumn("n_repeat_words", covered(F.col("starts")))
        .withColumn("n_symbols", n_of(F.col("rare"), SYMBOLS).cast("long"))
        .withColumn("n_dup_lines", dup_lines(t))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .drop("words", "rare", "windows", "placed", "starts", "text")
        .write.parquet(path)
    )
    counted = docs.sparkSession.read.parquet(path)
    refs = cut_lineage(references_of(counted) if refs is None else refs)
    per_lang = refs.where("not whole").select("r_lang", "r_chars", "r_words", "r_limits")
    whole = refs.where("whole").first()  # one row: a share per class and common word
    w_chars = F.array(*[F.lit(x) for x in (whole["r_chars"] if whole else [0.0] * N_CLASSES)])
    w_words = F.create_map(*[F.lit(x) for kv in (whole["r_words"] if whole else {"": 1.0}).items() for x in kv])
    w_limits = F.array(*[F.lit(x) for x in (whole["r_limits"] if whole else [1.0] * N_LIMITS)])
    few = per_lang.count() <= BROADCAST_LANGUAGES  # a few kB a language; more are joined as any other table
    joined = counted.join(F.broadcast(per_lang) if few else per_lang, F.col("lang").eqNullSafe(F.col("r_lang")), "left")
    chars, words = F.coalesce("r_chars", w_chars), F.coalesce("r_words", w_words)
    step = F.floor(STEPS * F.log2(F.col("n_words") / MIN_WORDS)) + 1  # the limit of the next lower length, so the wider one
    limit = F.element_at(F.coalesce("r_limits", w_limits), F.least(F.greatest(step, F.lit(1)), F.lit(N_LIMITS)).cast("int"))
    far = (F.col("char_distance") > MAX_CHAR_DISTANCE) | (F.col("word_distance") > limit)
    return (
        joined.withColumn("char_distance", F.when(F.col("long_enough"), _js_arrays(F.col("chars"), chars)))
        .withColumn("word_distance", F.when(F.col("long_enough"), _js_entries(F.col("common"), words)))
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
        # A generator is a barrier: a filter on ``kept`` would be pushed down otherwise, into the lambdas that it is made from.
        .select("row", F.inline(F.array(F.struct(*OUTPUTS))))
        .select(*[F.col(f"row.`{c}`").alias(c) for c in names], *OUTPUTS)
    )
