"""Quality rules by distribution divergence, in DataFrame functions only.

Every document has two histograms: characters by class, and the common words of its language.  Each is compared by its
Jensen-Shannon distance with the reference of the language, which is summed over all its documents that are long enough.
Short documents are too noisy to compare, so each rule has a minimum length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.shared import WORD_PATTERN, staged

SPACES = r"[\x20\x09-\x0D]+"
#: Removed one after the other from the text without white space; what is left is the last class.
CLASSES = (("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("symbol", r"[#*$%&|<>]+"),
           ("punctuation", r"[.,;:!?'\"()-]+"), ("letter", r"\p{L}+"))
#: Common words by language; the histogram has a bin for each and one for all other words.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "as"),
    "de": ("der", "die", "und", "das", "ist", "von", "zu", "den", "mit", "sich", "ein", "auf"),
    "fr": ("le", "la", "les", "de", "des", "et", "que", "un", "une", "dans", "pour", "est"),
    "es": ("el", "los", "las", "que", "y", "del", "en", "por", "con", "una", "se", "su"),
}


#: Largest distances from the language's reference.
CLASS_LIMIT, WORD_LIMIT = 0.25, 0.24


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more; ``hashes`` are those of its windows in order."""
    twice = lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = _let(placed, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
    covered = _let(starts, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base measures and both histograms of every row; null text: no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), text.alias("t"))
    rows = rows.select("*", F.regexp_extract_all("t", F.lit(WORD_PATTERN), F.lit(0)).alias("w"), F.regexp_replace("t", SPACES, "").alias("c0"),
                       F.filter(F.split("t", "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0).alias("lines"))
    every = sorted({w for words in COMMON.values() for w in words})
    hashes = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    rows = rows.select("*", hashes.alias("h"), F.filter(F.transform("w", lambda x: F.lower(x)), lambda x: x.isin(every)).alias("known"))
    for k, (_, pattern) in enumerate(CLASSES):
        rows = rows.select("*", F.regexp_replace(f"c{k}", pattern, "").alias(f"c{k + 1}"))
    n = len(CLASSES)
    classes = F.array(*[(F.length(f"c{k}") - F.length(f"c{k + 1}")).cast("long") for k in range(n)], F.length(f"c{n}").cast("long"),
                      (F.length("t") - F.length("c0")).cast("long"))
    bins = lambda words: F.array(*[(F.size("known") - F.size(F.array_remove("known", w))).cast("long") for w in words])
    common = F.array().cast("array<long>")
    for lang, words in COMMON.items():
        common = F.when(F.col("lang") == lang, bins(words)).otherwise(common)
    symbol = [name for name, _ in CLASSES].index("symbol")
    return rows.select("doc_id", "lang", F.size("w").cast("long").alias("n_words"), F.length("c0").cast("long").alias("word_chars"),
                       (F.length(f"c{symbol}") - F.length(f"c{symbol + 1}")).cast("long").alias("n_symbols"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       repeated_words(F.col("w"), F.col("h")).alias("n_repeat_words"), classes.alias("classes"), common.alias("common"))


def _share(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of shares with the same bins."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    return F.sqrt(F.greatest(_sum(F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)), F.lit(0.0)))


def judged(docs: DataFrame, class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT, class_words: int = 50, word_words: int = 100) -> DataFrame:
    """Every row's base measures, base_failed, class_distance, word_distance and kept.

    base_failed: fewer than 50 words, or more than half of the words in repeated 3-word windows.  The class rule holds
    from ``class_words`` words on, the common-word rule from ``word_words`` on and in languages with a list of common
    words; a distance is null where its rule doesn't hold.  A null language is a language of its own.
    """
    rows = staged(measured(docs), "measured")
    other = F.col("n_words") - _sum("common")
    rows = rows.withColumn("common", F.when(F.size("common") > 0, F.concat("common", F.array(F.greatest(other, F.lit(0)).cast("long")))).otherwise(F.col("common")))
    bins = len(CLASSES) + 2
    words = max(len(w) for w in COMMON.values()) + 1
    long_enough = rows.where(F.col("n_words") >= class_words)
    sums = long_enough.groupBy("lang").agg(*[F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(bins)],
                                           *[F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(words)])
    vector = lambda k, n: F.array(*[F.coalesce(F.col(f"{k}{i}"), F.lit(0)) for i in range(n)])
    total = lambda k, n: sum((F.coalesce(F.col(f"{k}{i}"), F.lit(0)) for i in range(1, n)), F.coalesce(F.col(f"{k}0"), F.lit(0)))
    refs = staged(sums.select("lang", _share(vector("c", bins), total("c", bins)).alias("ref_classes"),
                              F.when(total("w", words) > 0, _share(vector("w", words), total("w", words))).alias("ref_common")), "references")
    rows = rows.join(refs, "lang", "left")
    class_distance = F.when((F.col("n_words") >= class_words) & F.col("ref_classes").isNotNull(),
                            distance(_share(F.col("classes"), _sum("classes")), F.col("ref_classes")))
    word_distance = F.when((F.col("n_words") >= word_words) & F.col("ref_common").isNotNull() & (F.size("common") > 0),
                           distance(_share(F.col("common"), F.col("n_words")), F.col("ref_common")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       class_distance.alias("class_distance"), word_distance.alias("word_distance"))
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= class_limit) & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit)
    return rows.withColumn("kept", ~F.col("base_failed") & fits)
