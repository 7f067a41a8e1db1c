"""Quality rules by distribution divergence.

Each text gives a histogram of character classes and one of the corpus' most common short words. Both are compared to language references,
learned from all documents of a language, by Jensen-Shannon distance. A text is
dropped if even its nearest reference is too far away, and only if it is long enough for the histogram to
mean something (``min_chars`` for characters, ``min_words`` for words). How far words can be at all depends on the
reference, so their distance counts as a share of the one that a text with no common word has to it. Built from DataFrame expressions only.

Null texts have no words and fail the base rules, as empty ones do. Without any reference the base rules decide
alone. Documents without language train no reference but are judged. Extra columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_text, let, packed, stored, unpacked

WINDOW_WORDS = 8
BLANK = r"[\\x20\\x09-\\x0D]"
#: What to delete from a text to keep one class of characters. Blanks are counted with the words; control characters are one
#: more class, which is what these leave of the text's length.
CLASSES = {
    "lower": "[^a-z]+",
    "upper": "[^A-Z]+",
    "digit": "[^0-9]+",
    "stop": "[^.,;:?\\\\x27\\\\x22()-]+",
    "symbol": "[^!#*$%&|<>@=~^_+/{}\\\\[\\\\]\\\\\\\\]+",
    "letter": "[\\\\x00-\\\\x7F]+",
}
MIN_CHARS, MIN_WORDS = 200, 40
LEAST_DOCS, LEAST_WORDS = 3, 300
MAX_CHAR_DISTANCE = 0.27
#: Largest word distance, as a share of the one that a text with no common word has: from 100 words on, and for shorter
#: texts, where a clean one can have few common words by chance.
SURE_WORDS, MAX_WORD_SHARE, MAX_SHORT_SHARE = 100, 0.8, 0.99
COMMON_WORDS, COMMON_LENGTH = 24, 6


def repeated_words(words: str) -> str:
    """SQL text: how many words lie in windows of ``WINDOW_WORDS`` that occur more than once, the first included. Equal windows
    are found by sorting 64-bit hashes within the row; rows without a repeated hash skip the sort."""
    n = WINDOW_WORDS
    hashes = f"if(size(w) < {n}, cast(array() as array<bigint>), transform(sequence(1, size(w) - {n - 1}), i -> xxhash64(slice(w, i, {n}))))"
    ordered = "array_sort(transform(h, (x, i) -> struct(x as h, i as i)))"
    places = "array_sort(transform(filter(s, (x, k) -> get(s, k - 1).h <=> x.h or get(s, k + 1).h <=> x.h), x -> x.i))"
    covered = f"aggregate(transform(p, (x, k) -> cast(least({n}, coalesce(get(p, k + 1) - x, {n})) as bigint)), 0L, (a, x) -> a + x)"
    found = let(ordered, "s", let(places, "p", covered))
    return let(words, "w", let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {found})"))


def with_counts(docs: DataFrame, text: str = "t") -> DataFrame:
    """Adds the base columns ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    lines = f"filter(split({text}, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"
    step = docs.select("*", F.expr(f"array_remove(split({text}, '{BLANK}+'), '')").alias("words"))
    step = step.select(
        "*",
        F.expr("cast(size(words) as bigint)").alias("n_words"),
        F.expr("cast(char_length(array_join(words, '')) as bigint)").alias("word_chars"),
        F.expr(f"cast(char_length(regexp_replace({text}, '[^#*$%&|<>]+', '')) as bigint)").alias("n_symbols"),
        F.expr(let(lines, "l", "cast(size(l) - size(array_distinct(l)) as bigint)")).alias("n_dup_lines"),
        F.expr(repeated_words("words")).alias("n_repeat_words"),
    ).drop("words")
    return step.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def class_counts(text: str = "t", blanks: str | None = None) -> str:
    """SQL text: characters of each class, then blanks and what is of no class, as an array of doubles. Most of a text is
    lower-case letters and spaces, so only what is left without them is searched for the other classes."""
    controls = "char_length(regexp_replace(rest, '[^\\\\x09-\\\\x0D]+', ''))"
    spaces = f"octet_length({text}) - octet_length(replace({text}, ' ', ''))" if blanks is None else f"{blanks} - {controls}"
    parts = [f"char_length(regexp_replace(rest, '{drop}', ''))" for name, drop in CLASSES.items() if name != "lower"]
    lower = f"char_length({text}) - char_length(rest) - sp"
    listed = let(spaces, "sp", f"transform(array({lower}, {', '.join(parts)}, sp + {controls}), x -> cast(x as double))")
    counted = let(listed, "a", f"concat(a, array(cast(char_length({text}) as double) - aggregate(a, 0D, (s, x) -> s + x)))")
    return let(f"regexp_replace({text}, '[a-z ]+', '')", "rest", counted)


def plain_words(text: str = "t") -> str:
    """SQL text: lower-cased runs of letters."""
    return f"array_remove(split(lower({text}), '[^\\\\p{{L}}]+'), '')"


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[list[float], dict[str, float]]]:
    """Per language: shares of the character classes, and shares of its ``COMMON_WORDS`` most frequent words of at
    most ``COMMON_LENGTH`` letters, over all documents of the language. Every language of the table with ``LEAST_DOCS`` documents and
    ``LEAST_WORDS`` words has one, so no text is its own reference; a row and ``COMMON_WORDS`` words of each reach the driver."""
    known = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`").cast("string").alias("lang"), as_text(text).alias("t"))
    width = len(CLASSES) + 2
    by_class = known.select("lang", F.expr(class_counts()).alias("c")).groupBy("lang").agg(F.count("*").alias("docs"), *[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(width)])
    classes = by_class.where(F.col("docs") >= LEAST_DOCS).orderBy(F.desc("docs"), "lang").collect()
    if not classes:
        return {}
    words = known.select("lang", F.explode(F.expr(plain_words())).alias("word"))
    short = F.when(F.char_length("word") <= COMMON_LENGTH, F.col("word"))  # longer words count in the total only
    counts = stored(words.groupBy("lang", short.alias("word")).agg(F.count("*").alias("n")))
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.where(F.col("word").isNotNull()).withColumn("k", F.row_number().over(order)).where(F.col("k") <= COMMON_WORDS)
    common: dict[str, dict[str, float]] = {}
    for r in top.orderBy("lang", "k").collect():
        common.setdefault(r.lang, {})[r.word] = r.n / totals[r.lang]
    out = {}
    for r in classes:
        sums = [float(r[f"c{i}"] or 0) for i in range(width)]
        if sum(sums) and totals.get(r.lang, 0) >= LEAST_WORDS:
            out[r.lang] = ([x / sum(sums) for x in sums], common.get(r.lang, {}))
    return out


def js_distance(p: str, q: str) -> str:
    """SQL text: Jensen-Shannon distance (base 2) of two arrays of shares."""
    part = "if(p > 0, p * log2(2 * p / (p + q)), 0D) + if(q > 0, q * log2(2 * q / (p + q)), 0D)"
    return f"sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (p, q) -> {part}), 0D, (a, x) -> a + x) / 2))"


def no_word_distance(common: dict[str, float]) -> float:
    """Distance of a text with none of the words to a reference with these shares; it depends on their sum only."""
    s = sum(common.values())
    rest = 1 - s
    return math.sqrt(max(0.0, (math.log2(2 / (1 + rest)) + s + (rest * math.log2(2 * rest / (1 + rest)) if rest > 0 else 0.0)) / 2))


REFERENCES = "array<struct<classes:array<double>,places:array<int>,shares:array<double>,alone:double>>"


def reference_table(spark: SparkSession, references: dict) -> tuple[DataFrame, list[str]]:
    """One row with all references in the array ``_refs``, and the vocabulary that their ``places`` count in."""
    vocabulary = sorted({w for _, words in references.values() for w in words})
    place = {w: i for i, w in enumerate(vocabulary)}
    rows = []
    for classes, common in references.values():
        shares = [*common.values(), max(0.0, 1 - sum(common.values()))]
        rows.append((classes, [place[w] for w in common], shares, no_word_distance(common) if common else None))
    return spark.createDataFrame([(rows,)], f"_refs {REFERENCES}"), vocabulary


def _occurrences(word: str) -> str:
    """SQL text: how often ``word`` stands in ``j``, the words that matter, each between blanks of its own."""
    size = len(word.encode()) + 2
    return f"cast((octet_length(j) - octet_length(replace(j, ' {word} ', ''))) div {size} as double)"


def _distances(vocabulary: list[str], text: str) -> str:
    """SQL text: struct of the distances to the nearest reference in ``_refs`` and whether they are too far."""
    listed = ", ".join(f"'{w}'" for w in vocabulary)
    inside = f"filter(w, x -> x in ({listed}))" if vocabulary else "w"
    joined = "concat(' ', array_join(m, '  '), ' ')"
    counts = let(joined, "j", f"array({', '.join(_occurrences(v) for v in vocabulary)})") if vocabulary else "array(0D)"
    nearest = f"array_min(transform(_refs, r -> {js_distance('p', 'r.classes')}))"
    mine = "concat(transform(r.places, i -> k[i] / greatest(n, 1)), array(1D - aggregate(r.places, 0D, (a, i) -> a + k[i]) / greatest(n, 1)))"
    of_words = f"transform(filter(_refs, r -> r.alone is not null), r -> struct({js_distance(mine, 'r.shares')} as d, r.alone as alone))"
    share = "array_min(transform(dws, x -> x.d / x.alone))"
    far = f"(s >= {MIN_CHARS} and dc > {MAX_CHAR_DISTANCE}D) or (n >= {MIN_WORDS} and coalesce({share}, 0D) > if(n >= {SURE_WORDS}, {MAX_WORD_SHARE}D, {MAX_SHORT_SHARE}D))"
    body = let(of_words, "dws", f"struct(dc as char_distance, array_min(dws.d) as word_distance, {far} as far)")
    body = let("transform(c, x -> x / greatest(s, 1D))", "p", let(nearest, "dc", body))
    body = let(class_counts(text, "n_chars_of_t - word_chars"), "c", let("aggregate(c, 0D, (a, x) -> a + x)", "s", body))
    body = let("cast(size(w) as double)", "n", let(inside, "m", let(counts, "k", body)))
    return let(plain_words(text), "w", body)


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns with the base columns, ``char_distance`` and ``word_distance`` to the nearest reference, and ``kept``."""
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    own = packed(docs, [*base, "char_distance", "word_distance", "kept"]).alias("own")
    references = language_references(docs, text, lang)
    counted = with_counts(docs.select(own, as_text(text).alias("t"))).withColumn("n_chars_of_t", F.char_length("t"))
    if references:
        table, vocabulary = reference_table(docs.sparkSession, references)
        judged = counted.crossJoin(F.broadcast(table)).withColumn("d", F.expr(_distances(vocabulary, "t")))
    else:
        none = "struct(cast(null as double) as char_distance, cast(null as double) as word_distance, false as far)"
        judged = counted.withColumn("d", F.expr(none))
    return judged.select(*unpacked(judged, "own"), *base, "d.char_distance", "d.word_distance", F.expr("not base_failed and not d.far").alias("kept"))
