"""Personal data: base patterns as seeds, and bootstrapped contextual extraction around them.

Base spans (e-mail, IP, card and phone numbers) are found by regular expressions, with their places from the
pieces of the text between the matches. They are the seeds. Every identifier-like string of the corpus (a base match, or a
token with a digit) is an instance; the word before it, the word after it and its own first letters are its lexical patterns. On
the graph of patterns and instances, a pattern's confidence is the smoothed share of known instances in its distinct contexts
(instance and word on the other side, so copies of a text count once), and an unknown instance's score is the mean of its
patterns' confidences, its own contexts left out. A pattern with few known instances speaks against an instance if it goes with
the same ones over and over, as version numbers do; with ever new instances it says nothing. In each of ``ROUNDS`` rounds the instances that reach ``MIN_SCORE``, one of their patterns ``MIN_CONFIDENCE``, become known, and
the confidences are computed anew. What is known at the end, besides the seeds, becomes spans of kind ``id``.

The patterns that are confident by then also discover identifiers without a digit (names, handles): of all their places in
all texts, whatever token stands there, they must hold a known instance in the share ``MIN_CONFIDENCE``. A token with such
patterns on both sides is a span of kind ``id`` as well. Words of ordinary prose are no such patterns.

No texts are stored or moved: spans depend on the text alone and meet it by two hashes of it. They are broadcast
if few, otherwise joined. DataFrame expressions only.

Null texts count as empty and have no spans. Repeated rows are searched each. Extra columns pass through;
columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_under, let, packed, stored, unpacked

KINDS = ("email", "ip", "card", "phone")
ROUNDS, MIN_SCORE, MIN_CONFIDENCE, MIN_SUPPORT = 3, 0.55, 0.6, 3
SMOOTHING = 1.0
#: a pattern with at least so many instances per context goes with ever new ones
OPEN_CLASS = 0.5
#: below this share of known instances such a pattern says nothing
NO_DOUBT = 0.5
CONTEXT = 40
#: An e-mail or IP match can only begin where its run of characters begins or the last match ended: the
#: lookbehind keeps long runs from being tried at each character. A card run of under 13 digits is never valid.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be tried.
MARKS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TOKEN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
SPANS = "array<struct<start:bigint,end:bigint,match:string>>"


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str, match: str) -> str:
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return f"{match} rlike '^{part}([.]{part}){{3}}$'"
    digits = f"regexp_replace({match}, '[^0-9]+', '')"
    if kind == "card":
        return f"char_length({digits}) between 13 and 19 and luhn_check({digits})"
    return f"char_length({digits}) between 9 and 15" if kind == "phone" else "true"


def _starts(lengths: str) -> str:
    """Running sums of an array of longs, exclusive, as SQL text. In blocks of about the square root of the
    size, so that a text with very many matches does not cost the square of their number."""
    inside = "aggregate({0}, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + x)))"
    width = "cast(ceil(sqrt(size(l))) as int)"
    blocks = f"transform(sequence(0, size(l) - 1, greatest(1, {width})), b -> {inside.format(f'slice(l, b + 1, greatest(1, {width}))')})"
    totals = inside.format("transform(w, y -> element_at(y, -1))")
    joined = let(totals, "o", "flatten(transform(w, (y, i) -> transform(slice(y, 1, size(y) - 1), z -> z + o[i])))")
    return let(lengths, "l", f"if(size(l) = 0, cast(array() as array<bigint>), {let(blocks, 'w', joined)})")


def _matches(text: str, pattern: str) -> str:
    """SQL text: all matches with their places, and the pieces of text before and after each."""
    pieces, found = f"split({text}, {_sql(pattern)}, -1)", f"regexp_extract_all({text}, {_sql(pattern)}, 0)"
    lengths = "transform(m, (x, i) -> cast(char_length(p[i]) + char_length(x) as bigint))"
    one = "struct(s[i] + char_length(p[i]) as start, s[i] + char_length(p[i]) + char_length(x) as end, x as match, p[i] as before, p[i + 1] as after)"
    return let(pieces, "p", let(found, "m", let(_starts(lengths), "s", f"transform(m, (x, i) -> {one})")))


def base_spans(kind: str, text: str) -> Column:
    """Array of (start, end, match), code points, end exclusive."""
    plain = "x -> struct(x.start as start, x.end as end, x.match as match)"
    spans = f"transform(filter({_matches(text, PATTERNS[kind])}, x -> {_valid(kind, 'x.match')}), {plain})"
    return F.expr(f"if({text} rlike {_sql(MARKS[kind])}, {spans}, cast(array() as {SPANS}))")


def instances(text: str) -> Column:
    """Array of (start, end, name, seed, affix, left, right): identifier-like strings, whether they hold a base entity, their
    first letters and their neighbour words."""
    alternatives = [PATTERNS["email"], PATTERNS["phone"], PATTERNS["card"], TOKEN]
    seed = " or ".join(f"exists(regexp_extract_all(x.match, {_sql(p)}, 0), y -> {_valid(k, 'y')})" for k, p in PATTERNS.items())
    left = f"lower(regexp_extract(right(x.before, {CONTEXT}), '([\\\\p{{L}}]{{1,24}})[^\\\\p{{L}}]{{0,4}}$', 1))"
    right = f"lower(regexp_extract(left(x.after, {CONTEXT}), '^[^\\\\p{{L}}]{{0,4}}([\\\\p{{L}}]{{1,24}})', 1))"
    one = f"x -> struct(x.start as start, x.end as end, md5(cast(x.match as binary)) as name, {seed} as seed, regexp_extract(x.match, '^[^0-9]{{1,4}}', 0) as affix, {left} as left, {right} as right)"
    spans = f"transform({_matches(text, '|'.join(alternatives))}, {one})"
    return F.expr(f"if({text} rlike '[0-9@]', {spans}, cast(array() as array<struct<start:bigint,end:bigint,name:string,seed:boolean,affix:string,left:string,right:string>>))")


def _sides(*more: Column) -> Column:
    """``p``: the two patterns of an occurrence, each with the word on the other side, and ``more`` patterns."""
    sides = [F.struct(F.concat(F.lit(tag), own).alias("pattern"), F.col(other).alias("other")) for tag, own, other in (("L:", "left", "right"), ("R:", "right", "left"))]
    return F.explode(F.array(*sides, *more)).alias("p")


def bootstrap(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, patterns): unknown instances that confident patterns vouch for, and the confident patterns with their ``trust``.
    ``found`` has one row per occurrence (name, seed, affix, left, right)."""
    affix = F.struct(F.concat(F.lit("P:"), "affix").alias("pattern"), F.concat_ws(" ", "left", "right").alias("other"))
    contexts = found.select("name", "seed", _sides(affix)).select("name", "seed", "p.*").where(F.length("pattern") > 2)
    edges = stored(contexts.distinct().groupBy("pattern", "name").agg(F.max("seed").alias("seed"), F.count("*").alias("n")))
    known = edges.select("name").where("false")
    for _ in range(ROUNDS):
        told = edges.join(known.withColumn("known", F.lit(True)), "name", "left")
        told = told.withColumn("sure", F.when(F.col("seed") | F.coalesce("known", F.lit(False)), F.col("n")).otherwise(0))
        trust = stored(told.groupBy("pattern").agg(F.sum("sure").alias("all_sure"), F.sum("n").alias("support"), F.count("*").alias("names")).where(F.col("support") >= MIN_SUPPORT))
        # an instance does not testify on itself
        own = (F.col("all_sure") - F.col("sure")) / (F.col("support") - F.col("n") + SMOOTHING)
        heard = told.where(~F.col("seed")).join(trust, "pattern").withColumn("trust", own)
        heard = heard.where((F.col("trust") >= NO_DOUBT) | (F.col("names") < OPEN_CLASS * F.col("support")))
        scores = heard.groupBy("name").agg((F.sum(F.col("trust") * F.col("n")) / F.sum("n")).alias("score"), F.max("trust").alias("best"))
        known = stored(scores.where((F.col("score") >= MIN_SCORE) & (F.col("best") >= MIN_CONFIDENCE)).select("name"))
    confident = trust.withColumn("trust", F.col("all_sure") / (F.col("support") + SMOOTHING))
    return known, confident.where(F.col("trust") >= MIN_CONFIDENCE).select("pattern", "trust")


def _words(text: str) -> str:
    """SQL text: array of (left, right) of all tokens, in order; the words next to a token as in :func:`instances`."""
    left = "lower(regexp_extract(w[i - 1], '(\\\\p{L}{1,24})[^\\\\p{L}]{0,3}$', 1))"
    right = "lower(regexp_extract(w[i + 1], '^[^\\\\p{L}]{0,3}(\\\\p{L}{1,24})', 1))"
    one = f"struct(if(i = 0, '', {left}) as left, if(i = size(w) - 1, '', {right}) as right)"
    return let(f"regexp_extract_all({text}, '\\\\S+', 0)", "w", f"transform(w, (x, i) -> {one})")


def slot_spans(texts: DataFrame, patterns: DataFrame, found: DataFrame, names: DataFrame) -> DataFrame:
    """(k1, k2, start, end) of tokens, seeds excepted, between two patterns that hold known instances nearly wherever they occur."""
    sure = found.where("seed").select("left", "right").unionByName(found.where(~F.col("seed")).join(names, "name", "left_semi").select("left", "right"))
    hits = sure.select(_sides()).groupBy("p.pattern").agg(F.count("*").alias("hits"))
    tokens = texts.where(F.col("t") != "").select("k1", "k2", F.posexplode(F.expr(_words("t"))).alias("at", "w")).select("k1", "k2", "at", "w.*")
    places = tokens.select(F.explode(F.array(F.concat(F.lit("L:"), "left"), F.concat(F.lit("R:"), "right"))).alias("pattern"))
    totals = places.join(broadcast_under(stored(patterns)), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("places"))
    share = F.col("hits") / (F.col("places") + SMOOTHING)
    slots = stored(totals.join(hits, "pattern").select("pattern", share.alias("share")).where(F.col("share") >= MIN_CONFIDENCE))
    nothing = texts.select("k1", "k2", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end")).where("false")
    if slots.isEmpty():
        return nothing
    few = broadcast_under(slots)
    either = lambda tag: few.where(F.startswith("pattern", F.lit(tag))).select(F.substring("pattern", 3, 24).alias("left" if tag == "L:" else "right"))
    chosen = tokens.join(either("L:"), "left", "left_semi").join(either("R:"), "right", "left_semi").groupBy("k1", "k2").agg(F.collect_set("at").alias("chosen"))
    placed = texts.join(broadcast_under(stored(chosen), 200_000), ["k1", "k2"])
    core = "regexp_extract(x.match, '^[^\\\\p{L}\\\\p{N}]*(.*?)[^\\\\p{L}\\\\p{N}]*$', 1)"
    begin = "char_length(regexp_extract(x.match, '^[^\\\\p{L}\\\\p{N}]*', 0))"
    seed = " or ".join(f"exists(regexp_extract_all(x.match, {_sql(p)}, 0), y -> {_valid(k, 'y')})" for k, p in PATTERNS.items())
    one = f"x -> struct(x.start + {begin} as start, x.start + {begin} + char_length({core}) as end)"
    every = _matches("t", r"\S+")
    spans = f"transform(filter({let(every, 'm', 'transform(array_sort(chosen), i -> m[i])')}, x -> {core} <> '' and not ({seed})), {one})"
    return placed.select("k1", "k2", F.explode(F.expr(spans)).alias("s")).select("k1", "k2", "s.*")


def find_pii(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found`` and ``all_spans`` (kind, start, end)."""
    outputs = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_found", "all_spans"]
    source = docs.select(packed(docs, outputs, keep).alias("kept"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    named = source.withColumns({"k1": F.xxhash64("t"), "k2": F.hash("t")})
    texts = named.select("k1", "k2", "t")
    found = stored(texts.select("k1", "k2", F.explode(instances("t")).alias("i")).select("k1", "k2", "i.*"))
    names, patterns = bootstrap(found)
    by_context = found.where(~F.col("seed")).join(broadcast_under(names), "name", "left_semi").select("k1", "k2", "start", "end")
    extra = by_context.unionByName(slot_spans(texts, patterns, found, names))
    extra = stored(extra.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ids")))
    searched = named.select("kept", "k1", "k2", *[base_spans(k, "t").alias(k) for k in KINDS])
    joined = searched.join(broadcast_under(extra, 200_000), ["k1", "k2"], "left")
    lists = [f"transform({k}, x -> struct('{k}' as kind, x.start as start, x.end as end))" for k in KINDS]
    ids = "coalesce(transform(ids, x -> struct('id' as kind, x.start as start, x.end as end)), array())"
    joined = joined.withColumn("base", F.expr(f"concat({', '.join(lists)})")).withColumn("more", F.expr(ids))
    text = "array_join(transform({0}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    return joined.select(
        *unpacked(joined, "kept"),
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.expr(f"sha2(cast({text.format('base')} as binary), 256)").alias("base_sha256"),
        F.expr(text.format("concat(base, more)")).alias("spans"),
        F.size("more").cast("bigint").alias("n_found"),
        F.expr("concat(base, more)").alias("all_spans"),
    )


def masked(found: DataFrame, text: str = "text") -> Column:
    """The text of :func:`find_pii`'s rows with every span replaced by ``<kind>``; of overlapping spans the first (by start) names the place."""
    ordered = "array_sort(transform(all_spans, x -> struct(x.start as start, x.end as end, x.kind as kind)))"
    # spans merged where they overlap: (start, end, kind)
    merge = (
        "aggregate(slice(o, 2, size(o)), slice(o, 1, 1), (a, x) -> if(x.start < element_at(a, -1).end, "
        "concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, x.end) as end, element_at(a, -1).kind as kind))), "
        "concat(a, array(x))))"
    )
    t = f"`{text}`"
    part = f"concat(substring({t}, cast(if(i = 0, 0L, g[i - 1].end) + 1 as int), cast(x.start - if(i = 0, 0L, g[i - 1].end) as int)), '<', x.kind, '>')"
    tail = f"substring({t}, cast(element_at(g, -1).end + 1 as int))"
    body = let(ordered, "o", let(merge, "g", f"concat(array_join(transform(g, (x, i) -> {part}), ''), {tail})"))
    return F.expr(f"if({t} is null or size(all_spans) = 0, {t}, {body})")
