"""Quality rules by distribution divergence.

Each document is compared with references of its language: the histogram of its
character classes and the histogram of the language's common words (with one
class for all other words).  A reference is the mean histogram of the documents
of the language that a labelled table calls good (quality 1) and that are long
enough to be judged; junk, however common, is in no reference.  The distance is
the Jensen-Shannon distance to base 2 (0 to 1).  Texts shorter than the guards
are not judged by it, since a histogram of a few words says little; the base
rules (too few words, too many repeated 8-word windows) hold for every text.
Where no document is known to be good, no text long enough to be judged is kept.

Only DataFrame and SQL functions are used, all within the row except for the
means by language, which are summed map-side, and a semi-join with the labelled
ids on narrow rows.

Rows: null text has no words (and so fails the base rules); an unknown or null
language is judged by its character classes against the mean of all languages;
repeated rows are rows of their own; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.session import stage

# The commonest words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "on", "with", "as", "are", "be", "by", "this", "was", "or", "an", "it", "from"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "im", "für", "auf", "des", "ein", "dem", "nicht", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "les", "et", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "pas", "au", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "las", "un", "por", "con", "una", "para", "es", "al", "lo", "como", "más", "se"],
}
N_COMMON = 20
#: White space of the word rule, for regular expressions of Java.
SPACE = r"[\x20\x09-\x0D]"

MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.35, 0.8

# Words of 8-word windows that are found twice or more.  A window's hash is made
# of those of its halves, so that no window is copied.  array(x) with transform
# binds x to a name, so that each array is made once.
_JOINED = "zip_with({0}, slice({0}, {1} + 1, size({0})), (a, b) -> xxhash64(a, b))"
_REPEATED = f"""
transform(array(transform(w, x -> xxhash64(x))), h1 ->
  transform(array({_JOINED.format("h1", 1)}), h2 ->
  transform(array({_JOINED.format("h2", 2)}), h4 ->
  transform(array(slice({_JOINED.format("h4", 4)}, 1, size(h1) - 7)), g ->
    CASE WHEN size(array_distinct(g)) = size(g) THEN 0L ELSE
      transform(array(array_sort(transform(g, (h, i) -> struct(h, i)))), s ->
        transform(array(array_sort(array_distinct(flatten(
            zip_with(s, slice(s, 2, size(s)), (a, b) -> CASE WHEN a.h = b.h THEN array(a.i, b.i) ELSE CAST(array() AS array<int>) END))))), p ->
          aggregate(zip_with(p, slice(p, 2, size(p) + 1), (a, b) -> CAST(coalesce(least(8, b - a), 8) AS bigint)), 0L, (t, x) -> t + x))[0])[0]
    END)[0])[0])[0])[0]
"""


def _base(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("t"))
    words = f"array_remove(split(t, '{SPACE}+'), '')".replace("\\", "\\\\")
    found = rows.withColumn("m", F.expr(f"""transform(array({words}), w -> struct(
        CAST(size(w) AS bigint) AS n_words,
        CASE WHEN size(w) < 9 THEN 0L ELSE {_REPEATED} END AS n_repeat_words))[0]"""))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    # What is left without lower-case letters, then without white space, is short.
    found = (found.withColumn("r1", F.regexp_replace("t", "[a-z]+", "")).withColumn("r2", F.regexp_replace("r1", f"{SPACE}+", ""))
             .withColumn("lines", lines))
    gone = lambda col, pattern: F.length(col) - F.length(F.regexp_replace(col, pattern, ""))
    symbols = gone("r2", r"[#*$%&|<>]+")
    upper, digits, marks, beyond = gone("r2", "[A-Z]+"), gone("r2", "[0-9]+"), gone("r2", r"[.,;:!?'\"()\[\]-]+"), gone("r2", r"[^\x00-\x7F]+")
    rest = F.length("r2")
    classes = F.array(F.length("t") - F.length("r1"), upper, digits, F.length("r1") - rest, marks, symbols, beyond,
                      rest - upper - digits - marks - symbols - beyond)
    return found.select(
        "doc_id", "lang", "t", F.col("m.n_words").alias("n_words"), (F.length("t") - F.length("r1") + rest).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.col("m.n_repeat_words").alias("n_repeat_words"), F.length("t").alias("n_chars"), classes.alias("classes"))


def _common(lang: Column, t: Column) -> tuple[Column, Column]:
    """The text with its words set apart, and the counts of the language's
    common words in it (to be added as ``spread`` first)."""
    spread = F.concat(F.lit(" "), F.regexp_replace(F.lower(t), r"[^\p{L}]+", "  "), F.lit(" "))

    chosen = None
    for code, common in COMMON_WORDS.items():
        words = F.array(*map(F.lit, common))
        chosen = F.when(lang == code, words) if chosen is None else chosen.when(lang == code, words)
    # Words stand between two spaces each, so " the " never overlaps another.
    # One expression for all words: a copy for each word of each language makes
    # methods that are too long for the JVM's compilers.
    gone = lambda n, spaced: (n - F.octet_length(F.replace(F.col("spread"), spaced, F.lit("")))) / F.octet_length(spaced)
    counts = F.transform(F.array(F.octet_length("spread")), lambda n: F.transform(chosen, lambda w: gone(n, F.concat(F.lit(" "), w, F.lit(" "))).cast("int")))
    return spread, counts[0]


def histograms(docs: DataFrame) -> DataFrame:
    """Base figures of each document with its two histograms (shares)."""
    base = _base(docs)
    spread, chosen = _common(F.col("lang"), F.col("t"))
    base = base.withColumn("spread", spread).withColumn("common", chosen).drop("t", "spread")
    share = lambda c: f"transform(array(greatest(1, aggregate({c}, 0, (a, x) -> a + x))), s -> transform({c}, x -> x / CAST(s AS double)))[0]"
    return (base.withColumn("common", F.expr("CASE WHEN common IS NOT NULL THEN concat(common, array(greatest(0, CAST(n_words AS int) - aggregate(common, 0, (a, x) -> a + x)))) END"))
            .withColumn("p_chars", F.expr(share("classes"))).withColumn("p_words", F.expr(share("common"))).drop("classes", "common"))


def references(rows: DataFrame, labels: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """Mean histograms of the good documents by known language, and of all under
    the empty name: one row for each entry of ``COMMON_WORDS`` and one more at most.

    ``labels``: (doc_id, quality); an id that is called both good and poor is poor."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    long_enough = rows.select("doc_id", "lang", "n_chars", "n_words", "p_chars", "p_words").join(good, "doc_id", "left_semi").where((F.col("n_chars") >= min_chars) & (F.col("n_words") >= min_words))
    # A row for each entry of a histogram: an aggregate of each entry beside the
    # others is as long, in generated code and in its buffers, as all of them.
    entries = (long_enough.where(F.col("lang").isin(list(COMMON_WORDS)))
               .select(F.col("lang").alias("ref"), F.posexplode(F.concat("p_chars", "p_words")).alias("k", "p")))
    means = entries.groupBy("ref", "k").agg(F.avg("p").alias("q"), F.count("*").alias("weight"))
    known_lang = (means.groupBy("ref").agg(F.array_sort(F.collect_list(F.struct("k", "q"))).alias("e"), F.max("weight").alias("weight"))
                  .select("ref", F.slice("e.q", 1, 8).alias("q_chars"), F.slice("e.q", 9, N_COMMON + 1).alias("q_words"), "weight"))
    every = known_lang.agg(F.when(F.count("*") > 0, F.array(*[F.sum(F.col("q_chars")[k] * F.col("weight")) / F.sum("weight") for k in range(8)])).alias("q_chars"))
    codes = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in [*COMMON_WORDS, ""]])).alias("ref"))
    # A language without good documents is judged by the characters of all others.
    return codes.join(known_lang, "ref", "left").select("ref", F.coalesce("q_chars", every.scalar()).alias("q_chars"), "q_words")


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two histograms, to base 2."""
    term = "(CASE WHEN {0} > 0 THEN {0} * log2({0} / ((a + b) / 2)) ELSE 0D END)"
    return F.expr(f"sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (a, b) -> ({term.format('a')} + {term.format('b')}) / 2), 0D, (t, x) -> t + x)))")


def judge(docs: DataFrame, labels: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, max_chars: float = MAX_CHAR_DISTANCE, max_words: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Base figures, distances (null where a guard or a missing reference keeps
    the text from being judged) and the verdict of every document."""
    rows = stage(histograms(docs), "histograms")
    ref = F.broadcast(references(rows, labels, min_chars, min_words))
    known = F.when(F.col("lang").isin(list(COMMON_WORDS)), F.col("lang")).otherwise("")
    found = rows.withColumn("ref", known).join(ref, "ref", "left")
    found = (found.withColumn("char_distance", F.when(F.col("n_chars") >= min_chars, distance("p_chars", "q_chars")))
             .withColumn("word_distance", F.when((F.col("n_words") >= min_words), distance("p_words", "q_words")))
             .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))
    # Long enough to be judged, and nothing to judge by.
    unknown = (F.col("n_chars") >= min_chars) & (F.col("n_words") >= min_words) & F.col("q_chars").isNull()
    far = F.coalesce(F.col("char_distance") > max_chars, F.lit(False)) | F.coalesce(F.col("word_distance") > max_words, F.lit(False)) | unknown
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
