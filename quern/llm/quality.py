"""Quality rules: base rules on words and lines, then a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word unigrams and bigrams: that of the trusted documents
and that of the whole raw corpus.  A document's score is the mean log ratio of its n-grams, taken from the
counts of the half of the corpus that the document is not in; it is kept unless the score lies below the lower
fence of the trusted documents' scores, which are made in the same way.  DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import ensure_checkpoint_dir

SPACE = "[\\x20\\x09-\\x0D]+"
IN_WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
FEATURES = 1 << 16
SMOOTHING = 1.0
#: Parts of the corpus; each is scored by the counts of the others.
FOLDS = 2
#: Distances between the trusted scores' quartiles below the first of them at which rejection begins.
FENCE = 3.0
MIN_WORDS = 50
MAX_REPEAT = 50
COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def grams_of(words: Column, features: int = FEATURES) -> Column:
    """Hashed unigrams, then hashed bigrams, as numbers from 0 to ``features - 1``."""
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(features)).cast("int")
    one = F.transform(words, lambda w: bucket(w))
    two = F.transform(words, lambda w, i: bucket(w, F.get(words, i + 1)))
    return F.concat(one, F.slice(two, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))))


def repeat_words(words: Column, hashes: Column) -> Column:
    """Words that lie in a window of three which the text has twice or more.

    ``hashes`` are sorted numbers, one per window: its hash with the lowest 24 bits replaced by its place.
    Windows with equal hashes are compared word by word.
    """
    place = lambda x: x.bitwiseAND(F.lit((1 << 24) - 1)).cast("int")

    def same(x: Column, y: Column) -> Column:
        near = F.shiftright(x, 24) == F.shiftright(y, 24)
        for k in range(3):
            near = near & (F.get(words, place(x) + k) == F.get(words, place(y) + k))
        return F.coalesce(near, F.lit(False))

    held = F.filter(hashes, lambda x, i: same(x, F.get(hashes, i + 1)) | same(x, F.get(hashes, i - 1)))
    return F.array_sort(F.transform(held, place))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the words, the counts of the base rules, and the whole row as ``row``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(IN_WORD))
    first = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"), words_of(text).alias("words"),
        F.length(F.array_join(words_of(text), "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        with_word.alias("_lines"))
    words = F.col("words")
    windows = F.transform(words, lambda w, i: F.shiftleft(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), 24)
                          .bitwiseOR(i.cast("long")))
    second = first.withColumn("_windows", F.sort_array(
        F.slice(windows, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))))
    third = second.withColumn("_held", repeat_words(words, F.col("_windows")))
    held = F.col("_held")
    covered = F.aggregate(
        F.transform(held, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(held, i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return third.select(
        "row", "doc_id", "words", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"))


def fold_of(text: Column) -> Column:
    """The half of the corpus a text belongs to; equal texts are in one half."""
    return F.pmod(F.xxhash64(text, F.lit("half")), F.lit(FOLDS)).cast("int")


def gram_counts(docs: DataFrame, trusted: DataFrame, features: int = FEATURES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``fold, gram, n_raw, n_trusted`` over all documents; ``trusted`` has a row for each trusted ``doc_id``.

    Every document is counted in the raw multinomial, trusted ones in both.
    """
    ids = trusted.select(F.col(id_col).alias("_id"), F.lit(1).alias("_trusted")).dropDuplicates(["_id"])
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    marked = own.join(ids.hint("shuffle_hash"), F.col("doc_id") == F.col("_id"), "left")
    grams = marked.select("_trusted", fold_of(F.col("_text")).alias("fold"), words_of(F.col("_text")).alias("_words")) \
        .select("_trusted", "fold", F.explode(grams_of(F.col("_words"), features)).alias("gram"))
    return grams.groupBy("fold", "gram").agg(F.count(F.lit(1)).alias("n_raw"), F.count("_trusted").alias("n_trusted"))


def ratio_table(counts: DataFrame, features: int = FEATURES, smoothing: float = SMOOTHING) -> list[float]:
    """The log ratios that score each fold, one fold after the other; ``FOLDS * features`` rows come to the driver.

    A fold is scored by the counts of the other folds, so neither a document nor an equal copy of it, trusted or
    not, counts for or against itself, and trusted documents are judged as strictly as all others.
    """
    raw, trusted = ([[0] * features for _ in range(FOLDS)] for _ in range(2))
    for r in counts.collect():
        raw[r["fold"]][r["gram"]], trusted[r["fold"]][r["gram"]] = r["n_raw"], r["n_trusted"]
    out = []
    for fold in range(FOLDS):
        r, t = ([sum(x) for x in zip(*(part for k, part in enumerate(parts) if k != fold))] for parts in (raw, trusted))
        n_raw, n_trusted = sum(r) + smoothing * features, sum(t) + smoothing * features
        out += [round(math.log((y + smoothing) / n_trusted) - math.log((x + smoothing) / n_raw), 9) for x, y in zip(r, t)]
    return out


def score(docs: DataFrame, ratios: list[float], features: int = FEATURES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The counts, ``base_failed`` and ``llr`` of every row of ``docs``, and the row itself as ``row``."""
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")  # one literal
    base = measures(docs, id_col, text_col).withColumns({
        "_grams": grams_of(F.col("words"), features),
        "_start": fold_of(F.coalesce(F.col("row")[text_col], F.lit(""))) * features}).drop("words")
    total = F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.get(table, g + F.col("_start")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return base.withColumns({"llr": total / F.greatest(F.size("_grams"), F.lit(1)), "base_failed": failed}) \
        .drop("_grams", "_start")


def trusted_fence(scored: DataFrame, trusted: DataFrame, fence: float = FENCE, id_col: str = "doc_id") -> float:
    """The lower fence of the trusted documents' scores: first quartile less ``fence`` times the quartiles' distance.

    Quartiles are exact over all trusted rows past the base rules, of scores to four places, which bounds the
    values that the aggregate holds. Without any such row there is no fence (minus infinity).
    """
    ids = trusted.select(F.col(id_col).alias("_id")).dropDuplicates()
    held = scored.where(~F.col("base_failed")).select("doc_id", F.round("llr", 4).alias("llr")) \
        .join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    quarters = held.agg(F.percentile("llr", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).first()["q"]
    return quarters[0] - fence * (quarters[1] - quarters[0]) if quarters else -math.inf


def judge(docs: DataFrame, trusted: DataFrame, threshold: float | None, features: int, id_col: str, text_col: str,
          keep: list[str]) -> DataFrame:
    """``keep`` of the scored rows and ``kept``; scores are stored once, for the fence and for the verdict."""
    ensure_checkpoint_dir(docs.sparkSession)
    ratios = ratio_table(gram_counts(docs, trusted, features, id_col=id_col, text_col=text_col), features)
    scored = score(docs, ratios, features, id_col, text_col).select(*keep).checkpoint()
    if threshold is None:
        threshold = trusted_fence(scored, trusted, id_col=id_col)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, features: int = FEATURES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept`` per row.

    A row past the base rules is kept from ``threshold`` on, by default the lower fence of the trusted documents.
    A null or empty text has no words and fails the base rules.  Repeated rows are judged alike, each on its
    own; a null id is never trusted.  Without any trusted document the ratio still is defined (both
    multinomials are smoothed) and the base rules alone decide.  An empty table gives an empty table.
    """
    return judge(docs, trusted, threshold, features, id_col, text_col, [*COUNTS, "base_failed", "llr"])


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, features: int = FEATURES,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    judged = judge(docs, trusted, threshold, features, id_col, text_col, ["row", "doc_id", "base_failed", "llr"])
    return judged.where("kept").select("row.*")
