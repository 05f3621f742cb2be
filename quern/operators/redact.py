"""Masking of labelled words and spans in text.

A text is one row, so everything here works inside the row on arrays: no shuffle and no Python worker.
Intermediate arrays are columns of their own, so that none is computed twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTSIDE = "O"
WORD = "[^ \\t\\r\\n]+"
OFFSET_BLOCK = 256
TOKENS = "array<struct<start:int,end:int,label:string>>"

# Patterns a word is searched for, first match wins; RE2-safe (fixed values).
RULES = {
    "EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+",
    "IPADDRESS": "(^|[^0-9.])[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}([^0-9]|$)",
    "CREDITCARDNUMBER": "(^|[^0-9])[0-9]{16}([^0-9]|$)",
    "TELEPHONENUM": "(^|[^0-9])[0-9]{3}-[0-9]{4}([^0-9]|$)",
}
# Part of every match of RULES, quick to search for in prose.
HINT = "@|[0-9](?:[0-9]{15}|[0-9]{2}-[0-9]{4}|[.][0-9]{1,3}[.])"


def label_of(word: Column, rules: Mapping[str, str] = RULES) -> Column:
    out = None
    for label, pattern in rules.items():
        # every match of the built-in pattern has an @, which is quick to look for; other patterns may not
        test = word.contains("@") & word.rlike(pattern) if pattern == RULES["EMAIL"] else word.rlike(pattern)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(OUTSIDE))


def may_match(text: Column, rules: Mapping[str, str] = RULES) -> Column:
    """False only where no rule can match; lets most texts skip the word arrays.

    Other rules than RULES may be anchored to the word, so for them every text is looked at.
    """
    return text.rlike(HINT) if rules is RULES else text.isNotNull()


def label_words(text: Column, rules: Mapping[str, str] = RULES) -> Column:
    """``array<struct<gap, word, label>>``: every word, the blank text before it and its label."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    gaps = F.split(text, WORD, -1)
    return F.zip_with(F.slice(gaps, F.lit(1), F.size(gaps) - 1), words,
                      lambda g, w: F.struct(g.alias("gap"), w.alias("word"), label_of(w, rules).alias("label")))


def mask_words(df: DataFrame, text: str, out: str, aggregate: bool = False, legacy_end: bool = False,
               rules: Mapping[str, str] = RULES) -> DataFrame:
    """Replace every run of labelled words by one tag.

    Default: a change of label ends a run, tags are ``[LABEL]``.  ``aggregate``: labelled words in a row
    are one run whatever their labels, tag ``[redacted]``.  ``legacy_end`` lets a run swallow the
    unlabelled word after it, or the rest of the text when there is none.
    """
    outside = F.lit(OUTSIDE)
    source = F.col(text)
    df = df.withColumn("_items", F.when(may_match(source, rules), label_words(source, rules)))
    df = df.withColumn("_before", F.concat(F.array(outside), F.transform("_items", lambda x: x["label"])))

    def piece(x: Column, before: Column) -> Column:
        plain = F.concat(x["gap"], x["word"])
        if legacy_end:
            plain = F.when(before != outside, F.lit("")).otherwise(plain)
        tag = F.lit("[redacted]") if aggregate else F.concat(F.lit("["), x["label"], F.lit("]"))
        lead = F.when(before == outside, x["gap"]).otherwise(F.lit(""))
        begins = before == outside if aggregate else before != x["label"]
        return F.when(x["label"] == outside, plain).when(begins, F.concat(lead, tag)).otherwise(F.lit(""))

    pieces = F.zip_with("_items", F.slice("_before", F.lit(1), F.size("_items")), piece)
    tail = F.element_at(F.split(source, WORD, -1), -1)
    if legacy_end:
        tail = F.when(F.element_at("_before", -1) != outside, F.lit("")).otherwise(tail)
    masked = F.concat(F.array_join(pieces, ""), tail)
    return df.withColumn(out, F.when(F.col("_items").isNull(), source).otherwise(masked)).drop("_items", "_before")


def add_tokens(df: DataFrame, text: str, out: str, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Add ``array<struct<start, end, label>>`` of all words, offsets in characters from 0.

    Running offsets are made per block of words, then shifted by the block's start, so the copying that
    an array accumulator does stays linear in the text.
    """
    lengths = F.transform(label_words(F.col(text), rules), lambda x: F.struct(
        F.length(x["gap"]).alias("g"), F.length(x["word"]).alias("w"), x["label"].alias("label")))
    df = df.withColumn("_lengths", lengths)
    firsts = F.when(F.size("_lengths") > 0, F.sequence(F.lit(1), F.size("_lengths"), F.lit(OFFSET_BLOCK)))
    df = df.withColumn("_blocks", F.transform(firsts, lambda i: F.slice(F.col("_lengths"), i, F.lit(OFFSET_BLOCK))))
    sizes = F.transform("_blocks", lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x["g"] + x["w"]))
    df = df.withColumn("_starts", F.aggregate(sizes, F.array(F.lit(0)), lambda acc, s: F.concat(
        acc, F.array(F.element_at(acc, -1) + s))))

    def place(block: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast(TOKENS).alias("out"))
        return F.aggregate(block, empty, lambda acc, x: F.struct(
            (acc["at"] + x["g"] + x["w"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["g"]).alias("start"),
                                                  (acc["at"] + x["g"] + x["w"]).alias("end"),
                                                  x["label"].alias("label")))).alias("out")), lambda acc: acc["out"])

    placed = F.flatten(F.zip_with("_blocks", F.slice("_starts", F.lit(1), F.size("_blocks")), place))
    return (df.withColumn(out, F.coalesce(placed, F.array().cast(TOKENS)))
            .drop("_lengths", "_blocks", "_starts"))


def merge_spans(df: DataFrame, tokens: str, length: Column, out: str, aggregate: bool = False,
                legacy_end: bool = False) -> DataFrame:
    """Add the spans ``array<struct<start, end, label>>`` of tokens given in text order.

    The tokens may come from any labeller, for example a model.  Zero-length tokens are ignored.
    """
    outside = F.lit(OUTSIDE)
    none = F.array(F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"),
                            outside.alias("label")))
    real = F.transform(F.filter(tokens, lambda t: t["start"] < t["end"]), lambda t: F.struct(
        t["start"].cast("int").alias("start"), t["end"].cast("int").alias("end"), t["label"].alias("label")))
    df = df.withColumn("_real", real)
    size = F.size("_real")
    df = df.withColumn("_padded", F.concat(none, F.col("_real"), none))
    with_before = F.zip_with("_real", F.slice("_padded", F.lit(1), size), lambda t, b: F.struct(t.alias("t"), b.alias("b")))
    placed = F.zip_with(with_before, F.slice("_padded", F.lit(3), size),
                        lambda x, a: F.struct(x["t"].alias("t"), x["b"].alias("b"), a.alias("a")))
    df = df.withColumn("_hot", F.filter(placed, lambda x: x["t"]["label"] != outside))

    def joined(x: Column, y: Column) -> Column:
        return y["label"] != outside if aggregate else y["label"] == x["label"]

    def end(x: Column) -> Column:
        change = F.when(x["a"]["label"] != outside, x["a"]["start"])
        if legacy_end:
            return change.when(x["a"]["end"].isNull(), length.cast("int")).otherwise(x["a"]["end"])
        return change.otherwise(x["t"]["end"])

    firsts = F.transform(F.filter("_hot", lambda x: ~joined(x["t"], x["b"])), lambda x: x["t"])
    lasts = F.transform(F.filter("_hot", lambda x: ~joined(x["t"], x["a"])), end)
    spans = F.zip_with(firsts, lasts, lambda f, e: F.struct(f["start"].alias("start"), e.alias("end"),
                                                            f["label"].alias("label")))
    return df.withColumn(out, spans).drop("_real", "_padded", "_hot")


def apply_spans(df: DataFrame, text: str, spans: str, out: str, aggregate: bool = False) -> DataFrame:
    """Add the text with every span replaced by its tag; spans are in order and do not overlap."""
    source = F.col(text)
    ends = F.slice(F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"])), F.lit(1), F.size(spans))
    pieces = F.zip_with(spans, ends, lambda s, e: F.concat(
        F.substr(source, e + 1, s["start"] - e),
        F.lit("[redacted]") if aggregate else F.concat(F.lit("["), s["label"], F.lit("]"))))
    rest = F.coalesce(F.try_element_at(F.col(spans), F.lit(-1))["end"], F.lit(0))
    return df.withColumn(out, F.concat(F.array_join(pieces, ""), F.substr(source, rest + 1)))


def find_spans(df: DataFrame, text: str, keep: Sequence[str], aggregate: bool = False, legacy_end: bool = False,
               rules: Mapping[str, str] = RULES) -> DataFrame:
    """One row per masked span: ``keep, start, end, label``."""
    some = add_tokens(df.where(may_match(F.col(text), rules)), text, "_tokens", rules)
    merged = merge_spans(some, "_tokens", F.length(text), "_spans", aggregate, legacy_end)
    # The outer form: Spark would push "array not empty" of the plain one down as a second evaluation.
    return merged.select(*keep, F.inline_outer("_spans")).where(F.col("start").isNotNull())


def redact(df: DataFrame, text: str, out: str = "redacted_text", aggregate: bool = False,
           legacy_end: bool = False) -> DataFrame:
    """Record-level redaction with the rule labeller."""
    return mask_words(df, text, out, aggregate, legacy_end)
