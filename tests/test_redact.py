import itertools
import random

import pytest
from pyspark.sql import functions as F

from quern.operators import redact


def spans_of(text, tokens, aggregate, legacy):
    """Specification: words in a row with one label (any label, if aggregated) are a span.

    It ends with its last word, at the word that brings another label, or, in the legacy form, with the
    unlabelled word after it or the text.
    """
    words = [t for t in tokens if t[0] < t[1]]
    runs = [(kind, list(run)) for kind, run in itertools.groupby(words, lambda t: bool(t[2] != "O") if aggregate else t[2])]
    spans = []
    for (kind, run), after in itertools.zip_longest(runs, runs[1:]):
        if kind in (False, "O"):
            continue
        end = run[-1][1]
        if after is None:
            end = len(text) if legacy else end
        elif after[0] not in (False, "O"):
            end = after[1][0][0]
        elif legacy:
            end = after[1][0][1]
        spans.append((run[0][0], end, run[0][2]))
    return spans


def masked(text, spans, aggregate):
    out, at = "", 0
    for start, end, label in spans:
        out += text[at:start] + ("[redacted]" if aggregate else f"[{label}]")
        at = end
    return out + text[at:]


def cases():
    rnd = random.Random(5)
    out = [("", []), ("abc", [(0, 0, "O"), (0, 3, "X")]), ("ab cd", [(0, 2, "X"), (3, 5, "Y")])]
    for _ in range(150):
        text, tokens, at = "", [(0, 0, "O")], 0
        for _ in range(rnd.randint(0, 9)):
            gap, word = " " * rnd.randint(0, 2), rnd.choice(["é", "ab", "xyz"])
            text += gap + word
            tokens.append((at + len(gap), at + len(gap) + len(word), rnd.choice(["O", "O", "X", "Y"])))
            at = len(text)
            if rnd.random() < 0.2:
                tokens.append((at, at, rnd.choice(["X", "O"])))
        out.append((text + " " * rnd.randint(0, 1), tokens))
    return out


@pytest.mark.parametrize("aggregate", [False, True])
@pytest.mark.parametrize("legacy", [False, True])
def test_merge_and_apply_match_the_specification(spark, aggregate, legacy):
    rows = [(i, text, tokens) for i, (text, tokens) in enumerate(cases())]
    df = spark.createDataFrame(rows, f"i int, text string, tokens {redact.TOKENS}")
    df = redact.merge_spans(df, "tokens", F.length("text"), "spans", aggregate, legacy)
    df = redact.apply_spans(df, "text", "spans", "masked", aggregate)
    for r in df.collect():
        _, text, tokens = rows[r["i"]]
        want = spans_of(text, tokens, aggregate, legacy)
        assert [tuple(s) for s in r["spans"]] == want
        assert r["masked"] == masked(text, want, aggregate)


TEXTS = ["", "   ", "no data here", "write a.b@c.de now", "a.b@c.de x@y.zz", "x@y.zz 10.1.2.3 end", "at end 555-1234",
         "4444333322221111!", "é 10.1.2.3\n\n555-1234\tfin ", "a@b.co", " ".join(["w"] * 700 + ["a@b.co", "10.0.0.1"] + ["é"] * 600)]


@pytest.mark.parametrize("aggregate", [False, True])
@pytest.mark.parametrize("legacy", [False, True])
def test_word_masking_equals_span_masking(spark, aggregate, legacy):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    df = redact.add_tokens(df, "text", "tokens")
    df = redact.merge_spans(df, "tokens", F.length("text"), "spans", aggregate, legacy)
    df = redact.apply_spans(df, "text", "spans", "a", aggregate)
    for r in redact.mask_words(df, "text", "b", aggregate, legacy).collect():
        text = TEXTS[r["i"]]
        assert [text[t["start"]:t["end"]] for t in r["tokens"]] == text.split()
        assert r["a"] == r["b"]
        want = spans_of(text, [tuple(t) for t in r["tokens"]], aggregate, legacy)
        assert r["a"] == masked(text, want, aggregate)


def test_redacted_text_has_no_labelled_word(spark, tiny):
    from quern.sources.tables import load
    out = redact.redact(load(spark, tiny, "documents"), "text", "text2")
    out = redact.add_tokens(out, "text2", "tokens")
    left = out.select(F.explode("tokens").alias("t")).where(F.col("t.label") != "O")
    assert left.count() == 0


def test_hint_covers_every_rule(spark, tiny):
    from quern.sources.tables import load
    docs = load(spark, tiny, "documents").select("text").union(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    any_rule = F.lit(False)
    for pattern in redact.RULES.values():
        any_rule = any_rule | F.col("text").rlike(pattern)
    assert docs.where(any_rule & ~redact.may_match(F.col("text"))).count() == 0


def test_custom_rules(spark):
    df = spark.createDataFrame([("ask Bob Bob today",)], "text string")
    out = redact.mask_words(df, "text", "out", rules={"NAME": "^Bob$"}).first()["out"]
    assert out == "ask [NAME] today"


def test_rules_with_at_signs_search_every_word(spark):
    df = spark.createDataFrame([("tell #secret and @name now",)], "text string")
    out = redact.mask_words(df, "text", "out", rules={"TAG": "(@|#)[a-z]+"}).first()["out"]
    assert out == "tell [TAG] and [TAG] now"
