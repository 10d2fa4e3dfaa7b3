"""Classification: phrase rules, prototype similarity and layout rules combined.

Every step adds columns to the same rows, so classifying a corpus is one
map-only pass: nothing is shuffled, and a document never leaves its task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketmill.functions import scoring
from docketmill.functions.sqltext import in_list
from docketmill.functions.text import fold_case, is_ascii, round_half_even, tokens, word_pairs, words
from docketmill.rules import DEFAULT_RULES, UNKNOWN, RuleSet, column_name

SCORE_KINDS = ("scores", "alias_scores", "tfidf_scores", "structural_scores")


def _struct(df: DataFrame, prefix: str, rules: RuleSet):
    return [F.col(prefix)[column_name(c)] for c in rules.categories]


def _named(values, rules: RuleSet):
    return F.struct(*[v.alias(column_name(c)) for v, c in zip(values, rules.categories)])


def _folded(docs: DataFrame, text: str) -> DataFrame:
    whole = F.col(text)
    folded = F.when(is_ascii(whole), F.lower(whole)).otherwise(fold_case(whole))
    return docs.withColumns({"_folded": folded, "_plain": is_ascii(whole)})


def _pattern_scores(table: dict, rules: RuleSet, text: str, words: str | None = None):
    return _named([
        F.expr(scoring.pattern_score(f"`{text}`", "_folded", "_plain", table.get(c, []), rules.cues, words))
        for c in rules.categories
    ], rules)


def alias_scores(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add `alias_scores`: one weight sum of phrase rules per category."""
    values = _pattern_scores(rules.phrase_rules, rules, text)
    return _folded(docs, text).withColumn("alias_scores", values).drop("_folded", "_plain")


def structural_scores(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add `structural_scores`: one weight sum of layout rules per category."""
    values = _pattern_scores(rules.layout_rules, rules, text)
    return _folded(docs, text).withColumn("structural_scores", values).drop("_folded", "_plain")


def tfidf_scores(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add `tfidf_scores`: cosine similarity to each category's prototype.

    The length of the document cancels out of the cosine, so plain counts are used.
    """
    return _tfidf_scores(docs.withColumn("_tokens", F.sort_array(tokens(F.col(text)))), rules)


def _tfidf_scores(df: DataFrame, rules: RuleSet) -> DataFrame:
    df = df.withColumns({
        "_known": scoring.known_tokens("_tokens", rules),
        "_repeated": scoring.repeats("_tokens"),
    })
    df = df.withColumns({
        "_square": scoring.squared_length("_tokens", "_repeated", "_known", rules),
        "_dots": scoring.dot_products("_known", rules),
    })
    cosines = [
        F.when(F.col("_square") > 0, dot / F.sqrt("_square")).otherwise(F.lit(0.0))
        for dot in _struct(df, "_dots", rules)
    ]
    return df.withColumn("tfidf_scores", _named(cosines, rules)).drop(
        "_tokens", "_known", "_repeated", "_square", "_dots")


def combined_scores(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add the three score kinds and their weighted combination `scores`."""
    cues = scoring.rule_words(rules)
    df = _folded(docs, text).withColumn("_words", words(F.col(text))).withColumns({
        "_cues": F.expr(f"filter(_words, w -> w IN {in_list(cues)})") if cues else F.lit(None),
        "_tokens": F.sort_array(F.concat("_words", word_pairs(F.col("_words")))),
    }).drop("_words")
    df = df.withColumns({
        "alias_scores": _pattern_scores(rules.phrase_rules, rules, text, "_cues"),
        "structural_scores": _pattern_scores(rules.layout_rules, rules, text, "_cues"),
    }).drop("_folded", "_plain", "_cues")
    df = _tfidf_scores(df, rules)
    alias, tfidf, layout = (
        scoring.share_of_best(_struct(df, kind, rules))
        for kind in ("alias_scores", "tfidf_scores", "structural_scores")
    )
    combined = [
        F.lit(rules.phrase_weight) * a + F.lit(rules.tfidf_weight) * t + F.lit(rules.layout_weight) * s
        for a, t, s in zip(alias, tfidf, layout)
    ]
    return df.withColumn("scores", _named(combined, rules))


def classify(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add `category`, `best_match`, `confidence` and the four rounded score structs.

    The category is `Unknown` when the best score or its lead is too small; both
    tests use unrounded scores.
    """
    df = combined_scores(docs, rules, text)
    scores = _struct(df, "scores", rules)
    top, second = scoring.best_two(scores)
    df = df.withColumns({"_top": top, "_second": second})
    df = df.withColumn("best_match", scoring.named_best(scores, F.col("_top"), rules.categories))
    lead = F.col("_top") - F.col("_second")
    weak = (F.col("_top") < F.lit(rules.min_top_score)) | (lead < F.lit(rules.min_margin))
    return df.withColumns({
        "category": F.when(weak, F.lit(UNKNOWN)).otherwise(F.col("best_match")),
        "confidence": round_half_even(lead),
        **{kind: _named([round_half_even(v) for v in _struct(df, kind, rules)], rules) for kind in SCORE_KINDS},
    }).drop("_top", "_second")


def flat_scores(docs: DataFrame, kinds=SCORE_KINDS, rules: RuleSet = DEFAULT_RULES) -> list:
    """Score structs as plain columns, e.g. `tfidf_invoice`, for reports."""
    out = []
    for kind in kinds:
        prefix = kind.removesuffix("_scores").removesuffix("scores")
        for c in rules.categories:
            name = f"{prefix}_{column_name(c)}" if prefix else f"score_{column_name(c)}"
            out.append(F.col(kind)[column_name(c)].alias(name))
    return out


def category_counts(classified: DataFrame) -> DataFrame:
    """Documents per category; partial counts are merged, so a common category costs nothing extra."""
    return classified.groupBy("category").agg(F.count(F.lit(1)).alias("documents"))
