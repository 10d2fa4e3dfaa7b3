"""Sentence splitting, scoring and extractive summaries; all map-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketmill.functions import summary as S
from docketmill.functions import text as T
from docketmill.operators.rows import elements
from docketmill.rules import DEFAULT_RULES, RuleSet


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per kept sentence: `(key, sent_no, sentence)`, numbered from 0."""
    return elements(docs, [key], T.sentences(F.col(text)), "sentence", "sent_no")


def summary_tokens(
    docs: DataFrame, rules: RuleSet = DEFAULT_RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per word that counts in a kept sentence: `(key, sent_no, token)`."""
    listed = docs.select(key, T.sentences(F.col(text)).alias("_sentences"))
    found = S.token_occurrences("_sentences", rules)
    return elements(listed, [key], found, "o").select(
        key, F.col("o.sent").alias("sent_no"), F.col("o.token").alias("token"))


def sentence_scores(
    docs: DataFrame, rules: RuleSet = DEFAULT_RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per sentence with tokens: `(key, sent_no, score, words)`."""
    listed = docs.select(key, T.sentences(F.col(text)).alias("_sentences"))
    scores = S.sentence_scores(S.token_occurrences("_sentences", rules))
    return elements(listed, [key], scores, "s").select(
        key, F.col("s.sent").alias("sent_no"), F.col("s.score").alias("score"), F.col("s.words").alias("words"))


def summarize(
    docs: DataFrame, num_sentences: int = 3, rules: RuleSet = DEFAULT_RULES, text: str = "text"
) -> DataFrame:
    """Add `summary`: the best `num_sentences` sentences in document order."""
    df = docs.withColumn("_sentences", T.sentences(F.col(text)))
    # Short texts keep every sentence; do not score them.
    scores = F.when(
        F.size("_sentences") > num_sentences, S.sentence_scores(S.token_occurrences("_sentences", rules))
    )
    df = df.withColumn("_scores", F.coalesce(scores, F.array().cast("array<struct<sent:int,score:double,words:int>>")))
    out = S.top_sentences(F.col("_sentences"), F.col("_scores"), num_sentences)
    return df.withColumn("summary", out).drop("_sentences", "_scores")
