"""Extractive summary of one document, as an expression over its sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketmill.functions.sqltext import in_list, quoted
from docketmill.functions.text import SUMMARY_WORD, bind, runs, spelled
from docketmill.rules import RuleSet


def token_occurrences(sentences: str, rules: RuleSet) -> Column:
    """`(token, sent)` for every word of the sentences that counts: lower case, at
    least three letters, not a stopword."""
    return F.expr(f"""
        flatten(transform({sentences}, (s, i) -> transform(
            filter(
                transform(regexp_extract_all(s, {quoted(spelled(SUMMARY_WORD))}, 0), w -> lower(w)),
                t -> length(t) > 2 AND t NOT IN {in_list(sorted(rules.stopwords))}),
            t -> named_struct('token', t, 'sent', i))))""")


def sentence_scores(occurrences: Column) -> Column:
    """`(sent, score, words)` of every sentence with at least one token, in order.

    The score is the mean document frequency of the sentence's tokens: a whole
    number divided by a whole number, so equal scores compare as equal.  Dividing
    by the document's largest frequency would not change the order.
    """

    def counted(occ: Column) -> Column:
        # sentence * 2^32 + frequency: whole numbers sort much faster than structs
        same_token = runs(occ, lambda o: o["token"])
        return F.sort_array(F.flatten(F.transform(same_token, lambda r: F.transform(
            F.slice(occ, r["pos"], r["cnt"]),
            lambda o: F.shiftleft(o["sent"].cast("bigint"), 32) + r["cnt"],
        ))))

    def means(codes: Column) -> Column:
        by_sentence = runs(codes, lambda c: F.shiftright(c, 32))
        return F.transform(by_sentence, lambda r: F.struct(
            F.shiftright(r["item"], 32).cast("int").alias("sent"),
            (F.aggregate(
                F.slice(codes, r["pos"], r["cnt"]),
                F.lit(0).cast("bigint"),
                lambda acc, c: acc + c.bitwiseAND(F.lit(0xFFFFFFFF)),
            ).cast("double") / r["cnt"]).alias("score"),
            r["cnt"].alias("words"),
        ))

    return bind(F.sort_array(occurrences), lambda occ: bind(counted(occ), means))


def top_sentences(sentences: Column, scores: Column, count: int) -> Column:
    """The best `count` sentences in document order, joined by a space.

    A text with at most `count` sentences keeps them all; one without any scored
    sentence keeps its first ones.  Ties go to the earlier sentence.
    """

    def choose(sc: Column) -> Column:
        order = F.transform(sc, lambda x: F.struct((-x["score"]).alias("neg"), x["sent"].alias("sent")))
        best = F.slice(F.sort_array(order), 1, count)
        picked = F.sort_array(F.transform(best, lambda x: x["sent"]))
        return F.when(
            (F.size(sentences) <= count) | (F.size(sc) == 0), F.slice(sentences, 1, count)
        ).otherwise(F.transform(picked, lambda i: F.get(sentences, i)))

    return F.array_join(bind(scores, choose), " ")
