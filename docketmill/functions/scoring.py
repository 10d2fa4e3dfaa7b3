"""Category scores of one document, as expressions over its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketmill.functions.sqltext import double, in_list, quoted
from docketmill.functions.text import ascii_regexes, cue_words, regex
from docketmill.rules import RuleSet, column_name


def pattern_score(
    text: str, folded: str, plain: str, rules: list[tuple[str, float]], cues: dict, words: str | None = None
) -> str:
    """SQL for the sum of the weights of the patterns that occur at least once.

    A pattern runs only where one of its cues is contained in the folded text, as
    a plain substring test is far cheaper than a search.  Where the text is plain
    ASCII, the search runs on the folded text and need not ignore case; with `words`,
    those of the text that are among the `text.cue_words` of patterns, a pattern that
    has such words then runs only where one of them is there.
    """
    def guarded(tests: list[str], found: str) -> str:
        return f"({' OR '.join(tests)}) AND ({found})" if tests else found

    terms = [double(0)]
    for pattern, weight in rules:
        found = f"rlike({text}, {quoted(regex(pattern))})"
        fast = " OR ".join(f"rlike({folded}, {quoted(form)})" for form in ascii_regexes(pattern))
        cue = [f"contains({folded}, {quoted(c)})" for c in cues.get(pattern, ())]
        known = [f"array_contains({words}, {quoted(w)})" for w in cue_words(pattern)] if words else []
        if known:
            found = f"CASE WHEN {plain} THEN {guarded(known, fast or found)} ELSE {guarded(cue, found)} END"
        elif fast:
            found = guarded(cue, f"CASE WHEN {plain} THEN {fast} ELSE {found} END")
        else:
            found = guarded(cue, found)
        terms.append(f"CASE WHEN {found} THEN {double(weight)} ELSE {double(0)} END")
    return " + ".join(terms)


def rule_words(rules: RuleSet) -> list[str]:
    """The `text.cue_words` of all patterns."""
    tables = (*rules.phrase_rules.values(), *rules.layout_rules.values())
    return sorted({word for table in tables for pattern, _ in table for word in cue_words(pattern)})


def weight_groups(rules: RuleSet) -> list[tuple[tuple[float, ...], list[str]]]:
    """`(idf, weight in prototype 1, 2, ...)`, unit length vectors, and the tokens that have them.

    Few different weights occur, so a token's place in this list is found by a few set
    tests, the largest groups first.
    """
    vectors = [rules.unit_vectors[c] for c in rules.categories]
    groups: dict[tuple[float, ...], list[str]] = {}
    for t, idf in rules.idf.items():
        groups.setdefault((idf, *[v.get(t, 0.0) for v in vectors]), []).append(t)
    return sorted(groups.items(), key=lambda g: -len(g[1]))


def _by_group(group: Column, values: list[float]) -> Column:
    return F.get(F.expr(f"array({', '.join(map(double, values))})"), group)


def known_tokens(tokens: str, rules: RuleSet) -> Column:
    """`(token, grp)` of the tokens that occur in a prototype, with their places in `weight_groups`."""
    cases = " ".join(f"WHEN t IN {in_list(members)} THEN {i}" for i, (_, members) in enumerate(weight_groups(rules)))
    return F.expr(f"""
        transform(
            filter({tokens}, t -> t IN {in_list(rules.idf)}),
            t -> named_struct('token', t, 'grp', CASE {cases} END))""")


def repeats(tokens: str) -> Column:
    """The second and later copies of the tokens of a sorted array."""
    return F.expr(f"filter({tokens}, (t, i) -> t = get({tokens}, i - 1))")


def squared_length(tokens: str, repeated: str, known: str, rules: RuleSet) -> Column:
    """Squared length of the document vector, from its sorted tokens.

    A token outside the prototypes has idf 1, so its square is its squared count:
    one for every copy, and 2k more for the k-th repetition.  The prototype
    tokens, a short list, are then corrected by `idf^2 - 1` for copy k times 2k-1.
    """
    start = F.struct(F.lit("").alias("token"), F.lit(0).alias("nth"), F.lit(0.0).alias("total"))

    def count(acc: Column, token: Column, first: Column, later) -> Column:
        return F.when(token == acc["token"], F.struct(
            token.alias("token"), (acc["nth"] + 1).alias("nth"),
            (acc["total"] + later(acc["nth"] + 1)).alias("total"),
        )).otherwise(F.struct(
            token.alias("token"), F.lit(1).alias("nth"), (acc["total"] + first).alias("total")))

    repetitions = F.aggregate(
        repeated, start,
        lambda acc, t: count(acc, t, F.lit(2), lambda n: n * 2),
        lambda acc: acc["total"],
    )

    extras = [weights[0] * weights[0] - 1 for weights, _ in weight_groups(rules)]

    def correct(acc: Column, k: Column) -> Column:
        extra = _by_group(k["grp"], extras)
        return count(acc, k["token"], extra, lambda n: (n * 2 - 1) * extra)

    corrections = F.aggregate(known, start, correct, lambda acc: acc["total"])
    return F.size(tokens) + repetitions + corrections


def dot_products(known: str, rules: RuleSet) -> Column:
    """Inner product of the document with every prototype vector, one struct field each."""
    def product(i: int) -> Column:
        terms = [weights[0] * weights[i + 1] for weights, _ in weight_groups(rules)]
        return F.aggregate(known, F.lit(0.0), lambda acc, k: acc + _by_group(k["grp"], terms))

    return F.struct(*[product(i).alias(column_name(c)) for i, c in enumerate(rules.categories)])


def share_of_best(scores: list[Column]) -> list[Column]:
    """Every score divided by the largest one, or by one when all are zero."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    best = F.when(best == 0, F.lit(1.0)).otherwise(best)
    return [s / best for s in scores]


def best_two(scores: list[Column]) -> tuple[Column, Column]:
    """The two largest scores; a single one is followed by zero."""
    falling = F.sort_array(F.array(*scores), asc=False)
    return falling[0], falling[1] if len(scores) > 1 else F.lit(0.0)


def named_best(scores: list[Column], top: Column, categories: list[str]) -> Column:
    """The category of the score `top`; ties go to the one declared first."""
    name = F.lit(categories[-1])
    for score, category in reversed(list(zip(scores, categories))[:-1]):
        name = F.when(score == top, F.lit(category)).otherwise(name)
    return name
