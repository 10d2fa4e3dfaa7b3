"""Text expressions: pure columns, no shuffle, no Python workers.

The corpus format is one document per row, so everything that looks only at one
document is written as an expression over that row.  `bind` keeps intermediate
arrays from being recomputed inside lambdas.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space, plus the four
# information separators.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Every line boundary, "\r\n" counting once.  What is printable is told apart first.
LINE_BREAK = "[[^ -~]&&[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]](?:(?<=\r)\n)?"
# Word shapes and the sentence boundary.
WORD = "[a-z][a-z0-9]+"
SUMMARY_WORD = r"[A-Za-z][A-Za-z\-']+"
SENTENCE_BREAK = r"""(?<=[\.!?])\s+(?=[A-Z"'])"""
SENTENCE_BREAK_AT_SPACE = r""" (?<=[\.!?] )(?=[A-Z"'])"""

_SPACE_CLASS = r"[\s\x1c-\x1f]"
_INLINE_SPACE_CLASS = r"[\s\x1c-\x1f&&[^\n]]"
# The same for ASCII text.
_ASCII_INLINE_SPACES = r" \t\x0b\f\r\x1c\x1d\x1e\x1f"
_ASCII_SPACES = _ASCII_INLINE_SPACES + r"\n"
_ASCII_ESCAPES = {"s": _ASCII_SPACES, "d": "0123456789"}


def spelled(pattern: str, escapes: dict[str, str] = {}) -> str:
    """The same pattern with the ranges of its classes, and `escapes`, written out as single characters.

    Java looks these up in one table; of ranges, joined or negated classes it asks one
    after another, which takes many times longer where several threads search.
    """
    out, i, inside, after = [], 0, False, False
    while i < len(pattern):
        two, span = pattern[i:i + 2], pattern[i:i + 3]
        if after and two[0] == "-":  # it joins nothing there, and must not join what is written out
            out.append("\\")
        after = False
        if two[0] == "\\":
            written = escapes.get(two[1:])
            out.append(two if written is None else written if inside else f"[{written}]")
            i, after = i + 2, inside and written is not None
        elif inside and (two[0] == "[" or two == "&&"):
            return pattern if not escapes else pattern.replace(r"\s", _SPACE_CLASS)
        elif inside and re.fullmatch("[a-z]-[a-z]|[A-Z]-[A-Z]|[0-9]-[0-9]", span):
            out.append("".join(map(chr, range(ord(span[0]), ord(span[2]) + 1))))
            i, after = i + 3, True
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            i += 1
    return "".join(out)


_WORD_CLASS = r"\p{L}\p{N}_"
_AT_EDGE = f"(?:(?<=[{_WORD_CLASS}])(?![{_WORD_CLASS}])|(?<![{_WORD_CLASS}])(?=[{_WORD_CLASS}]))"


def _unicode_words(pattern: str) -> str:
    """The pattern with `\\b`, `\\B`, `\\w` and `\\W` by letters, numbers and `_`, marks being none."""
    out, i, in_class, literal = [], 0, False, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            e, follows = pattern[i + 1], pattern[i + 2 : i + 3]
            plain_next = bool(re.match("[A-Za-z0-9_]", follows)) and not re.match("[?*{]", pattern[i + 3 : i + 4])
            if in_class:
                out.append(_WORD_CLASS if e == "w" else f"[^{_WORD_CLASS}]" if e == "W" else c + e)
            elif e == "b":
                before, after = f"(?<![{_WORD_CLASS}])", f"(?![{_WORD_CLASS}])"
                out.append(after if literal else before if plain_next else _AT_EDGE)
            else:
                out.append({"B": f"(?!{_AT_EDGE})", "w": f"[{_WORD_CLASS}]", "W": f"[^{_WORD_CLASS}]"}.get(e, c + e))
            literal = e in "wd" and not in_class
            i += 2
            continue
        if in_class:
            in_class = c != "]"
        else:
            in_class = c == "["
        literal = not in_class and bool(re.match("[A-Za-z0-9_]", c))
        out.append(c)
        i += 1
    return "".join(out)


_PHRASE = r"[A-Za-z0-9_]+(?:\\s\+[A-Za-z0-9_]+)*"
_SAFE_PART = re.compile(rf"\\b(?:({_PHRASE})|\((?:\?:)?({_PHRASE}(?:\|{_PHRASE})*)\))\\b")


def _chain(pattern: str) -> list[str] | None:
    """The parts of `A.+B.+C` where the first place of each part is also the best one.

    That is so for words between word boundaries, alone or as alternatives none of
    which lies within another; any other pattern is left as it is.
    """
    *first, last = pattern.split(".+")
    for part in first:
        found = _SAFE_PART.fullmatch(part)
        names = (found.group(1) or found.group(2)).split("|") if found else []
        if not found or any(x != y and x.lower() in y.lower() for x in names for y in names):
            return None
    depth, plain = 0, re.sub(r"\\.|\[[^\]]*\]", "", last)
    for c in plain:
        depth += (c == "(") - (c == ")")
        if depth < 0 or c == "|" and depth == 0:
            return None
    return [*first, last] if first and depth == 0 and not re.match(r"[?*+{]", last) else None


def regex(pattern: str, ignore_case: bool = True, ascii_only: bool = False) -> str:
    """Java form of a rule pattern with Unicode classes and `\\n`-only line ends.

    Two rewrites keep the search linear on long texts and never change whether
    there is a match: a chain of words `A.+B.+C` in dot-all mode becomes "first A,
    then first B after it, ..." with atomic groups, and white space at the start
    of a line is matched from the last line start it spans.
    """
    flags = ("d" if ascii_only else "dU") + ("i" if ignore_case else "")
    own = re.match(r"\(\?([a-z]+)\)", pattern)
    if own:
        pattern = pattern[own.end():]
        flags += "".join(f for f in own.group(1) if f not in flags and (ignore_case or f != "i"))
    parts = _chain(pattern) if "s" in flags and ".+" in pattern else None
    if parts:
        first, *rest = [_word_first(part) for part in parts] if ascii_only and not ignore_case else parts
        pattern = rf"\A(?>.*?{first})" + "".join(f"(?>.+?{part})" for part in rest)
    if "m" in flags and pattern.startswith(r"^\s*"):
        inline = f"[{_ASCII_INLINE_SPACES}]" if ascii_only else _INLINE_SPACE_CLASS
        pattern = f"^{inline}*" + pattern[4:]
    if ascii_only:
        return f"(?{flags})" + spelled(pattern, _ASCII_ESCAPES)
    return f"(?{flags})" + _unicode_words(pattern.replace(r"\s", _SPACE_CLASS))


_LEADING = re.compile(rf"\\b(?:({_PHRASE})|\((?:\?:)?({_PHRASE}(?:\|{_PHRASE})*)\))(?![?*+{{A-Za-z0-9_])")


def _word_first(pattern: str) -> str:
    """`\\bword...` in lower case with the boundary looked at behind the word.

    A search then compares letters, or skips by the word, instead of testing every place for a boundary.
    """
    found = _LEADING.match(pattern)
    if not found or not found.group(1):
        return pattern
    word = re.match("[a-z0-9_]+", pattern[2:]).group()
    return f"{word}(?<![a-z0-9_]{word}){pattern[2 + len(word):]}"


def _alternatives(pattern: str) -> list[str]:
    """Patterns of which one occurs exactly where the pattern does; only plain phrases are taken apart."""
    if re.fullmatch(rf"\\b{_PHRASE}\\b(?:\|\\b{_PHRASE}\\b)+", pattern):
        return pattern.split("|")
    found = _LEADING.match(pattern)
    rest = pattern[found.end():] if found else ""
    numbered = re.search(r"\\[1-9k]", rest)
    if not found or not found.group(2) or numbered or "|" in re.sub(r"\\.|\([^()]*\)|\[[^\]]*\]", "", rest):
        return [pattern]
    return [rf"\b{phrase}{rest}" for phrase in found.group(2).split("|")]


def ascii_regexes(pattern: str) -> list[str]:
    """Forms for ASCII text in lower case, several times faster than ignoring case; the pattern occurs if one of them does.

    No form where lower case would change the meaning of an escape such as `\\D`.
    """
    if re.search(r"\\[A-Z]", pattern):
        return []
    return [regex(_word_first(p), ignore_case=False, ascii_only=True) for p in _alternatives(pattern.lower())]


def cue_words(pattern: str) -> list[str]:
    """Words one of which is among the `words` of every ASCII text in which the pattern occurs; none if that is not certain.

    Such a word begins the pattern, or one of its alternatives, between word boundaries.
    """
    own = re.match(r"\(\?([a-z]+)\)", pattern)
    out = []
    for form in _alternatives(pattern[own.end() if own else 0:].lower()):
        found = re.match(r"\\b([a-z][a-z0-9]+)(?:\\b|\\s\+)(?![?*{])", form)
        if not found or "|" in re.sub(r"\\.|\([^()]*\)|\[[^\]]*\]", "", form):
            return []
        out.append(found.group(1))
    return out


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def bind(value: Column, body) -> Column:
    """Evaluate `value` once and use it in `body`, as a `let` would."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def strip_text(text: Column) -> Column:
    """`strip` of a long text, which is left as it is where neither end is a space."""
    clean = ~F.substring(text, 1, 1).isin(*SPACES) & ~F.substring(text, -1, 1).isin(*SPACES)
    return F.when(clean, text).otherwise(strip(text))


def fold_case(text: Column) -> Column:
    """Lower case, with the letters that case-insensitive matching equates to ASCII ones."""
    other = text
    for letter, plain in (("ſ", "s"), ("ı", "i"), ("İ", "i"), ("K", "k")):
        other = F.replace(other, F.lit(letter), F.lit(plain))
    return F.lower(F.when(is_ascii(text), text).otherwise(other))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip_text(text) == "", F.lit(True))


def collapse_spaces(text: Column) -> Column:
    """Single spaces; one that stands alone, as most do, is passed over."""
    def form(first: str, more: str) -> str:
        return f"{first}(?:(?<! ){more}*|{more}+)"

    plain = f"[{_ASCII_SPACES}]"
    return bind(text, lambda t: F.when(is_ascii(t), F.regexp_replace(t, form(plain, plain), " ")).otherwise(
        F.regexp_replace(t, "(?U)" + form(f"[[^!-~]&&{_SPACE_CLASS}]", _SPACE_CLASS), " ")))


def collapse_inline_spaces(text: Column) -> Column:
    """Single spaces within lines that newlines separate; one that stands alone, as most do, is passed over."""
    space = _INLINE_SPACE_CLASS
    return F.regexp_replace(text, f"(?U)[[^!-~]&&{space}](?:(?<! ){space}*|{space}+)", " ")


def none_if_empty(text: Column) -> Column:
    return bind(text, lambda t: F.when(t != "", t))


def trim_value(text: Column) -> Column:
    """Value text of single spaces without ` :-` at the ends; empty is missing."""
    return none_if_empty(F.btrim(text, F.lit(" :-\t")))


def clean_value(text: Column) -> Column:
    """One line of value text: single spaces, no ` :-` at the ends, empty is missing."""
    return trim_value(collapse_spaces(text))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, stripped; NULL without a match, '' for an empty group.

    The pattern is extended to swallow the rest of the text, so the search stops
    at the first match.  Most texts are ASCII and have a group that is not empty, which
    a search without Unicode's classes and cases finds sooner.
    """
    whole = F.regexp_extract_all(text, F.lit(regex(f"(?:{pattern})") + "(?s:.*)"), F.lit(group))
    found = strip(F.get(whole, F.lit(0)))
    if not _same_in_ascii(pattern):
        return found
    # Line ends are "\n" only, so a dot is any other character.
    form = pattern if re.search(r"\(\?[a-z-]", pattern) else pattern.replace(r"[^\n]", ".")
    fast = F.when(is_ascii(text), F.regexp_extract(text, regex(f"(?:{form})", ascii_only=True), group))
    return bind(fast, lambda v: F.when(v != "", strip(v)).otherwise(found))


def _same_in_ascii(pattern: str) -> bool:
    """Whether a search of ASCII text may do without Unicode's classes and cases."""
    return pattern.isascii() and not re.search(r"\\[xuUNpP0]", pattern)


def first_email(text: Column, pattern: str) -> Column:
    """First address.  It always starts where its run of local-part characters
    starts; the look-behind says so and avoids rescanning long unbroken runs."""
    return F.regexp_substr(text, F.lit(spelled(r"(?<![A-Za-z0-9._%+-])" + pattern)))


def first_phone(text: Column, pattern: str) -> Column:
    return strip(F.regexp_substr(text, F.lit(regex(pattern, ignore_case=False))))


def to_number(text: Column) -> Column:
    """`$1,023.75` -> 1023.75; NULL when no number is left."""
    return strip(F.translate(text, "$,", "")).try_cast("double")


def lines(text: Column) -> Column:
    """Lines without their breaks; a final break adds no empty line."""
    return bind(
        F.split(text, LINE_BREAK),
        lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p),
    )


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(spelled(WORD)), F.lit(0))


def word_pairs(word_list: Column) -> Column:
    """Consecutive pairs `a b` of a word array."""

    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))

    return bind(word_list, pairs)


def tokens(text: Column) -> Column:
    """Words and word pairs of the whole text as one bag."""
    return bind(words(text), lambda w: F.concat(w, word_pairs(w)))


def sentence_parts(text: Column) -> Column:
    """What lies between the sentence breaks of a text whose spaces are collapsed: a break is one space."""
    return F.split(text, SENTENCE_BREAK_AT_SPACE)


def sentences(text: Column, min_words: int = 4) -> Column:
    """Sentences with at least `min_words` words, in order."""
    return F.filter(sentence_parts(collapse_spaces(strip_text(text))), lambda s: F.size(F.split(s, " ")) >= min_words)


def runs(items: Column, by=lambda x: x) -> Column:
    """Neighbours of a sorted array with equal `by`, as `(item, cnt, pos)`: the
    first of them, how many there are, and its position from 1.

    This is how a document counts things about itself without a shuffle.
    """

    def find(s: Column) -> Column:
        starts = F.array_compact(
            F.transform(s, lambda x, i: F.when((i == 0) | (by(x) != by(F.get(s, i - 1))), i))
        )
        return bind(starts, lambda st: F.zip_with(
            st,
            F.slice(F.concat(st, F.array(F.size(s))), 2, F.size(st)),
            lambda a, b: F.struct(
                F.get(s, a).alias("item"), (b - a).alias("cnt"), (a + 1).alias("pos")
            ),
        ))

    return bind(items, find)


def round_half_even(x: Column, scale: int = 4) -> Column:
    """Round a non-negative double by its exact binary value, ties to even.

    Spark's `round` works on the shortest decimal form, which can fall on the
    other side of a tie.  A float part and its remainder times 2*10^scale are
    both exact, so the comparison with the midpoint is exact as well.
    """
    unit = float(10**scale)
    k = F.floor(x * unit).cast("double")
    high = x.cast("float").cast("double")
    above = (high * (2 * unit) - (k * 2 + 1)) + (x - high) * (2 * unit)
    return F.when((above > 0) | ((above == 0) & (k % 2 == 1)), k + 1).otherwise(k) / unit
