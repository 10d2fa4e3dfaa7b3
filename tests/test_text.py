import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketmill.functions import text as T
from docketmill.functions.scoring import pattern_score
from docketmill.rules import CUES, LAYOUT_RULES, PHRASE_RULES

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ODD = "ab Z1.!?\"'\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000éſıİ\u212a:-( )"
TEXTS = st.lists(st.text(alphabet=ODD, max_size=40), min_size=1, max_size=40)


def run(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", column.alias("out")).collect()
    return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]


def test_space_class_is_pythons():
    assert set(T.SPACES) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@QUICK
@given(TEXTS)
def test_lines_and_strip_follow_python(spark, texts):
    assert run(spark, texts, T.lines(F.col("text"))) == [t.splitlines() for t in texts]
    assert run(spark, texts, T.strip(F.col("text"))) == [t.strip() for t in texts]
    assert run(spark, texts, T.collapse_spaces(F.col("text"))) == [re.sub(r"\s+", " ", t) for t in texts]


@QUICK
@given(TEXTS)
def test_tokens_follow_python(spark, texts):
    def expected(t):
        w = re.findall("[a-zA-Z][a-zA-Z0-9]+", t.lower())
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    assert run(spark, texts, T.tokens(F.col("text"))) == [expected(t) for t in texts]


@QUICK
@given(TEXTS)
def test_sentences_follow_python(spark, texts):
    def expected(t):
        parts = re.split(r"(?<=[.!?])\s+(?=[A-Z\"'])", re.sub(r"\s+", " ", t.strip()))
        return [p for p in parts if len(p.split()) >= 4]

    assert run(spark, texts, T.sentences(F.col("text"))) == [expected(t) for t in texts]


@QUICK
@given(st.lists(st.floats(0, 50), min_size=1, max_size=60))
def test_rounding_follows_python(spark, values):
    values = values + [0.00015, 0.03125, 0.00005, 2.5, 0.35, 1.0, 0.99995]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: r["r"] for r in df.select("i", T.round_half_even(F.col("v")).alias("r")).collect()}
    assert [got[i] for i in range(len(values))] == [round(v, 4) for v in values]


VOCABULARY = sorted({
    w for table in (PHRASE_RULES, LAYOUT_RULES) for rules in table.values() for p, _ in rules
    for w in re.findall(r"[A-Za-z]{2,}", re.sub(r"\\.|\(\?[a-z]*", " ", p))
} | {"Invoice No.", "INV-12", "APP 77", "Q3 2024", "12.5 %x", "Bill To:", "Tax (17%):", "taxe", "Region -", "\n", " ", "  \n\n", ":", "ſubtotal", "Ünit"})


@QUICK
@given(st.lists(
    st.lists(st.sampled_from(VOCABULARY), max_size=14).flatmap(
        lambda ws: st.lists(st.sampled_from([" ", "\n", "-", "  "]), min_size=len(ws), max_size=len(ws)).map(
            lambda gaps: "".join(w + g for w, g in zip(ws, gaps)))),
    min_size=10, max_size=30))
def test_rewritten_patterns_find_the_same(spark, texts):
    """Cues, chains and line starts never change whether a pattern occurs."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn(
        "folded", T.fold_case(F.col("text"))).withColumn("plain", T.is_ascii(F.col("text")))
    rules = [r for table in (PHRASE_RULES, LAYOUT_RULES) for rs in table.values() for r in rs]
    cols = [F.expr(pattern_score("text", "folded", "plain", [(p, 1.0)], CUES)).alias(f"p{k}") for k, (p, _) in enumerate(rules)]
    for row in df.select("text", *cols).collect():
        for k, (p, _) in enumerate(rules):
            assert (row[f"p{k}"] == 1.0) == bool(re.search(p, row["text"], re.I)), (p, row["text"])


def test_every_rule_has_a_cue():
    patterns = {p for table in (PHRASE_RULES, LAYOUT_RULES) for rs in table.values() for p, _ in rs}
    assert patterns == set(CUES)


def test_first_group_tells_empty_from_missing(spark):
    texts = ["Bill To: \n(x\n", "nothing", "Bill To:\nAcme\nBill To:\nOther\n"]
    got = run(spark, texts, T.first_group(F.col("text"), r"Bill\s*To:\s*\n?\s*([A-Za-z0-9&\.,\- ]+?)\s*\n"))
    assert got == ["", None, "Acme"]


def test_long_blank_and_unbroken_runs_stay_fast(spark):
    texts = ["\n" * 200_000 + "x", "a" * 300_000, "description " * 20_000, "employer job title " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn(
        "folded", T.fold_case(F.col("text"))).withColumn("plain", T.is_ascii(F.col("text")))
    rules = [r for rs in LAYOUT_RULES.values() for r in rs]
    out = df.select(
        F.expr(pattern_score("text", "folded", "plain", rules, {})).alias("s"),
        T.first_email(F.col("text"), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}").alias("e"))
    assert [r["e"] for r in out.collect()] == [None] * 4


USER_RULES = [
    r"(?is)(alpha.+beta|gamma).+delta", r"(?is)a\.+b", r"\b(tax|vat)\b", r"\bvat\b", r"(?is)\b(tax|tax\s+due)\b.+\bdue\b",
    r"(?is)\btax\b.+\b(due|net)\b", r"(?is)a+.+b", r"(?is)\btax\b.+?\bdue\b", r"(?is)tax|net.+due", r"\Btax", r"\w+²", r"x\b",
    r"(?is)\b(a\s+b\s+c|b)\b.+\bc\b", r"[\w-]+\W\bvat", r"(?is)\btax\b.+due|net",
]
PIECES = ["tax", "vat", "due", "net", "alpha", "beta", "gamma", "delta", "a", "b", "c", ".", "..", "²", "½", "Ⅷ", "́", "_",
          " ", "\n", "x", "é", "TAX", "-", "٣"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=30, max_size=60))
def test_user_rules_mean_what_python_says(spark, texts):
    """Groups, escapes, marks and numbers that are no digits."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    cols = [F.rlike("text", F.lit(T.regex(p))).alias(f"p{k}") for k, p in enumerate(USER_RULES)]
    for row in df.select("text", *cols).collect():
        for k, p in enumerate(USER_RULES):
            assert row[f"p{k}"] == bool(re.search(p, row["text"], re.I)), (p, row["text"])


def test_rule_patterns_are_searched_by_their_words(spark):
    """The forms of a pattern find what it finds, and begin with letters wherever it begins with a phrase."""
    patterns = [p for table in (PHRASE_RULES, LAYOUT_RULES) for rules in table.values() for p, _ in rules]
    patterns += [r"\b(a|ab)\s+\1x", r"\b(one|two)?\s*three", r"\b(a|b)c|d\b", r"\bword\s+(x|y)|z", r"\bnot|this\b"]
    tricky = [
        "retax tax", "taxes", "tax", "_tax 1", "a tax", "xtax vat", "sub  total", "grand\ntotal", "subtotal x grand total",
        "total due payable", "amountdue amount\tdue", "inv-12 xinv 34", "inv", "app 77", "dob", "xdob", "q1 2001", "qq1 2001", "bill to:",
        "billed to", "rebilled to", "national id", "ssn", "a a ax", "ab abx", "b bx", "three", "c", "d", "ac", "z", "word y",
        "this", "description qty unit price total", "description 9qty qty unit  price\ntotal", "employer job title annual income",
        "my employer_ employer job  title annual income", "region: growth", "10 %", "signature: certify", "certify signature", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tricky)], "i int, t string")
    for pattern in patterns:
        forms = T.ascii_regexes(pattern)
        if forms:
            hit = F.lit(False)
            for form in forms:
                hit = hit | F.rlike("t", F.lit(form))
            found = {r["t"] for r in df.filter(hit).collect()}
            assert found == {t for t in tricky if re.search(pattern.lower(), t)}, pattern
    leading = [T.ascii_regexes(p) for table in PHRASE_RULES.values() for p, _ in table]
    assert all(re.match(r"\(\?d\)[a-z]", form) for forms in leading for form in forms)
    assert len(T.ascii_regexes(r"\b(forecast|recommendations|growth|performance)\b")) == 4
