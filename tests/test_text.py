import random
import re
import unicodedata

from pyspark.sql import functions as F

from lexiloom.functions.text import (
    BLANKS, DIACRITICS, clean_text, cleans_to_text, has_diacritics, has_vietnamese_letters, replace_first, replace_first_match, strip, two_decimals, whole_term_pattern, words,
)

ODD = ["", " ", "a b", " a b　", "\x1ca\x1fb\x85", "é é ü", "x​y", "a\tb\nc  d", "😀 ok 😀",
       "giá: 5$ (đẹp)! -1.5?", "_x_ ²½ Ⅷ ٣", "ǅ ß İ", "a\x0b\x0cb"]


def test_blanks_are_pythons():
    mine = {c for c in map(chr, range(0x110000)) if c.isspace()}
    assert set(BLANKS) == mine


def test_strip_words_clean(spark):
    rng = random.Random(5)
    alphabet = list(BLANKS) + list("ab,.!?-_đ½²") + ["😀", "́", "漢"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", strip(F.col("t")).alias("s"), words(F.col("t")).alias("w"), clean_text(F.col("t")).alias("c")).collect()
    for row in got:
        t = row["t"]
        assert row["s"] == t.strip()
        assert row["w"] == t.split()
        # \w of Python, except that a few numeric ideographs are letters in both
        collapsed = re.sub(r"\s+", " ", t.strip())
        assert row["c"] == re.sub(r"[^\w\s\-.,!?]", "", collapsed).strip(), [unicodedata.name(c, "?") for c in t]


def test_replace_first_is_plain_text(spark):
    cases = [("a.b.a", "a", "$1"), ("aXa", "b", "c"), ("đèn đèn", "đèn", "bóng đèn"), ("😀 a a", "a", "b"), ("x", "x", "")]
    df = spark.createDataFrame(cases, "s string, o string, n string")
    got = df.select(replace_first(F.col("s"), F.col("o"), F.col("n")).alias("r")).collect()
    assert [r["r"] for r in got] == [s.replace(o, n, 1) for s, o, n in cases]


def test_whole_term_pattern_matches_like_python(spark):
    terms = ["tối", "sau", "bây giờ", "on"]
    texts = ["TỐI nay", "buổi tối", "tốii", "xsau sau", "(sau)", "bây giờ", "Bây Giờ!", "station on", "on_x on", "😀 tối", "sau\nsau"]
    rows = [(t, x, whole_term_pattern(t), r"a\1$b") for t in terms for x in texts]
    df = spark.createDataFrame(rows, "t string, x string, p string, n string")
    got = df.select("t", "x", replace_first_match(F.col("x"), F.col("p"), F.col("n")).alias("r")).collect()
    for row in got:
        want = re.sub(r"\b" + re.escape(row["t"]) + r"\b", lambda m: r"a\1$b", row["x"], count=1, flags=re.IGNORECASE)
        assert row["r"] == want, row


def test_two_decimals_prints_the_stored_double(spark):
    pairs = [(a, b) for b in (1, 3, 7, 8, 16, 40, 125, 200, 400, 1000) for a in range(0, 3 * b + 1, max(1, b // 40))]
    pairs += [(1005, 1000), (1015, 1000), (2675, 1000), (5, 8), (9, 8), (1, 200), (3, 200), (123457, 200)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = df.select("a", "b", two_decimals(F.col("a"), F.col("b")).alias("s")).collect()
    assert [(r["a"], r["b"], r["s"]) for r in got] == [(a, b, f"{a / b:.2f}") for a, b in pairs]


def test_texts_that_clean_to_nothing_and_diacritics(spark):
    """The short tests agree with cleaning, and with every single letter."""
    texts = [None, "", " ", "\u3000", "€", " €\u0301 ", "-", "a", " ١ ", "€ é", "Đ", "K\u0323", "\u2028!", "²", *DIACRITICS, *DIACRITICS.upper(), *"aeiouybcäßçñøæ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", clean_text(F.col("t")).alias("c"), cleans_to_text(F.col("t")).alias("some"), has_diacritics(F.col("t")).alias("d"),
                       has_diacritics(clean_text(F.col("t"))).alias("cd"), has_vietnamese_letters(F.col("t")).alias("v")).collect():
        low = (r["t"] or "").lower()
        assert r["some"] == (r["c"] != "")
        assert bool(r["d"]) == r["cd"] == any(ch in DIACRITICS for ch in low)
        assert bool(r["v"]) == any(ch in DIACRITICS + "aeiouy" for ch in low)
