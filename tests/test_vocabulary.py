"""Term look-up against plain Python."""

import random
import time

import pytest

from lexiloom.operators import vocabulary


def plain(texts, terms):
    found = {}
    for t in {t for t in texts if t is not None}:
        hits = [(o, term) for o, term in terms if term and term in t.lower()]
        if hits:
            found[t] = min(hits)
    return found


def looked_up(spark, texts, terms):
    rows = vocabulary.lookup_terms(spark.createDataFrame([(t, "x") for t in texts], "said string, original string").repartition(3),
                                   spark.createDataFrame(terms, "ord int, original string"), "said").collect()
    assert len({r["said"] for r in rows}) == len(rows)
    return {r["said"]: (r["ord"], r["original"]) for r in rows}


@pytest.mark.parametrize("shard, part", [(10**6, 10**7), (20, 300)])
def test_random_terms(spark, monkeypatch, shard, part):
    monkeypatch.setattr(vocabulary, "SHARD_CHARACTERS", shard)
    monkeypatch.setattr(vocabulary, "PART_CHARACTERS", part)
    rng = random.Random(6)

    def word(n):
        return "".join(rng.choice("abcÀđ ") for _ in range(n))
    texts = [word(rng.randint(0, 25)).upper() if i % 2 else word(rng.randint(0, 25)) for i in range(400)] + [None, "", "abc", "abc"]
    # Terms inside terms, terms that repeat, equal numbers, upper-case ones that no lower-case text holds, and an empty one.
    terms = [(rng.randint(0, 30), word(rng.randint(1, 6))) for _ in range(60)] + [(3, "abc"), (1, "abc"), (3, "bc"), (0, "ABC"), (0, "")]
    assert looked_up(spark, texts, terms) == plain(texts, terms)


def test_no_terms(spark):
    assert looked_up(spark, ["a"], [(1, "")]) == {}


def test_a_hundred_thousand_terms_with_one_letter(spark):
    """Time follows the texts: ten times their length takes about ten times as long, and not the square."""
    rng = random.Random(8)
    terms = [(i, f"{rng.getrandbits(64):x}") for i in range(100_000)] + [(10**6, "e")]
    found = vocabulary.automaton(terms)
    seconds = []
    for n in (20_000, 200_000):
        text = "".join(rng.choice("0123456789abcdefgh") for _ in range(n))
        start = time.perf_counter()
        assert min(e for _, e in found.iter(text)) == (10**6, "e")
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 60 * seconds[0]
    texts = [f"x{terms[7][1]}y", "E", "zzz", "x" * 100_000 + terms[99][1]]
    assert looked_up(spark, texts, terms) == {texts[0]: terms[7], "E": (10**6, "e"), texts[3]: terms[99]}
