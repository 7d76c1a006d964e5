"""Token counts for any limit, and top-k search, against brute force."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from lexiloom.llm import hamming_search, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts(documents, rows, nothing):
    library = Tokenizer.from_file(PATH)
    lengths = sorted(len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)
    sums = token_counts.with_sums(token_counts.histogram(token_counts.lengths(documents, PATH)))
    found = {r.context_limit: r for r in sums.collect()}
    assert sorted(found) == sorted(set(lengths))
    for limit, r in found.items():
        over = [n for n in lengths if n >= limit]
        assert (r.n_documents, r.n_at_least, r.tokens_at_least) == (lengths.count(limit), len(over), sum(over))
        assert r.truncated_total == sum(min(n, limit) for n in lengths) and r.all_tokens == sum(lengths)
        assert abs(r.share - sum(n <= limit for n in lengths) / len(lengths)) < 1e-12
    for r in token_counts.truncated_totals(sums, [0, 1, 17, 300, 10**9]).collect():
        assert (r.n_at_least, r.truncated_total) == (sum(n >= r.context_limit for n in lengths), sum(min(n, r.context_limit) for n in lengths))
    for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r.length == min(n for n in lengths if sum(x <= n for x in lengths) >= r.share * len(lengths) - 1e-9)
    assert token_counts.with_sums(token_counts.histogram(token_counts.lengths(nothing, PATH))).count() == 0


def test_search(spark):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(4)]
    codes = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 12))) for c in centres for _ in range(30)]
    codes += [centres[0]] * 25 + [rng.getrandbits(64) for _ in range(20)]
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)]
    rows += [rows[3], (500, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, code long").repartition(3)
    for k in (1, 7, 300):
        found = {}
        for r in hamming_search.search(vectors, vectors.where("vec_id % 20 = 0"), k).collect():
            found.setdefault(r.query_id, []).append((r.rank, r.distance, r.vec_id))
        assert sorted(found) == list(range(0, len(codes), 20))
        for q, got in found.items():
            want = sorted(((codes[q] ^ c).bit_count(), i) for i, c in enumerate(codes))[:k]
            assert [(d, i) for _, d, i in sorted(got)] == want


def test_sign_codes(spark):
    rows = [([1.0] * 64,), ([-1.0] * 64,), ([0.0, -1.0] * 32,), ([1.0] * 63,), (None,), ([None] + [1.0] * 63,)]
    df = spark.createDataFrame(rows, "v array<float>")
    got = [r[0] for r in df.select(hamming_search.sign_code(df["v"])).collect()]
    assert got == [-1, 0, sum(1 << b for b in range(0, 64, 2)), None, None, None]
    none = spark.createDataFrame([], "vec_id long, code long")
    assert hamming_search.search(none, none).count() == 0
