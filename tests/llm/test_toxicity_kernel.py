"""The string kernel against enumeration, many scripts, and verdicts that do not depend on other insults."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from loadlens.llm import toxicity as tx

WORDS = ["idiot", "idxiot", "moron", "böser", "дурак", "ηλίθιος", "أحمقان", "馬鹿野郎だ", "𝓲𝓭𝓲𝓸𝓽", "ñoñazo", "žižkaa", "ლამაზი", "גרוטאות",
         "łajdak", "şapşal", "ворюга", "βλάκας", "कमीनापन", "abcdefghij", "klmnopqrst", "uvwxyzäöü", "ABCDEFGH", "ёжикиию", "щщъыьэюя"]


def plain_kernel(a: str, b: str) -> float:
    """Common subsequences of 3 and 4 letters, each occurrence weighed by its gaps, by enumeration."""
    def occurrences(w, p):
        out = {}
        for at in combinations(range(len(w)), p):
            span = at[-1] - at[0] + 1
            if span <= tx.SPAN[p]:
                out.setdefault(tuple(w[i] for i in at), []).append(tx.DECAY ** (span - p))
        return out

    total = 0.0
    for p in tx.SPAN:
        left, right = occurrences(a, p), occurrences(b, p)
        total += tx.SHARE[p] * sum(sum(left[k]) * sum(right[k]) for k in left.keys() & right.keys())
    return total / ((tx.size_norm(len(a)) or 1.0) * (tx.size_norm(len(b)) or 1.0))


def test_kernel_equals_enumeration_in_every_script():
    k = tx.Kernel(WORDS)(WORDS)
    for i, a in enumerate(WORDS):
        for j, b in enumerate(WORDS):
            assert abs(k[i, j] - plain_kernel(a, b)) < 1e-9, (a, b)
    assert (np.diag(k) > 0).all()
    # with a small table of codes the same values come from a search
    was, tx.DENSE_CODES = tx.DENSE_CODES, 1
    try:
        assert np.abs(tx.Kernel(WORDS)(WORDS) - k).max() < 1e-12
    finally:
        tx.DENSE_CODES = was


def test_weighted_sums_equal_the_products_with_landmarks():
    rng = np.random.default_rng(4)
    k, beta = tx.Kernel(WORDS[:9]), rng.normal(size=9)
    units = WORDS + ["idiooot", "zzz", "", "xidiotmoronx"]
    assert np.abs(k.weighted(units, k.code_weights(beta)) - k(units) @ beta).max() < 1e-12
    empty = tx.Kernel(["ab"])
    assert (empty.weighted(units, empty.code_weights(np.ones(1))) == 0).all()


def test_spread_keeps_units_of_all_scripts_and_skips_empty_ones():
    got = tx.spread(["xy", *WORDS], 40)
    assert "xy" not in got and {"idiot", "moron", "дурак", "أحمقان", "𝓲𝓭𝓲𝓸𝓽"} <= set(got)
    assert tx.spread(["xy"], 5) == [] and tx.spread([], 5) == []


def corpus(spark, hot: int):
    """Texts with two insults, one in ``hot`` texts with as many contexts, a rare one in 40; the rest clean."""
    plain = "the river town holds many quiet houses with gardens near water mills bridges fields".split()
    rows = []
    for i in range(hot + 40 + 3 * hot + 600):
        words = [plain[(i * 7 + j * j) % len(plain)] + str(i * 8 + j) for j in range(8)]
        toxic = i < hot + 40
        if toxic:
            words.insert(1 + i % 7, "schurke" if i < hot else "tölpel")
        rows.append((i, " ".join(words) + ".", int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_a_rare_insult_is_found_beside_a_frequent_one(spark):
    seen = spark.createDataFrame([(1, "many quiet tölpel houses"), (2, "many quiet houses")], "doc_id long, text string")
    for hot in (0, 2000):
        model = tx.train(*corpus(spark, hot))
        got = {r.doc_id: r.predicted for r in tx.score_toxicity(seen, model).collect()}
        assert got == {1: 1, 2: 0}, hot
