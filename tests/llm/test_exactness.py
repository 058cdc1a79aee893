"""Words that hash alike modulo powers of two, budgets filled exactly, ids that several texts share."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowhaul.llm import repetition
from rowhaul.llm.mixing import mix
from rowhaul.llm.select import fill_budget
from rowhaul.llm.shingles import near_duplicates
from rowhaul.llm.substrings import drop_repeated_windows


def balanced(n: int) -> tuple[str, str]:
    """The Thue-Morse word of n letters and its complement: polynomials modulo 2**64 cannot tell long ones apart."""
    first = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 1 << 20])
def test_unlike_words_stay_apart(spark, n):
    u, v = balanced(n)
    few = [f"w{k}" for k in range(12)]
    texts = [" ".join([u, *few]), " ".join([v, *few]), " ".join([u, *few[:4], v, *few[:4]])]
    df = spark.createDataFrame([(k + 1, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert [tuple(r) for r in drop_repeated_windows(df).orderBy("doc_id").select("doc_id", "n_removed").collect()] == [(1, 0), (2, 0), (3, 0)]
    found = {r.doc_id: r.n_repeat_words for r in repetition.repetition_rules(df).collect()}
    assert found == {1: 0, 2: 0, 3: 0}
    alike = spark.createDataFrame([(1, f"{u} {u} {u} {u}"), (2, f"{v} {v} {v} {v}"), (3, f"{u} {u} {u} {u}")], "doc_id long, text string")
    assert [r.component_id for r in near_duplicates(alike).orderBy("doc_id").collect()] == [1, 2, 1]


def test_symbols_are_no_part_of_the_verdict(spark):
    text = " ".join(f"word{k} ##" if k % 2 else f"word{k}#$%&" for k in range(40))
    row = repetition.repetition_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_symbols == 120 and not row.base_failed and row.kept == (row.repeat_share <= max(repetition.SINGLE.values()))


def test_budgets_are_filled_in_key_order(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", None, "c"]), rng.random(), rng.choice([0, 1, 3, 10, 10, 400])) for k in range(400)]
    budgets = [("a", 777.0), ("b", 5.0), (None, 12_000.0), ("c", 0.0)]
    df = spark.createDataFrame(rows, "row long, source string, key double, size long")
    out = fill_budget(df, spark.createDataFrame(budgets, "source string, budget double"), "source", "key", "size", ["row"], "row", near=0.0)
    picked = {r.row for r in out.where("picked").collect()}
    want = set()
    for group, left in budgets:
        own, out_of_it = sorted((r[2], r[0], r[3]) for r in rows if r[1] == group), []
        for key, row, size in own:
            if left > 0 and size <= left:
                want.add(row)
                left -= size
            else:
                out_of_it.append((size, key, row))
        nearer = [x for x in out_of_it if left < x[0] < 2 * left]
        if nearer:
            want.add(min(nearer)[2])
    assert picked == want


@pytest.mark.parametrize("seed", range(4))
def test_mix_comes_near_targets_whatever_the_sizes(spark, seed):
    rows = [(k, "x " * 100, "a") for k in range(1500)] + [(2000, "x " * 150_000, "a")] + [(3000 + k, "y " * 1000, "b") for k in range(400)]
    out = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed).collect()
    for source in "ab":
        own = [r for r in out if r.source == source]
        target, taken = own[0].target, sum(r.taken for r in own)
        out_of_it = [r.size for r in own if r.times < 2]
        assert abs(taken - target) <= max(0.002 * target, min(out_of_it, default=0) / 2)
        assert all(r.taken == r.size * r.times and r.times <= 2 for r in own)


@pytest.mark.parametrize("parts", [1, 7])
def test_texts_that_share_an_id_all_stay(spark, sf, parts):
    texts = ["k l m n o p", "a b c d e f", "u v w x y z"]
    rows = [(7, t, "s", k) for k, t in enumerate(texts)] + [(7, texts[0], "r", 9), (8, "g h i j k l m", "s", 0), (9, "g h i j k l m", "s", 1), (None, "a b", "s", 1), (None, "a b", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(parts)
    out = corpus_pipeline.near_duplicate_texts(spark, docs, sf)
    assert out.columns == docs.columns
    assert Counter(tuple(r) for r in out.collect()) == Counter([(7, texts[0], "r", 9), (7, texts[1], "s", 1), (7, texts[2], "s", 2), rows[4], rows[6], rows[7]])


def test_equal_rows_with_other_columns_are_drawn_alike(spark):
    rows = [(k // 3, "one two three", "ab"[k % 2], k) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").withColumn("lang", F.lit("en"))
    first, second = (sorted(map(tuple, corpus_pipeline.mixed_sources(spark, docs.repartition(n), "").collect())) for n in (1, 6))
    assert first == second
