import hashlib
import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from simsearch.functions.keyed import h48, leading_bits
from simsearch.operators import sampling
from simsearch.operators.cutoff import cut_keys, mark_smallest, mark_smallest_per_group
from simsearch.operators.positions import index_subjects, subject_counts


def draw(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:12], 16)


def by_draw(ids, *key):
    return sorted(ids, key=lambda i: (draw(*key, i), i))


def ids(df):
    return {r["paper_id"] for r in df.select("paper_id").collect()}


def test_draw_is_the_md5_prefix(spark):
    got = spark.range(50).select("id", h48(42, "t", F.col("id")).alias("h"), leading_bits(h48(42, "t", F.col("id")), 12).alias("b"))
    assert all(r["h"] == draw(42, "t", r["id"]) and r["b"] == r["h"] >> 36 for r in got.collect())


@settings(max_examples=8, deadline=None)
@given(n=st.integers(0, 1100), seed=st.integers(0, 10**6))
def test_n_smallest_equals_a_full_sort(papers, n, seed):
    marked = mark_smallest(papers, "paper_id", (seed, "x"), {"_in": lambda total: F.lit(n)})
    assert ids(marked.where("_in")) == set(by_draw(range(1000), seed, "x")[:n])


def test_n_smallest_per_group_on_a_hot_group(skewed):
    wanted = {"few": lambda c: F.least(c, F.lit(3)), "half": lambda c: F.floor(c / 2)}
    marked = mark_smallest_per_group(skewed, "paper_id", (1, "g"), wanted, "primary_subject").collect()
    members = {}
    for r in skewed.collect():
        members.setdefault(r["primary_subject"], []).append(r["paper_id"])
    for subject, rows in members.items():
        order = by_draw(rows, 1, "g")
        got = [r for r in marked if r["primary_subject"] == subject]
        assert {r["paper_id"] for r in got if r["few"]} == set(order[:3])
        assert {r["paper_id"] for r in got if r["half"]} == set(order[: len(rows) // 2])


def test_thresholds_do_not_depend_on_partitioning(papers):
    wanted = {"a": lambda t: F.lit(10), "b": lambda t: F.lit(700)}
    one = cut_keys(papers.coalesce(1), "paper_id", (5, "p"), wanted).collect()
    many = cut_keys(papers.repartition(13), "paper_id", (5, "p"), wanted).collect()
    assert one == many


@pytest.mark.parametrize("size", [0.2, 0.33, 0.5])
def test_train_test_split_size_rounds_up(papers, size):
    got = Counter(r["split"] for r in sampling.train_test_split(papers, size, 42).collect())
    assert got["test"] == math.ceil(1000 * size) and got["train"] == 1000 - got["test"]


def test_split_share_must_be_a_fraction(papers):
    with pytest.raises(ValueError):
        sampling.train_test_split(papers, 1.0, 42)


def test_fast_split_is_stable_when_rows_are_added(papers):
    before = sampling.train_test_split(papers.where("paper_id < 500"), 0.3, 1, exact=False)
    after = sampling.train_test_split(papers, 0.3, 1, exact=False)
    assert before.exceptAll(after).count() == 0


def test_nested_split_is_a_partition_of_the_rows(papers):
    rows = sampling.nested_split(papers, 0.2, 42).collect()
    assert Counter(r["split"] for r in rows) == {"test": 200, "eval": 160, "train": 640}
    assert len({r["paper_id"] for r in rows}) == 1000
    other = sampling.nested_split(papers, 0.2, 43).where("split = 'test'")
    assert ids(other) != {r["paper_id"] for r in rows if r["split"] == "test"}


def test_ir_sample_takes_a_fifth_of_the_requested_size(papers):
    got = Counter(r["role"] for r in sampling.ir_sample(papers, 500, 42).collect())
    assert got == {"query": 100, "corpus": 400}
    assert Counter(r["role"] for r in sampling.ir_sample(papers, 5000, 42).collect()) == {"query": 1000}
    actual = Counter(r["role"] for r in sampling.ir_sample(papers, 5000, 42, "actual").collect())
    assert actual == {"query": 200, "corpus": 800}
    with pytest.raises(ValueError):
        sampling.ir_sample(papers, 10, 42, "half")


def test_stratified_sample_keeps_shares_and_size(skewed):
    got = Counter(r["primary_subject"] for r in sampling.stratified_sample(skewed, 300, 3).collect())
    assert sum(got.values()) <= 300
    assert got["hot"] >= 180
    small = sampling.stratified_sample(skewed, 20, 3).collect()
    assert len(small) == 20


def test_stratified_ir_split_caps_and_skips_singles(skewed):
    rows = sampling.stratified_ir_split(skewed, 10, 3).collect()
    per = {}
    for r in rows:
        per.setdefault(r["primary_subject"], Counter())[r["role"]] += 1
    assert not any(s.startswith("single") for s in per)
    assert per["hot"] == {"query": 2, "corpus": 8}
    assert all(c["query"] >= 1 and c["corpus"] >= 1 and sum(c.values()) <= 10 for c in per.values())


def test_positions_are_dense_and_in_draw_order(skewed):
    index = index_subjects(skewed, 9)
    at = {r["pos"]: r["paper_id"] for r in index.positions.collect()}
    subjects = index.subjects.collect()
    total = sum(r["n"] for r in subjects)
    assert sorted(at) == list(range(total))
    assert sorted(r["ix"] for r in subjects) == list(range(len(subjects)))
    members = {}
    for r in skewed.collect():
        members.setdefault(r["primary_subject"], []).append(r["paper_id"])
    for r in subjects:
        expected = by_draw(members[r["subject"]], 9, "pos")
        assert [at[r["lo"] + i] for i in range(r["n"])] == expected


def test_subject_counts_drop_singles(skewed):
    assert not any(r["subject"].startswith("single") for r in subject_counts(skewed).collect())
