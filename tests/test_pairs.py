from collections import Counter

import pytest
from pyspark.sql import functions as F

from simsearch.operators import pairs, skew
from simsearch.operators.pairs import PairConfig, contrastive_pairs, pair_builder, positive_pairs


def subjects_of(papers):
    return {r["paper_id"]: r["primary_subject"] for r in papers.collect()}


@pytest.mark.parametrize("balanced", [True, False])
def test_positive_pairs_join_two_papers_of_one_subject(skewed, balanced):
    subject = subjects_of(skewed)
    rows = positive_pairs(skewed, PairConfig(300, balanced=balanced)).collect()
    assert sorted(r["pair_id"] for r in rows) == list(range(300))
    for r in rows:
        assert r["anchor_id"] != r["positive_id"]
        assert subject[r["anchor_id"]] == subject[r["positive_id"]] == r["subject"]
        assert r["anchor"] == f"text {r['anchor_id']}" and r["positive"] == f"text {r['positive_id']}"
        assert not r["subject"].startswith("single")
    share = Counter(r["subject"] for r in rows)["hot"] / 300
    assert share < 0.1 if balanced else 0.5 < share < 0.8


@pytest.mark.parametrize("count", [1, 5, 100])
def test_positive_pair_count_is_exact(papers, count):
    assert positive_pairs(papers, PairConfig(count)).count() == count


def test_same_seed_same_pairs_other_seed_or_epoch_others(papers):
    def rows(df, **kw):
        return {tuple(r) for r in positive_pairs(df, PairConfig(50, **kw)).collect()}

    base = rows(papers, seed=1)
    assert base == rows(papers.repartition(9), seed=1)
    assert base != rows(papers, seed=2) and base != rows(papers, seed=1, epoch=1)


@pytest.mark.parametrize("count", [2, 10, 101])
@pytest.mark.parametrize("min_rows", [2, 1])
def test_contrastive_pairs_are_half_positive(skewed, count, min_rows):
    subject = subjects_of(skewed)
    rows = contrastive_pairs(skewed, PairConfig(count, negatives_min_rows=min_rows)).collect()
    assert len(rows) == count
    assert Counter(r["label"] for r in rows)[1.0] == count // 2
    for r in rows:
        assert (subject[r["id1"]] == subject[r["id2"]]) == (r["label"] == 1.0)
        assert r["id1"] != r["id2"]


def test_single_rows_appear_in_negatives_only_when_allowed(skewed):
    def singles(min_rows):
        subject = subjects_of(skewed)
        rows = contrastive_pairs(skewed, PairConfig(2000, negatives_min_rows=min_rows)).collect()
        return sum(subject[i].startswith("single") for r in rows for i in (r["id1"], r["id2"]))

    assert singles(2) == 0 and singles(1) > 0


def test_one_eligible_subject_gives_positives_only(spark):
    rows = [(1, "a", "Physics"), (2, "b", "Physics"), (3, "c", "Solo")]
    papers = spark.createDataFrame(rows, "paper_id bigint, abstract string, primary_subject string")
    got = contrastive_pairs(papers, PairConfig(7)).collect()
    assert [r["label"] for r in got] == [1.0] * 7


def test_no_eligible_subject_is_an_error(papers):
    alone = papers.withColumn("primary_subject", F.col("title"))
    for builder in (positive_pairs, contrastive_pairs):
        with pytest.raises(ValueError, match="no subject"):
            builder(alone, PairConfig(5))


def test_result_does_not_depend_on_the_join_strategy(skewed, monkeypatch):
    config = PairConfig(200, balanced=False)
    before = sorted(tuple(r) for r in positive_pairs(skewed, config).collect())
    monkeypatch.setattr(pairs, "MAX_BROADCAST_DRAWS", 0)
    monkeypatch.setattr(pairs, "MAX_BROADCAST_GROUPS", 0)
    assert sorted(tuple(r) for r in positive_pairs(skewed, config).collect()) == before


def test_other_text_fields_can_be_paired(papers):
    row = positive_pairs(papers, PairConfig(1, text_field="title")).first()
    assert row["anchor"] == f"Paper {row['anchor_id']}"


def test_builders_by_loss_name():
    assert pair_builder("ContrastiveLoss") is contrastive_pairs
    assert pair_builder("MultipleNegativesRankingLoss") is positive_pairs
    with pytest.raises(ValueError, match="unsupported loss"):
        pair_builder("Contrastive")


@pytest.mark.parametrize("build", [pairs.positive_pairs, pairs.contrastive_pairs])
def test_a_paper_that_is_drawn_all_the_time_changes_nothing(spark, monkeypatch, build):
    """A two-row subject beside a huge one: past the broadcast bound its papers are hot keys."""
    rows = [(i, f"text {i}", "tiny" if i < 2 else "huge") for i in range(600)]
    papers = spark.createDataFrame(rows, "paper_id bigint, abstract string, primary_subject string")
    config = pairs.PairConfig(num_pairs=300, seed=3)
    want = sorted(map(tuple, build(papers, config).collect()))
    monkeypatch.setattr(pairs, "MAX_BROADCAST_DRAWS", 0)
    monkeypatch.setattr("simsearch.operators.skew.MAX_BROADCAST_GROUPS", 1)
    assert sorted(map(tuple, build(papers, config).collect())) == want and len(want) == 300


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_texts_are_shuffled_and_not_stored(spark, papers, monkeypatch, bound):
    """Neither within the broadcast bound nor past it are texts checkpointed; pairs of one anchor lie together."""
    seen = []
    whole = skew.checkpoint
    for module in (skew, pairs):
        monkeypatch.setattr(module, "checkpoint", lambda df: (seen.append(df.columns), whole(df))[1], raising=False)
    monkeypatch.setattr(pairs, "MAX_BROADCAST_DRAWS", bound)
    monkeypatch.setattr(skew, "MAX_BROADCAST_GROUPS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = positive_pairs(papers, PairConfig(2000, seed=4))
        anchors = [[r["anchor_id"] for r in part] for part in made.select("anchor_id").rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [columns for columns in seen if "abstract" in columns]
    assert sum(map(len, anchors)) == 2000
    assert sum(a != b for part in anchors for a, b in zip([None, *part], part, strict=False)) == len({a for part in anchors for a in part})


def test_a_paper_that_is_drawn_very_often_is_dealt_out_in_copies(spark, monkeypatch):
    lookups = spark.range(4000).select(F.col("id").alias("pair_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("side"))
    lookups = lookups.withColumn("paper_id", F.when(F.col("side") == 1, 7).otherwise(F.col("pair_id") + 10))
    table = spark.range(5000).select(F.col("id").alias("paper_id"), F.concat(F.lit("text "), "id").alias("abstract"))
    drawn, hot = pairs._copied(pairs._paired(lookups), 8000)
    assert [tuple(r) for r in hot.collect()] == [(7, 63)] and drawn.count() == 4001
    for bound in (2_000_000, 0):
        monkeypatch.setattr(pairs, "MAX_BROADCAST_DRAWS", bound)
        got = pairs.attach_both_sides(lookups, table, ["abstract"], 8000)
        assert {tuple(r) for r in got.collect()} == {(i, 7, i + 10, "text 7", f"text {i + 10}") for i in range(4000)}
        assert got.count() == 4000


def test_repeated_papers_and_lost_sides_make_one_row_a_pair(spark):
    """An id that the table holds more than once gives its first text that is not null, one that it lacks gives nulls."""
    lookups = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 6), (2, 2, 9), (3, 1, 8), (3, 2, 9)], "pair_id bigint, side int, paper_id bigint")
    table = spark.createDataFrame([(5, None), (5, "five"), (5, "five"), (6, "six"), (6, None), (None, "none"), (None, None)], "paper_id bigint, abstract string")
    got = pairs.attach_both_sides(lookups, table, ["abstract"], 6)
    assert sorted(map(tuple, got.collect())) == [(1, 5, 6, "five", "six"), (2, 6, None, "six", None)]


@pytest.mark.parametrize("build", [positive_pairs, contrastive_pairs])
def test_the_parts_hold_all_pairs(skewed, monkeypatch, build):
    config = PairConfig(500, balanced=False)
    want = sorted(map(tuple, build(skewed, config).collect()))
    monkeypatch.setattr(pairs, "MIN_PART_PAIRS", 100)
    parts = [part.collect() for part in pairs.pair_parts(build, skewed, config)]
    assert 2 <= len(parts) <= 5 and max(map(len, parts)) < 250  # also of the subject that has two thirds of the rows
    assert sorted(tuple(r) for part in parts for r in part) == want
