"""Odd-sketch near-duplicates against brute force: families, revision chains, copies, crowded keys."""

import random
import re

import numpy as np
import pytest
from test_corpus import _components, _lower, _rows

from simsearch.llm import minhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text):
    w = SPACE.findall(_lower(text))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def _expected(rows):
    sets = [_set(r[1]) for r in rows]
    near = lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    groups = _components([r[0] for r in rows], near)
    return sorted(((r[0], len(s), g, r[0] == g) for r, s, g in zip(rows, sets, groups, strict=True)), key=repr)


def _got(df):
    return sorted(map(tuple, minhash.near_groups(df).collect()), key=repr)


def test_groups_equal_brute_force(spark):
    rows = _rows()
    schema = "doc_id bigint, text string, lang string, node string, n string, bands string, `a b` string, copies int"
    assert _got(spark.createDataFrame(rows, schema).repartition(3)) == _expected(rows)


def _family(rng, size, changes, length=80):
    base = [f"w{rng.getrandbits(30):x}" for _ in range(length)]
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(length)] = f"v{rng.getrandbits(30):x}"
        yield " ".join(words)


def _chain(rng, size, length=100):
    """Each revision is linked to the next, not to those after it."""
    words = [f"c{rng.getrandbits(30):x}" for _ in range(length)]
    for i in range(size):
        yield " ".join(words)
        for at in (10 * i % length, (10 * i + 50) % length):
            words[at] = f"r{rng.getrandbits(30):x}"


@pytest.mark.parametrize("block", [4, minhash.BLOCK])
def test_families_and_chains_equal_brute_force(spark, monkeypatch, block):
    """Templates with members below and above the similarity share keys; every link between them counts."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "STAR", 2 * block)
    rng = random.Random(8)
    texts = [t for changes in (1, 3, 5, 8, 12) for t in _family(rng, 14, changes)] + list(_chain(rng, 25))
    texts += texts[:10] + [t.upper().replace(" ", "  ") for t in texts[5:12]]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert _got(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)) == _expected(rows)


def test_small_sets_at_the_border_are_found(spark):
    rows = [(0, "a b c d e f g"), (1, "a b c d e f g h"), (2, "x a b c d e f g"), (3, "p q r s t u v w"), (4, "p q r s t u v"), (5, "one"), (6, "ONE"), (7, "one two three"), (8, "one two three four")]
    assert _got(spark.createDataFrame(rows, "doc_id bigint, text string")) == _expected(rows)


def test_one_id_with_several_texts_and_repeated_rows(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    rows = [(1, a), (1, b), (2, a), (2, a), (3, b + " tail"), (None, a), (None, "alone with no id"), (None, ""), (4, None), (4, "")]
    assert _got(spark.createDataFrame(rows, "doc_id bigint, text string")) == _expected(rows)
    assert _got(spark.createDataFrame([], "doc_id bigint, text string")) == []


def test_sketches_tell_high_similarities():
    rng = np.random.default_rng(5)
    for share in (0.6, 0.8, 0.9, 1.0):
        common = int(2000 * share / (1 + share))  # of two sets of 1,000
        left = []
        for _ in range(40):
            x = rng.integers(0, 1 << 63, size=2000 - common, dtype=np.uint64)
            least = minhash.samples(np.concatenate([x[:1000], np.concatenate([x[:common], x[1000:]])]), np.array([0, 1000]))
            odd = minhash.odd_sketches(least).view(np.uint64)
            left.append(int(np.bitwise_count(odd[0] ^ odd[1]).sum()))
        flips = 2 * minhash.SAMPLES * (1 - share)
        assert abs(np.mean(left) - 256 * (1 - (1 - 2 / 512) ** flips)) < 6
        if share >= 0.8:
            assert max(left) <= minhash.most_bits(80)
    assert minhash.most_bits(80) < 256 * (1 - (1 - 2 / 512) ** (2 * minhash.SAMPLES * 0.55))


def test_pairs_at_the_similarity_share_a_band():
    rng = np.random.default_rng(6)
    missed = 0
    for _ in range(200):
        x = rng.integers(0, 1 << 63, size=180, dtype=np.uint64)
        least = minhash.samples(np.concatenate([x[:162], x[18:]]), np.array([0, 162]))  # 144 of 180 are common
        keys = minhash.band_keys(least)
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0
