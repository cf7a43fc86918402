"""The whole pipeline against a plain version of it, stage by stage, on a small table with every kind of case."""

import random
import re
import zlib

import numpy as np
import pytest
from test_corpus import BENCH, SPACE, _contaminated, _fp, _prose, _rows
from test_rows import _leaky, _scan

import corpus_pipeline
from simsearch.llm import packing
from simsearch.session import ship_package

MARGIN = {"symbols": 10, "lines": 40, "length": 150}


def _measures(text):
    """Words, whether the fixed rules fail, and the three ratios by their leading eight bits."""
    text = text or ""
    w = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeats = len({p for v in seen.values() if len(v) > 1 for i in v for p in range(i, i + 8)})
    counts = {"symbols": (len(re.findall(r"[#*$%&|<>]", text)), len(w)), "lines": (len(lines) - len(set(lines)), len(lines)), "length": (sum(map(len, w)), len(w))}
    ratio = {name: 100 * a // b if b else 0 for name, (a, b) in counts.items()}
    cut = lambda r: r >> max(0, r.bit_length() - 8) << max(0, r.bit_length() - 8)
    return len(w), len(w) < 20 or 100 * repeats > 30 * len(w), {name: cut(r) for name, r in ratio.items()}


def _fences(rows):
    """Limits of a list of measured documents."""
    limits = {}
    for name in MARGIN:
        values = sorted(r[2][name] for r in rows)
        at = lambda q: values[-(-q * len(values) // 4) - 1]  # noqa: E731, B023
        margin = max(3 * (at(3) - at(1)), MARGIN[name])
        limits[f"max_{name}"] = at(3) + margin
        if name == "length":
            limits["min_length"] = max(0, at(1) - margin)
    return limits


def _quality(rows):
    measured = [_measures(r[1]) for r in rows]
    long = [(r[2], r[3], m) for r, m in zip(rows, measured, strict=True) if m[0] >= 20]
    of = lambda *key: [m for lang, source, m in long if (lang, source)[: len(key)] == key]
    mix = lambda own, n, other: {k: (own[k] * n + 10 * other[k]) // (n + 10) for k in own}
    kept = []
    for row, (n, failed, ratio) in zip(rows, measured, strict=True):
        if n < 20 or failed:
            continue
        lang, group = of(row[2]), of(row[2], row[3])
        limit = mix(_fences(group), len(group), mix(_fences(lang), len(lang), _fences([m for _, _, m in long])))
        if all(ratio[r] <= limit[f"max_{r}"] for r in MARGIN) and ratio["length"] >= limit["min_length"]:
            kept.append(row)
    return kept


def _one_of_each(rows):
    """Of rows joined by chains of near fingerprints that with the smallest id. (Rows with one id and different texts do not occur here.)"""
    rows = list(dict.fromkeys(rows))
    fps = [_fp(r[1]) for r in rows]
    left, kept = set(range(len(rows))), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            i = todo.pop()
            group.add(i)
            near = {j for j in left if (fps[i] ^ fps[j]).bit_count() <= 3}
            left -= near
            todo += near
        kept.append(min((rows[i] for i in group), key=lambda r: (r[0] is None, r[0])))
    return kept


def _redacted(text):
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in _scan(text)[4].split(",") if s):
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind.upper()}]"]
        at = max(at, int(end))
    return "".join([*out, text[at:]])


def _expected(rows, bench):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    rows = [r for r in _one_of_each(_quality(rows)) if not _contaminated(r[1], bench)[1]]
    pieces = []
    for doc, text, *_ in rows:
        ids = np.array([*library.encode(_redacted(text), add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for size in packing.binary_lengths(len(ids)):
            pieces.append((doc, at, size, zlib.crc32(ids[at : at + size].tobytes()), len(ids)))
            at += size
    return sorted(pieces, key=repr)


def _documents():
    rng = random.Random(21)
    rows = [(r[0], r[1], r[2], r[3], None) for r in _rows()]
    for i in range(160):
        text = f"{_prose(rng, rng.randint(15, 60))} {_leaky(rng) if i % 3 == 0 else ''} {_prose(rng, rng.randint(5, 40))}"
        rows.append((1000 + i, text, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "s1", None]), len(text)))
    base = rows[-1][1]
    rows += [(2000 + i, base + " tail" * (i % 2), "en", "hot", 1) for i in range(40)]  # a large group of copies
    for i, leak in enumerate(("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "short item", "no id here")):
        rows.append((3000 + i, f"{_prose(rng, 30)} {leak} {_prose(rng, 30)}", "en", "s1", 1))
    rows += [(4000, f"{_prose(rng, 40)} {'# | ' * 60}", "en", "hot", 1), (4001, _prose(rng, 30_000), "en", "hot", 1), (4002, "word " * 40, "de", "s1", 1)]
    rows += [(None, rows[60][1], "en", "s1", 1), (None, f"{_prose(rng, 45)} unnamed", "en", "s1", 1), rows[70], rows[70]]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    ship_package(spark)
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(_documents(), "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_equals_its_plain_version(spark, folder):
    got = corpus_pipeline.run(spark, folder).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()
    want = _expected(_documents(), BENCH)
    assert sorted(map(tuple, got), key=repr) == want
    docs = {p[0] for p in want}
    assert len(docs) > 60 and not docs & {3000, 3001, 3002, 4000, 4002} and 4001 in docs and len(docs & set(range(2000, 2040))) <= 2


def test_stages_take_effect_one_after_the_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = _documents()
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:4], (_quality, _one_of_each, lambda r: [x for x in r if not _contaminated(x[1], BENCH)[1]], None), strict=True):
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if plain is not None:
            rows = plain(rows)
            assert sorted(((r[0], r[1]) for r in docs.collect()), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr), name
    assert {r["doc_id"]: r["text"] for r in docs.where("doc_id IS NOT NULL").collect()} == {r[0]: _redacted(r[1]) for r in rows if r[0] is not None}


def test_sequences_of_one_length_share_a_bucket(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pieces = packing.pack(docs, packing.default_tokenizer())
    packing.write_buckets(pieces, f"{tmp_path}/buckets")
    buckets = spark.read.parquet(f"{tmp_path}/buckets")
    lengths = {r["length"] for r in buckets.select("length").distinct().collect()}
    assert lengths == {r["length"] for r in pieces.select("length").distinct().collect()} and all(n & (n - 1) == 0 for n in lengths)
    one = spark.read.parquet(f"{tmp_path}/buckets/length=64")
    assert one.count() == buckets.where("length = 64").count() > 0 and {len(r["tokens"]) for r in one.collect()} == {256}
    assert buckets.count() == pieces.count()
