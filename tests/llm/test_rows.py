"""Whole rows of operators that SQL does not express, against plain Python; and columns of any name."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from test_corpus import _prose, _rows

from simsearch.llm import chat, decontaminate, kdshard, quality, secrets, simhash, urlfilter

# ---- secrets


def _scan(text):
    """Base and linked spans of a text by its definition: every part against every other one of its scope."""
    text = text or ""
    base = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12 and m[0].isascii():
            base.append((m.start(), m.end(), "assign"))
    base += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    weak = [w for w in secrets.weak_spans(text) if not any(s < w[1] and w[0] < e for s, e, _ in base)]
    role = {"assign": "S", "hex": "S", "opaque": "S", "access": "I", "ident": "I", "endpoint": "E"}
    same = lambda x, y: not re.search(r"\n[\x20\t\r]*\n", text[min(x[0], y[0]) : max(x[0], y[0]) + 1])
    partner = lambda x, y: (role[x[2]] == "S") != (role[y[2]] == "S")
    spans = base + [w for w in weak if any(partner(w, o) and same(w, o) for o in base + weak)]
    kinds = ["assign", "access", "hex", "ident", "endpoint", "opaque"]
    order = lambda found: ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(found, key=lambda x: (x[0], kinds.index(x[2]), x[1])))
    counts = [sum(k == kind for _, _, k in base) for kind in kinds[:3]]
    return (*counts, hashlib.sha256(order(base).encode()).hexdigest(), order(spans))


def _leaky(rng):
    parts = [
        lambda: f"user = u{rng.randint(1, 99)}", lambda: "".join(rng.choice("aB3xY9_") for _ in range(rng.randint(15, 30))),
        lambda: f"https://h{rng.randint(1, 9)}.example/p?q=1", lambda: "token: " + "".join(rng.choice("abc123.=") for _ in range(rng.randint(5, 20))),
        lambda: "AKIA" + "".join(rng.choice("ABC123") for _ in range(rng.randint(5, 20))), lambda: "".join(rng.choice("0123abcdef") for _ in range(rng.randint(10, 24))),
        lambda: "\n\n", lambda: "\n \t\n", lambda: "\n", lambda: _prose(rng, rng.randint(1, 60)), lambda: "API_KEY=é", lambda: "server: abcd.example",
    ]
    return " ".join(rng.choice(parts)() for _ in range(rng.randint(1, 25)))


def test_secret_scan_equals_brute_force(spark):
    rng = random.Random(13)
    texts = [r[1] for r in _rows()] + [_leaky(rng) for _ in range(300)] + ["x " * 30_000 + _leaky(rng) + " y" * 30_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, texts[60], "", 0), (3, texts[60], "", 0), (None, texts[61], "", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, `n hex` int").repartition(4)
    want = sorted(((d, *_scan(t)) for d, t, _, _ in rows), key=repr)
    assert sorted(map(tuple, secrets.scan(df).collect()), key=repr) == want
    assert sum(len(w[5]) > 0 for w in want) > 100


# ---- sharding


def _tree(points, shards):
    """The k-d tree by sorting: cut the widest dimension at the first place where the bytes before exceed the left half's share."""
    out, todo = {}, [(0, shards, points)]
    while todo:
        first, n, own = todo.pop()
        if n == 1 or not own:
            out[first] = own
            continue
        dims = [[p[2][d] for p in own] for d in range(4)]
        wide = max(range(4), key=lambda d: max(dims[d]) - min(dims[d]))
        want, upto, at = sum(p[1] for p in own) * (n // 2) // n, {}, 0
        for p in own:
            upto[p[2][wide]] = upto.get(p[2][wide], 0) + p[1]
        for key in sorted(upto):
            at += upto[key]
            if at > want:
                break
        todo += [(first, n // 2, [p for p in own if p[2][wide] < key]), (first + n // 2, n - n // 2, [p for p in own if p[2][wide] >= key])]
    return out


def _documents():
    rng = random.Random(7)
    rows = [(i, _prose(rng, rng.randint(0, 80)), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", None])) for i in range(500)]
    return rows + [(900, "y" * 30_000, "en", "hot"), (901, None, None, None), (None, None, None, None)]


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_sharding_equals_a_plain_tree(spark, shards):
    rows = _documents()
    points = kdshard.points(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3))
    held = [(i, r["size"], [r[d] for d in kdshard.DIMENSIONS], r["text_crc32"], r["doc_id"]) for i, r in enumerate(points.collect())]
    want = sorted((str(p[4]), p[1], p[3], shard) for shard, own in _tree(held, shards).items() for p in own)
    got = kdshard.place(points, shards).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["node"]) for r in got) == want
    by_text = {(str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _, _ in rows}
    assert {w[:3] for w in want} == by_text


@pytest.mark.parametrize("row", [(5, "the same text " * 20, "en", "hot"), (None, "", None, None)])
def test_a_row_that_repeats_to_a_third_of_all_fills_its_shards_evenly(spark, row):
    rows = _documents()[:500]
    copies = len(rows) if row[0] is None else sum(len(t or "") for _, t, _, _ in rows) // 2 // len(row[1])
    df = spark.createDataFrame(rows + [row] * copies, "doc_id bigint, text string, lang string, source string")
    found = kdshard.shard(df, 24).groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    sizes = [r["s"] for r in found]
    assert len(found) == 24 and max(sizes) - min(sizes) < 0.35 * (sum(sizes) / 24) and all(r["n"] == r["top"] + 1 for r in found)


def test_leaves_may_be_asked_for_by_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 92, None, None) for i in range(640)], "doc_id bigint, text string, lang string, source string")
    found = kdshard.shard(df, target_bytes=8_000).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(found) == 8 and max(r["s"] for r in found) <= 8_800


# ---- quality


def _kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return {r["doc_id"]: r["kept"] for r in quality.judge(df, F.col("doc_id")).collect()}


def test_no_bin_is_the_last_one(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(i, " ".join(word(rng.randint(110, 130)) for _ in range(25)), "xx", "long") for i in range(120)]
    rows += [(500, " ".join(word(5_000) for _ in range(25)), "xx", "long"), (501, " ".join(word(300) for _ in range(25)), "xx", "long")]
    kept = _kept(spark, rows)
    assert all(kept[i] for i in range(120)) and not kept[500] and not kept[501]


def test_bins_lose_less_than_a_part_in_128(spark):
    values = [0, 1, 99, 255, 256, 257, 511, 1000, 123_456, 10**9, 10**15]
    df = spark.createDataFrame([(v, 100, v, 100, v) for v in values], "n_symbols bigint, n_words bigint, n_dup_lines bigint, n_lines bigint, word_chars bigint")
    for row in df.select("n_symbols", *[c.alias(n) for n, c in quality._bins().items()]).collect():
        v = row["n_symbols"]
        assert all(row[n] <= v and v - row[n] <= v / 128 and (v >= 256 or row[n] == v) for n in ("symbols", "lines", "length"))


def test_a_groups_own_rule_grows_with_its_documents(spark):
    """Texts with many symbols: alone in their source they are judged by the others' rule, which fades without a jump."""
    rng = random.Random(6)
    prose = [(i, _prose(rng, 60), "en", "prose") for i in range(300)]
    limits = []
    for n in (1, 48, 49, 50, 51, 400):
        code = [(1000 + i, _prose(rng, 50) + " #" * 25, "en", "code") for i in range(n)]
        df = spark.createDataFrame(prose + code, "doc_id bigint, text string, lang string, source string")
        limits.append(quality.thresholds(df).where("g_source = 'code'").first()["max_symbols"])
    assert limits == sorted(limits) and limits[0] < 15 and limits[-1] > 35 and max(b - a for a, b in zip(limits[1:4], limits[2:5], strict=True)) <= 1


# ---- columns of any name


def test_columns_of_any_name_come_through(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, `a b` int, `x-y.z` string, `_text` string, `_row` int, `q``s` array<string>"
    rows = [(i, f"{'word ' * 5}{i} some more plain words here to make it twenty in all one two three four five six seven", "en", "s", 1, 2, "3", "4", 5, ["6"]) for i in range(4)]
    docs = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([(1, "nothing of this stands there at all in any text here")], "item_id bigint, text string")
    for kept in (secrets.redact(docs), decontaminate.remove_documents(docs, bench), quality.keep(docs), simhash.keep_one(docs)):
        assert kept.columns == docs.columns and kept.count() >= 1
        assert all(r["x-y.z"] == "3" and r["q`s"] == ["6"] and r["_row"] == 5 for r in kept.collect())
    pages = spark.createDataFrame([(1, "https://a.example/x", 2, "3")], "page_id bigint, url string, `a b` int, `host` string")
    assert [tuple(r) for r in urlfilter.keep(pages).collect()] == [(1, "https://a.example/x", 2, "3")]


# ---- benchmark tables and automata of any size


def test_windows_of_many_items_are_held_in_a_few_bytes_each():
    words = [f"w{i % 977}x{i % 31}" for i in range(60_000)]
    windows = decontaminate.Windows([(str(i), " ".join(words[i : i + 60]).encode()) for i in range(0, 60_000, 60)], 10)
    hashes, _, starts, ends, item = windows.by_length[10]
    assert len(hashes) == 51_000 and len(windows.buffer) + sum(a.nbytes for a in (hashes, starts, ends, item)) < 40 * 51_000
    spans, items = windows.find([w.encode() for w in words[100:130]], decontaminate.np.zeros(30, dtype=int))
    assert spans and set().union(*items.values()) <= set(windows.names)


def test_many_globs_are_run_in_bounded_groups(monkeypatch):
    seen = []
    automaton = urlfilter.Automaton([urlfilter.Glob(f"*x{i}y*", "", "block", -1) for i in range(2_000)])
    whole = urlfilter.Automaton._simulate
    monkeypatch.setattr(urlfilter.Automaton, "_simulate", lambda self, urls, lengths: (seen.append(len(urls)), whole(self, urls, lengths))[1])
    fits = automaton.run([f"ax{i}yb".encode() for i in range(3_000)])
    assert all(fits[i, i] for i in range(2_000)) and not fits[2_500].any()
    assert max(seen) * 40 * automaton.words <= urlfilter.STEP_BYTES


# ---- chat


def _read(spark, events):
    log = spark.createDataFrame(events, "conv_id bigint, msg string, seq int, kind string, role string, text string").repartition(3)
    return {r["conv_id"]: r for r in chat.read_back(chat.render(chat.fold(log))).collect()}


def _turns(*turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_turns_stand_in_the_order_of_their_first_events_whatever_their_names(spark):
    events = [(1, "m2", 0, "delta", "user", "first"), (1, "m1", 1, "delta", "assistant", "se"), (1, "m0", 2, "delta", "user", "third"), (1, "m1", 3, "delta", None, "cond")]
    assert _read(spark, events)[1]["turns_sha256"] == _turns(("user", "first"), ("assistant", "second"), ("user", "third"))


def test_ties_in_sequence_go_by_kind_and_text_and_then_by_name(spark):
    events = [(1, "b", 0, "delta", "user", "y"), (1, "b", 0, "delta", "user", "x"), (1, "a", 0, "delta", "user", "z"), (1, "c", None, "delta", "user", "0")]
    assert _read(spark, events)[1]["turns_sha256"] == _turns(("user", "0"), ("user", "z"), ("user", "xy"))


@pytest.mark.parametrize("kind", ["append", None])
def test_an_unknown_kind_is_an_error(spark, kind):
    with pytest.raises(Exception, match="event of unknown kind"):
        _read(spark, [(1, "a", 0, "delta", "user", "x"), (1, "a", 1, kind, "user", "y")])


def test_turns_are_found_in_the_string_not_in_its_rows(spark, monkeypatch):
    rng = random.Random(3)
    turns = [(rng.choice(["user", "assistant", "[/INST]"]), rng.choice(["", "</s>[INST] ok", "x" * rng.randint(1, 900), "é<s>" * 40])) for _ in range(60)]
    text = "".join(chat.OPEN + chat.escape(r) + chat.MIDDLE + chat.escape(t) + chat.CLOSE for r, t in turns)
    for size in (1, 7, 64, 10_000):
        reader, masks, at = chat.Reader(), [], 0
        for r, t in turns:
            low = at + len(chat.OPEN + chat.escape(r) + chat.MIDDLE)
            masks.append((low, low + (len(chat.escape(t)) if r == "assistant" else 0)))
            at = low + len(chat.escape(t) + chat.CLOSE)
        for i in range(0, len(text), size):
            reader.read(text[i : i + size], [m for m in masks if i <= m[0] < i + size])
        loss = "".join(t for r, t in turns if r == "assistant")
        assert reader.row(5) == (5, 60, _turns(*turns), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
    with pytest.raises(ValueError, match="ends inside a turn"):
        unfinished = chat.Reader()
        unfinished.read("<s>[INST]user[/INST]x", [])
        unfinished.row(1)


def test_the_log_of_a_table_folds_to_the_table(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 5), rng.choice([None, *range(-3, 40)]), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "é" * 5, _prose(rng, 9), "</s>"]), "odd") for _ in range(300)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, `seq no` string")
    log = chat.log_of(table)
    assert {r["kind"] for r in log.select("kind").distinct().collect()} == set(chat.KINDS)
    order = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    want = {}
    for conv, _, role, text, _ in sorted(rows, key=order):
        want.setdefault(conv, []).append((role or "", text or ""))
    got = chat.read_back(chat.render(chat.fold(log))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"]) for r in got} == {c: (len(t), _turns(*t)) for c, t in want.items()}
