"""Quality rules with thresholds that each language and source sets for itself (DataFrame functions only).

Fixed rules: fewer than 20 words, or more than 30 in 100 words inside eight-word windows that repeat in the text.

Adaptive rules: three ratios of every document with 20 words or more (symbols per 100 words, repeated lines per 100 lines,
characters per 100 words) are counted in bins by (language, source). Bins are the ratio's leading ``BIN_BITS`` bits: exact below
256, beyond that a quantile is low by less than one part in 128, and there is no last bin. Such a count table is a
quantile sketch: two tables merge by adding the counts of equal bins, in any order, with the same result, and a table has at
most 7,424 bins a ratio. A document is rejected beyond an outer fence, the quartile plus three times the quartile
range and never less than a fixed margin, so a group of clean documents rejects none.

A group's fences are the mean, by weight, of its own, with one vote a document, and its language's, with ``PRIOR`` votes; a language's are
so mixed with those of all documents. The votes of others fade as a group grows; there is no size at which the rule changes.

Nulls: a null text has no words and fails the fixed rules; null languages or sources form groups of their own. Repeated rows
are judged one by one. Very long texts are measured whole, inside their row. Ties: a quartile that falls between two bins is the
smaller one, and a ratio on a fence is kept. An empty table gives no rows. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read; ``keep``
returns every column it was given, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsearch.llm.common import bounded_broadcast
from simsearch.session import checkpoint

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
PRIOR = 10
BIN_BITS = 8
# The least distance of a fence from its quartile.
MARGIN = {"symbols": 10, "lines": 40, "length": 150}
FENCE = 3
_NO_NAME = "\x00"  # stands for a null language or source in keys


def measures(docs: DataFrame, *carry: Column) -> DataFrame:
    """The carried columns with the counts of each text; every count is computed inside its row."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE), "")
    first = docs.select(*carry, "lang", "source", F.coalesce("text", F.lit("")).alias("text"), words.alias("words"))
    kept = [c for c in first.columns if c not in ("text", "words")]
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    second = first.select(
        *kept,
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
    )
    hashes = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    )
    kept += ["n_words", "word_chars", "n_symbols"]
    third = second.select(
        *kept,
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        hashes.alias("hashes"),
    )
    kept += ["n_lines", "n_dup_lines"]
    # Only a text with a repeated window sorts its windows.
    ordered = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    fourth = third.select(*kept, ordered.alias("ordered"))
    same = lambda x, j: x["h"] == F.get("ordered", j)["h"]
    repeated = F.filter("ordered", lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)))
    fifth = fourth.select(*kept, F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("starts"))
    covered = F.transform("starts", lambda s, j: F.coalesce(F.least(F.get("starts", j + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return fifth.select(*kept, F.coalesce(total, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def _bins() -> dict[str, Column]:
    parts = {"symbols": ("n_symbols", "n_words"), "lines": ("n_dup_lines", "n_lines"), "length": ("word_chars", "n_words")}
    ratio = lambda a, b: f"cast(coalesce(try_divide({a} * 100, {b}), 0) as bigint)"
    cut = lambda r: f"greatest(0, length(bin({r})) - {BIN_BITS})"  # noqa: E731  bits that a bin leaves out
    return {name: F.expr(f"shiftleft(shiftright({r}, {cut(r)}), {cut(r)})") for name, r in ((n, ratio(*p)) for n, p in parts.items())}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def sketches(docs: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n): the mergeable counts, combined before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(name).alias("ratio"), b.alias("bin")) for name, b in _bins().items()])
    return (
        measures(docs)
        .where(F.col("n_words") >= MIN_WORDS)
        .select(*_keys(), F.explode(pairs).alias("p"))
        .groupBy("g_lang", "g_source", "p.ratio", "p.bin")
        .agg(F.count("*").alias("n"))
    )


def _keys() -> list[Column]:
    return [F.coalesce(c, F.lit(_NO_NAME)).alias(f"g_{c}") for c in ("lang", "source")]


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row a group: its documents and the limits of the three ratios. A window holds one group's bins only."""
    merged = sketch.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    ranked = merged.select(
        *keys, "ratio", "bin", F.sum("n").over(group.orderBy("bin")).alias("upto"), F.sum("n").over(group).alias("total")
    )
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("bin")))
    by_ratio = ranked.groupBy(*keys, "ratio").agg(
        quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("total").alias("total")
    )
    margin = lambda r: F.greatest(FENCE * (F.col("q3") - F.col("q1")), F.lit(MARGIN[r]))
    limits = {
        "max_symbols": F.col("q3") + margin("symbols"),
        "max_lines": F.col("q3") + margin("lines"),
        "max_length": F.col("q3") + margin("length"),
        "min_length": F.greatest(F.lit(0), F.col("q1") - margin("length")),
    }
    return by_ratio.groupBy(*keys).agg(
        F.max("total").alias("n_docs"),
        *[F.max(F.when(F.col("ratio") == name[4:], value)).alias(name) for name, value in limits.items()],
    )


LIMITS = ("max_symbols", "max_lines", "max_length", "min_length")


def _mixed(own: str, n: str, others: Column) -> Column:
    """A limit with ``n`` votes for its own value and ``PRIOR`` for the others', in whole numbers."""
    return F.call_function("div", F.col(own) * F.col(n) + PRIOR * others, F.col(n) + PRIOR)


def thresholds(docs: DataFrame) -> DataFrame:
    """The limits of each (language, source)."""
    sketch = checkpoint(sketches(docs))
    fine, coarse = _fences(sketch, ["g_lang", "g_source"]), _fences(sketch, ["g_lang"])
    everything = _fences(sketch, []).select(*LIMITS).first()  # one row
    whole = {c: F.lit(everything[c] if everything else None).cast("bigint") for c in LIMITS}
    by_lang = coarse.select("g_lang", *[_mixed(c, "n_docs", whole[c]).alias("l_" + c) for c in LIMITS])
    mixed = fine.join(by_lang, "g_lang").select("g_lang", "g_source", *[_mixed(c, "n_docs", F.col("l_" + c)).alias(c) for c in LIMITS])
    return checkpoint(mixed)


def judge(docs: DataFrame, *carry: Column) -> DataFrame:
    """The carried columns, the counts, ``base_failed`` and ``kept``."""
    limits = thresholds(docs)
    limits = bounded_broadcast(limits, limits.count())
    rows = measures(docs, *carry).select("*", *_keys())
    rows = rows.join(limits, ["g_lang", "g_source"], "left")
    bins = _bins()
    outside = (
        (bins["symbols"] > F.col("max_symbols"))
        | (bins["lines"] > F.col("max_lines"))
        | (bins["length"] > F.col("max_length"))
        | (bins["length"] < F.col("min_length"))
    )
    failed = rows.select("*", base_failed().alias("base_failed"))
    return failed.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False)))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Rows are picked by a generator: the optimizer would move a filter below the projections that compute the counts once and
    so compute them anew for every word.
    """
    row = F.when(F.col("kept"), F.array("_row")).otherwise(F.slice(F.array("_row"), 1, 0))
    return judge(docs, F.struct("*").alias("_row")).select(F.inline(row))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op9_quality_rules(spark, sf_dir):
    from simsearch.llm.common import table

    return judge(table(spark, sf_dir, "documents"), F.col("doc_id")).select("doc_id", *COUNTS, "base_failed", "kept")


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(1)) AS lang, coalesce(source, chr(1)) AS source,
    coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
m AS (SELECT r, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM w),
g AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1),
c AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM d) GROUP BY r),
fr AS (SELECT m.*, coalesce(c.n, 0) AS n_repeat_words, n_words < 20 OR 100 * coalesce(c.n, 0) > 30 * n_words AS base_failed,
    CASE WHEN n_words = 0 THEN 0 ELSE n_symbols * 100 // n_words END AS r1,
    CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines * 100 // n_lines END AS r2,
    CASE WHEN n_words = 0 THEN 0 ELSE word_chars * 100 // n_words END AS r3 FROM m LEFT JOIN c USING (r)),
f AS (SELECT *, r1 - r1 % (1::BIGINT << greatest(0, length(ltrim(bin(r1), '0')) - 8)) AS b1,
    r2 - r2 % (1::BIGINT << greatest(0, length(ltrim(bin(r2), '0')) - 8)) AS b2,
    r3 - r3 % (1::BIGINT << greatest(0, length(ltrim(bin(r3), '0')) - 8)) AS b3 FROM fr),
s AS (SELECT lang, source, GROUPING(lang, source) AS level, count(*) AS n,
    quantile_disc(b1, 0.25) AS s1, quantile_disc(b1, 0.75) AS s3, quantile_disc(b2, 0.25) AS d1, quantile_disc(b2, 0.75) AS d3,
    quantile_disc(b3, 0.25) AS l1, quantile_disc(b3, 0.75) AS l3
    FROM f WHERE n_words >= 20 GROUP BY GROUPING SETS ((lang, source), (lang), ())),
x AS (SELECT lang, source, level, n, s3 + greatest(3 * (s3 - s1), 10) AS max_s, d3 + greatest(3 * (d3 - d1), 40) AS max_d,
    l3 + greatest(3 * (l3 - l1), 150) AS max_l, greatest(0, l1 - greatest(3 * (l3 - l1), 150)) AS min_l FROM s),
y AS (SELECT b.lang, (b.n * b.max_s + 10 * c.max_s) // (b.n + 10) AS max_s, (b.n * b.max_d + 10 * c.max_d) // (b.n + 10) AS max_d,
    (b.n * b.max_l + 10 * c.max_l) // (b.n + 10) AS max_l, (b.n * b.min_l + 10 * c.min_l) // (b.n + 10) AS min_l
    FROM x b JOIN x c ON c.level = 3 WHERE b.level = 1),
z AS (SELECT a.lang, a.source, (a.n * a.max_s + 10 * y.max_s) // (a.n + 10) AS max_s, (a.n * a.max_d + 10 * y.max_d) // (a.n + 10) AS max_d,
    (a.n * a.max_l + 10 * y.max_l) // (a.n + 10) AS max_l, (a.n * a.min_l + 10 * y.min_l) // (a.n + 10) AS min_l
    FROM x a JOIN y ON a.lang = y.lang WHERE a.level = 0)
SELECT f.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(b1 > z.max_s OR b2 > z.max_d OR b3 > z.max_l OR b3 < z.min_l, false) AS kept
FROM f LEFT JOIN z ON f.lang = z.lang AND f.source = z.source
"""
