"""Operator 1: quality rules by a hashed n-gram log-likelihood ratio [DataFrame functions only].

Words and adjacent word pairs are hashed (CRC-32) into ``BUCKETS`` buckets.  Two multinomials
with add-one smoothing are counted over them: the trusted target and the raw corpus.  A text's
score is the mean, over its words and pairs, of the log ratio target / corpus; a text is kept
if the base rules pass and the score reaches ``THRESHOLD``.  No draw is made, so each text's
verdict is a function of the tables.  Log ratios are whole millionths, so sums do not depend on
the order of addition.

The corpus counts cover every word of every text.  The target is a bounded sample of trusted
rows (``target_docs``, by MD5 of the id), counted over their whole texts.  Both come from one pass
that pre-aggregates on the map side into at most ``BUCKETS`` rows a task; the weights (a fixed
number) are the only thing that returns to the driver.  Scoring is one map-only pass.

Defined cases: null and blank texts have no words, fail the base rules and have a null score;
without trusted rows all ratios are equal to those of an even target; repeated rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from clockroll.llm.common import words_of

BUCKETS = 1 << 16
TARGET_DOCS = 20_000
THRESHOLD = -0.15
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20


def buckets_of(words: Column) -> Column:
    """Buckets of the words and of the adjacent pairs."""
    n = F.size(words)
    bucket = lambda s: F.pmod(F.crc32(s.cast("binary")), F.lit(BUCKETS)).cast("int")
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: bucket(F.concat(a, F.lit(" "), b)))
    return F.concat(F.transform(words, bucket), pairs)


def log_ratios(df: DataFrame, trusted: DataFrame, target_docs: int = TARGET_DOCS) -> list[int]:
    """Millionths of log(target / corpus) for each bucket.  ``df``: id, text; ``trusted``: id."""
    ids = (trusted.select("id").where("id IS NOT NULL").distinct()
           .orderBy(F.md5(F.col("id").cast("string")), "id").limit(target_docs).withColumn("trusted", F.lit(1)))
    flagged = df.select("id", words_of(F.col("text")).alias("words")).join(F.broadcast(ids), "id", "left")
    each = flagged.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(buckets_of(F.col("words"))).alias("b"))
    rows = each.groupBy("b").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in rows:
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    n_raw, n_target = sum(raw) + BUCKETS, sum(target) + BUCKETS
    return [round((math.log((t + 1) / n_target) - math.log((c + 1) / n_raw)) * 1e6) for c, t in zip(raw, target, strict=True)]


def base_measures(df: DataFrame) -> DataFrame:
    """Adds ``words`` and the base measures to ``df`` (with ``text``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("words", words_of(F.col("text"))).withColumn("_lines", lines)
    # Hashes of 1, 2, 4 and 5 words in a row, each from two of those before.
    def in_a_row(first: str, then: str, shift: int, words: int) -> Column:
        n = F.greatest(F.size("_one") - (words - 1), F.lit(0))
        return F.zip_with(F.slice(first, F.lit(1), n), F.slice(then, F.lit(shift + 1), n), lambda a, b: F.xxhash64(a, b))

    df = df.withColumn("_one", F.transform("words", lambda w: F.xxhash64(w))).withColumn("_two", in_a_row("_one", "_one", 1, 2))
    df = df.withColumn("_four", in_a_row("_two", "_two", 2, 4)).withColumn("_windows", in_a_row("_four", "_one", 4, WINDOW))
    # Only texts with a repeated window need its places: windows side by side in hash order.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_ordered", ordered)
    o = F.col("_ordered")
    places = F.transform("_ordered", lambda s, k: F.when((F.get(o, k - 1)["h"] == s["h"]) | (F.get(o, k + 1)["h"] == s["h"]), s["i"]))
    df = df.withColumn("_places", F.sort_array(F.array_compact(places)))
    p = F.col("_places")
    covered = F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
    n_words = F.size("words").cast("long")
    n_repeat = F.coalesce(covered, F.lit(0)).cast("long")
    return (df.withColumns({
        "n_words": n_words, "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "n_repeat_words": n_repeat})
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))
        .drop("_lines", "_one", "_two", "_four", "_windows", "_ordered", "_places"))


def judge(df: DataFrame, ratios: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """``df`` (id, text) with the base measures, ``score`` and ``kept``."""
    weights = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<bigint>")  # folded to one constant
    judged = base_measures(df).withColumn("_buckets", buckets_of(F.col("words")))
    total = F.aggregate("_buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(weights, b))
    n = F.size("_buckets").cast("long")
    judged = judged.withColumn("_total", total)
    reached = F.col("_total") >= F.lit(round(threshold * 1e6)) * n
    return (judged.withColumn("score", F.when(n > 0, F.col("_total") / n / 1e6))
            .withColumn("kept", ~F.col("base_failed") & reached)
            .drop("words", "_buckets", "_total"))


#: DuckDB: the same rules over strings; CRC-32 is spelled out over bytes.
SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i::UBIGINT] || [0::UBIGINT,0,0,0,0,0,0,0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
target AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {TARGET_DOCS}),
grams AS (
  SELECT rid, doc_id, unnest(words) AS g FROM docs
  UNION ALL
  SELECT rid, doc_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM docs WHERE len(words) > 1),
hashed AS (
  SELECT g, (xor(list_reduce([4294967295::UBIGINT] || list_transform(range(len(hex(g)) // 2), lambda k: ('0x' || substr(hex(g), (2 * k + 1)::BIGINT, 2))::UBIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::INT + 1])), 4294967295::UBIGINT) % {BUCKETS})::INT AS b
  FROM (SELECT DISTINCT g FROM grams), crc_table),
counted AS (
  SELECT b, count(*) AS raw, count(target.doc_id) AS target
  FROM grams JOIN hashed USING (g) LEFT JOIN target USING (doc_id) GROUP BY b),
weights AS (
  SELECT b, round((ln((target + 1) / (sum(target) OVER () + {BUCKETS})) - ln((raw + 1) / (sum(raw) OVER () + {BUCKETS}))) * 1e6)::BIGINT AS w FROM counted),
scores AS (SELECT rid, sum(w) AS total, count(*) AS n FROM grams JOIN hashed USING (g) JOIN weights USING (b) GROUP BY rid),
places AS (
  SELECT rid, i, list_aggregate(words[i:i + {WINDOW - 1}], 'string_agg', ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM docs WHERE len(words) >= {WINDOW})),
repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM places) WHERE c > 1),
covered AS (
  SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n_repeat
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM repeated) GROUP BY rid),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
base AS (
  SELECT docs.rid, doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, total, n
  FROM docs LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN scores USING (rid)),
failed AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND total >= {round(THRESHOLD * 1e6)} * n AS kept, CASE WHEN n > 0 THEN total / n / 1e6 END AS score
FROM failed
"""
