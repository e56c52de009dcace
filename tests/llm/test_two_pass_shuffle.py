import tempfile
import zlib

from clockroll.llm import two_pass_shuffle as T


def run(spark, df, **options):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/shards"
    T.write_shards(df, path, **options)
    return T.read_shards(spark, path, df)


def test_rows_law(spark, edge_docs):
    out = run(spark, edge_docs, n_shards=4, bucket_bytes=2000)
    rows = out.collect()
    assert sorted((r.doc_id, r.text, r.score) for r in rows if r.doc_id is not None and r.text) == sorted((r.doc_id, r.text, r.score) for r in edge_docs.collect() if r.doc_id is not None and r.text)
    sizes = []
    for s in range(4):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
        sizes.append(len(slots))
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 11
    for r in T.digests(out).collect():
        assert r.law == "rows" and r.grown_shard is None
    texts = {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in edge_docs.collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in T.digests(out).collect()} == texts


def test_same_for_any_partitioning_and_seeded(spark):
    df = spark.range(500).selectExpr("id as doc_id", "concat('t', id) as text")
    place = lambda x: {r.doc_id: (r.shard, r.slot) for r in x.collect()}
    a = place(run(spark, df.repartition(7), n_shards=24, bucket_bytes=4096))
    assert a == place(run(spark, df.coalesce(1), n_shards=24, bucket_bytes=4096))
    assert a != place(run(spark, df, n_shards=24, bucket_bytes=4096, seed=2))
    # A shuffle: neighbours do not stay together.
    near = sum(a[i][0] == a[i + 1][0] for i in range(499))
    assert near < 60


def test_empty_and_clashing_names(spark, no_docs):
    assert run(spark, no_docs).count() == 0
    df = spark.createDataFrame([(1, "x", 5, "s")], "doc_id long, text string, shard int, slot string")
    r = run(spark, df, n_shards=2).collect()[0]
    assert (r["_shard"], r["_slot"], r["slot"]) == (5, "s", 0)


def test_permutation_by_a_plain_two_pass_shuffle(spark):
    """Buckets by hash, each in hash order, shuffled by its seed, laid end to end, cut into shards."""
    import random
    df = spark.range(400).selectExpr("id as doc_id", "concat('text', id) as text")
    from pyspark.sql import functions as F
    keyed = df.select("doc_id", F.xxhash64(F.lit(T.SEED), "doc_id", "text").alias("h1"), F.xxhash64(F.lit(T.SEED + 1), "doc_id", "text").alias("h2")).collect()
    size = sum(len(f"text{i}") + 64 for i in range(400))
    n_buckets = -(-size // 3000)
    laid = []
    for k in range(n_buckets):
        bucket = sorted(((r.h1, r.h2, r.doc_id) for r in keyed if r.h1 % n_buckets == k))
        draw = random.Random(f"{T.SEED}:{k}")
        for i in range(len(bucket) - 1, 0, -1):
            j = draw.randrange(i + 1)
            bucket[i], bucket[j] = bucket[j], bucket[i]
        laid += [x[2] for x in bucket]
    want = {}
    for s in range(7):
        part = laid[-(-s * 400 // 7) if s * 400 % 7 == 0 else s * 400 // 7:(s + 1) * 400 // 7]
        want |= {d: (s, i) for i, d in enumerate(part)}
    got = {r.doc_id: (r.shard, r.slot) for r in run(spark, df, n_shards=7, bucket_bytes=3000).collect()}
    assert got == want


def test_equal_rows_do_not_share_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(T, "REPEATED", 50)
    rows = [(1, "same", 1)] * 600 + [(i, f"t{i}", 1) for i in range(300)] + [(7, None, 2)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    out = run(spark, df, n_shards=6, bucket_bytes=2000)
    got = out.collect()
    assert sorted((r.doc_id, r.text or "", r.n) for r in got) == sorted((a, b or "", c) for a, b, c in rows)
    for s in range(6):
        part = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert 60 < sum(r.text == "same" for r in part) < 130  # spread like other rows


def test_long_text_and_nested_columns(spark):
    rows = [(i, "x" * (200_000 if i == 3 else 10), [i, None], {"k": i}) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, list array<long>, kind map<string,long>").drop("kind")
    out = run(spark, df, n_shards=3, bucket_bytes=1000).collect()
    assert sorted((r.doc_id, len(r.text), r.list[0]) for r in out) == [(i, len(t), i) for i, t, _, _ in rows]
