"""Operator 5: mixing sources to target weights by hierarchical budgets [DataFrame functions only].

The tree is domain - language - source.  A node can give its tokens ``max_epochs`` times; what
its children can give bounds an inner node.  The token budget goes down the tree: siblings
share their parent's budget by weight, a sibling that cannot use its share gives the rest back
to the others of the same parent (by weight again, until all are full or the budget is spent),
and only what a whole family cannot use reaches the parent's own siblings.  For siblings in
the order of capacity / weight that is one pass of running sums: full up to a place, and in
proportion to weight after it.  All arithmetic is in whole numbers; fractions are cut off.

A leaf with ``a`` budgeted tokens and ``n`` of its own gives ``a div n`` whole epochs and, from the
next epoch, a prefix of its documents in that epoch's seeded order (MD5 of seed, epoch, id and
text), as long as the running total stays within the rest.  The prefix of a large leaf is found
from a histogram: the order's range is cut into cells of about ``CELL_DOCS`` documents, totals per
cell are added up, and only the cell in which the rest runs out is put in order.  What remains
is one cut per leaf, which each row is held against; texts are never shuffled.

The prefix ends at the first document that would exceed the rest, and what is then left goes to no
other leaf.  Bound: a leaf gets less than its budget by less than the tokens of that one document,
and never more than its budget; where one document holds most of a leaf this may be all of it.

Defined cases: null and blank texts have 0 tokens; null languages and sources are the nodes
``und`` and ``unknown``; sources without a domain rule are in ``other``; nodes without a weight get
the default weight; rows equal in id and text stand or fall together; an empty table gives an
empty result; a budget beyond the capacity gives every leaf ``max_epochs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clockroll.llm.common import free_name, gathered, staged, words_of

SEED = "mix-1"
CELL_DOCS = 4096
MAX_EPOCHS = 3
LEAF = ["domain", "lang", "source"]
#: Target weights (whole numbers; only their ratios among siblings count).
DOMAIN_WEIGHTS = {"web": 400, "books": 250, "forum": 200, "reference": 150}
LANG_WEIGHTS = {"en": 500, "de": 200, "fr": 200, "es": 100}
DEFAULT_WEIGHT = 50
SOURCE_WEIGHT = 100


def domain_of(source: Column) -> Column:
    """The default domain rule: the number that ends a source's name, modulo four."""
    digits = F.regexp_extract(source, r"(\d{1,9})$", 1)
    n = F.when(digits != "", digits.cast("long") % 4)
    return F.when(n == 0, "web").when(n == 1, "books").when(n == 2, "forum").when(n == 3, "reference").otherwise("other")


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` staged in few files: its tables are narrow, and executors open each file anew (on a local file system
    Hadoop starts a process for the rights of each)."""
    return staged(gathered(df), purpose)


def _weight(col: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in weights.items():
        out = F.when(F.col(col) == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def _share(nodes: DataFrame, family: list[str], name: str) -> DataFrame:
    """``nodes`` (family columns, ``name``, weight ``w``, capacity ``c``, the parent's ``budget``) with
    the node's own ``a``."""
    kin = W.partitionBy(*family) if family else W.partitionBy(F.lit(0))
    order = kin.orderBy(F.col("c").cast("double") / F.col("w").cast("double"), name)
    left = F.col("budget") - (F.sum("c").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("c"))
    shares = F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing))
    big = lambda c: c.cast("decimal(38,0)")
    out = nodes.withColumn("_left", big(left)).withColumn("_shares", big(shares)).withColumn("_k", F.row_number().over(order))
    out = out.withColumn("_full", F.col("c").cast("decimal(19,0)") * F.col("_shares").cast("decimal(19,0)") <= F.col("_left").cast("decimal(19,0)") * F.col("w").cast("decimal(19,0)"))
    first = F.min(F.when(~F.col("_full"), F.struct("_k", "_left", "_shares"))).over(kin)
    out = out.withColumn("_first", first)
    part = F.expr("cast(_first._left as decimal(19,0)) * cast(w as decimal(18,0)) div cast(_first._shares as decimal(19,0))")
    return out.withColumn("a", F.when(F.col("_full"), F.col("c")).otherwise(big(part))).drop("_left", "_shares", "_k", "_full", "_first")


def budgets(leaves: DataFrame, total: int | Column, max_epochs: int = MAX_EPOCHS,
            domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None, source_weights: dict[str, int] | None = None) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with each leaf's budget ``a``.  ``total``: tokens to
    spend, or None for as many as there are."""
    leaves = leaves.withColumn("c", (F.col("tokens") * max_epochs).cast("decimal(38,0)"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("c").cast("decimal(38,0)").alias("c"))
    domains = langs.groupBy("domain").agg(F.sum("c").cast("decimal(38,0)").alias("c"))
    everything = W.partitionBy(F.lit(0))
    spend = F.sum("c").over(everything) / max_epochs if total is None else F.lit(total)
    domains = domains.withColumn("budget", F.least(spend.cast("decimal(38,0)"), F.sum("c").over(everything).cast("decimal(38,0)")))
    domains = _share(domains.withColumn("w", _weight("domain", DOMAIN_WEIGHTS if domain_weights is None else domain_weights, DEFAULT_WEIGHT)), [], "domain")
    langs = langs.join(domains.select("domain", F.col("a").alias("budget")), "domain")
    langs = _share(langs.withColumn("w", _weight("lang", LANG_WEIGHTS if lang_weights is None else lang_weights, DEFAULT_WEIGHT)), ["domain"], "lang")
    leaves = leaves.join(langs.select("domain", "lang", F.col("a").alias("budget")), ["domain", "lang"])
    leaves = _share(leaves.withColumn("w", _weight("source", source_weights or {}, SOURCE_WEIGHT)), ["domain", "lang"], "source")
    return leaves.select(*LEAF, "tokens", "n_docs", F.col("a").cast("long").alias("a"))


def _order_key(epoch: Column, mark: Column, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), mark))


def _cell(key: Column, n_docs: Column) -> Column:
    cells = F.ceil(n_docs / CELL_DOCS).cast("long")
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * cells, 32)


def cuts(marked: DataFrame, total: int | None, max_epochs: int = MAX_EPOCHS, seed: str = SEED, **weights) -> DataFrame:
    """Per leaf: whole epochs, and where the prefix of the next epoch ends (cells before ``cell``, and
    in it the order keys up to ``cut``).  ``marked``: leaf columns, ``mark``, ``n``."""
    leaves = marked.groupBy(*LEAF).agg(F.sum("n").alias("tokens"), F.count("*").alias("n_docs"))
    plan = budgets(leaves, total, max_epochs, **weights)
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("a div tokens")).otherwise(F.lit(max_epochs)).cast("int"))
    plan = _kept(plan.withColumn("rest", F.col("a") - F.col("epochs") * F.col("tokens")), "mix-plan")
    keyed = marked.join(plan.where("tokens > 0").select(*LEAF, "epochs", "rest", "n_docs"), LEAF)
    keyed = keyed.withColumn("key", _order_key(F.col("epochs"), F.col("mark"), seed)).withColumn("cell", _cell(F.col("key"), F.col("n_docs")))
    cells = keyed.groupBy(*LEAF, "rest", "cell").agg(F.sum("n").alias("n"))
    upto = W.partitionBy(*LEAF).orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.withColumn("upto", F.sum("n").over(upto))
    edge = cells.where("upto > rest").groupBy(*LEAF).agg(F.min(F.struct("cell", (F.col("upto") - F.col("n")).alias("before"))).alias("e")).select(*LEAF, "e.cell", "e.before")
    edge = _kept(edge, "mix-edge")
    inside = keyed.join(edge, [*LEAF, "cell"]).groupBy(*LEAF, "cell", "rest", "before", "key").agg(F.sum("n").alias("n"))
    run = F.sum("n").over(W.partitionBy(*LEAF).orderBy("key").rowsBetween(W.unboundedPreceding, 0)) + F.col("before")
    last = inside.withColumn("upto", run).where("upto <= rest").groupBy(*LEAF).agg(F.max("key").alias("cut"))
    return plan.join(edge.drop("before"), LEAF, "left").join(last, LEAF, "left").select(*LEAF, "n_docs", "epochs", "cell", F.coalesce("cut", F.lit("")).alias("cut"))


def mixed(df: DataFrame, total: int | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED, domain=domain_of, id_col: str = "doc_id", **weights) -> DataFrame:
    """``df`` with ``domain``, ``n_tokens`` and ``copies`` (how often the mixture takes the row; 0: not at
    all).  The columns get a leading underscore where ``df`` has one of the name."""
    taken = df.columns
    names = {x: free_name([*taken, "domain", "n_tokens", "copies"] if x in {t.lower() for t in taken} else taken, x) for x in ("domain", "n_tokens", "copies")}
    row = free_name([], "_row")
    src = df.select(F.struct(*[df[f"`{c}`"] for c in taken]).alias(row))
    field = lambda c: F.col(row)[c]
    source = F.coalesce(field("source").cast("string"), F.lit("unknown"))
    mark = F.md5(F.concat_ws("|", F.coalesce(field(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(field("text"), F.lit("")))))
    marked = src.select(domain(field("source").cast("string")).alias("domain"), F.coalesce(field("lang"), F.lit("und")).alias("lang"), source.alias("source"),
                        mark.alias("mark"), F.size(words_of(field("text"))).cast("long").alias("n"), row)
    narrow = _kept(marked.drop(row), "mix-docs")
    # One row per leaf; as a written table its size is known, so Spark broadcasts it only if it is small.
    plan = _kept(cuts(narrow, total, max_epochs, seed, **weights), "mix-cuts").withColumnRenamed("cell", "edge")
    out = marked.join(plan, LEAF).withColumn("key", _order_key(F.col("epochs"), F.col("mark"), seed)).withColumn("cell", _cell(F.col("key"), F.col("n_docs")))
    inside = F.col("epochs") < max_epochs
    chosen = F.col("edge").isNull() | (F.col("cell") < F.col("edge")) | ((F.col("cell") == F.col("edge")) & (F.col("key") <= F.col("cut")))
    copies = F.col("epochs") + F.when(inside & chosen, 1).otherwise(0)
    return out.select(*[field(c).alias(c) for c in taken], F.col("domain").alias(names["domain"]), F.col("n").alias(names["n_tokens"]), copies.cast("int").alias(names["copies"]))


def taken(df: DataFrame, total: int | None = None, **options) -> DataFrame:
    """The mixture itself: the rows of ``df``, columns as they are, each as often as it is taken."""
    row = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"), *[df[c] for c in ("doc_id", "text", "lang", "source")])
    out = mixed(row, total, **options)
    return out.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def _case(col: str, weights: dict[str, int], default: int) -> str:
    return "CASE " + col + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END"


def _share_sql(src: str, family: str, name: str) -> str:
    part = f"PARTITION BY {family}" if family else ""
    return f"""(SELECT *, CASE WHEN is_full THEN c ELSE (min_by(lft, CASE WHEN NOT is_full THEN k END) OVER ({part}) * w) // (min_by(shares, CASE WHEN NOT is_full THEN k END) OVER ({part})) END AS a FROM (
    SELECT *, c * shares <= lft * w AS is_full FROM (
      SELECT *, budget - (sum(c) OVER (o ROWS UNBOUNDED PRECEDING) - c) AS lft, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares, row_number() OVER o AS k
      FROM {src} WINDOW o AS ({part} ORDER BY c::DOUBLE / w::DOUBLE, {name}))))"""


def sql(documents: str = "documents", max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> str:
    """DuckDB: the same mixture without cells."""
    n = "regexp_extract(source, '(\\d{1,9})$', 1)"
    return f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL OR {n} = '' THEN 'other' ELSE ['web', 'books', 'forum', 'reference'][({n}::BIGINT % 4 + 1)::INT] END AS domain,
    coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
    md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS mark,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS n FROM {documents}),
leaves AS (SELECT domain, lang, source, sum(n)::HUGEINT AS tokens, (sum(n) * {max_epochs})::HUGEINT AS c, {SOURCE_WEIGHT}::HUGEINT AS w FROM docs GROUP BY ALL),
langs AS (SELECT domain, lang, sum(c)::HUGEINT AS c, ({_case('lang', LANG_WEIGHTS, DEFAULT_WEIGHT)})::HUGEINT AS w FROM leaves GROUP BY domain, lang),
domains AS (SELECT *, (sum(c) OVER ())::HUGEINT // {max_epochs} AS budget FROM (SELECT domain, sum(c)::HUGEINT AS c, ({_case('domain', DOMAIN_WEIGHTS, DEFAULT_WEIGHT)})::HUGEINT AS w FROM langs GROUP BY domain)),
d1 AS (SELECT domain, a AS budget FROM {_share_sql('domains', '', 'domain')}),
l0 AS (SELECT langs.*, budget FROM langs JOIN d1 USING (domain)),
l1 AS (SELECT domain, lang, a AS budget FROM {_share_sql('l0', 'domain', 'lang')}),
s0 AS (SELECT leaves.*, budget FROM leaves JOIN l1 USING (domain, lang)),
s1 AS (SELECT domain, lang, source, tokens, a, CASE WHEN tokens > 0 THEN a // tokens ELSE {max_epochs} END AS epochs FROM {_share_sql('s0', 'domain, lang', 'source')}),
keyed AS (SELECT docs.*, epochs, a - epochs * tokens AS rest, tokens, md5(concat_ws('|', '{seed}', epochs::VARCHAR, mark)) AS key FROM docs JOIN s1 USING (domain, lang, source)),
run AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, n AS n_tokens, (epochs + CASE WHEN epochs < {max_epochs} AND (tokens = 0 OR upto <= rest) THEN 1 ELSE 0 END)::INT AS copies FROM run
"""
