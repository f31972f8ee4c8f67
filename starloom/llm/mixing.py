"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of levels (domain, language, source). At
every node it is split among the children by weight; a child that cannot use
its share (all its tokens, ``max_epochs`` times) is filled, and what it
leaves goes to its siblings first. Only when all of them are full does the
shortage reach the node's own siblings: a node's capacity is the sum of its
children's. Each leaf then takes whole epochs of its documents and a
token-prefix of one more, in an order seeded by the epoch. DataFrame
operations only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import free

#: Hash buckets of a leaf's epoch order: hex digits of the order hash.
BUCKET_DIGITS = 3


def n_tokens(text: str = "text") -> Column:
    """Runs of other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("long")


def fill(children: DataFrame, parent: Sequence[str], budget: str, out: str) -> DataFrame:
    """``children`` (``weight``, ``cap``, the parent's ``budget``) with
    ``out``: shares by weight, none above its cap, what a full child leaves
    going to its siblings.

    With children in the order of cap / weight, the common level (tokens per
    weight) of those not filled is the largest of (budget - caps before) /
    (weights not before). A child of weight 0 or null gets nothing.
    """
    at = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), F.col("cap"))
    before = at.rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy(*parent)
    level = (F.col(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    some = F.col("weight") > 0
    filled = children.where(some).withColumn("_level", level).withColumn("_level", F.max("_level").over(all_of))
    filled = filled.withColumn(out, F.least(F.col("cap").cast("double"), F.greatest(F.col("_level") * F.col("weight"), F.lit(0.0)))).drop("_level")
    return filled.unionByName(children.where(~F.coalesce(some, F.lit(False))).withColumn(out, F.lit(0.0)))


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Column], share: float, max_epochs: int) -> DataFrame:
    """``leaves`` (the levels and ``tokens``) with ``budget``, whole tokens.

    The root's budget is ``share`` of all tokens.
    """
    capped = leaves.withColumn("cap", F.col("tokens") * max_epochs).withColumn("_root", F.lit(0))
    given, path = None, ["_root"]
    for depth, level in enumerate(levels):
        keys = [*path, level]
        nodes = capped.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weights.get(level, F.lit(1.0)).cast("double"))
        if depth:
            up = given.select(*[F.col(c).alias(f"_{c}") for c in path], F.col("share").alias("above"))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in path]
            nodes = nodes.join(up, same).drop(*[f"_{c}" for c in path if c != "_root"], "__root")
        else:
            nodes = nodes.withColumn("above", F.floor(F.sum("tokens").over(Window.partitionBy("_root")) * share).cast("double"))
        given = fill(nodes, path, "above", "share")
        path = keys
    return given.select(*levels, "tokens", F.floor("share").alias("budget"))


def select(docs: DataFrame, levels: Sequence[str], weights: Mapping[str, Column] | None = None, share: float = 1.0,
           max_epochs: int = 2, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """``docs`` (the levels, ``n_tokens``, an id and any other columns) with
    ``copies`` (long), how often each row is taken; 0 for those left out.

    A leaf's order in epoch e is that of the md5 of ``seed:e:id``; ties by
    tokens. Running totals are summed over hash buckets first, so a leaf
    with a third of all rows is spread over many tasks. Null levels are
    values like others; rows without tokens stand in the order and use no
    budget; repeated rows count each; no rows give no rows. A column
    ``copies`` of ``docs`` is replaced; columns named like ``_full``,
    ``_rest``, ``_order``, ``_bucket``, ``_own``, ``_at``, ``_before`` or a
    level behind ``_`` are not allowed.
    """
    docs = docs.drop("copies")
    taken_names = {"_full", "_rest", "_order", "_bucket", "_own", "_at", "_before", *(f"_{c}" for c in levels), *(f"__{c}" for c in levels)}
    if clash := sorted(taken_names & set(docs.columns)):
        raise ValueError(f"columns of these names cannot be kept: {clash}")
    leaves = docs.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    plan = budgets(leaves, levels, weights or {}, share, max_epochs)
    plan = plan.select(
        *[F.col(c).alias(f"_{c}") for c in levels],
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).alias("_full"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("_rest"))
    known = docs.join(plan, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels])
    known = known.withColumn("_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_full").cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary")))
    known = known.withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    keys = [f"_{c}" for c in levels]
    sums = known.groupBy(*keys, "_bucket").agg(F.sum("n_tokens").alias("_in"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("_bucket").alias("_at"), F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*keys, "_bucket").orderBy("_order", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    known = known.withColumn("_own", F.sum("n_tokens").over(own))
    known = known.join(sums, [F.col("_bucket") == F.col("_at"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]])
    taken = F.col("_full") + F.when(F.col("_before") + F.col("_own") <= F.col("_rest"), 1).otherwise(0)
    return known.select(*docs.columns, taken.cast("long").alias("copies"))


def source_domain(source: str = "source") -> Column:
    """The domain of a source of ``documents``: its number modulo 4."""
    return F.concat(F.lit("d"), (F.regexp_extract(F.col(source), r"(\d+)$", 1).try_cast("int") % 4).cast("string"))


LEVELS = ("domain", "lang", "source")
#: Target weights among siblings.
DOMAIN_WEIGHT = {"d0": 1.0, "d1": 2.0, "d2": 1.0, "d3": 1.0}
LANG_WEIGHT = {"en": 4.0}


def _weight(level: str, given: Mapping[str, float]) -> Column:
    found = F.lit(1.0)
    for value, weight in given.items():
        found = F.when(F.col(level) == value, weight).otherwise(found)
    return found


def document_weights() -> dict[str, Column]:
    return {"domain": _weight("domain", DOMAIN_WEIGHT), "lang": _weight("lang", LANG_WEIGHT)}


def mix_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens, copies`` for every row."""
    rows = docs.select("doc_id", source_domain().alias("domain"), "lang", "source", n_tokens().alias("n_tokens"))
    return select(rows, LEVELS, document_weights())


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text, lang, source`` and any others) in
    the numbers of ``copies``. Rows equal in these four are one kind, taken
    as often as they are together."""
    kind = ["doc_id", "text", "lang", "source"]
    a, b, copies, nth = (free(name, docs.columns) for name in ("_a", "_b", "_copies", "_nth"))
    keyed = docs.withColumn(a, F.xxhash64(*kind, *[F.col(c).isNull() for c in kind])).withColumn(b, F.xxhash64(F.lit(1), *kind, *[F.col(c).isNull() for c in kind]))
    rows = keyed.select(F.col(a).alias("a"), F.col(b).alias("b"), "doc_id", source_domain().alias("domain"), "lang", "source", n_tokens().alias("n_tokens"))
    chosen = select(rows, LEVELS, document_weights()).groupBy("a", "b").agg(F.sum("copies").cast("int").alias(copies)).where(F.col(copies) > 0)
    chosen = chosen.select(F.col("a").alias(a), F.col("b").alias(b), copies)
    own = Window.partitionBy(a, b).orderBy(copies)
    found = keyed.join(chosen, [a, b]).withColumn(nth, F.row_number().over(own)).where(F.col(nth) == 1)
    return found.withColumn(nth, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)
