"""Mixing of sources to target weights, by hierarchical budgets.

Weights are given per level of a tree, here domain - language - source.  A node's
budget is shared among its children by weight; a child that cannot use its share
leaves the shortage to its siblings, and only what none of them can use goes
up.  Each leaf is then filled with whole epochs and a prefix of one more epoch, whose
order is a seeded hash of the document and the epoch.

The prefix of a leaf is found without sorting it: tokens are summed by 1 / 4096
slices of the hash range, and only the slice that holds the cut is put in order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import free_name, stage, table

#: Value that stands for all that a level does not list.
OTHER = "*"
#: Bits of the hash that name a slice, at least.
SLICE_BITS = 12
SEED = 17


@dataclass(frozen=True)
class Level:
    """One level of the tree: a column and weights by its value; others share the weight of ``*``, 0 if it has none.

    The number of leaves is bounded by the values listed, whatever the data hold.
    """

    column: str
    weights: dict[str, float] = field(hash=False)

    def value(self) -> Column:
        return F.when(F.col(self.column).isin(*self.weights), F.col(self.column)).otherwise(F.lit(OTHER))


def share(budget: float, weights: list[float], room: list[float]) -> list[float]:
    """``budget`` by weight, none over its room; shortages go to the others by weight. Weight 0 gets nothing."""
    got = [0.0] * len(weights)
    open_ = [i for i, w in enumerate(weights) if w > 0 and room[i] > 0]
    while budget > 0 and open_:
        whole = sum(weights[i] for i in open_)
        full = [i for i in open_ if budget * weights[i] >= (room[i] - got[i]) * whole]
        if not full:
            for i in open_:
                got[i] += budget * weights[i] / whole
            break
        for i in full:
            budget -= room[i] - got[i]
            got[i] = room[i]
        open_ = [i for i in open_ if i not in full]
    return got


def leaf_budgets(levels: list[Level], tokens: dict[tuple, int], budget: int, max_epochs: int) -> dict[tuple, int]:
    """Whole tokens for each leaf (a path of values); at most max_epochs times what it has."""
    usable: dict[tuple, float] = {}

    def room(path: tuple) -> float:
        """What the leaves under a path with weights over 0 can take."""
        if path not in usable:
            depth = len(path)
            if depth == len(levels):
                usable[path] = float(tokens.get(path, 0) * max_epochs)
            else:
                below = sorted({p[: depth + 1] for p in tokens if p[:depth] == path})
                usable[path] = sum(room(p) for p in below if levels[depth].weights.get(p[-1], 0) > 0)
        return usable[path]

    def fill(path: tuple, amount: float) -> dict[tuple, float]:
        depth = len(path)
        if depth == len(levels):
            return {path: amount}
        below = sorted({p[: depth + 1] for p in tokens if p[:depth] == path})
        parts = share(amount, [levels[depth].weights.get(p[-1], 0) for p in below], [room(p) for p in below])
        out: dict[tuple, float] = {}
        for p, part in zip(below, parts):
            out |= fill(p, part)
        return out

    exact = fill((), min(float(budget), room(())))
    whole = {p: int(x + 1e-9) for p, x in exact.items()}
    rest = min(budget, round(sum(exact.values()))) - sum(whole.values())
    for p in sorted(exact, key=lambda p: (whole[p] - exact[p], p)):
        if rest > 0 and whole[p] < tokens[p] * max_epochs and exact[p] > 0:
            whole[p], rest = whole[p] + 1, rest - 1
    return whole


def slice_bits(rows: int) -> int:
    """Slices grow with the root of the rows: neither the slices of a leaf nor the rows of the one with the cut are many for one task."""
    return max(SLICE_BITS, -(-rows.bit_length() // 2))


def mix(docs: DataFrame, levels: list[Level], budget_part: float, max_epochs: int, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, epoch, tokens, one column per level): a row for each time a document is taken.

    Tokens are runs of non-blank characters; the budget is ``budget_part`` of all.  In the
    last epoch of a leaf a document is taken if the tokens before it are under what is
    left, so a leaf exceeds its budget by less than one document.  Null, empty and blank texts
    have no tokens and cost nothing; a leaf without any tokens gives nothing.  Values not
    listed, null among them, are one leaf value ``*``, taken by its weight; a level that gives it none
    leaves these rows out.  Repeated rows are taken one by one, ties
    in the order follow doc_id (null first) and then tokens.  An empty table gives no rows.
    """
    names = [f"level_{i}" for i in range(len(levels))]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0)).cast("long").alias("tokens"),
        *[x.value().alias(n) for x, n in zip(levels, names)],
    )
    rows = stage(rows, "mix-tokens")
    found = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).collect()  # at most the listed leaves
    bits = slice_bits(sum(r["rows"] for r in found))
    tokens = {tuple(r[n] for n in names): r["tokens"] for r in found if r["tokens"]}
    budgets = leaf_budgets(levels, tokens, int(sum(tokens.values()) * budget_part), max_epochs)
    plan = [(*p, budgets[p] // tokens[p], budgets[p] % tokens[p]) for p in tokens if budgets.get(p)]
    schema = ", ".join(f"{n} string" for n in names) + ", epochs long, rest long"
    plan = F.broadcast(rows.sparkSession.createDataFrame(plan, schema))
    planned = rows.join(plan, names).withColumn("hash", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("epochs"), F.col("doc_id")), 1))
    planned = planned.withColumn("slice", F.shiftright("hash", 63 - bits))

    slices = planned.where("rest > 0").groupBy(*names, "slice", "rest").agg(F.sum("tokens").alias("held"))
    upto = Window.partitionBy(*names).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cuts = slices.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))
    cuts = cuts.where("before < rest and before + held >= rest").select(*names, F.col("slice").alias("cut"), "before")
    marked = planned.join(F.broadcast(cuts), names, "left")  # a row for each leaf

    before = Window.partitionBy(*names).orderBy("hash", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    exact = marked.where("slice = cut").withColumn("before", F.col("before") + F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    more = {"slice = cut": exact, "cut is null or slice <> cut": marked.where("cut is null or slice <> cut")}
    parts = []
    for part in more.values():
        taken = F.when(F.col("cut").isNull(), False).when(F.col("slice") == F.col("cut"), F.col("before") < F.col("rest")).otherwise(F.col("slice") < F.col("cut"))
        times = F.col("epochs") + taken.cast("long")
        part = part.withColumn("times", times).where("times > 0")
        parts.append(part.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("epoch"), "tokens", *names))
    out = parts[0].unionByName(parts[1])
    return out.select("doc_id", F.col("epoch").cast("int").alias("epoch"), "tokens", *[F.col(n).alias(x.column) for n, x in zip(names, levels)])


#: Domains of the sources, by the number in a source's name.
DOMAINS = ("web", "books", "forum")
#: Domain of sources without a number.
UNNUMBERED = "other"


def with_domain(docs: DataFrame) -> DataFrame:
    number = F.try_to_number(F.regexp_extract("source", r"(\d{1,9})$", 1), F.lit("999999999")).cast("int")
    names = F.array(*[F.lit(d) for d in DOMAINS])
    return docs.withColumn("domain", F.when(number.isNull(), UNNUMBERED).otherwise(F.element_at(names, number % len(DOMAINS) + 1)))


#: Weights of a level are relative to those of its values that occur; every level has a ``*``, so no row is without budget.
LEVELS = [
    Level("domain", {"web": 0.5, "books": 0.3, "forum": 0.2, UNNUMBERED: 0.2, OTHER: 0.1}),
    Level("lang", {"en": 0.55, "de": 0.2, "fr": 0.15, "es": 0.1, OTHER: 0.1}),
    Level("source", {f"src{i}": 1.0 for i in range(20)} | {OTHER: 0.5}),
]
BUDGET_PART = 0.6
MAX_EPOCHS = 3


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """60 % of the tokens of documents, mixed by domain, language and source, at most three epochs."""
    return mix(with_domain(table(spark, sf_dir, "documents")), LEVELS, BUDGET_PART, MAX_EPOCHS)


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that one epoch takes, towards the same weights and 90 % of the tokens.

    A document is taken or left by its doc_id, so repeated rows go together and rows with a null id do, too.  Null and empty
    texts cost nothing and are taken with their leaf; very long texts count whole.  Null or unlisted languages and
    sources have weights of their own.  Other columns pass as they are, whatever their names.  An empty table stays empty.
    """
    mark = free_name(docs, "_taken")
    taken = mix(with_domain(docs.select("doc_id", "text", "lang", "source")), LEVELS, 0.9, 1).select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(taken, F.col("doc_id").eqNullSafe(F.col(mark)), "left_semi")


QUERIES = {"op3_mixing": op3_mixing}
ORACLE: dict[str, str] = {}
