"""Mixing sources to target weights by hierarchical budgeting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, inside, running, small

LEVELS = ("domain", "lang", "source")
#: Target weights of children by the path of their parent; a child not named weighs DEFAULT_WEIGHT.
WEIGHTS = {
    (): {"web": 4.0, "books": 3.0, "code": 2.0, "forums": 1.0},
    ("web",): {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0},
    ("books",): {"en": 3.0, "de": 1.0, "fr": 1.0, "es": 1.0},
}
DEFAULT_WEIGHT = 1.0


def domain_of(source: str = "source") -> Column:
    """The domain of a source: the tables have none, so it follows from the number in the source's name."""
    names = F.array(*[F.lit(x) for x in ("web", "books", "code", "forums")])
    number = F.coalesce(F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"(\d{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.get(names, F.pmod(number, F.lit(4)))


def token_count(text: Column) -> Column:
    """Whitespace-separated tokens of the whole text; null or blank: 0."""
    return F.coalesce(F.size(F.filter(F.split(text, r"\s+"), lambda x: x != "")), F.lit(0)).cast("long")


def budgets(supply: dict[tuple, int], total: float, weights: dict, epochs: int) -> dict[tuple, float]:
    """Tokens for each leaf: `total` shared out down the tree in proportion to weights.

    A child never gets more than `epochs` times the tokens below it. What one child can't use goes to its siblings
    in proportion to their weights; only what all of them can't use goes back to the ancestor, which offers it to
    its own siblings: at every node the children's capacity is known first, so a node never accepts more than
    its subtree can use. A zero or negative weight gets nothing.
    """
    room: dict[tuple, float] = {}
    children: dict[tuple, set] = {}
    for leaf, tokens in supply.items():
        if all(weights.get(leaf[:k], {}).get(leaf[k], DEFAULT_WEIGHT) > 0 for k in range(len(leaf))):
            for k in range(len(leaf) + 1):
                room[leaf[:k]] = room.get(leaf[:k], 0) + tokens * epochs
                if k:
                    children.setdefault(leaf[: k - 1], set()).add(leaf[:k])
    out: dict[tuple, float] = dict.fromkeys(supply, 0.0)

    def share(node: tuple, amount: float) -> None:
        if node not in children:
            if node in out:
                out[node] = amount
            return
        parts = {c: weights.get(node, {}).get(c[-1], DEFAULT_WEIGHT) for c in children[node]}
        given: dict[tuple, float] = {}
        while parts:
            each = amount / sum(parts.values())
            full = [c for c in parts if room[c] <= parts[c] * each]
            if not full:
                given |= {c: w * each for c, w in parts.items()}
                break
            for c in full:
                given[c] = room[c]
                amount -= room[c]
                del parts[c]
        for c, x in given.items():
            share(c, max(0.0, x))

    if () in room:
        share((), min(total, room[()]))
    return out


def mix(ws: Workspace, docs: DataFrame, total_fraction: float = 0.5, epochs: int = 3, seed: str = "mix-1", weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text", annotate: bool = True) -> DataFrame:
    """docs that the mixture takes, with domain, n_tokens and n_copies (times taken, at most `epochs`).

    Every leaf (domain, language, source) gets a token budget from `budgets` over total_fraction of all tokens.
    Epoch e of a leaf lists its documents in the order of md5(seed, e, id): whole epochs are taken while the
    budget lasts, and of the next one the shortest prefix of documents whose tokens reach what is left. Documents
    without tokens belong to no mixture. Null domain, language or source are leaves of their own (''). A null id
    sorts as ''; repeated rows are documents of their own, and equal ids lie next to each other in an epoch.
    One task holds no leaf: a leaf's running sum is split by range. Leaf totals, one row for each
    (domain, language, source), are gathered at the driver. Other columns pass through; those that clash with the
    three added ones are replaced. Without `annotate` none is added, and each document that is taken keeps its columns.
    """
    path = [F.coalesce(domain_of(), F.lit("")), F.coalesce(F.col("lang"), F.lit("")), F.coalesce(F.col("source"), F.lit(""))]
    leaf = F.to_json(F.array(*path))
    narrow = ws.put("tokens", docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), leaf.alias("_leaf"), *[p.alias(f"_{x}") for p, x in zip(path, LEVELS, strict=True)], token_count(F.col(text_col)).alias("_tokens")).filter("_tokens > 0"))
    sums = narrow.groupBy("_leaf", *[f"_{x}" for x in LEVELS]).agg(F.sum("_tokens").alias("n")).collect()
    supply = {tuple(r[f"_{x}"] for x in LEVELS): r["n"] for r in sums}
    given = budgets(supply, total_fraction * sum(supply.values()), WEIGHTS if weights is None else weights, epochs)
    plan = [(r["_leaf"], int(given[k] // r["n"]), float(round(given[k] - given[k] // r["n"] * r["n"], 6))) for r in sums for k in [tuple(r[f"_{x}"] for x in LEVELS)]]
    plan_df = small(ws.spark.createDataFrame(plan, "_leaf string, _whole int, _rest double"), 128)
    drawn = narrow.join(plan_df, "_leaf").withColumn("_order", F.md5(F.concat_ws("|", F.lit(seed), F.col("_whole").cast("string"), F.col("_id"))))
    prefix = running(ws, "epoch", drawn.drop(*[f"_{x}" for x in LEVELS]), "_leaf", ["_order", "_id", "_tokens"], F.col("_tokens"))
    taken = prefix.withColumn("n_copies", F.least(F.col("_whole") + (F.col("before") < F.col("_rest")).cast("int"), F.lit(epochs)))
    # one row for each id: rows that share id, leaf and tokens are taken up to the same number of times
    counts = taken.groupBy("_id", "_leaf", "_tokens").agg(F.max("n_copies").alias("n_copies")).filter("n_copies > 0")
    counts = ws.put("copies", counts.select(F.col("_id").alias("_cid"), F.col("_leaf").alias("_cleaf"), F.col("_tokens").alias("_ctokens"), "n_copies"))
    ws.drop("epoch", "tokens")
    added = {"domain", "n_tokens", "n_copies"} if annotate else set()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"), path[0].alias("_domain"), token_count(F.col(text_col)).alias("_tokens"), leaf.alias("_leaf"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"))
    # half of all documents and more are taken: both sides move
    joined = rows.join(counts.hint("merge"), (F.col("_id") == F.col("_cid")) & (F.col("_leaf") == F.col("_cleaf")) & (F.col("_tokens") == F.col("_ctokens")))
    others = [inside(c).alias(c) for c in docs.columns if c.lower() not in added]
    return joined.select(*others, *([F.col("_domain").alias("domain"), F.col("_tokens").alias("n_tokens"), "n_copies"] if annotate else []))
