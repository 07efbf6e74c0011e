"""Temperature mixing of sources, with DataFrame and SQL functions only.

1. *Shares.* Tokens of each source, as a share of all tokens.
2. *Exponent.* Weights are the shares to the power ``a``, normalised. ``a`` starts
   at 1 (as the data are) and goes down towards 0 (all sources alike); it is
   bisected to the largest value that reaches a target entropy, or the least one
   that keeps the most repeated source within a limit of repetitions. One
   aggregate over the sources evaluates four levels of bisection at once.
3. *Quotas.* Weight times budget, in tokens. A source larger than its quota is
   drawn in part, a smaller one is repeated: each epoch is a permutation of the
   source by hash, and the stream of epochs ends when the quota is reached.
4. *Blocks.* The budget is cut into blocks; a document goes to the block of its
   place in its source's stream, so each block holds the sources in their
   weights, and documents are permuted inside the block.

Places are running sums. They are made in two levels: sums per hash bucket of a
source, their running sum, and a running sum inside each bucket. So a source with
a third of the rows is spread over as many tasks as it has buckets.

Defined cases: tokens are words (bytes 0x20, 0x09-0x0D separate them). A null
source is a source of its own. A source without tokens has no weight and isn't
drawn; documents without tokens in other sources keep their place. Rows equal in
id, source and text are one unit that is drawn together (``n_rows``). An empty
table gives no rows.
"""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.llm.tables import fresh, saved

WORD = r"[^\x20\x09-\x0D]+"
LEVELS, PASSES = 4, 8
UNITS_IN_BUCKET = 2048


def token_estimate(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source.cast("string")))


def _figures(shares: DataFrame, points: list[float]) -> list[dict[str, float]]:
    """For each exponent the weights' entropy, and the largest and least weight over share; one aggregate over the sources."""
    cols = []
    for i, a in enumerate(points):
        w, r = F.pow("p", F.lit(a)), F.pow("p", F.lit(a - 1))
        cols += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log("p")).alias(f"l{i}"), F.max(r).alias(f"hi{i}"), F.min(r).alias(f"lo{i}")]
    row = shares.agg(*cols).first()
    return [{"entropy": math.log(z) - a * row[f"l{i}"] / z, "most": row[f"hi{i}"] / z, "least": row[f"lo{i}"] / z}
            for i, a in enumerate(points) for z in [row[f"z{i}"]]]


def bisected(shares: DataFrame, goes_up: Callable[[dict[str, float]], bool]) -> tuple[float, float]:
    """The interval of exponents, 2 ** -32 wide, at whose lower end ``goes_up`` holds and at whose upper end it doesn't.

    ``shares`` has the column ``p``. ``goes_up`` must hold below some exponent and fail above it.
    """
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        n = 1 << LEVELS
        points = [low + (high - low) * i / n for i in range(1, n)]
        up = dict(zip(points, map(goes_up, _figures(shares, points)), strict=True))
        for _ in range(LEVELS):  # as single steps would go
            mid = (low + high) / 2
            low, high = (mid, high) if up[mid] else (low, mid)
    return low, high


def exponent(shares: DataFrame, sources: int, target_entropy: float | None, max_repeats: float | None, epochs: float | None) -> float:
    """The exponent, to 6 places. ``epochs``: the budget over all tokens; None: as many as draw every document."""
    if target_entropy is not None:
        goal = target_entropy * math.log(sources) - 1e-12
        if _figures(shares, [1.0])[0]["entropy"] >= goal:
            return 1.0
        return round(bisected(shares, lambda f: f["entropy"] >= goal)[0], 6)

    def exceeds(f: dict[str, float]) -> bool:
        return (f["most"] / f["least"] if epochs is None else f["most"] * epochs) > max_repeats

    if not exceeds(_figures(shares, [0.0])[0]):
        return 0.0
    return round(bisected(shares, exceeds)[1], 6)


def mixing_plan(shares: DataFrame, budget_tokens: int | None = None, target_entropy: float | None = None, max_repeats: float | None = None) -> DataFrame:
    """``skey, n, epochs, quota, weight`` per source with tokens; ``shares`` has ``skey`` and ``n``.

    ``target_entropy`` is a share of the entropy of equal weights. Without a
    budget it is the least one under which every document is drawn. If all
    weights as they are repeat more often than ``max_repeats``, the budget is too
    large for the limit and the weights stay as they are.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either target_entropy or max_repeats")
    total, sources = shares.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    if not total:
        return shares.limit(0).selectExpr("skey", "n", "0L as epochs", "0L as quota", "0D as weight")
    p = shares.where("n > 0").withColumn("p", F.col("n") / F.lit(float(total)))
    a = exponent(p, sources, target_entropy, max_repeats, None if budget_tokens is None else budget_tokens / total)
    z = p.agg(F.sum(F.pow("p", F.lit(a)))).first()[0]
    planned = p.withColumn("weight", F.pow("p", F.lit(a)) / F.lit(z))
    if budget_tokens is None:
        budget = planned.agg(F.max(F.col("n") / F.col("weight"))).first()[0]
        quota = F.greatest(F.floor(F.col("weight") * F.lit(budget)), F.col("n"))
    else:
        quota = F.floor(F.col("weight") * F.lit(float(budget_tokens)))
    planned = planned.withColumn("quota", quota.cast("long"))
    return planned.select("skey", "n", F.ceil(F.col("quota") / F.col("n")).cast("long").alias("epochs"), "quota", "weight")


def _digits(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Rows equal in id, source and text as one: ``doc_id, source, skey, digest, n_rows, n_tokens``."""
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), source_key(F.col(source_col)).alias("skey"),
        F.coalesce(F.md5(text_col), F.lit("")).alias("digest"), token_estimate(F.col(text_col)).alias("n_tokens"))
    return slim.groupBy("doc_id", "source", "skey", "digest").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))


RUN = 1 << 12


def repeated(df: DataFrame, times: str, name: str) -> DataFrame:
    """Each row as often as its column ``times`` (a long) says, numbered from 0 in the column ``name``.

    In two levels, so that no row holds an array of all its numbers.
    """
    run = fresh("run", [*df.columns, name])
    runs = df.where(F.col(times) > 0).withColumn(run, F.explode(F.expr(f"sequence(0L, ({times} - 1) div {RUN})")))
    return runs.withColumn(name, F.explode(F.expr(f"sequence({run} * {RUN}, least({times}, ({run} + 1) * {RUN}) - 1)"))).drop(run)


def mix_sources(docs: DataFrame, budget_tokens: int | None = None, target_entropy: float | None = None, max_repeats: float | None = None,
                block_tokens: int = 1 << 18, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                budget_epochs: float | None = None) -> DataFrame:
    """The mixture as draws: ``doc_id, source, digest, n_rows, n_tokens, epoch long, block long, position long``.

    ``digest`` is the text's MD5 in hex ("" for a null text). Blocks and the
    positions in them are counted from 0. ``budget_epochs`` gives the budget as a
    multiple of all tokens.
    """
    spread = saved(units(docs, id_col, text_col, source_col), "units")
    shares = saved(spread.groupBy("skey").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("units")), "shares")
    total, count = shares.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("units"), F.lit(0))).first()
    if budget_epochs is not None:
        budget_tokens = int(budget_epochs * total)
    plan = saved(mixing_plan(shares, budget_tokens, target_entropy, max_repeats), "plan")
    whole = plan.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    blocks = max(1, -(-whole // block_tokens))
    shift = 60 - min(24, max(0, (count // UNITS_IN_BUCKET).bit_length()))

    copies = repeated(spread.join(plan, "skey").where("epochs > 0"), "epochs", "epoch")
    seeded = F.lit(str(seed))
    order = _digits(seeded, F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest"))
    copies = copies.withColumn("place", order).withColumn("bucket", F.shiftright("place", shift))
    sums = copies.groupBy("skey", "epoch", "bucket").agg(F.sum("n_tokens").alias("own"))
    before = sums.selectExpr("skey", "epoch", "bucket", "sum(own) over (partition by skey, epoch order by bucket) - own as before")
    placed = copies.join(before, ["skey", "epoch", "bucket"]).selectExpr(
        "*", "epoch * n + before + sum(n_tokens) over (partition by skey, epoch, bucket order by place, doc_id, digest"
        " rows between unbounded preceding and current row) - n_tokens as at").where("at < quota")
    placed = placed.withColumn("block", F.floor(F.col("at").cast("double") / F.col("quota").cast("double") * F.lit(float(blocks))).cast("long"))
    shuffled = placed.withColumn("within", _digits(seeded, F.lit("in"), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest")))
    return shuffled.selectExpr(
        "doc_id", "source", "digest", "n_rows", "n_tokens", "epoch", "block",
        "cast(row_number() over (partition by block order by within, doc_id, skey, epoch) - 1 as long) as position")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **mixing) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, with their own columns."""
    drawn = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **mixing)
    times = drawn.groupBy("doc_id", "source", "digest").agg(F.count("*").alias("_times"))
    hit = (docs[id_col].eqNullSafe(times["doc_id"]) & docs[source_col].eqNullSafe(times["source"])
           & (F.coalesce(F.md5(docs[text_col]), F.lit("")) == times["digest"]))
    extra = "times"
    while extra in docs.columns:
        extra += "_"
    got = docs.join(times, hit).select(*(docs[c] for c in docs.columns), times["_times"].alias(extra))
    return repeated(got, extra, fresh("nth", got.columns)).select(*docs.columns)
