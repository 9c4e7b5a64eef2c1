"""Consolidation of an archive: exact, soft, null-area and sole-null passes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import identity as I
from ledgerloom.operators import similar as S
from ledgerloom.operators.blocks import labels
from ledgerloom.operators.merge import Fold, _plain, _plan, compact, null_fill, settled
from ledgerloom.plans.lineage import cut, keep


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Match keys that several rows have, with their number."""
    return df.select(I.match_key().alias("match_key")).where("match_key != ''").groupBy("match_key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def _collapse(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Merge each row into its target in the order of seq; plan: ord, target, seq."""
    joined = df.join(plan, "ord")
    out = null_fill(joined, ["target"], "seq").drop("ord", "_rows")
    return out.withColumnRenamed("target", "ord").select(*df.columns)


def richest_first(df: DataFrame):
    """The order of a group's rows as a value: no window, so a group is aggregated in part before it is shuffled."""
    return F.struct((-I.fullness(df)).alias("f"), F.col("ord").alias("o"))


def exact(df: DataFrame) -> DataFrame:
    """Rows of one strict key become one, the richest first; rows without a key stay."""
    key = F.when(I.match_key() == "", F.concat(F.lit("#"), F.col("ord"))).otherwise(I.match_key())
    return null_fill(df.withColumns({"_key": key, "_rank": richest_first(df)}), ["_key"], "_rank").select(*df.columns)


def _leaders(frame: pd.DataFrame) -> pd.DataFrame:
    """Greedy leaders of a component of names that match, richest first: each absorbs the later ones that match it, not what those match."""
    near: dict[int, set] = {}
    full: dict[int, int] = {}
    for a, b, fa, fb in zip(frame["a"], frame["b"], frame["a_full"], frame["b_full"], strict=True):
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
        full[a], full[b] = fa, fb
    taken: dict[int, int] = {}
    for x in sorted(full, key=lambda i: (-full[i], i)):
        if x not in taken:
            taken[x] = x
            for y in near[x]:
                taken.setdefault(y, x)
    return pd.DataFrame({"node": taken.keys(), "leader": taken.values()})


def soft(df: DataFrame) -> DataFrame:
    """Rows of one unit signature with a locality whose project names differ by a slip are merged into their leader.

    Rows of one name and signature share their fate, so only distinct names are compared: those that share a segment, by an equi-join. Leaders
    are chosen within the components of names that really match.
    """
    sig = F.when(I._slug("locality") == "", F.concat(F.lit("#"), F.col("ord"))).otherwise(I.unit_signature())
    slim = keep(df.select("ord", I._slug("projectName").alias("slug"), I.fullness(df).alias("full"), sig.alias("k")))
    names = keep(slim.where("slug != ''").groupBy("k", "slug").agg(F.max(F.struct("full", (-F.col("ord")).alias("o"))).alias("m")).select("k", "slug", "m.full", (-F.col("m.o")).alias("node")))
    pairs = S.soft_join(names.select("k", "slug"), names.select("k", "slug")).where("a_slug < b_slug")
    of = lambda p: names.select("k", F.col("slug").alias(f"{p}_slug"), F.col("node").alias(p), F.col("full").alias(f"{p}_full"))
    edges = keep(pairs.join(of("a"), ["k", "a_slug"]).join(of("b"), ["k", "b_slug"]).select("a", "b", "a_full", "b_full"))
    found = labels(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    leaders = edges.join(found, F.col("a") == F.col("node")).groupBy("label").applyInPandas(_leaders, "node long, leader long")
    told = names.join(leaders, "node", "left").select("k", "slug", F.coalesce("leader", "node").alias("target"))
    plan = slim.join(told, ["k", "slug"], "left").select("ord", F.coalesce("target", "ord").alias("target"), F.struct((-F.col("full")).alias("f"), F.col("ord").alias("o")).alias("seq"))
    return _collapse(df, plan)


def _attach(frame: pd.DataFrame) -> pd.DataFrame:
    """Null-area rows of a component, richest first, each into what it matches among sized and kept ones."""
    rows = [_plain(r) for r in frame.to_dict("records")]
    sized = sorted((r for r in rows if r["area"] is not None), key=lambda r: r["ord"])
    unsized = sorted((r for r in rows if r["area"] is None), key=lambda r: (-Fold.full(r), r["ord"]))
    bare = {r["ord"] for r in unsized}
    return _plan(sized + unsized, lambda r: r["ord"] in bare)


def attach_null_areas(df: DataFrame) -> DataFrame:
    """Rows without an area go into what they match, if any row has an area; rows meet by city, locality, count and guard of the name, or by a legacy identity."""
    if df.where(F.col(I.AREA).isNotNull()).limit(1).isEmpty():
        return df
    plan = settled(keep(compact(df).withColumn("side", F.lit(0))), _attach)
    return _collapse(df, plan.select("ord", "target", "seq"))


def attach_sole_null(df: DataFrame) -> DataFrame:
    """The only null-area row of a loose key goes into the richest sized row of that key."""
    area = F.col(I.AREA)
    keyed = df.select("ord", I.match_key(loose=True).alias("loose"), area.isNull().alias("bare"), I.fullness(df).alias("full"))
    groups = keyed.where("loose != ''").groupBy("loose").agg(
        F.count_if("bare").alias("nulls"), F.max(F.when(F.col("bare"), F.col("ord"))).alias("src"), F.max(F.when(~F.col("bare"), F.struct("full", (-F.col("ord")).alias("o")))).alias("best")
    )
    moves = groups.where("nulls = 1 and best is not null").select(F.col("src").alias("ord"), (-F.col("best.o")).alias("target"))
    plan = keyed.select("ord").join(moves, "ord", "left").select("ord", F.coalesce("target", "ord").alias("target"), F.when(F.col("target").isNull(), 0).otherwise(1).alias("seq"))
    return _collapse(df, plan)


def dedupe(df: DataFrame) -> DataFrame:
    """All four passes; each works on what the one before left."""
    return attach_sole_null(cut(attach_null_areas(cut(soft(cut(exact(df)))))))


def dedupe_if_needed(df: DataFrame, always: bool = True) -> DataFrame:
    """Consolidate; with ``always`` off, only if a strict key occurs twice."""
    return dedupe(df) if always or not duplicate_groups(df).limit(1).isEmpty() else df


def latest_of_each(df: DataFrame) -> DataFrame:
    """The last row of each match key (else slug, else the row itself), at the place of the first."""
    key = F.coalesce(F.nullif(I.match_key(), F.lit("")), F.nullif(F.col("slug"), F.lit("")) if "slug" in df.columns else F.lit(None).cast("string"), F.concat(F.lit("#"), F.col("ord")))
    return df.withColumn("_key", key).groupBy("_key").agg(F.max_by(F.struct(*df.columns), "ord").alias("r"), F.min("ord").alias("_first")).select("r.*", F.col("_first").alias("first_ord"))
