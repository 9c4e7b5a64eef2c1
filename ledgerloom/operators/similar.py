"""An index for names that match softly: candidates share a segment, so they come from an equi-join.

The ratio of two names is 2M/T with T both lengths together and M the letters of common blocks, which are a common
subsequence. So at ratio NEAR one name becomes the other by at most D = T - NEAR * T insertions and deletions. Cut the first name
into D + 1 segments: each slip touches one of them at most, so one segment stands unchanged in the second name, moved by no more
than the slips allow. First tokens are equal by the guard and are left out. Every pair that matches is found; what is found is compared in full.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ledgerloom.operators import identity as I

NEAR, GAP, SHORTEST = 0.92, 3, 8


def slips(a: int, b: int) -> int:
    """Insertions and deletions between names of these lengths at ratio NEAR, at most."""
    return int((a + b) - NEAR * (a + b) + 1e-9)


def _rest(slug: str) -> str:
    return slug[len(slug.split("-", 1)[0]) :]


def posts(slug: str) -> list[str]:
    """The segments under which a name is kept, for every length that its partner may have."""
    rest, own, out = _rest(slug), len(slug), set()
    for other in range(max(SHORTEST, own - GAP), own + GAP + 1) if own >= SHORTEST else ():
        n = slips(own, other) + 1
        for i in range(n):
            out.add(f"{own}|{other}|{i}|{rest[i * len(rest) // n : (i + 1) * len(rest) // n]}")
    return sorted(out)


def probes(slug: str) -> list[str]:
    """The segments under which the partners of a name are kept: those of its own letters, moved as far as the slips allow."""
    rest, own, out = _rest(slug), len(slug), set()
    for other in range(max(SHORTEST, own - GAP), own + GAP + 1) if own >= SHORTEST else ():
        size, most, grown = len(rest) + other - own, slips(other, own), own - other
        if size < 0:
            continue
        for i in range(most + 1):
            a, b = i * size // (most + 1), (i + 1) * size // (most + 1)
            for move in range(-most, most + 1):
                if abs(move) + abs(grown - move) <= most and 0 <= a + move and b + move <= len(rest):
                    out.add(f"{other}|{own}|{i}|{rest[a + move : b + move]}")
    return sorted(out)


@F.pandas_udf(ArrayType(StringType()))
def _posts(slug: pd.Series) -> pd.Series:
    return slug.map(posts)


@F.pandas_udf(ArrayType(StringType()))
def _probes(slug: pd.Series) -> pd.Series:
    return slug.map(probes)


def soft_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """(k, a_slug, b_slug) of the names of ``a`` and ``b`` (k, slug; distinct) that match softly within one k."""
    named = lambda df: df.where("slug != ''")
    guarded = lambda df, keys: named(df).select("k", "slug", I.guard_key(F.col("slug")).alias("g"), F.explode(keys("slug")).alias("p")).select("k", "slug", F.xxhash64("k", "g", "p").alias("h"))
    left = guarded(a, _posts).withColumnRenamed("slug", "a_slug")
    right = guarded(b, _probes).withColumnRenamed("slug", "b_slug")
    near = left.join(right, ["k", "h"]).where("a_slug != b_slug").select("k", "a_slug", "b_slug").distinct()
    same = named(a).join(named(b), ["k", "slug"]).select("k", F.col("slug").alias("a_slug"), F.col("slug").alias("b_slug"))
    return I.soft_pairs(near, "a_slug", "b_slug").unionByName(same)
