"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned windows, verified hits, spans or documents removed.

Built-in functions only. Words are runs of letters and digits (every character beyond ASCII counts as a letter), A-Z lowered. A
window is ``WINDOW`` consecutive words of an item, or all words of a shorter item. The set of window hashes goes to all
tasks if the windows take ``SET_BYTES`` at most; beyond that only a bitmap of bounded size does, and what passes it is joined by a
shuffle, with the same result. A hit is verified by its words: only documents with hits are read again for that, and
only by their number. Windows that the same items hold form one class, and documents with the same classes are told their items once, so a
passage that many items and many documents share is never multiplied.

Defined cases: a null or blank text has no words and no hit; an item without words has no window; items of one item_id count once, and a
null item_id is the empty string; repeated rows and rows without doc_id are judged each on its own; overlapping occurrences count each word
once; an empty table gives an empty result, and without benchmark nothing is hit; other columns pass through ``clean`` whatever their names.
A very long text is one row of words and one of 8 byte hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

WINDOW = 10
#: Bytes of benchmark windows (their texts and 64 bytes each) up to which their set is broadcast.
SET_BYTES = 32 << 20
#: What separates words once A-Z are lowered.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The words of a text as it is.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INTERNAL = ("_rid", "_hit", "_from", "_to", "_words", "_gaps", "_after", "_pairs", "_maybe", "_key", "_x", "_bits", "_bucket", "norm", "n_words", "words", "classes")


def normalised(text: Column) -> Column:
    """The words, one blank between each two; only A-Z are lowered, so a text beyond ASCII can't go through lower()."""
    x = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(F.translate(x, UPPER, LOWER))
    return F.trim(F.regexp_replace(low, GAPS, " "))


def _count(norm: str) -> Column:
    return F.when(F.col(norm) == "", F.lit(0)).otherwise(F.length(norm) - F.length(F.replace(F.col(norm), F.lit(" "))) + 1).cast("long")


def _at(words: str, start: Column, size) -> Column:
    return F.slice(words, start + 1, size)


def windows(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(w, length, h, class) of every distinct window, staged, and the items of every class: (class, items)."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), normalised(F.col(text)).alias("t")).where("t != ''")
    words = items.select("item", F.split("t", " ").alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    each = words.select("item", F.explode(F.transform(starts, lambda i: _at("words", i, size))).alias("x"))
    held = each.groupBy("x").agg(F.sort_array(F.collect_set("item")).alias("items")).withColumn("class", F.sha2(F.to_json("items"), 256))
    return C.stage(held.select(F.array_join("x", " ").alias("w"), F.size("x").alias("length"), F.xxhash64("x").alias("h"), "class", "items"), "leak-windows")


def _found(staged: DataFrame, wins: DataFrame, length: int, small: bool) -> DataFrame:
    """(_rid, at, length) of windows of ``length`` words whose hash is in the set."""
    keys = wins.where(F.col("length") == length).select("h").distinct()
    words = staged.where(F.col("n_words") >= length).select("_rid", F.split("norm", " ").alias("words"))
    hashed = words.select("_rid", F.transform(F.sequence(F.lit(0), F.size("words") - length), lambda i: F.xxhash64(_at("words", i, length))).alias("hs"))
    rows = hashed.select("_rid", F.posexplode_outer("hs").alias("at", "h"))  # the inner form would hash twice: Spark infers a filter on the array
    hits = rows.join(F.broadcast(keys), "h", "left_semi") if small else C.semi(rows, "h", C.stage(keys, "leak-keys"))
    return hits.select("_rid", "at", F.lit(length).alias("length"))


def hit_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, size: int, set_bytes: int, keep: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged rows (_rid, own columns, n_words, norm), per hit row (_rid, words: places of hit words in order, classes), and the windows."""
    wins = windows(benchmark, item_id, item_text, size)
    own = docs.columns if keep else [doc_id]
    staged = C.stage(docs.withColumns({"_rid": F.monotonically_increasing_id(), "norm": normalised(F.col(text))}).select("_rid", *own, _count("norm").alias("n_words"), "norm"), "leak-rows", "zstd")
    total = wins.agg(F.sum(F.octet_length("w") + 64)).first()[0] or 0
    small = total <= set_bytes
    lengths = sorted(r[0] for r in wins.select("length").distinct().collect())  # WINDOW numbers at most
    if not lengths:
        return staged, C.stage(staged.limit(0).select("_rid", F.array().cast("array<int>").alias("words"), F.array().cast("array<string>").alias("classes")), "leak-hits"), wins
    found = C.stage(reduce(DataFrame.unionAll, [_found(staged, wins, n, small) for n in lengths]), "leak-found")
    # a hit's words are read from its document, which comes once with all its hits
    places = found.groupBy("_rid").agg(F.collect_list(F.struct("at", "length")).alias("hits"))
    # split below the join: above it, Spark would move the split into the lambda and do it once a hit
    texts = C.semi(staged.select("_rid", "norm"), "_rid", found.select("_rid").distinct()).select("_rid", F.split("norm", " ").alias("words"))
    worded = places.join(texts, "_rid")
    cut = worded.select("_rid", F.transform("hits", lambda x: F.struct(x["at"].alias("at"), x["length"].alias("length"), F.array_join(_at("words", x["at"], x["length"]), " ").alias("w"))).alias("hits"))
    rows = cut.select("_rid", F.explode_outer("hits").alias("x")).select("_rid", "x.*")
    known = wins.select("w", "class")
    sure = rows.join(F.broadcast(known) if small else known, "w")
    per = sure.groupBy("_rid").agg(F.collect_list(F.struct("at", "length")).alias("hits"), F.sort_array(F.collect_set("class")).alias("classes"))
    covered = F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["at"], x["at"] + x["length"] - 1)))))
    hits = C.stage(per.select("_rid", covered.alias("words"), "classes"), "leak-hits")
    C.unstage(found)
    return staged, hits, wins


def judged(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    staged, hits, wins = hit_spans(docs, benchmark, "doc_id", "text", item_id, item_text, size, set_bytes)
    # documents with the same classes have the same items, which are put together once
    alike = hits.select("classes").distinct().withColumn("class", F.explode("classes"))
    items = alike.join(wins.select("class", "items").distinct(), "class").groupBy("classes").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    named = C.stage(items.select("classes", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "leak-items")
    per = hits.select("_rid", F.size("words").cast("long").alias("n_hit"), "classes").join(named, "classes").drop("classes")
    out = staged.select("_rid", "doc_id", "n_words").join(per, "_rid", "left")
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, set_bytes: int = SET_BYTES) -> DataFrame:
    """``docs`` without contaminated documents (``remove`` = "documents"), or with hit words cut out of their texts ("spans").

    A span goes from its first hit word to its last; what stands before and after it stays as it is.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    held, named = C.aside(docs, *INTERNAL)
    at = dict(zip(docs.columns, held.columns, strict=True))
    staged, hits, _ = hit_spans(held, benchmark, at[doc_id], at[text], item_id, item_text, size, set_bytes, keep=True)
    rows = staged.select("_rid", *held.columns)
    if remove == "documents":
        return named(C.anti(rows, "_rid", hits.select("_rid")))
    known = lambda k: F.col("words")[k]
    first = F.filter("words", lambda p, i: (i == 0) | (known(F.greatest(i - 1, F.lit(0))) < p - 1))
    last = F.filter("words", lambda p, i: (i == F.size("words") - 1) | (known(F.least(i + 1, F.size("words") - 1)) > p + 1))
    spans = hits.select(F.col("_rid").alias("_hit"), F.concat(F.array(F.lit(-1)), last).alias("_from"), F.concat(first, F.array(F.lit(1 << 30))).alias("_to"))
    t = F.coalesce(F.col(f"`{at[text]}`"), F.lit(""))
    near = C.semi(rows, "_rid", hits.select("_rid")).join(spans, F.col("_rid") == F.col("_hit"))
    near = near.withColumns({"_words": F.regexp_extract_all(t, F.lit(WORDS), F.lit(0)), "_gaps": F.split(t, WORDS, -1)})
    near = near.withColumn("_after", F.slice("_gaps", F.lit(2), F.size("_words"))).withColumn("_pairs", F.arrays_zip("_words", "_after"))
    # gap k stands before word k: of the words between two spans, each is followed by its gap
    kept = lambda a, b: F.slice("_pairs", a + 2, F.greatest(F.least(b, F.size("_words")) - a - 1, F.lit(0)))
    part = lambda a, b: F.concat(F.array(F.col("_gaps")[a + 1]), F.flatten(F.transform(kept(a, b), lambda x: F.array(x["_words"], x["_after"]))))
    texts = F.array_join(F.flatten(F.transform(F.arrays_zip("_from", "_to"), lambda s: part(s["_from"], s["_to"]))), "")
    cleaned = near.withColumn(at[text], texts).select(*held.columns)
    return named(C.anti(rows, "_rid", hits.select("_rid")).select(*held.columns).unionByName(cleaned))
