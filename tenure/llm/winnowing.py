"""Document fingerprints by winnowing, in column expressions only.

Words are hashed once; a k-gram hash is built from the word hashes by a rolling polynomial, in
log2(k) steps that join neighbouring halves. Hash and position are packed into one number so
that the least number of a window is its least hash, the rightmost one on ties; the minima of
all windows of w k-grams take log2(w) steps in the same way. Every run of w + k - 1 words that
two texts share leaves a common hash in both fingerprints.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.llm.common import BLANK_RUN, partitions, text_of

# Words in a k-gram and k-grams in a window (powers of two), the modulus and the
# base of the polynomial, and the place of the hash above the position.
K, W = 4, 8
MODULUS, BASE = 2147483647, 1103515245
PLACE = 1 << 31
_BLANKS = " \t\n\x0b\x0c\r"
#: Ranges of ids that are ordered in one task each, at most.
MOST_RANGES = 16_384


def word_hashes(text: Column) -> Column:
    """31-bit hash of each word of a text, from the first digits of its MD5."""
    bare = F.btrim(text, F.lit(_BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))
    return F.transform(
        words, lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long") % MODULUS
    )


def _joined(df: DataFrame, column: str, size: int, merge) -> DataFrame:
    """Replace an array by merge(x[i], x[i + 1]), then [i + 2], ... up to ``size`` neighbours."""
    step = 1
    while step < size:
        left = F.greatest(F.size(column) - step, F.lit(0))
        pairs = F.zip_with(F.slice(column, 1, left), F.slice(column, step + 1, left), merge(step))
        df = df.withColumn(column, pairs)
        step *= 2
    return df


def fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """Add ``out``: an array of packed (hash, position), in order of position.

    A text of fewer than k words has one k-gram, all its words; one of fewer than w k-grams has
    one window; one without words has an empty fingerprint.
    """
    if k & (k - 1) or w & (w - 1):
        raise ValueError("k and w must be powers of two")
    short = F.aggregate(out, F.lit(0).cast("long"), lambda a, x: (a * BASE + x) % MODULUS)
    df = df.withColumn(out, word_hashes(F.col(text)))
    df = df.withColumn(
        f"{out}_short", F.when(F.size(out) < k, F.when(F.size(out) > 0, F.array(short)).otherwise(F.array().cast("array<bigint>")))
    )
    df = _joined(df, out, k, lambda step: lambda a, b: (a * pow(BASE, step, MODULUS) + b) % MODULUS)
    df = df.withColumn(out, F.coalesce(f"{out}_short", out)).drop(f"{out}_short")
    df = df.withColumn(out, F.transform(out, lambda g, i: g * PLACE + (PLACE - 1 - i.cast("long"))))
    df = df.withColumn(f"{out}_one", F.when((F.size(out) > 0) & (F.size(out) < w), F.array(F.array_min(out))))
    df = _joined(df, out, w, lambda step: lambda a, b: F.least(a, b))
    return df.withColumn(out, F.array_distinct(F.coalesce(f"{out}_one", out))).drop(f"{out}_one")


def hashes(packed: Column | str) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(packed, lambda p: F.shiftright(p, 31)))


def positions(packed: Column | str) -> Column:
    return F.transform(packed, lambda p: (F.lit(PLACE - 1) - p.bitwiseAND(F.lit(PLACE - 1))).cast("int"))


def shown(packed: Column | str) -> Column:
    """Fingerprint as text: hash in hex and position of each chosen k-gram."""
    entries = F.transform(
        packed,
        lambda p: F.concat(
            F.lpad(F.lower(F.hex(F.shiftright(p, 31))), 8, "0"),
            F.lit(":"),
            (F.lit(PLACE - 1) - p.bitwiseAND(F.lit(PLACE - 1))).cast("string"),
        ),
    )
    return F.array_join(entries, " ")


def likeness(a: Column | str, b: Column | str) -> Column:
    """Common share of two sets of hashes; 1 for two empty ones."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds below the id; a coarse array first, then one of its parts."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < doc_id))

    coarse = below(F.array(*[F.lit(p[-1]) for p in parts]))
    fine = F.array(*[F.array(*[F.lit(b) for b in p]) for p in [*parts, parts[-1][:1]]])
    number = coarse * step + F.when(coarse < len(parts), below(F.element_at(fine, coarse + 1))).otherwise(0)
    return F.coalesce(number, F.lit(0)).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and _h, _next_h (own and next hashes), in descending order of doc_id.

    Ids are cut into ranges of about equal size, each ordered in one task; texts are shuffled
    once. A range also gets a copy of the first row of the range that follows, so no row has to
    look elsewhere; after the last row comes the first. Equal ids are ordered by text, null ids
    come last.
    """
    spark = docs.sparkSession
    n = min(MOST_RANGES, max(1, partitions(spark)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    placed = rows.withColumn("_range", _range_of(F.col("doc_id"), sorted(set(cuts))))
    # One row per range.
    firsts = placed.groupBy("_range").agg(F.max("doc_id").alias("id")).orderBy("_range").collect()
    if not firsts:
        heads = placed.limit(0).select("_range", "doc_id", "text")
    else:
        follows = [(r["_range"], firsts[i - 1]["_range"], firsts[i - 1]["id"]) for i, r in enumerate(firsts)]
        wanted = spark.createDataFrame(follows, "_to int, _range int, id long")
        same = (placed["_range"] == wanted["_range"]) & placed["doc_id"].eqNullSafe(wanted["id"])
        heads = (
            placed.join(F.broadcast(wanted), same)
            .groupBy("_to")
            .agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
            .select(F.col("_to").alias("_range"), "doc_id", "text")
        )
    every = placed.withColumn("_copy", F.lit(0)).unionByName(heads.withColumn("_copy", F.lit(1)))
    spread = every.repartition(max(n, partitions(spark)), "_range")
    order = Window.partitionBy("_range").orderBy("_copy", F.col("doc_id").desc_nulls_last(), "text")
    after = spread.withColumn("next_text", F.lead("text").over(order))
    printed = fingerprint(after, "text", "_fp").withColumn("_h", hashes("_fp"))
    return printed.withColumn("_next_h", F.lead("_h").over(order)).where("_copy = 0").drop("_copy", "_range")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null and empty texts have no words and an empty fingerprint; two empty fingerprints are
    alike (1), an empty and another are not (0). A single row follows itself. Repeated rows all
    appear; an empty table gives an empty result; other columns are not used.
    """
    after = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    changed = fingerprint(after.withColumn("edited", edited), "edited", "_edited_fp").withColumn("_edited_h", hashes("_edited_fp"))
    return changed.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown("_fp").alias("fingerprint"),
        shown("_edited_fp").alias("edited_fingerprint"),
        likeness("_h", "_edited_h").alias("near_edited"),
        likeness("_h", "_next_h").alias("near_next"),
    )
