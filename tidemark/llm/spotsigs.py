"""Document fingerprints by SpotSigs, in DataFrame functions alone.

A spot signature is a common word (the anchor) with the chain of the next ``chain`` content words after it, other
common words skipped, looked for within ``reach`` words. A word that no common word precedes within ``reach`` words is
an anchor too, so that tables, lists and other languages give signatures throughout, and an edit changes only those
near it. A text's fingerprint is the sorted set of its signatures' 32-bit hashes. Sets are partitioned by their length, in classes whose
bounds differ by the factor ``1 / similarity``: sets that are at least ``similarity`` alike lie in the same class or in
neighbouring ones, and only such are compared (``near_pairs``): those that share one of their first signatures, as
many as a set of that length can lack and still be like another, by exact Jaccard likeness. No pair is missed.

Words are runs of letters and digits, lower-cased. Null texts are empty; texts without words have an empty
fingerprint, and two empty ones are alike (1.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Common words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be but by for from had has he his in is it not of on or she that the their they this to was were
which with you
als auch auf aus bei das dem den der des die ein eine einem einen einer er es für im ist mit nicht sich sie und von
war wie zu zum
au avec ce dans de du elle en est et il la le les mais ne ou par pas plus pour que qui se sur un une
al como con del el esta está las lo los más no para pero por si sin su sus también todo una y ya
""".split()


@dataclass(frozen=True)
class SpotSpec:
    chain: int = 2
    reach: int = 8
    similarity: float = 0.8
    #: Keys in a stretch of the id order; and the most stretches, whose first keys the driver holds.
    stretch: int = 256
    max_stretches: int = 16_384


def signature_set(text: Column, spec: SpotSpec = SpotSpec()) -> Column:
    """The sorted distinct hashes of a text's spot signatures."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    anchor = lambda w: w.isin(ANCHORS)

    def signatures(words: Column) -> Column:
        listed = F.filter(F.transform(words, lambda w, i: F.when(anchor(w), i + 1)), lambda i: i.isNotNull())
        # From each listed anchor to the next: it, and the words more than ``reach`` after it. The first stretch has none.
        begins, ends = F.concat(F.array(F.lit(-spec.reach)), listed), F.concat(listed, F.array(F.size(words) + 1))
        none = F.array().cast("array<int>")
        own = lambda a: F.when(a > 0, F.array(a)).otherwise(none)
        far = lambda a, b: F.when(b > a + spec.reach + 1, F.sequence(a + spec.reach + 1, b - 1)).otherwise(none)
        places = F.flatten(F.zip_with(begins, ends, lambda a, b: F.concat(own(a), far(a, b))))
        chain = lambda i: F.slice(F.filter(F.slice(words, i + 1, spec.reach), lambda w: ~anchor(w)), 1, spec.chain)
        return F.transform(places, lambda i: F.xxhash64(F.element_at(words, i), chain(i)).bitwiseAND(F.lit(0xFFFFFFFF)))

    # The words are named once, so that they are not split again for each use.
    return F.array_sort(F.array_distinct(F.element_at(F.transform(F.array(words), signatures), 1)))


def fingerprint_text(signatures: Column) -> Column:
    """Eight hex digits for each signature."""
    return F.array_join(F.transform(signatures, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def length_class(signatures: Column, spec: SpotSpec = SpotSpec()) -> Column:
    """The partition of a set by its length."""
    return F.floor(F.log(F.greatest(F.size(signatures), F.lit(1)).cast("double")) / F.lit(-math.log(spec.similarity))).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets; null sets count as empty."""
    left, right = F.coalesce(F.size(a), F.lit(0)), F.coalesce(F.size(b), F.lit(0))
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(F.greatest(left, right) == 0, F.lit(1.0))
        .when((left == right) & (a == b), F.lit(1.0))
        .otherwise(shared / (left + right - shared))
    )


def near_sets(docs: DataFrame, spec: SpotSpec = SpotSpec()) -> DataFrame:
    """set_id (the least doc_id with the set), sigs: every distinct signature set; texts without words have the empty one."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), signature_set(F.coalesce(docs["text"], F.lit("")), spec).alias("sigs"))
    return rows.groupBy("sigs").agg(F.min("doc_id").alias("set_id"))


def near_pairs(sets: DataFrame, spec: SpotSpec = SpotSpec()) -> DataFrame:
    """a < b, likeness: the pairs of distinct sets (set_id, sigs) that are at least ``similarity`` alike.

    Equal sets have one row in ``sets``, so copies don't multiply pairs; rows without set_id take no part.
    """
    n = F.size("sigs")
    first = n - F.ceil(n * spec.similarity - 1e-9).cast("int") + 1
    own = sets.where("set_id is not null").where(n > 0).select("set_id", n.alias("n"), length_class(F.col("sigs"), spec).alias("c"), F.explode(F.slice("sigs", F.lit(1), first)).alias("s"))
    # A set also shows itself to the class above; the smaller of two is in the same class or the one below.
    shown = own.select("s", F.col("set_id").alias("x"), F.col("n").alias("nx"), F.explode(F.array(F.col("c"), F.col("c") + 1)).alias("c"))
    met = own.withColumnsRenamed({"set_id": "y", "n": "ny"}).join(shown, ["s", "c"]).where("nx < ny or nx = ny and x < y").where(F.col("nx") >= F.col("ny") * spec.similarity - 1e-9)
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("sigs").alias("u")), "a").join(sets.select(F.col("set_id").alias("b"), F.col("sigs").alias("v")), "b")
    return both.select("a", "b", likeness(F.col("u"), F.col("v")).alias("likeness")).where(F.col("likeness") >= spec.similarity - 1e-12)


#: What rows are ordered by: 1 with an id and 0 without, the id (0 without), and a hash of the text.
KEY = ("has", "id", "h")


def _listed(keys: list[tuple[int, int, int]]) -> Column:
    """Keys as one constant array of structs."""
    if not keys:
        return F.array().cast("array<struct<has: int, id: bigint, h: bigint>>")
    parts = (F.split(F.lit(",".join(str(k[i]) for k in keys)), ",").cast("array<bigint>") for i in range(3))
    return F.arrays_zip(*parts).cast("array<struct<has: int, id: bigint, h: bigint>>")


def with_next(docs: DataFrame, spec: SpotSpec = SpotSpec()) -> DataFrame:
    """doc_id, text, sigs, next_text, next_sigs, copies: rows with the one that follows by descending doc_id.

    The last is followed by the first. Equal ids follow each other by the text's hash, descending; null ids come last.
    The order is cut into stretches at keys (id and text hash) that a hash picks; each stretch also gets the first row of
    the following one, so that one shuffle of the texts is enough. Rows of one id lie in as many stretches as they have
    texts for. Where more rows than a stretch holds are the same in id and text, they are counted before the shuffle and
    stand as two rows: one with the true next, and one followed by itself that stands for ``copies`` of them.
    """
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = own.select("doc_id", "text", F.col("doc_id").isNotNull().cast("int").alias("has"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h"))
    counts = stored(rows.groupBy(*KEY).agg(F.count("*").alias("n")), "spots-keys")
    shape = counts.agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.max(F.struct(*KEY)).alias("last")).first()
    every = max(spec.stretch, shape["keys"] * 2 // spec.max_stretches)
    picked = counts.where(F.pmod(F.xxhash64(*KEY), F.lit(every)) == 0).select(*KEY)
    heads = sorted({tuple(r) for r in picked.collect()} | ({tuple(shape["last"])} if shape["keys"] else set()))  # about max_stretches at most
    # At most max_stretches keys have more rows than this.
    hot = counts.where(F.col("n") > max(spec.stretch, (shape["n"] or 0) // spec.max_stretches)).select(*KEY)
    once = F.lit(1).cast("long").alias("n")
    if hot.limit(1).count():
        many = rows.join(F.broadcast(hot), list(KEY), "left_semi").groupBy(*KEY, "doc_id", "text").agg(F.count("*").alias("n"))
        few = rows.join(F.broadcast(hot), list(KEY), "left_anti")
        rows = few.select(*KEY, "doc_id", "text", once).unionByName(many)
    else:
        rows = rows.select(*KEY, "doc_id", "text", once)
    step = max(1, math.isqrt(len(heads)))
    fine, coarse, key = _listed(heads), _listed(heads[step - 1 :: step]), F.struct(*KEY)
    # Heads below the key: whole steps first, then one step of single heads.
    steps = F.size(F.filter(coarse, lambda x: x < key))
    placed = rows.withColumn("own", steps * step + F.size(F.filter(F.slice(fine, steps * step + 1, step), lambda x: x < key)))
    head = F.coalesce(F.get(fine, F.col("own")) == key, F.lit(False))
    before = F.when(F.col("own") == len(heads) - 1, F.lit(0)).otherwise(F.col("own") + 1)  # of stretches, in descending order
    spot = lambda stretch, guard: F.struct(stretch.alias("stretch"), F.lit(guard).alias("guard"))
    spots = F.when(head, F.array(spot(F.col("own"), 0), spot(before, 1))).otherwise(F.array(spot(F.col("own"), 0)))
    dealt = placed.select(*KEY, "doc_id", "text", "n", F.explode(spots).alias("spot")).select(*KEY, "doc_id", "text", "n", "spot.*").repartition("stretch")
    signed = dealt.withColumn("sigs", signature_set(F.col("text"), spec))
    order = Window.partitionBy("stretch").orderBy("guard", *(F.desc(k) for k in KEY))
    led = signed.withColumns({"next_text": F.lead("text").over(order), "next_sigs": F.lead("sigs").over(order)}).where("guard = 0")
    alone = F.when(F.col("n") > 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    parted = led.withColumn("alone", F.explode(alone))
    return parted.select(
        "doc_id", "text", "sigs", F.when(F.col("alone"), F.col("text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(F.col("alone"), F.col("sigs")).otherwise(F.col("next_sigs")).alias("next_sigs"), F.when(F.col("alone"), F.col("n") - 1).otherwise(1).alias("copies"),
    )


def edited_fingerprints(docs: DataFrame, spec: SpotSpec = SpotSpec()) -> DataFrame:
    """Fingerprints of every text and of its edit, whose last third is the beginning of the next document."""
    chars = F.char_length("text")
    third = F.floor(chars / 3).cast("int")
    edited = with_next(docs, spec).select(
        "doc_id", "copies", "sigs", "next_sigs", chars.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), chars - third), F.substring("next_text", F.lit(1), third)).alias("edited"),
    )
    signed = edited.select("doc_id", "copies", "n_chars", "sigs", "next_sigs", F.sha2("edited", 256).alias("edited_sha256"), signature_set(F.col("edited"), spec).alias("edited_sigs"))
    found = signed.select(
        "doc_id", "copies", "n_chars", "edited_sha256", fingerprint_text(F.col("sigs")).alias("fingerprint"), fingerprint_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.size("sigs").alias("n_signatures"), length_class(F.col("sigs"), spec).alias("length_class"),
    )
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
