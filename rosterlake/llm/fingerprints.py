"""Threshold-scaled fingerprints: every shingle hash below a fixed fraction of the hash range is kept.

Two such sketches of texts of any lengths can be merged and compared, since both keep the
same hashes of what they share. So that no text with words has an empty sketch, its least hash always stays
(the least of a union is the least of both, so merging still works). Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import table

WORDS, ONE_IN = 5, 4
#: Hash values in use: 48 bits, so a hash is 12 hexadecimal digits.
_BITS = 48


def sketch(text: Column, words: int = WORDS, one_in: int = ONE_IN) -> Column:
    """Sorted distinct hashes of the text's ``words``-word shingles below ``1 / one_in`` of the range, and the least of all.

    Words are what white space separates, in lower case. The text is padded in front with empty words, so one of n words has n
    shingles, which tells short texts apart too; without words, there is none.
    """
    split = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    limit = (1 << _BITS) // one_in
    # a lambda over an array of one element names the words, so that they are split once
    padded = F.concat(F.array_repeat(F.lit(""), words - 1), split)
    return F.element_at(
        F.transform(
            F.array(padded),
            lambda w: F.when(F.size(w) >= words, _kept(_hashes(w, words), limit)).otherwise(F.array().cast("array<bigint>")),
        ),
        1,
    )


def _hashes(w: Column, words: int) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.size(w) - (words - 1)),
        lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, words)), 64 - _BITS),
    )


def _kept(hashes: Column, limit: int) -> Column:
    return F.element_at(
        F.transform(F.array(hashes), lambda h: F.array_sort(F.array_distinct(F.array_append(F.filter(h, lambda x: x < limit), F.array_min(h))))), 1
    )


def merged(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """The sketch of two texts together, but for shingles across their border."""
    both = F.array_union(a, b)
    return F.array_sort(F.filter(both, lambda x: (x < (1 << _BITS) // one_in) | (x == F.array_min(both))))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has; two empty sketches are alike."""
    least = F.least(F.size(a), F.size(b))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, 1.0).otherwise(
        F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), least.cast("double")), F.lit(0.0))
    )


def printed(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), _BITS // 4, "0")), "")


def _ranges(bare: DataFrame, most: int) -> tuple[list[int], int | None]:
    """Ids that begin a range, a few dozen rows to each range and at most ``most`` ranges; and the first id of
    all (None where some id is null: nulls come first)."""
    n, nulls, least = bare.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.min("doc_id")).first()
    ranges = max(2, min(most, n // 64))
    shares = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    edges = bare.agg(F.expr(f"percentile_approx(doc_id, array({shares}), {max(10_000, 4 * ranges)})")).first()[0]
    return sorted(set(edges or [])), None if nulls else least


def with_next(docs: DataFrame, most_ranges: int = 16_384) -> DataFrame:
    """doc_id, text and sketch of each document beside text and sketch of the next one.

    Ids are cut into ranges at some of the ids themselves. A text moves once, to its range; the first of a
    range goes to the range before as well (and the first of all to the last), as a guest who is only looked at.
    """
    bare = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    edges, least = _ranges(bare, most_ranges)
    borders = F.expr(f"array({', '.join(f'{e}L' for e in edges)})" if edges else "cast(array() as array<bigint>)")

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        beyond = F.element_at(borders, middle + 1) <= F.col("doc_id")
        open_ = state["lo"] < state["hi"]
        return F.struct(
            F.when(open_ & beyond, middle + 1).otherwise(state["lo"]).alias("lo"),
            F.when(open_ & ~beyond, middle).otherwise(state["hi"]).alias("hi"),
        )

    steps = F.sequence(F.lit(0), F.lit(len(edges).bit_length()))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(edges)).alias("hi")), halve, lambda s: s["lo"])
    ranged = bare.withColumn("range", F.when(F.col("doc_id").isNull() | F.lit(not edges), 0).otherwise(found))
    at_edge = (F.col("range") > 0) & (F.try_element_at(borders, F.col("range")) == F.col("doc_id"))
    at_start = F.col("doc_id").isNull() if least is None else F.col("doc_id") == least

    def place(where: Column, guest: int) -> Column:
        return F.struct(where.cast("int").alias("range"), F.lit(guest).alias("guest"))

    places = F.array_compact(F.array(
        place(F.col("range"), 0), F.when(at_edge, place(F.col("range") - 1, 1)), F.when(at_start, place(F.lit(len(edges)), 2))
    ))
    moved = ranged.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.range", "p.guest")
    sketched = moved.repartition("range").withColumn("sketch", sketch(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return sketched.select(
        "doc_id", "text", "sketch", "guest", F.lead("text").over(order).alias("next_text"), F.lead("sketch").over(order).alias("next_sketch")
    ).filter("guest = 0").drop("guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's sketch, that of its edited text, and the next document's sketch.

    The edited text has the next document's beginning in place of its last quarter. Documents are in order of
    id, null first; rows that share an id, in order of text. A null text is empty. One row for each row.
    """
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring("next_text", F.lit(1), quarter))
    both = with_next(docs).select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    return both.withColumn("edited_sketch", sketch(F.col("edited")))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    found = fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
