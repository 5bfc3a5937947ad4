"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Every shingle of ``SHINGLE`` words is hashed once; the top bits of the hash choose a
bin, each bin keeps its least hash. An empty bin takes the value of another one, found
by a sequence of hashes of its number that is the same for all texts (``PROBES`` of them,
after that the filled bin that comes first by a further hash). Of each bin the low 8 bits are
packed, eight bins to a long. The share of equal bins is corrected for the chance that
unequal values agree in 8 bits.

DataFrame functions only; all arrays are per document, nothing is exploded.

Defined cases: null counts as empty; fewer than ``SHINGLE`` words are one shingle; a
text without words has an empty fingerprint, which is like another empty one (1.0)
and unlike all others (0.0); equal texts have equal fingerprints; an empty table gives an
empty result. Following documents: null ids come first, repeated ids are ordered by a hash of their text; a
single document follows itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE, BINS, LOW_BITS, PROBES = 5, 256, 8, 16
_PER_LONG = 64 // LOW_BITS
_SPACE = " \t\n\x0b\x0c\r"
_LEAST_ID = -(1 << 63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _hashes(text: Column, size: int) -> Column:
    """One 64-bit hash per shingle; the words' hashes are hashed together."""
    trimmed = F.trim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SPACE))

    def shingles(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - size)
        many = F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(size))))
        return F.when(F.size(h) >= size, many).otherwise(F.array(F.xxhash64(h)))

    hashed = F.transform(F.split(trimmed, "[ \t-\r]+"), lambda w: F.xxhash64(w))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(_let(hashed, shingles))


def _bin(x: Column) -> Column:
    return F.shiftright(x, 64 - (BINS - 1).bit_length())


def _slots(hashes: Column) -> Column:
    """The least hash of each bin, its lowest bit set, or null; ``BINS`` of them in order."""
    def least(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))

    def filled(m: Column) -> Column:
        none = F.array_except(
            F.sequence(F.lit(-BINS // 2).cast("long"), F.lit(BINS // 2 - 1).cast("long")), F.transform(m, _bin)
        )
        marked = F.transform(m, lambda x: x.bitwiseOR(F.lit(1)))
        gaps = F.transform(none, lambda e: F.shiftleft(e, 64 - (BINS - 1).bit_length()))
        both = F.sort_array(F.concat(marked, gaps))
        return F.transform(both, lambda x: F.when(x.bitwiseAND(F.lit(1)) == 1, x))

    return _let(_let(F.sort_array(hashes), least), filled)


def _densified(slots: Column) -> Column:
    """Every bin's value: its own, or that of the first filled bin in its sequence."""
    def of(i: Column) -> Column:
        probes = [F.get(slots, F.pmod(F.xxhash64(i, F.lit(n)), F.lit(BINS)).cast("int")) for n in range(PROBES)]
        ranked = F.transform(
            F.filter(slots, lambda x: x.isNotNull()), lambda x: F.struct(F.xxhash64(i, _bin(x)).alias("rank"), x.alias("x"))
        )
        return F.coalesce(F.get(slots, i), *probes, F.array_min(ranked)["x"])

    return F.transform(_numbers(BINS), of)


def _packed(values: Column) -> Column:
    """Bits 1 to 8 of each value, eight values to a long."""
    def word(i: Column) -> Column:
        out = None
        for j in range(_PER_LONG):
            low = F.shiftrightunsigned(F.get(values, i * _PER_LONG + j), 1).bitwiseAND(F.lit((1 << LOW_BITS) - 1))
            out = low if out is None else out.bitwiseOR(F.shiftleft(low, LOW_BITS * j))
        return out

    return F.transform(_numbers(BINS // _PER_LONG), word)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """Packed fingerprint of a text: longs, none for a text without words."""
    def made(hashes: Column) -> Column:
        packed = _let(_let(_slots(hashes), _densified), _packed)
        return F.when(F.size(hashes) > 0, packed).otherwise(F.array().cast("array<bigint>"))

    return _let(_hashes(text, size), made)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    def unlike(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for n in (4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, n))
        return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    different = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda n, x: n + x)
    chance = 2.0**-LOW_BITS
    share = ((F.lit(BINS) - different) / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), share))
    )


def as_text(packed: Column) -> Column:
    """A fingerprint in hexadecimal."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")


# --- each document with the following one ----------------------------------------


def with_following(docs: DataFrame, id: str, columns: dict[str, str], buckets: int) -> DataFrame:
    """``docs`` with columns of the row that follows by ascending id; after the last comes the first.

    Ids are cut into ranges at ``buckets`` of their percentiles, which are all the driver sees; the first
    row of each range is copied to the end of the one before, so every range is put in order by itself.
    ``columns`` maps names to the names of their successors.
    """
    place = F.coalesce(F.col(id).cast("long"), F.lit(_LEAST_ID))
    shares = [n / buckets for n in range(buckets)]
    found = docs.select(place.alias("p")).agg(F.percentile_approx("p", shares, 100 * buckets), F.min("p")).first()
    if found[1] is None:
        return docs.withColumns({new: F.lit(None).cast(docs.schema[old].dataType) for old, new in columns.items()})
    bounds = sorted({found[1], *found[0]})
    known = F.lit(bounds).cast("array<bigint>")
    bucket = F.size(F.filter(known, lambda b: b <= F.col("__place")))
    tie = F.xxhash64(*columns)
    placed = docs.withColumn("__place", place).withColumn("__tie", tie)
    own = placed.withColumns({"__bucket": bucket, "__guest": F.lit(0)})
    first = placed.filter(F.col("__place").isin(bounds))
    lead = F.lead("__tie").over(Window.partitionBy("__place").orderBy(F.desc("__tie")))
    guests = first.withColumn("__next", lead).filter(F.col("__next").isNull()).dropDuplicates(["__place"]).drop("__next")
    guests = guests.withColumns(
        {"__bucket": F.when(bucket == 1, len(bounds)).otherwise(bucket - 1), "__guest": F.lit(1)}
    )
    window = Window.partitionBy("__bucket").orderBy("__guest", "__place", "__tie")
    both = own.unionByName(guests)
    moved = both.withColumns({new: F.lead(old).over(window) for old, new in columns.items()})
    return moved.filter(F.col("__guest") == 0).drop("__place", "__tie", "__bucket", "__guest")


def edited_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Every document, its text with the second half taken from the following one, and their fingerprints.

    id, n_chars, edited, fingerprint, edited_fingerprint (longs), near_edited, near_next.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "fingerprint", fingerprint(F.col("text"), size)
    )
    pairs = with_following(own, id, {"text": "next_text", "fingerprint": "next_fingerprint"}, buckets)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    made = pairs.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint(F.col("edited"), size))
    return made.select(
        id,
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
