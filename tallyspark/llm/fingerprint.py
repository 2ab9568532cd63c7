"""Document fingerprints as homomorphic multiset hashes of paragraphs.

Every paragraph (line) hashes to a wide vector; a document's fingerprint is the
sum of its paragraphs' vectors, lane by lane, modulo powers of two. So the
order of paragraphs does not matter, and a paragraph can be inserted or deleted
by adding or subtracting its vector (``combine`` and ``without``).

A vector has two parts. DIGEST lanes of 32 bits, modulo 2^32, are hashes of the
whole paragraph: documents with the same paragraphs agree on them, others do
not. SKETCH lanes, also modulo 2^32, count for each of 63 bits the paragraph's
word shingles whose hash has that bit. As the counts add up over paragraphs
too, the lanes minus half the number of shingles are a random projection of the
document's shingles, and the cosine of two of them, cut to 0..1, estimates how
much two documents share (``likeness``; standard error about 1/8 for unrelated
ones). Counting goes block by block: within BLOCK shingles a count fits into
FIELD bits, so one addition counts for seven lanes at once.

Everything is built-in column functions on one row. A document's successor, by
ascending ``doc_id``, comes from a range-partitioned table of the ids alone: a
window in each range, and one over the ranges' first ids, a row per range.
Texts meet their successor's opening through two joins on ``doc_id``.

Nulls: a null text counts as empty, which is one empty paragraph. A null
``doc_id`` has no successor (nothing is put in) and is no one's. Rows that
repeat a ``doc_id`` share a successor, and as a successor the row with the
least text hash stands for all. Very long texts are counted whole, in blocks. Extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import stored

SHINGLE = 3
DIGEST = 16  # lanes of 32 bits
FIELD = 9
SHARED = 7  # fields of a 63-bit number
BLOCK = (1 << FIELD) - 1
SKETCH = FIELD * SHARED  # lanes of 32 bits

_WORD_GAP = r"[\x20\x09-\x0D]+"
_LANE = (1 << 32) - 1


def _words(paragraph: Column) -> Column:
    return F.filter(F.split(paragraph, _WORD_GAP), lambda w: w != "")


def _shingle_hashes(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words (of all the words, if fewer)."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(
        *[F.element_at(words, i + k) for k in range(size)]))
    return (F.when(F.size(words) >= size, runs)
            .when(F.size(words) > 0, F.array(F.xxhash64(words)))
            .otherwise(F.array().cast("array<long>")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _sums(values: Column, lanes: list[Callable[[Column], Column]]) -> Column:
    """For each lane, the sum over an array of the lane of its elements."""
    names = [f"s{i}" for i in range(len(lanes))]
    zero = F.struct(*[F.lit(0).cast("long").alias(n) for n in names])
    total = F.aggregate(values, zero, lambda acc, v: F.struct(*[
        (acc[n] + lane(v)).alias(n) for n, lane in zip(names, lanes, strict=True)]))
    return _let(total, lambda t: F.array(*[t[n] for n in names]))


def _digest_lane(seed: int, high: bool) -> Callable[[Column], Column]:
    def lane(paragraph: Column) -> Column:
        h = F.xxhash64(F.lit(seed), paragraph)
        return F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(F.lit(_LANE))
    return lane


def _spread(bit: int) -> Callable[[Column], Column]:
    """Every FIELD-th bit of a hash, each in a field of its own."""
    mask = sum(1 << (FIELD * k) for k in range(SHARED))
    return lambda h: F.shiftrightunsigned(h, bit).bitwiseAND(F.lit(mask))


def _counts(hashes: Column) -> Column:
    """How many of the hashes have each of the lowest SKETCH bits."""
    def fields(sums: Column) -> Column:
        return F.flatten(F.transform(sums, lambda x: F.array(*[
            F.shiftrightunsigned(x, FIELD * k).bitwiseAND(F.lit(BLOCK)) for k in range(SHARED)])))

    def block(i: Column) -> Column:
        return fields(_sums(F.slice(hashes, i * BLOCK + 1, BLOCK), [_spread(b) for b in range(FIELD)]))

    blocks = F.sequence(F.lit(0), F.floor(F.size(hashes) / BLOCK).cast("int"))
    zero = F.array_repeat(F.lit(0).cast("long"), SKETCH)
    return F.aggregate(blocks, zero, lambda acc, i: F.zip_with(acc, block(i), lambda x, y: x + y))


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Struct of the digest lanes, the sketch lanes, and the number of shingles of a text."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n")
    # fewer than 2^31 paragraphs and shingles fit into a text: sums below 2^63
    digest = F.transform(_sums(paragraphs, [_digest_lane(i // 2, i % 2 == 1) for i in range(DIGEST)]),
                         lambda x: x.bitwiseAND(F.lit(_LANE)))

    def of_hashes(hashes: Column) -> Column:
        return F.struct(digest.alias("digest"), _counts(hashes).alias("sketch"),
                        F.size(hashes).cast("long").alias("shingles"))

    return _let(F.flatten(F.transform(paragraphs, lambda p: _let(
        _words(p), lambda w: _shingle_hashes(w, shingle)))), of_hashes)


def _lane_wise(a: Column, b: Column, sign: int) -> Column:
    def add(x: Column, y: Column) -> Column:
        return (x + sign * y).bitwiseAND(F.lit(_LANE))

    return F.struct(F.zip_with(a["digest"], b["digest"], add).alias("digest"),
                    F.zip_with(a["sketch"], b["sketch"], add).alias("sketch"),
                    (a["shingles"] + sign * b["shingles"]).alias("shingles"))


def combine(a: Column, b: Column) -> Column:
    """Fingerprint of all paragraphs of both."""
    return _lane_wise(a, b, 1)


def without(a: Column, b: Column) -> Column:
    """Fingerprint of a document of which the paragraphs of ``b`` are taken out."""
    return _lane_wise(a, b, -1)


def as_text(print_: Column) -> Column:
    """All lanes, 8 hexadecimal digits each."""
    def digits(lanes: Column) -> Column:
        return F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), "")

    return F.lower(F.concat_ws("-", digits(print_["digest"]), digits(print_["sketch"])))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1; 1 for equal fingerprints."""
    def centred(p: Column) -> Column:
        return F.transform(p["sketch"], lambda x: 2.0 * x - p["shingles"])

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    def cosine(x: Column, y: Column) -> Column:
        return _let(F.sqrt(dot(x, x) * dot(y, y)), lambda norm: F.when(
            norm > 0, F.least(F.greatest(dot(x, y) / norm, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0)))

    return F.when(a["digest"] == b["digest"], F.lit(1.0)).otherwise(
        _let(centred(a), lambda x: _let(centred(b), lambda y: cosine(x, y))))


def successors(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) of distinct ids: the next larger one, after the
    largest the least."""
    ranges = stored(ids.select("doc_id").distinct().repartitionByRange("doc_id")
                    .withColumn("part", F.spark_partition_id()), "id-ranges")
    inside = Window.partitionBy("part").orderBy("doc_id")
    over = Window.orderBy("part")
    heads = ranges.groupBy("part").agg(F.min("doc_id").alias("head"))  # a row per range
    heads = heads.select("part", F.coalesce(
        F.lead("head").over(over), F.first("head").over(over)).alias("next_head"))
    return (ranges.withColumn("next_id", F.lead("doc_id").over(inside)).join(F.broadcast(heads), "part")
            .select("doc_id", F.coalesce("next_id", "next_head").alias("next_id")))


def edited_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per document: n_chars, its text's fingerprint, and the text (with its
    fingerprint) whose last quarter is replaced by the opening of the next
    document; likeness of the fingerprint to the edited text's and to the next
    document's."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_id", F.xxhash64("text"))
    sizes = stored(rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("text_id").alias("text_id"), F.max(F.floor(F.length("text") / 4)).alias("quarter")), "sizes")
    wanted = (successors(sizes).join(sizes.select("doc_id", "quarter"), "doc_id")
              .select(F.col("doc_id").alias("before"), F.col("next_id").alias("doc_id"), "quarter")
              .join(sizes.select("doc_id", "text_id"), "doc_id"))
    openings = stored(
        rows.join(wanted, ["doc_id", "text_id"])
        .select(F.col("before").alias("doc_id"), F.expr("left(text, quarter)").alias("opening"),
                fingerprint(F.col("text"), shingle).alias("next_print"))
        .dropDuplicates(["doc_id"]), "openings")
    keep = F.length("text") - F.floor(F.length("text") / 4)
    return (rows.join(openings, "doc_id", "left")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited_text", F.concat(
                F.substring("text", F.lit(1), keep.cast("int")),
                F.substring(F.coalesce("opening", F.lit("")), F.lit(1),
                            F.floor(F.length("text") / 4).cast("int"))))
            .withColumn("print", fingerprint(F.col("text"), shingle))
            .withColumn("edited_print", fingerprint(F.col("edited_text"), shingle))
            .select("doc_id", "n_chars", "print", "edited_text", "edited_print",
                    likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                    F.when(F.col("next_print").isNotNull(), likeness(
                        F.col("print"), F.col("next_print"))).alias("near_next")))
