"""Secrets in texts: three fixed patterns, and tokens that look random.

*Patterns.* ``assign`` (a named credential), ``access`` (an access key id) and
``hex`` (a long hexadecimal run) are found leftmost and without overlap, kind
by kind; matches that are too short are dropped. (For the latter two, a least
length in the pattern says the same: a match takes all of a run, and no later
start in the run is longer. An ``assign`` match that is too short still uses
up its characters.)

*Randomness tests.* A candidate is a run of at least MIN_TOKEN characters that
an encoding could have made. The encoding is inferred from the kinds of
characters in the run (a word of letters alone has none and is no candidate),
and the run's symbols are tested for what its encoder would give: a
chi-squared test of a uniform alphabet, a runs test of the upper against the
lower half of the alphabet, and a test of the serial correlation of
neighbours. Fisher's method combines the three.

*False-discovery control.* A candidate is dismissed as structured only if the
Benjamini-Hochberg procedure at level ``level`` rejects its randomness, among
all candidates of the corpus of about its own length: short runs have little
power and are not compared with long ones. P-values are rounded up to a fixed
logarithmic grid, so the procedure needs one count per length class and grid
cell, an aggregate of bounded size. Candidates that stand are ``random`` spans;
those inside a pattern's span add nothing and are left out.

Everything is built-in column functions on one row: no shuffle but for that
count, and no key that could be hot. Offsets are code points, ends exclusive.

Nulls: a null text has no spans (and stays null when redacted). Very long texts
are scanned whole; their offsets are summed in blocks. Null or
repeated ids, repeated rows and extra columns pass through. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = 0.05
MIN_TOKEN = 20
CELLS = 1000  # of the p-value grid: 20 to each factor of e
CLASSES = 12  # of token lengths: 2 to each factor of 2

# The patterns and least lengths of the three kinds.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"  # looking back only saves time: a match starts its run

TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}"

# Words of credentials, at most a few signs and words before a run.
CONTEXT = (r"(?i)(?:key|token|secret|passw|pwd|auth|bearer|credential|signature|cookie|session)[a-z]*"
           r"""[^A-Za-z0-9\n]{0,8}(?:(?:is|was|value|header|id)[^A-Za-z0-9\n]{1,8}){0,2}\z""")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: (what a run of the encoding looks like, its alphabet), the narrowest first
ENCODINGS = (
    (r"^(?=.*[a-f])(?=.*[0-9])[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^(?=.*[A-F])(?=.*[0-9])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^(?=.*[A-Z])(?=.*[2-7])[A-Z2-7]+$", _UPPER + "234567"),
    (r"^(?=.*[A-Z])(?=.*[0-9])[0-9A-Z]+$", _DIGITS + _UPPER),
    (r"^(?=.*[a-z])(?=.*[0-9])[0-9a-z]+$", _DIGITS + _LOWER),
    (r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    (r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
)


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of the standard normal (a published polynomial, error below 1e-7)."""
    def tail(z: Column, t: Column) -> Column:
        poly = t * (0.319381530 + t * (-0.356563782 + t * (
            1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.greatest(2 * F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly, F.lit(1e-200))

    return _let(F.least(F.abs(z), F.lit(30.0)), lambda z: _let(
        1 / (1 + 0.2316419 * z), lambda t: tail(z, t)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _battery(values: Column, alphabet: Column) -> Column:
    """Combined p-value of the three tests that symbols 0..alphabet-1 are
    independent and uniform."""
    n = F.size(values).cast("double")
    df = alphabet - 1.0
    squares = F.aggregate(F.array_distinct(values), F.lit(0.0), lambda acc, v: acc + F.pow(
        (F.size(values) - F.size(F.array_remove(values, v))).cast("double"), F.lit(2.0)))
    chi = alphabet / n * squares - n
    spread = 2 / (9 * df)
    uniform = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    neighbours = F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1),
                            lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def total(of: Callable[[Column], Column]) -> Column:
        return F.aggregate(neighbours, F.lit(0.0), lambda acc, p: acc + of(p).cast("double"))

    half = alphabet / 2
    changes = total(lambda p: ((p["a"] >= half) != (p["b"] >= half)).cast("int"))
    runs = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    middle, variance = df / 2, (alphabet * alphabet - 1) / 12
    serial = total(lambda p: (p["a"] - middle) * (p["b"] - middle)) / (variance * F.sqrt(n - 1))
    x = -2 * sum((F.log(_normal_tail(z)) for z in (uniform, runs, serial)), F.lit(0.0))
    # Fisher: chi-squared with six degrees of freedom
    return _let(x, lambda v: F.exp(-v / 2) * (1 + v / 2 + v * v / 8))


def _p_value(token: Column) -> Column:
    """Null where no encoding fits."""
    alphabet = F.lit(None).cast("string")
    for shape, letters in reversed(ENCODINGS):
        alphabet = F.when(token.rlike(shape), letters).otherwise(alphabet)

    def tested(letters: Column) -> Column:
        values = F.transform(F.regexp_extract_all(token, F.lit("(?s)(.)"), 1),
                             lambda c: F.instr(letters, c) - 1)
        return F.when(letters.isNotNull(), _let(values, lambda v: _battery(
            v, F.length(letters).cast("double"))))

    return _let(alphabet, tested)


def _cell(p: Column) -> Column:
    """Grid cell of a p-value: exp(-cell / 20), rounded up."""
    return F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * 20), F.lit(CELLS)).cast("int")


def _length_class(token: Column) -> Column:
    return F.least(F.floor(F.log2(F.length(token) / MIN_TOKEN) * 2), F.lit(CLASSES)).cast("int")


def dismissal_cells(docs: DataFrame, level: float = LEVEL) -> dict[int, int]:
    """By length class, the least grid cell whose candidates Benjamini-Hochberg
    rejects as not random; classes without rejections are missing."""
    tokens = (docs.where(F.col("text").rlike(TOKEN))
              .select(F.explode(F.regexp_extract_all("text", F.lit(f"({TOKEN})"), 1)).alias("token"))
              .select(_length_class(F.col("token")).alias("class"), _cell(_p_value(F.col("token"))).alias("cell"))
              .where("cell IS NOT NULL").groupBy("class", "cell").count().collect())
    counts: dict[int, dict[int, int]] = {}
    for r in tokens:  # at most (CLASSES + 1) x (CELLS + 1) rows
        counts.setdefault(r["class"], {})[r["cell"]] = r["count"]
    out = {}
    for length, cells in counts.items():
        total, so_far = sum(cells.values()), 0
        for cell in sorted(cells, reverse=True):
            so_far += cells[cell]
            if math.exp(-cell / 20) <= level * so_far / total:
                out[length] = cell
    return out


def _looks_random(token: Column, cells: dict[int, int]) -> Column:
    limit = F.lit(CELLS + 1)
    for length, cell in sorted(cells.items()):
        limit = F.when(_length_class(token) == length, cell).otherwise(limit)
    return F.coalesce(_cell(_p_value(token)) < limit, F.lit(False))


def _kinds(cells: dict[int, int]) -> list[tuple[str, str, int, str, Callable[[Column], Column]]]:
    """(kind, pattern, group of the pattern that is judged, a quick test that a
    text may have one, the judgement)."""
    def any_match(found: Column) -> Column:
        return F.lit(True)

    return [
        ("assign", ASSIGN, 1, f"{ASSIGN[:-2]}{{{ASSIGN_LEAST},}})",
         lambda found: F.length(found) >= ASSIGN_LEAST),
        ("access", ACCESS, 0, ACCESS, any_match),
        ("hex", HEX, 0, HEX, any_match),
        ("random", TOKEN, 0, TOKEN, lambda found: _looks_random(found, cells)),
    ]


def _pieces(text: Column, pattern: str, group: int, maybe: str) -> Column:
    """The text as pieces that end with a match each (the last may have none):
    structs of the piece, its match and the judged group. Empty if the quick
    test fails."""
    # a lazy gap, then the match or the end of the text: linear, and leftmost
    cut = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    groups = [F.regexp_extract_all(text, cut, i) for i in (0, 2, 2 + group)]
    found = F.arrays_zip(groups[0].alias("piece"), groups[1].alias("match"), groups[2].alias("judged"))
    return F.when(text.rlike(maybe), found).otherwise(F.array().cast(
        "array<struct<piece:string,match:string,judged:string>>"))


def _running(values: Column, block: int = 512) -> Column:
    """Running sums of an array of ints, block by block so that long arrays
    stay near linear."""
    def sums(array: Column) -> Column:
        return F.aggregate(array, F.array().cast("array<int>"), lambda acc, x: F.concat(
            acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)))

    def joined(blocks: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), sums(F.transform(blocks, lambda b: F.element_at(b, -1))))
        return F.flatten(F.zip_with(blocks, F.slice(ends, 1, F.size(blocks)),
                                    lambda b, before: F.transform(b, lambda x: x + before)))

    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / block).cast("int") - 1),
                         lambda i: sums(F.slice(values, i * block + 1, block)))
    return F.when(F.size(values) > 0, _let(blocks, joined)).otherwise(F.array().cast("array<int>"))


_SPAN = "array<struct<start:int,rank:int,stop:int>>"


def _spans(pieces: Column, rank: int, judged: Callable[[Column], Column]) -> Column:
    """Array of (start, rank of the kind, stop) of the matches that stand."""
    stops = _running(F.transform(pieces, lambda p: F.length(p["piece"])))
    spans = F.filter(F.zip_with(pieces, stops, lambda p, stop: F.when(
        (p["match"] != "") & judged(p["judged"]),
        F.struct((stop - F.length(p["match"])).alias("start"), F.lit(rank).alias("rank"),
                 stop.alias("stop")))), lambda s: s.isNotNull())
    return F.when(F.size(pieces) > 0, spans).otherwise(F.array()).cast(_SPAN)


def _with_spans(docs: DataFrame, cells: dict[int, int]) -> DataFrame:
    """Adds an array of spans for each kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs
    for rank, (kind, pattern, group, maybe, judged) in enumerate(_kinds(cells)):
        df = (df.withColumn(f"_{kind}", _pieces(text, pattern, group, maybe))
              .withColumn(f"_{kind}", _spans(F.col(f"_{kind}"), rank, judged)))
    return df


def _text_of(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in _kinds({})])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """One row per document: doc_id, the number of spans of each kind, and the
    spans of the patterns (``base_spans``) and of all kinds (``spans``)."""
    rows = _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                       dismissal_cells(docs, level))
    rows = rows.withColumn("_base", F.concat("_assign", "_access", "_hex"))
    added = F.filter("_random", lambda r: ~F.exists("_base", lambda b: (b["start"] <= r["start"])
                                                    & (b["stop"] >= r["stop"])))
    return (rows.withColumn("_random", added)
            .select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}")
                                for k in ("assign", "access", "hex", "random")],
                    _text_of(F.col("_base")).alias("base_spans"),
                    _text_of(F.concat("_base", "_random")).alias("spans")))


def _cleaned(pieces: Column, kind: str, judged: Callable[[Column], Column]) -> Column:
    def before(p: Column) -> Column:
        return F.substring(p["piece"], F.lit(1), F.length(p["piece"]) - F.length(p["match"]))

    def secret(p: Column) -> Column:
        return judged(p["judged"]) & (before(p).rlike(CONTEXT) if kind == "random" else F.lit(True))

    return F.array_join(F.transform(pieces, lambda p: F.when(
        (p["match"] != "") & secret(p), F.concat(before(p), F.lit(f"[{kind}]"))).otherwise(p["piece"])), "")


def redact(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """The documents with every secret in the text replaced by its kind in
    brackets, kind by kind; all other columns as they are. ``random`` runs go
    only where a word just before them speaks of a credential (CONTEXT):
    looking random is no proof, and long identifiers can."""
    def without(kind: str, pattern: str, group: int, maybe: str, judged) -> Column:
        text = F.col("text")
        return _let(_pieces(text, pattern, group, maybe), lambda pieces: F.when(
            F.size(pieces) > 0, _cleaned(pieces, kind, judged)).otherwise(text))

    df = docs
    for kind in _kinds(dismissal_cells(docs, level)):
        df = df.withColumn("text", without(*kind))
    return df
