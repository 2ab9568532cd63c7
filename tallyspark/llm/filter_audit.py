"""How filters of a pipeline interact: what each removes, in every order.

Filters run one after another, so what a filter removes depends on those
before it. The states are the subsets of filters that have run; an edge runs
one more filter. An order of all filters is a path from the empty to the full
set.

*Counts.* A row fails a set of filters, its mask. All that the audit needs is
the number of rows per part and mask, at most 2^k rows a part for k filters.
One filter may be a copy filter: a row fails it if its text is identical to
that of a row with a smaller doc_id anywhere in the table. Texts are compared
by their SHA-256; copies are counted within (digest, part, mask) before
they meet, so a text that a third of all rows share sends a row per task.

*Forward-backward path counting.* Forward, the orders reaching each state are
counted; backward, those leaving it. Reaching times leaving is the number of
orders that run through an edge. The rows an edge removes, weighted by it and
summed over a filter's edges, are that filter's removals over all orders: its
Shapley value times the number of orders. Each step of an order is an edge,
so its figures are read from the edge table and not counted again. Pairs in
``before`` forbid orders; both counts then leave them out.

Bounds: at most MAX_FILTERS filters, as their orders are listed. Per part,
2^k counts are together in a task.

Nulls: a null text is empty; a null part is the empty string. A null doc_id is
neither smaller nor larger than any, so its row fails no copy filter, makes no
other row fail it, and has no labels. Rows that share text and doc_id are no
copies of each other; each counts. A document with several label rows is good
(toxic) if any says so. A filter whose condition is null does not fail. Very
long texts are hashed and tested in their row. Extra columns are ignored. An
empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.common import map_pandas, stored

MAX_FILTERS = 8
EDGE_SCHEMA = ("part string, state int, filter string, orders_reaching long, orders_leaving long, kept long, "
               "removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


class Lattice:
    """States 0 .. 2^k - 1 (bit i: filter i has run) and, per state, the
    number of legal orders reaching it from none and leaving it for all."""

    def __init__(self, names: list[str], before: tuple = ()):
        if not 0 < len(names) <= MAX_FILTERS or len(set(names)) < len(names):
            raise ValueError(f"1 to {MAX_FILTERS} filters with different names are needed, not {names}")
        self.names = names
        self.full = (1 << len(names)) - 1
        self.needs = [sum(1 << names.index(first) for first, then in before if then == name) for name in names]
        self.reaching = [0] * (self.full + 1)
        self.leaving = [0] * (self.full + 1)
        self.reaching[0] = self.leaving[self.full] = 1
        for state in range(self.full + 1):
            for i in self.next(state):
                self.reaching[state | 1 << i] += self.reaching[state]
        for state in range(self.full, -1, -1):
            for i in self.next(state):
                self.leaving[state] += self.leaving[state | 1 << i]
        if not self.leaving[0]:
            raise ValueError(f"no order satisfies {before}")

    def next(self, state: int) -> list[int]:
        """Filters that may run next."""
        return [i for i, needs in enumerate(self.needs) if not state >> i & 1 and needs & ~state == 0]

    def edges(self) -> list[tuple[int, int]]:
        """(state, filter) of the edges that some legal order takes."""
        return [(state, i) for state in range(self.full + 1) if self.reaching[state]
                for i in self.next(state) if self.leaving[state | 1 << i]]

    def orders(self) -> list[tuple[str, int, int, str]]:
        """(order, step from 1, state before it, filter) of every legal order."""
        found = []
        for order in permutations(range(len(self.names))):
            state, steps = 0, []
            for step, i in enumerate(order, 1):
                if i not in self.next(state):
                    break
                steps.append(("".join(self.names[x] for x in order), step, state, self.names[i]))
                state |= 1 << i
            else:
                found += steps
        return found

    def figures(self, counts: np.ndarray) -> list[tuple]:
        """Per edge, in the columns of EDGE_SCHEMA after the part. counts:
        rows, good rows and toxic rows by mask."""
        passing = counts.copy()  # by state: rows that fail none of its filters
        for i in range(len(self.names)):
            halves = passing.reshape(3, -1, 2, 1 << i)
            halves[:, :, 1] += halves[:, :, 0]
        passing = passing[:, ::-1]
        failing = [int(counts[0, [m for m in range(self.full + 1) if m >> i & 1]].sum())
                   for i in range(len(self.names))]
        shapley = [0] * len(self.names)
        removed = {}
        for state, i in self.edges():
            removed[state, i] = [int(x) for x in passing[:, state] - passing[:, state | 1 << i]]
            shapley[i] += removed[state, i][0] * self.reaching[state] * self.leaving[state | 1 << i]
        return [(state, self.names[i], self.reaching[state], self.leaving[state | 1 << i],
                 int(passing[0, state | 1 << i]), lost, failing[i] - lost, int(counts[0, 1 << i]), good, toxic,
                 shapley[i]) for (state, i), (lost, good, toxic) in removed.items()]


def fail_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str | None = None,
                part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): rows per part and set of failed filters.

    ``filters`` maps a name to the condition under which a row fails, over the
    columns of ``docs`` (``text`` is never null there); bit i of the mask is
    the i-th name, and ``copies`` names the copy filter, the last bit."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fails = [F.when(condition, F.lit(1 << i)).otherwise(0) for i, condition in enumerate(filters.values())]
    rows = (docs.withColumn("text", text)
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                    F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                    sum(fails, F.lit(0)).alias("mask")))
    # stored, so that the join with them is of two plain shuffles: a hot doc_id can be split
    marks = stored(labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                   .agg(F.max(F.expr("int(quality <=> 1)")).alias("good"),
                        F.max(F.expr("int(toxic <=> 1)")).alias("toxic")).where("good + toxic > 0"), "labels")
    rows = (rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
            .join(marks, "doc_id", "left").fillna(0, ["good", "toxic"]))
    keys = ["digest", "part", "mask", "good", "toxic"]
    known = F.col("doc_id").isNotNull()
    texts = (rows.groupBy(*keys)
             .agg(F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_known"),
                  F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
             .withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest"))))
    first = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    copied = (F.col("n_known") - first) if copies else F.lit(0).cast("long")
    bit = F.lit(1 << len(filters))
    return (texts.select("part", "good", "toxic", "mask", "n", copied.alias("copied"))
            .select("part", "good", "toxic", F.explode(F.array(
                F.struct(F.col("mask"), (F.col("n") - F.col("copied")).alias("n")),
                F.struct(F.col("mask").bitwiseOR(bit).alias("mask"), F.col("copied").alias("n")))).alias("x"))
            .select("part", "good", "toxic", "x.*").where("n > 0")
            .groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("good") * F.col("n")).alias("good"),
                 F.sum(F.col("toxic") * F.col("n")).alias("toxic")))


def edge_figures(counts: DataFrame, lattice: Lattice) -> DataFrame:
    """EDGE_SCHEMA: every edge's figures in every part."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in EDGE_SCHEMA.split(", ")]
        for pdf in batches:
            for part, rows in zip(pdf["part"], pdf["rows"], strict=True):
                by_mask = np.zeros((3, lattice.full + 1), np.int64)
                for row in rows:
                    by_mask[:, row["mask"]] = row["n"], row["good"], row["toxic"]
                yield pd.DataFrame([(part, *x) for x in lattice.figures(by_mask)], columns=names)

    return (counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("rows"))
            .transform(map_pandas, run, EDGE_SCHEMA))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str | None = None,
          part: str = "lang", before: tuple = ()) -> DataFrame:
    """One row per part, legal order and step, with the figures of its edge."""
    lattice = Lattice([*filters, *([copies] if copies else [])], before)
    orders = docs.sparkSession.createDataFrame(
        lattice.orders(), "filter_order string, step int, state int, filter string")
    edges = edge_figures(fail_counts(docs, labels, filters, copies, part), lattice)
    return (edges.join(orders, ["state", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley", "orders_reaching", "orders_leaving"))


def text_filters() -> dict[str, Column]:
    """Conditions of the production audit: few words, repeated words, capitals, symbols."""
    text = F.col("text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


#: The audit of text_filters() and the copy filter E, for DuckDB.
AUDIT_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
           max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), fails AS (
    SELECT doc_id, part,
           CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
    FROM words
), counts AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, step, CAST(1 << (ascii(filter_order[step]) - 65) AS INTEGER) AS own,
           CAST(coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)
                AS INTEGER) AS done
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), figures AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN mask & (done | own) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & done = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & done <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & done = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & done = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM counts, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM figures
"""
