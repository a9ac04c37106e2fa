"""How filters interact: what each removes in every order, by counting paths in the subset lattice.

A document matters only through the set of filters that it fails. The rows are therefore added up
per part and failure set; with ``k`` filters a part is one row of ``2 ** k`` counts, however
many documents it has. The lattice of all subsets of filters then gives every answer:

* its states are sets of filters already applied, its edges apply one filter more; an edge
  removes the documents that fail the new filter and none of the applied ones;
* a forward pass counts the orders that reach each state, a backward pass those that leave it;
  their product is the number of orders that use an edge. Edge removals weighted by it are the sum
  over all orders, ``k!`` times the Shapley value;
* a step of one order is one edge, read from the same array.

No order is simulated and documents are scanned once. Equal texts are found by a digest, and
counted per digest before they meet, so that a text that a third of all rows share is added up in
many tasks.

Cases: a null text is an empty one, which fails only what its conditions say; a null part is the
part ``""``; a null id is larger than every other, and not smaller than another null; rows of
the same id are not earlier than each other; of repeated labels of an id the larger counts; rows
without label count as neither good nor toxic; an empty table has no parts and gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import col_of
from tabwright.sources.tables import stage

SPACES = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions on a text alone, under which it fails a filter: short, repetitive, shouting, marked up."""
    words = F.array_remove(F.split(text, SPACES), "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": 100 * different < 50 * n,
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def paths(filters: int) -> tuple[list[int], list[int]]:
    """Per state (a set of filters as bits): orders that reach it, and orders that leave it."""
    states, full = range(1 << filters), (1 << filters) - 1
    forward, backward = [0] * len(states), [0] * len(states)
    forward[0] = backward[full] = 1
    for s in states:
        for f in range(filters):
            if s >> f & 1:
                forward[s] += forward[s ^ 1 << f]
    for s in reversed(states):
        for f in range(filters):
            if not s >> f & 1:
                backward[s] += backward[s | 1 << f]
    return forward, backward


def failure_sets(
    docs: DataFrame,
    failures: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Per document row ``id, part, digest`` of its text and ``fails``, a bit for each condition."""
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failures.values())), F.lit(0))
    return docs.select(
        col_of(id_col).alias("id"),
        F.coalesce(col_of(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(col_of(text_col), F.lit("")).alias("text"),
    ).select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.cast("int").alias("fails"))


def counts(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    label_id_col: str = "doc_id",
    good_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """Per part and failure set: documents, good ones and toxic ones.

    The bit after the last condition means that a smaller id has the same text.
    """
    rows = stage(failure_sets(docs, failures, id_col, text_col, part_col), "failure-sets")
    marks = labels.select(
        col_of(label_id_col).alias("id"),
        (col_of(good_col) == 1).cast("int").alias("good"),
        (col_of(toxic_col) == 1).cast("int").alias("toxic"),
    )
    marks = marks.where("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # rows without id have no label; a join would send them all to one task
    marked = rows.where("id is not null").join(marks, "id", "left")
    bare = rows.where("id is null").withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    marked = marked.unionByName(bare).fillna(0, ["good", "toxic"])

    # rows of one id first, so that the smallest id of a text is found with its rows
    kind = ["digest", "fails", "part", "good", "toxic"]
    same = marked.groupBy(*kind, "id").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "n"))
    same = same.groupBy(*kind).agg(F.sum("n").alias("n"), first.alias("first"))
    # a text has one row per part and label here, so what meets is few
    head = F.struct("first.last", "first.id")
    same = stage(same.withColumn("head", head), "text-groups")
    heads = same.groupBy("digest").agg(F.min("head").alias("least"))
    same = same.join(heads, "digest")
    early = F.when(F.col("head") == F.col("least"), F.col("first.n")).otherwise(0)
    # null ids are not smaller than each other: where all are null, none fails
    early = F.when(F.col("least.id").isNull(), F.col("n")).otherwise(early)
    later = 1 << len(failures)
    split = F.array(
        F.struct(F.col("fails").alias("fails"), early.cast("long").alias("n")),
        F.struct((F.col("fails") + later).alias("fails"), (F.col("n") - early).cast("long").alias("n")),
    )
    out = same.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return out.groupBy("part", "fails").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def lattice(found: DataFrame, filters: int) -> DataFrame:
    """One row per part: for each measure an array over edges ``state * filters + filter`` of the
    documents that the edge removes, and the documents that each state keeps."""
    measures, states = ("n", "good", "toxic"), 1 << filters
    per_set = [
        F.array(*(F.coalesce(F.sum(F.when(F.col("fails") == s, F.col(m))), F.lit(0)) for s in range(states))).alias(m)
        for m in measures
    ]
    sets = found.groupBy("part").agg(*per_set)
    bits = F.array(*(F.lit(1 << f) for f in range(filters)))
    index = F.sequence(F.lit(0), F.lit(states - 1))

    def total(measure: str, keep: Callable[[Column], Column]) -> Column:
        rows = F.arrays_zip(F.col(measure).alias("c"), index.alias("s"))
        chosen = F.filter(rows, lambda x: keep(x["s"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, x: a + x["c"])

    def removed(measure: str) -> Column:
        def edge(e: Column) -> Column:
            state, new = F.floor(e / filters).cast("int"), F.element_at(bits, F.pmod(e, F.lit(filters)) + 1)
            return total(measure, lambda s: (s.bitwiseAND(state) == 0) & (s.bitwiseAND(new) != 0))

        return F.transform(F.sequence(F.lit(0), F.lit(states * filters - 1)), edge)

    kept = F.transform(index, lambda state: total("n", lambda s: s.bitwiseAND(state) == 0))
    return sets.select(
        "part", *(removed(m).alias(f"{m}_removed") for m in measures), kept.alias("kept"), F.col("n").alias("sets")
    )


def audit(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part, order of all filters and step in it, from counts per failure set.

    ``names`` are the filters' letters, one character each, in the order of their bits.
    """
    k = len(names)
    forward, backward = paths(k)
    edges = stage(lattice(found, k), "lattice")

    def at(measure: str, state: Column, bit: Column) -> Column:
        return F.element_at(F.col(measure), (state * k + bit + 1).cast("int"))

    def weighted(f: int) -> Column:
        free = [s for s in range(1 << k) if not s >> f & 1]
        terms = (forward[s] * backward[s | 1 << f] * at("n_removed", F.lit(s), F.lit(f)) for s in free)
        return sum(terms, F.lit(0).cast("long"))

    # documents that fail a filter: the edge from the empty state; that fail only it: one failure set
    own = [
        F.struct(
            weighted(f).alias("shapley"),
            at("n_removed", F.lit(0), F.lit(f)).alias("failing"),
            F.element_at("sets", (1 << f) + 1).alias("unique_fails"),
        )
        for f in range(k)
    ]
    # the orders as strings: their number depends on the filters only (120 of five)
    orders = F.array(*(F.lit("".join(p)) for p in permutations(names)))
    rows = edges.withColumn("own", F.array(*own)).withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    bit = F.instr(F.lit("".join(names)), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    state = sum((F.when(F.instr("filter_order", n) < F.col("step"), 1 << f).otherwise(0) for f, n in enumerate(names)), F.lit(0))
    after = sum((F.when(F.instr("filter_order", n) <= F.col("step"), 1 << f).otherwise(0) for f, n in enumerate(names)), F.lit(0))
    rows = rows.withColumns({"bit": bit, "state": state, "after": after})
    mine = F.element_at("own", F.col("bit") + 1)
    removed = at("n_removed", F.col("state"), F.col("bit"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.element_at("kept", F.col("after") + 1).alias("kept"),
        removed.alias("removed"),
        (mine["failing"] - removed).alias("redundant"),
        mine["unique_fails"].alias("unique_fails"),
        at("good_removed", F.col("state"), F.col("bit")).alias("good_lost"),
        at("toxic_removed", F.col("state"), F.col("bit")).alias("toxic_lost"),
        mine["shapley"].alias("shapley"),
    )
