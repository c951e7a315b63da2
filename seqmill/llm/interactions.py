"""Operator 12: what filters of documents take away together, alone and in each other's place.

Each document fails some of a few filters. Per part of the corpus the documents
are counted by the filters that they fail, and these counts give, for every set
S of filters, the number J(S) of documents that fail all of S, as a sum of
products of the flags. All else follows from the J of a part, by inclusion and
exclusion, without looking at documents again:

* survivors of the filters in P: the Möbius inverse, the sum over S in P of
  (-1)^|S| J(S);
* what a filter removes at its place in an order: survivors of the filters
  before it less those with it, and its redundancy: what it fails less that;
* unique failures: what is lost from the survivors of the others;
* Shapley values: a set T of filters has the Harsanyi dividend (-1)^(|T|+1) J(T),
  of which each filter of T gets the same share. Times the number of orders
  they are whole numbers, the sums of what a filter removes over all orders.

The same holds for weights in place of counts, so good and toxic documents lost
come from the same flags.

One of the filters is that a text repeats that of a smaller id. Texts are known
by their SHA-256; rows are added up by id, then by digest and part, where the
least id is kept, so that a text with a third of all rows moves as one row a
task, and at most as many rows of a text as there are parts meet.

Defined results: a null text is empty, a null part the empty string. A row
without an id repeats nothing and is repeated by none; several rows of one id
don't repeat each other. A row counts as good or toxic if any label of its id
says so, and as neither without a label. No documents, no rows.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: White space between words; other characters make words.
SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 200, 50, 3, "[#$%&*|]"
#: Filters whose orders are listed at most: 40,320 orders.
MOST_FILTERS = 8


def text_failures(text: Column) -> dict[str, Column]:
    """The four filters that look at a text alone, as conditions of failing: few words, few different words, many capitals, marks."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(MARKS),
    }


def patterns(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, A to E (0 or 1), n, good, toxic``: documents by part and by what they fail."""
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"))
    own = [x.cast("int").alias(k) for k, x in text_failures(F.col("text")).items()]
    flags = ["A", "B", "C", "D"]
    rows = docs.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *own)
    # rows without an id have no labels, but must not all meet
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    rows = rows.join(said.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left")
    sums = lambda: [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    one = rows.withColumns({"n": F.lit(1).cast("long"), "good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))}).groupBy("doc_id", "salt", "digest", "part", *flags).agg(*sums())
    known = F.col("doc_id").isNotNull()
    first = F.min(F.when(known, F.struct("doc_id", "n", "good", "toxic"))).alias("first")
    held = one.groupBy("digest", "part", *flags).agg(*sums(), *[F.sum(F.when(known, F.col(c)).otherwise(0)).alias(f"known_{c}") for c in ("n", "good", "toxic")], first)
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    held = held.withColumn("is_first", F.coalesce(F.col("first.doc_id") == least, F.lit(False)))
    again = {c: F.col(f"known_{c}") - F.when(F.col("is_first"), F.col(f"first.{c}")).otherwise(0) for c in ("n", "good", "toxic")}
    both = F.array(F.struct(F.lit(1).alias("E"), *[x.alias(c) for c, x in again.items()]), F.struct(F.lit(0).alias("E"), *[(F.col(c) - x).alias(c) for c, x in again.items()]))
    return held.select("part", *flags, F.explode(both).alias("x")).select("part", *flags, "x.*").filter("n > 0").groupBy("part", *flags, "E").agg(*sums())


def joint(rows: DataFrame, filters: list[str], weights: list[str], part: str = "part") -> DataFrame:
    """Per part an array for each weight: at the number whose bits are a set of filters, the weight of what fails all of the set.

    Every entry is the sum of the product of its set's flags.
    """
    rows = rows.groupBy(part, *filters).agg(*[F.sum(w).alias(w) for w in weights])

    def product(weight: str, members: int) -> Column:
        out = F.col(weight)
        for i, f in enumerate(filters):
            if members >> i & 1:
                out = out * F.col(f)
        return F.sum(out).cast("long")

    return rows.groupBy(part).agg(*[F.array(*[product(w, s) for s in range(1 << len(filters))]).alias(w) for w in weights])


def survivors(weights: str, filters: int) -> Column:
    """From the joint weights of all sets, in the array column ``weights``, what fails none of a set, for every set: Möbius inversion."""
    whole = 1 << filters
    inside = lambda p: [s for s in range(whole) if s & p == s]
    return F.expr("array(" + ", ".join(" ".join(f"{'-' if s.bit_count() % 2 else '+'} {weights}[{s}]" for s in inside(p)) for p in range(whole)) + ")")


def shares(counts: str, filters: int) -> Column:
    """Shapley values times the number of orders, one a filter: of each set's dividend its filters get equal shares."""
    sets = lambda i: [s for s in range(1 << filters) if s >> i & 1]
    term = lambda s: f"{'+' if s.bit_count() % 2 else '-'} {factorial(filters) // s.bit_count()} * {counts}[{s}]"
    return F.expr("array(" + ", ".join(" ".join(map(term, sets(i))) for i in range(filters)) + ")")


def audit(rows: DataFrame, filters: list[str], part: str = "part", count: str = "n", lost: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """A row for each part, order of the filters and step.

    ``rows`` have for each filter a column that is 1 where it fails, else 0, a ``count`` of documents and weights ``lost``.
    Filters are named by one letter each.
    """
    k = len(filters)
    if not 0 < k <= MOST_FILTERS or any(len(f) != 1 for f in filters):
        raise ValueError(f"from one to {MOST_FILTERS} filters of one letter")
    found = joint(rows, filters, [count, *lost], part)
    found = found.select(part, *[F.col(w).alias(f"j_{w}") for w in (count, *lost)], *[survivors(f"`{w}`", k).alias(f"s_{w}") for w in (count, *lost)], shares(f"`{count}`", k).alias("shares"))
    bit = {f: 1 << i for i, f in enumerate(filters)}
    steps = [{"filter_order": "".join(o), "step": s + 1, "at": filters.index(o[s]), "before": sum(bit[f] for f in o[:s])} for o in permutations(filters) for s in range(k)]
    every = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, at: int, before: int>>")
    out = found.select("*", F.inline(every))
    own = F.expr("shiftleft(1, at)")
    at = lambda a, m: F.element_at(F.col(a), (m + 1).cast("int"))
    gone = lambda w: at(f"s_{w}", F.col("before")) - at(f"s_{w}", F.col("before") + own)
    whole = F.lit((1 << k) - 1)
    return out.select(
        part, "filter_order", "step",
        at(f"s_{count}", F.col("before") + own).alias("kept"),
        gone(count).alias("removed"),
        (at(f"j_{count}", own) - gone(count)).alias("redundant"),
        (at(f"s_{count}", whole - own) - at(f"s_{count}", whole)).alias("unique_fails"),
        *[gone(w).alias(f"{w}_lost") for w in lost],
        at("shares", F.col("at")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(patterns(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), list("ABCDE"))


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
f AS (SELECT part,
  CAST(len(ws) < 200 AS INT) AS a, CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INT) AS b,
  CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT) AS c, CAST(regexp_matches(text, '[#$%&*|]') AS INT) AS d,
  CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS e, coalesce(q, 0) AS good, coalesce(x, 0) AS toxic
  FROM w LEFT JOIN (SELECT doc_id, CAST(bool_or(coalesce(quality = 1, false)) AS INT) AS q, CAST(bool_or(coalesce(toxic = 1, false)) AS INT) AS x FROM labels GROUP BY 1) l USING (doc_id)),
m AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
i AS (SELECT unnest(range(5)) AS i),
o AS (SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM i p, i q, i r, i s, i t WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
st AS (SELECT array_to_string([substr('ABCDE', CAST(x AS INT) + 1, 1) FOR x IN o], '') AS filter_order, step, 1 << CAST(o[step] AS INT) AS own,
  coalesce(list_sum([1 << CAST(x AS INT) FOR x IN o[1:step - 1]]), 0)::INT AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
z AS (SELECT part, filter_order, step, own,
  sum(n) FILTER (m & (before | own) = 0) AS kept, sum(n) FILTER (m & before = 0 AND m & own > 0) AS removed, sum(n) FILTER (m & before > 0 AND m & own > 0) AS redundant,
  sum(n) FILTER (m = own) AS unique_fails, sum(good) FILTER (m & before = 0 AND m & own > 0) AS good_lost, sum(toxic) FILTER (m & before = 0 AND m & own > 0) AS toxic_lost
  FROM m, st GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM z
"""
