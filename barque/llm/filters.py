"""Filter interaction audit by recursive enumeration (operator 12).

Filters are judged once: every row gets a mask with a bit for each filter that it fails, and rows are counted by (part, mask).
A recursive query then starts from every mask that occurs and extends prefixes of filters with letters that are not yet in
them; it carries the bits applied so far, and each level says what its last filter does to a mask. Counts of the cells come
in by mask, so an order costs no pass over the rows.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barque.llm.sqlwords import WHITE, split_words
from barque.llm.storage import discard, stored

#: The condition "identical to the text of a smaller id".
IDENTICAL = "identical"
#: Conditions of failure over `text` and `words` (runs without white space), by letter.
FILTERS = {
    "A": "size(words) < 200",
    "B": "100 * size(array_distinct(words)) < 50 * size(words)",
    "C": "100 * length(regexp_replace(text, '[^A-Z]+', '')) > 2 * length(text)",
    "D": "text rlike '[#$%&*|]'",
    "E": IDENTICAL,
}
MOST = 6  # filters: 1,957 prefixes and 64 masks stay far below the limit of a recursive query's rows


def masked(docs: DataFrame, filters: dict[str, str], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """doc_id, part and mask of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", "text", split_words(F.col("text"), WHITE).alias("words"))
    bits = [F.when(F.expr(c), 1 << i).otherwise(0) for i, c in enumerate(filters.values()) if c != IDENTICAL]
    mask = sum(bits, F.lit(0)).alias("mask")
    alike = [i for i, c in enumerate(filters.values()) if c == IDENTICAL]
    if not alike:
        return rows.select("doc_id", "part", mask)
    facts = stored(rows.select("doc_id", "part", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), mask), "facts")
    # the first of each text is found by text and id, so copies of one text lie in many partitions
    first = facts.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    found = facts.join(first, ["k1", "k2", "doc_id"], "left")
    return found.select("doc_id", "part", F.expr("mask").bitwiseOR(F.when(later, sum(1 << i for i in alike)).otherwise(0)).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame, filters: dict[str, str], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """part, mask, n, good, toxic: rows, and rows whose label says quality = 1 and toxic = 1. Of several labels of an id
    the largest counts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").filter("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = masked(docs, filters, id_col, text_col, part_col).join(known, "doc_id", "left")
    of = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), of("good"), of("toxic"))


def walk(masks: DataFrame, letters: list[str]) -> DataFrame:
    """Every prefix of letters for every mask: prefix, letter and step (its last filter and length), mask, and whether that
    filter removes the mask, would have but for an earlier one (redundant), or leaves it (kept)."""
    spark, n = masks.sparkSession, len(letters)
    bits = [(letter, 1 << i) for i, letter in enumerate(letters)]
    moves = spark.createDataFrame([(applied, letter, bit) for applied in range(1 << n) for letter, bit in bits if not applied & bit], "applied int, letter string, bit int")
    return spark.sql(
        """WITH RECURSIVE walk(prefix, letter, step, applied, mask, removed, redundant, kept) AS (
            SELECT '', '', 0, 0, mask, 0, 0, 1 FROM {masks}
            UNION ALL
            SELECT concat(w.prefix, m.letter), m.letter, w.step + 1, w.applied | m.bit, w.mask,
                CASE WHEN w.mask & m.bit <> 0 AND w.mask & w.applied = 0 THEN 1 ELSE 0 END,
                CASE WHEN w.mask & m.bit <> 0 AND w.mask & w.applied <> 0 THEN 1 ELSE 0 END,
                CASE WHEN w.mask & (w.applied | m.bit) = 0 THEN 1 ELSE 0 END
            FROM walk w JOIN {moves} m ON w.applied = m.applied)
        SELECT prefix, letter, step, mask, removed, redundant, kept FROM walk WHERE step > 0""",
        masks=masks.coalesce(1),
        moves=moves,
    )


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What each filter does in every order of the filters, by part.

    filters: a letter and its condition of failure (SQL over text and words, or IDENTICAL), six at most. One row per part,
    filter_order and step: kept after the step; removed by it; redundant (fail its filter, removed earlier); unique_fails
    (fail its filter alone); good_lost and toxic_lost (removed here, by their labels); shapley (removed by its filter,
    summed over all orders). A null text is empty, a null part the empty string. IDENTICAL goes by smaller ids: rows with a
    null id neither fail it nor make others fail, and repeated rows of one id don't either. An empty table gives no rows;
    null labels are none; other columns are ignored.
    """
    letters, n = list(filters), len(filters)
    if not 0 < n <= MOST or any(len(x) != 1 for x in letters):
        raise ValueError(f"1 to {MOST} filters of one letter each")
    counted = stored(cells(docs, labels, filters, id_col, text_col, part_col), "cells")
    steps = stored(walk(counted.select("mask").distinct(), letters), "walk")

    bit = F.element_at(F.create_map(*(F.lit(x) for i, letter in enumerate(letters) for x in (letter, 1 << i))), F.col("letter"))
    total = lambda flag, c: F.sum(F.col(flag) * F.col(c)).alias(f"{flag}_{c}")
    at = counted.join(F.broadcast(steps), "mask")  # prefixes x masks: 125,248 rows at most
    unique = F.sum(F.when(F.col("mask") == bit, F.col("n")).otherwise(0)).alias("unique_fails")
    at = at.groupBy("part", "prefix", "letter", "step").agg(total("kept", "n"), total("removed", "n"), total("redundant", "n"), unique, total("removed", "good"), total("removed", "toxic"))
    at = stored(at, "metrics")
    discard(counted)

    orders = steps.filter(F.col("step") == n).select(F.col("prefix").alias("filter_order")).distinct()
    orders = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    orders = orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)")).drop("step")
    ways = F.element_at(F.array(*(F.lit(factorial(n - s)) for s in range(1, n + 1))), F.col("step"))  # orders that share a prefix
    shapley = at.groupBy("part", "letter").agg(F.sum(F.col("removed_n") * ways).cast("long").alias("shapley"))
    out = at.join(F.broadcast(orders), "prefix").join(shapley, ["part", "letter"])  # orders: n * n! rows
    columns = {"kept_n": "kept", "removed_n": "removed", "redundant_n": "redundant", "unique_fails": "unique_fails", "removed_good": "good_lost", "removed_toxic": "toxic_lost"}
    return out.select("part", "filter_order", F.col("step").cast("int").alias("step"), *(F.col(a).cast("long").alias(b) for a, b in columns.items()), "shapley")


def op12_filters(spark, sf_dir: str) -> DataFrame:
    return filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
