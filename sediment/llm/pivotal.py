"""Mixing sources to target weights, by pivotal dependent rounding.

Every source gets a target of words. Its documents are then copied a whole number of
times, with an expectation of target over size of the source: the whole part for all, the
fractional part as a probability. Drawing each document alone would miss the target by
much when sizes differ. Instead two documents at a time trade: words move from one to the
other, at random with expectations kept, until one of them is whole. What each bucket of
documents has left over, one fraction, trades again with those of other buckets, in a tree
of groups, until a source has a single fraction, drawn last. The words a source takes
differ from its target by less than one document.

Buckets and draws come from hashes of id, text and, where a row is repeated, the number of
the copy, so reruns and retried tasks agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import WORD, attach, ship, slim, text_hash
from sediment.session import materialise

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix over words of all documents, and the most copies of a source.
SHARE, MOST = 1.5, 2.0
#: Documents per bucket, and residuals that meet in one group of the tree.
BUCKET_ROWS, FAN_IN = 5_000, 64
#: Repeated rows that are numbered together.
RUN_ROWS = 4096
SEED = 17


def sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``_id``, ``_hash``, ``source`` and ``size``, the words of each document."""
    rows = slim(docs, _id=id_column, _text=text_column, source=source_column)
    size = F.coalesce(F.regexp_count("_text", F.lit(WORD)), F.lit(0)).cast("long")
    return rows.select("_id", text_hash(F.col("_text")).alias("_hash"), "source", size.alias("size"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``rows`` and ``target``.

    Weights go round by rank, null last. Sources share ``share`` of all words by weight; one
    that would pass ``most`` times its size stops there and the others share the rest. The
    sources that stop are those with the least size per weight: going up that order, one
    stops if an equal share of what is left would pass its limit.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    per = per.withColumn("most", F.col("source_size") * F.lit(most))
    up = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    gone = F.coalesce(F.sum("most").over(up), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * F.lit(share) - gone) / weight_left
    per = per.withColumn("stops", F.col("most") / F.col("weight") <= level)
    taken = F.coalesce(F.sum(F.when(F.col("stops"), F.col("most"))).over(everything), F.lit(0.0))
    rest = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    level = (F.sum("source_size").over(everything) * F.lit(share) - taken) / rest
    target = F.when(F.col("stops"), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * level))
    return per.withColumn("target", target).select("source", "source_size", "rows", "target")


def numbered(sized: DataFrame) -> DataFrame:
    """The rows of ``sizes``, repeated ones with their number in ``nth``: null, 1, 2 and so on.

    The first has null, which a hash passes over, so a row not repeated hashes as without it.
    """
    per = sized.groupBy("_id", "_hash", "source", "size").agg(F.count("*").alias("n"))
    last = F.col("n") - 1
    per = per.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(RUN_ROWS).cast("long"))))
    nth = F.explode(F.sequence("run", F.least(last, F.col("run") + (RUN_ROWS - 1))))
    return per.withColumn("nth", nth).withColumn("nth", F.nullif("nth", F.lit(0).cast("long"))).drop("n", "run")


def settle(size: list[int], chance: list[float], draws: list[float]) -> tuple[list[int], int, float]:
    """Round all chances but one: 0 or 1 for each place, the place left over (-1: none) and its chance.

    Keeps the sum of size times chance (the place left over included) and each expectation.
    """
    whole = [0] * len(size)
    left, x = -1, 0.0
    for i, y in enumerate(chance):
        if y <= 0.0 or y >= 1.0 or size[i] == 0:
            whole[i] = int(y >= 1.0) if size[i] else int(draws[i] < y)
            continue
        if left < 0:
            left, x = i, y
            continue
        s, t = size[left], size[i]
        up, down = min((1 - x) * s, y * t), min(x * s, (1 - y) * t)
        if draws[i] * (up + down) < down:  # words move from i to left
            left_done, x, y = (1 - x) * s <= y * t, x + up / s, y - up / t
            end, other = 1, 0
        else:
            left_done, x, y = x * s <= (1 - y) * t, x - down / s, y + down / t
            end, other = 0, 1
        if left_done:
            whole[left] = end
            left, x = i, y
        else:
            whole[i] = other
        if not 1e-12 < x < 1 - 1e-12:
            whole[left], left = round(x), -1
    return whole, left, x


def _round(columns: list[str]):
    """For one group, ordered by hash: rows with ``whole``, null for the one left over, which keeps ``chance``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("draw", "_hash", "size", "place")])
        size, chance, draw = (table.column(c).to_pylist() for c in ("size", "chance", "draw"))
        whole, left, x = settle(size, chance, [d / 2.0**53 for d in draw])
        if left >= 0:
            whole[left], chance[left] = None, x
        table = table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(chance, pa.float64()))
        return table.append_column("whole", pa.array(whole, pa.int64())).select(columns)

    return run


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``_id``, ``_hash``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    A null text has no words; a null source is a source. Documents without words are drawn
    alone and take nothing. Repeated rows are documents of their own. A source without words
    has target 0 and takes none; no rows give no rows.
    """
    ship(docs.sparkSession)
    sized = materialise(sizes(docs, id_column, text_column, source_column), "mix-sizes")
    goals = materialise(targets(sized, weights, share, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0)
    goal = goals.select(F.col("source").alias("_source"), "source_size", "target", rate.alias("rate"), "rows")
    rows = numbered(sized).join(goal, F.col("source").eqNullSafe(F.col("_source")))
    place = F.xxhash64(F.lit(seed), "_id", "_hash", "source", "nth")
    rows = rows.select(
        "_id",
        "_hash",
        "source",
        "size",
        "source_size",
        "target",
        F.floor("rate").cast("long").alias("base"),
        (F.col("rate") - F.floor("rate")).alias("chance"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "_id", "_hash", "nth"), 11).alias("draw"),
        F.pmod(place, F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS))).alias("bucket"),
        F.lit(0).cast("long").alias("place"),
    )
    fields = ["_id", "_hash", "size", "source_size", "target", "base", "chance", "draw", "place", "whole"]
    schema = rows.schema
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields} | {"whole": "long"}
    out = ", ".join(f"`{c}` {kinds[c]}" for c in ["source", "bucket", *fields])
    done = rows.groupBy("source", "bucket").applyInArrow(_round(["source", "bucket", *fields]), out)
    first = materialise(done, "mix-buckets")

    open_rows = first.where("whole is null").select("source", "bucket", "_hash", "size", "chance", "draw", F.col("bucket").alias("place"))
    # From here a residual is known by its source and first bucket, its "place".
    settled = None
    level_schema = f"source {kinds['source']}, bucket long, _hash long, size long, chance double, draw long, place long, whole long"
    level = 0
    groups = first.agg(F.max("bucket")).first()[0]
    groups = 1 if groups is None else groups + 1
    while True:
        level += 1
        groups = math.ceil(groups / FAN_IN)
        again = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1 + level), "source", "place", "_hash"), 11)
        step = open_rows.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)).withColumn("draw", again)
        step = step.groupBy("source", "bucket").applyInArrow(
            _round(["source", "bucket", "_hash", "size", "chance", "draw", "place", "whole"]), level_schema
        )
        step = materialise(step, "mix-level")
        ended = step.where("whole is not null").select("source", "place", "whole")
        settled = ended if settled is None else settled.union(ended)
        open_rows = step.where("whole is null").drop("whole")
        if groups <= 1:
            break
    last = F.shiftrightunsigned(F.xxhash64(F.lit(seed - 1), "source", "place", "_hash"), 11) / F.lit(2.0**53)
    drawn = open_rows.select("source", "place", (last < F.col("chance")).cast("long").alias("whole"))
    settled = settled.union(drawn).select(F.col("source").alias("_source"), "place", F.col("whole").alias("settled"))
    on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == settled["place"])
    late = first.where("whole is null").drop("place").join(settled, on).withColumn("whole", F.col("settled"))
    names = ["_id", "_hash", "source", "size", "source_size", "target"]
    both = first.where("whole is not null").select(*names, "base", "whole").union(late.select(*names, "base", "whole"))
    copies = F.col("base") + F.col("whole")
    return both.select(*names, copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings) -> DataFrame:
    """The documents that the mix takes, with ``copies`` and ``taken`` after their own columns.

    Each comes once, however many copies; repeated rows come once with their copies summed.
    Columns of these two names in ``docs`` are replaced.
    """
    mixed = mix(docs, id_column, text_column, source_column, **settings)
    mixed = mixed.groupBy("_id", "_hash").agg(
        F.count("*").alias("_n"), F.sum("copies").alias("copies"), F.sum("taken").alias("taken")
    )
    mixed = materialise(mixed.where("copies > 0"), "mix-copies")
    kept = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in ("copies", "taken")]
    return attach(docs, mixed, id_column, text_column).select(*kept, "copies", "taken")
