"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]. Its integral, the
cumulative token demand, ends at the source's target; inverting it turns a token's place
in its source's stream into the time at which it is trained on. Documents are then sorted
by range of that time. A source whose target exceeds its size is streamed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, n_words, unused
from .numbering import running_total


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most_passes: float = 2.0) -> DataFrame:
    """`source`, source_size, target, slope from rows (source, size).

    Sources in code point order, null last, weigh `weights`, repeating. Targets share
    `share` of all sizes by weight, none above `most_passes` times its source's size: the
    level at which water stands that is poured over the weights, found by sorting sources
    by capacity per weight. Windows here run over one row per source.
    """
    everything = Window.partitionBy()
    ranked = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("__rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("__weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int")))
        .withColumn("__cap", F.col("source_size") * F.lit(float(most_passes)))
        .withColumn("__fill", F.col("__cap") / F.col("__weight"))
        .withColumn("__demand", F.lit(float(share)) * F.sum("source_size").over(everything))
    )
    below = Window.orderBy("__fill", "__rank").rowsBetween(Window.unboundedPreceding, -1)
    # With the sources before this one full, the level if this and all later ones are not.
    levelled = (
        ranked.withColumn("__full", F.coalesce(F.sum("__cap").over(below), F.lit(0.0)))
        .withColumn("__open", F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(below), F.lit(0.0)))
        .withColumn("__level", (F.col("__demand") - F.col("__full")) / F.col("__open"))
        # The first source, in that order, that its level doesn't fill has the right one.
        .withColumn("__level", F.first(F.when(F.col("__level") <= F.col("__fill"), F.col("__level")), ignorenulls=True).over(
            Window.orderBy("__fill", "__rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ))
    )
    return levelled.select(
        "source", "source_size",
        F.coalesce(F.least("__cap", F.col("__level") * F.col("__weight")), F.col("__cap")).alias("target"),
        # Heavier sources come early, lighter ones late: weight(t) = target * (1 + slope * (1 - 2t)).
        ((F.col("__weight") - F.lit(sum(weights) / len(weights))) / F.lit(2.0 * max(weights))).alias("slope"),
    )


def training_time(tokens: str, target: str = "target", slope: str = "slope"):
    """Inverts D(t) = target * (t + slope * (t - t*t)) at `tokens`; 0 to 1."""
    u = F.least(F.greatest(F.col(tokens) / F.when(F.col(target) > 0, F.col(target)), F.lit(0.0)), F.lit(1.0))
    a = F.col(slope)
    root = F.sqrt(F.greatest((1 + a) * (1 + a) - 4 * a * u, F.lit(0.0)))
    return F.coalesce(2 * u / ((1 + a) + root), F.lit(0.0))


def mixing_plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most_passes: float = 2.0,
                doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, taken, passes, position.

    size: words of the text (null: 0). A source's stream is its documents in a hashed
    order, over and over; the mix takes its first round(target) words, so taken sums to
    the target within half a word and no document exceeds `most_passes` times its size
    (rounded up). `passes` holds, for each pass that takes words, (pass, words, position)
    with position in [0, 1] the training time of the middle word. position is the first
    one's; for a document of which nothing is taken, null. Repeated rows are streamed
    each. Reruns agree. Empty table: no rows; other columns aren't read.
    """
    return _plan(docs, weights, share, most_passes, doc_id, text, source)


def _plan(docs: DataFrame, weights: tuple[float, ...], share: float, most_passes: float, doc_id: str, text: str, source: str, row: list[Column] = []) -> DataFrame:
    """`mixing_plan` with the columns `row` too, by which rows of one id and size are told apart and ordered."""
    slim = durable(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), *row,
    ))
    keys = slim.columns[3:]
    targets = durable(source_targets(slim, weights, share, most_passes))
    placed = running_total(slim, "doc_id", ["doc_id", "size", *keys], "size", "source").drop("__total").withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))).drop("source")
    # One row a source: its count doesn't grow with the texts; Spark decides on its measured size whether to broadcast.
    known = targets.withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    joined = placed.join(known, "__source").withColumn("__quota", F.round("target").cast("long"))
    most = int(-(-most_passes // 1))
    taken = [
        F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("__quota") - F.lit(k).cast("long") * F.col("source_size") - F.col("__before")))
        for k in range(most)
    ]
    timed = joined.withColumns({f"__taken{k}": t for k, t in enumerate(taken)})
    for k in range(most):
        timed = timed.withColumn(f"__middle{k}", F.lit(k) * F.col("source_size") + F.col("__before") + F.col(f"__taken{k}") / 2)
    parts = F.filter(
        F.array(*[F.struct(F.lit(k).alias("pass"), F.col(f"__taken{k}").alias("words"), training_time(f"__middle{k}").alias("position")) for k in range(most)]),
        lambda p: p["words"] > 0,
    )
    return timed.withColumn("passes", parts).select(
        "doc_id", "source", "size", "source_size", "target",
        sum((F.col(f"__taken{k}") for k in range(1, most)), F.col("__taken0")).alias("taken"),
        "passes", F.expr("get(passes, 0).position").alias("position"), *keys,
    )


def by_position(rows: DataFrame, partitions: int, position: str = "position") -> DataFrame:
    """Sorted by ranges of the training time; rows never trained on come last."""
    order = [F.col(position).asc_nulls_last(), F.col("doc_id")]  # the id parts the rows that are never trained on
    return rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most_passes: float = 2.0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source", partitions: int | None = None) -> DataFrame:
    """The rows of `docs` in training order, each as often as the mix takes it, with all their columns.

    Whole documents are kept whole: a pass counts if it takes at least half of the
    document, so a source is off its target by at most half of one document. Documents
    without words ask for nothing and stay once, at the beginning. A row is known by its
    id, source and the hash of its text, so repeated and null ids are told apart; rows equal
    in all of these are numbered, and each comes out as often as its number is taken.
    """
    spark = docs.sparkSession
    columns = docs.columns
    row = F.xxhash64(docs[text], docs[source].cast("string"), docs[source].isNull())
    plan = _plan(docs, weights, share, most_passes, doc_id, text, source, [row.alias("__row")])
    whole = F.when(F.col("size") == 0, F.array(F.lit(0.0))).otherwise(
        F.transform(F.filter("passes", lambda p: p["words"] * 2 >= F.col("size")), lambda p: p["position"])
    )
    same = Window.partitionBy("__id", "__row")
    planned = plan.select(F.col("doc_id").alias("__id"), "__row", whole.alias("__times"))
    planned = durable(planned.withColumns({"__copies": F.count(F.lit(1)).over(same), "__copy": F.row_number().over(same.orderBy("__times"))}))
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges are found on the positions alone, so the texts' shuffles needn't be sampled first.
    order = [F.col("__position"), F.col("__id"), F.col("__row")]
    placed = planned.select("__id", "__row", "__copies", "__copy", F.explode("__times").alias("__position")).repartitionByRange(partitions, *order)
    times = durable(placed.withColumn("__part", F.spark_partition_id()))

    def met(rows: DataFrame, times: DataFrame, more: list[Column]) -> DataFrame:
        times = times.select(*[F.col(c).alias(c) for c in times.columns])  # told apart from what `rows` were joined to
        on = docs[doc_id].eqNullSafe(times["__id"]) & (row == times["__row"])
        for c in more:
            on = on & (c == times["__copy"])
        return rows.join(times, on).select(F.struct(*[docs[c] for c in columns]).alias("row"), *[times[c] for c in ("__position", "__id", "__row", "__part")])

    rows = met(docs, times.where("__copies = 1"), [])
    if not planned.where("__copies > 1").isEmpty():
        repeats = planned.where("__copies > 1 AND __copy = 1").select(F.col("__id").alias("__i"), F.col("__row").alias("__r"))
        numbered = docs.join(repeats, docs[doc_id].eqNullSafe(repeats["__i"]) & (row == repeats["__r"]), "left_semi")
        number = unused("__number", columns)
        numbered = numbered.withColumn(number, F.row_number().over(Window.partitionBy(docs[doc_id], row).orderBy(F.lit(0))))
        rows = rows.unionByName(met(numbered, times.where("__copies > 1"), [F.col(number)]))
    parts = times.agg(F.max("__part")).first()[0]
    return rows.repartitionById((parts or 0) + 1, F.col("__part")).sortWithinPartitions(*order).select("row.*")
