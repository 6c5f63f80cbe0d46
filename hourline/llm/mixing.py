"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import as_text, discard, once, query, running, stored, table

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
UNIT = 1 << 20  # copies are counted in fixed point, so that sums do not depend on their order
CAP = 3
TOLERANCE = 1e-6


def word_count(text: str = "text"):
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(__source, source_size, target) from rows with `__source`, `__null` and `__size`.

    Sources by code point, the NULL source last, get the weights in turn. They share the total by weight; a
    target stops at `cap` times its source's size and the excess is shared again. With sources ordered by
    cap/weight, the stopped ones come first, so the level is found from running sums in one step.
    """
    sources = sized.groupBy("__source", "__null").agg(F.sum("__size").cast("bigint").alias("source_size"))
    turn = running(sources, [], [F.col("__null"), F.col("__source")], {"__n": F.lit(1).cast("bigint")}, "mix-turn")
    turn = turn.select(
        "__source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("__n__before") % len(weights) + 1).cast("int")).cast("bigint").alias("__w"),
        (F.col("source_size") * cap).alias("__cap"),
    )
    filled = running(
        turn.withColumn("__ratio", F.col("__cap") / F.col("__w")), [], [F.col("__ratio"), F.col("__source")],
        {"__c": F.col("__cap"), "__v": F.col("__w")}, "mix-level",
    )
    filled = filled.withColumn("__total", F.col("__c__all") / F.lit(cap)).withColumn(
        "__level", (F.col("__total") - F.col("__c__before")) / (F.col("__v__all") - F.col("__v__before"))
    )
    level = filled.where("__level <= __ratio").agg(F.max("__level").alias("__level"))
    return filled.drop("__level").crossJoin(F.broadcast(level)).select(
        "__source", "source_size", F.least(F.col("__cap").cast("double"), F.col("__level") * F.col("__w")).alias("target"),
    )


def tilt(sized: DataFrame, targets: DataFrame, cap: int, tolerance: float) -> DataFrame:
    """Targets with `__tilt` and `__mean`: a document of size x is taken min(cap, exp(tilt x / mean)) times.

    These rates are as close to 1 in relative entropy as any whose words per source meet the targets. The
    dual is convex and separate per source; all sources take one Newton step per pass over the counts
    of (source, size), halving their bracket where a step would leave it, until every source is met.
    """
    spark = sized.sparkSession
    counts, counts_at = stored(
        sized.where("__size > 0").groupBy("__source", "__size").agg(F.count(F.lit(1)).alias("__n")), "mix-counts"
    )
    means = counts.groupBy("__source").agg((F.sum(F.col("__n") * F.col("__size")) / F.sum("__n")).alias("__mean"))
    state = targets.join(means, "__source", "left").select(
        "*", F.lit(0.0).alias("__tilt"), F.lit(-60.0).alias("__low"),
        # Sizes are whole words, so from this tilt on even a document of one word reaches the cap.
        (F.log(F.lit(cap + 1.0)) * F.col("__mean")).alias("__high"),
        (F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)).alias("__full"),
        F.lit(False).alias("__met"),
    )
    state, state_at = stored(state, "mix-tilt")
    while True:
        rate = F.exp(F.least(F.col("__tilt") * F.col("__size") / F.col("__mean"), F.lit(50.0)))
        words = F.col("__n") * F.col("__size")
        step = (
            counts.join(state.where("not __met and not __full"), "__source")
            .groupBy("__source").agg(
                F.sum(words * F.least(rate, F.lit(float(cap)))).alias("__f"),
                F.sum(F.when(rate < cap, words * rate * F.col("__size") / F.col("__mean")).otherwise(0.0)).alias("__df"),
            )
        )
        over = F.col("__f") > F.col("target")
        low = F.when(over, F.col("__low")).otherwise(F.col("__tilt"))
        high = F.when(over, F.col("__tilt")).otherwise(F.col("__high"))
        newton = F.col("__tilt") - (F.col("__f") - F.col("target")) / F.col("__df")
        # A bracket too narrow to matter also ends a source: no rate moves any more.
        met = (F.abs(F.col("__f") - F.col("target")) <= tolerance * F.col("target")) | (high - low < 1e-12)
        moved = state.join(step, "__source", "left").select(
            "__source", "source_size", "target", "__mean",
            F.when(F.col("__f").isNull() | met, F.col("__tilt"))
            .when((F.col("__df") > 0) & (newton > low) & (newton < high), newton)
            .otherwise((low + high) / 2).alias("__tilt"),
            F.when(F.col("__f").isNull(), F.col("__low")).otherwise(low).alias("__low"),
            F.when(F.col("__f").isNull(), F.col("__high")).otherwise(high).alias("__high"),
            "__full", (F.col("__f").isNull() | met).alias("__met"),
        )
        past = state_at
        state, state_at = stored(moved, "mix-tilt")
        discard(spark, past)
        if state.where("not __met").isEmpty():
            break
    discard(spark, counts_at)
    return state.withColumn("__tilt", F.round("__tilt", 9))


def mix(
    df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, source: str = "source",
    key: str = "doc_id", text: str = "text", seed: str = SEED, tolerance: float = TOLERANCE, words: str | None = None,
) -> DataFrame:
    """Entropy balancing: `df` with size, source_size, target, rate and `copies`, how often to take each row.

    All columns of `df` pass through three sorts; give it narrow rows, with their sizes in the column `words` instead of
    the text, as `taken` does.

    Rates are rounded by running sums along each source (largest documents first), so the words of a
    source differ from its target by less than one document; a second pass moves single copies of
    small documents against what is left. No row is taken more than `cap` times. NULL text and texts
    without words have size 0 and one copy (it has no words); a NULL source is a source of its own, a NULL key is drawn as
    the text 'null'. Equal rows are interchangeable. An empty table gives no rows. Columns of `df` with the added names
    are replaced.
    """
    added = ("size", "source_size", "target", "rate", "copies")
    sized = df.drop(*added).withColumns({
        "__size": F.coalesce(F.col(words), F.lit(0)).cast("bigint") if words else word_count(text), "__null": F.col(source).isNull(),
        "__source": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")),
        "__draw": F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))),
    })
    sized, _ = stored(sized, "mix-sized")
    targets = tilt(sized, source_targets(sized.select("__source", "__null", "__size"), weights, cap), cap, tolerance)
    rate = F.when(F.col("__size") == 0, 1.0).when(F.col("__full"), float(cap)).when(F.col("target") <= 0, 0.0).otherwise(
        F.least(F.exp(F.least(F.col("__tilt") * F.col("__size") / F.col("__mean"), F.lit(50.0))), F.lit(float(cap)))
    )
    rated = sized.join(targets.select("__source", "source_size", "target", "__tilt", "__mean", "__full"), "__source").withColumn(
        "__rate", F.round(rate * UNIT).cast("bigint")
    ).drop("__tilt", "__mean", "__full")
    order = [F.col("__size").desc(), F.col("__draw"), F.col(key)]
    along = running(rated, ["__source"], order, {"__r": F.col("__rate")}, "mix-round")
    half = UNIT // 2
    along = along.withColumn(
        "__copies", F.expr(f"(__r__before + __r + {half}L) div {UNIT}L - (__r__before + {half}L) div {UNIT}L")
    ).drop("__r", "__r__before", "__r__all")
    got = along.groupBy("__source").agg(F.sum(F.col("__copies") * F.col("__size")).alias("__got"))
    left = along.join(got, "__source").withColumn("__left", F.round(F.col("target") - F.col("__got")).cast("bigint"))
    movable = (
        (F.col("__size") > 0) & (F.col("__size") * 8 <= F.abs("__left"))
        & F.when(F.col("__left") > 0, F.col("__copies") < cap).otherwise(F.col("__copies") > 0)
    )
    moved = running(left.drop("__got"), ["__source"], order, {"__m": F.when(movable, F.col("__size")).otherwise(F.lit(0).cast("bigint"))}, "mix-rest")
    move = (F.col("__m") > 0) & (F.col("__m__before") + F.col("__m") <= F.abs("__left"))
    return moved.select(
        *[c for c in df.columns if c not in added],
        F.col("__size").alias("size"), "source_size", "target", (F.col("__rate") / UNIT).alias("rate"),
        (F.col("__copies") + F.when(move, F.signum("__left")).otherwise(0)).cast("int").alias("copies"),
    )


def taken(df: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mixture itself: the rows of `df`, each as often as it is taken, with the columns of `df`.

    Copies are worked out on rows without text and joined to the rows by key and a hash of all columns, so texts move
    once. Rows equal in every column are taken together, as often as all of them are.
    """
    columns = [F.to_json(c) if "map<" in kind else F.col(c) for c, kind in df.dtypes]
    marks = {f"__mark{n}": F.xxhash64(F.lit(n), *columns) for n in (1, 2)}
    narrow = df.select(F.col(source).alias("__from"), F.col(key).alias("__id"), word_count(text).alias("__words"), *[c.alias(m) for m, c in marks.items()])
    mixed = mix(narrow, source="__from", key="__id", words="__words", **options).where("copies > 0")
    times = mixed.groupBy(as_text("__id").alias("__key"), *marks).agg(F.sum("copies").alias("__times"))
    return (
        once(df, marks, key).join(times, ["__key", *marks])
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*df.columns)
    )


@query("op1_mixing")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs.select("doc_id", "source", word_count().alias("words")), words="words")
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
        "copies", "rate", "source",
    )
