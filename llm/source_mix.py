"""Mixing sources to target weights, with DataFrame operations only.

The words of each source, its documents in pseudorandom order, form one stream that is cut into
blocks of fixed length. A source's target gives its number of slots. Every slot falls into an
output shard by hash, so the counts of a shard over the sources are multinomial draws; the slot's
number maps to a block through a pseudorandom permutation of the source's block indexes, a new one
for each pass over them, and blocks are joined by index. A source never has more than two passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelf.staging import stage

#: Words are runs of anything but the ASCII white space of this class.
WORD = r"[^\x20\x09-\x0D]+"
_SEAM = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"
WEIGHTS = (3, 1, 2)
SHARE, PASSES = 1.5, 2
BLOCK_WORDS, SHARD_SLOTS = 128, 8192
_BUCKETS, _CHUNK, _ROUNDS = 4096, 4096, 24


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words; 0 for a null text) of each row."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"))


def _key(source: str = "source") -> Column:
    """A source's name that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))


def targets(rows: DataFrame) -> DataFrame:
    """key, source_size and target of each source of ``rows`` (source, size).

    Sources in code point order, null last, weigh 3, 1, 2, repeating, and share 150 % of all sizes.
    A target ends at twice its source's size and the rest goes to the others by weight. That is
    the smaller of the cap and a common level times the weight; sources ranked by cap over weight
    reach their caps in that order, so running sums give the level. One row for each source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place - 1) % len(WEIGHTS) + 1)
    named = sums.select(_key().alias("key"), "source_size", weight.alias("weight"))
    named = named.withColumn("cap", F.col("source_size") * float(PASSES))
    ranked = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * SHARE
    filled = F.sum("cap").over(ranked.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")
    open_weight = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    level = named.withColumn("level", (total - filled) / open_weight)
    first = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct(
        (F.col("cap") / F.col("weight")).alias("ratio"), "key", "level"
    ))).over(whole)
    target = F.least("cap", F.coalesce(first["level"] * F.col("weight"), F.col("cap")))
    return level.select("key", "source_size", target.alias("target"))


def _slots(goals: DataFrame, block_words: int) -> DataFrame:
    """goals with blocks and slots: as many slots as the target is of the source, in blocks."""
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.round(F.col("target") / F.col("source_size") * blocks)
    return goals.withColumn("blocks", blocks).withColumn(
        "slots", F.coalesce(F.least(wanted, blocks * PASSES), F.lit(0)).cast("long")
    )


def _permuted(index: Column, count: Column, key: list[Column], seed: int) -> Column:
    """A pseudorandom permutation of 0 to ``count`` - 1: in each round, swap with a partner or not."""

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(F.lit(seed), *key, r) - x, count)
        swap = F.xxhash64(F.lit(seed + 1), *key, r, F.greatest(x, partner)) % 2 == 0
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), index, step)


def draws(goals: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """One row for each slot: key, shard, slot, pass and the block it takes."""
    goals = _slots(goals, block_words).where("slots > 0")
    shards = F.ceil(F.sum("slots").over(Window.partitionBy()) / SHARD_SLOTS).cast("long")
    chunks = goals.withColumn("shards", shards).select(
        "key", "blocks", "slots", "shards", F.explode(F.sequence(F.lit(0), F.expr(f"(slots - 1) div {_CHUNK}"))).alias("chunk")
    )
    # A few rows here become thousands each: a given number of partitions keeps them apart.
    tasks = int(goals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = chunks.repartition(tasks, "key", "chunk").select(
        "key", "blocks", "shards",
        F.explode(F.sequence(
            F.col("chunk") * _CHUNK, F.least((F.col("chunk") + 1) * _CHUNK, F.col("slots")) - 1
        )).alias("slot"),
    )
    turn = F.expr("cast(slot div blocks as int)")
    return slots.select(
        "key", F.pmod(F.xxhash64(F.lit(seed + 2), "key", "slot"), F.col("shards")).alias("shard"), "slot",
        turn.alias("pass"),
        _permuted(F.expr("slot % blocks"), F.col("blocks"), [F.col("key"), turn], seed).alias("block"),
    )


def _placed(rows: DataFrame, seed: int) -> DataFrame:
    """Each row of ``rows`` with its key and its place in its source's order: bucket and row in it."""
    order = F.xxhash64(F.lit(seed + 3), "doc_id", "size")
    placed = rows.withColumn("key", _key()).withColumn("order", order)
    placed = placed.withColumn("bucket", F.pmod("order", F.lit(_BUCKETS)).cast("int"))
    inside = Window.partitionBy("key", "bucket").orderBy("order", "doc_id", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return placed.withColumn("inner", running).withColumn("row", F.row_number().over(inside))


def _pieces(rows: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Each row of ``rows`` (doc_id, source, size) once for each block that holds words of it.

    bucket and row tell rows of a source apart; ``from`` and ``words`` are the part in the block.
    Offsets come from two levels of running sums: buckets of a source, then rows of a bucket.
    """
    placed = _placed(rows, seed)
    sums = rows.withColumn("key", _key()).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed + 3), "doc_id", "size"), F.lit(_BUCKETS)).cast("int")
    ).groupBy("key", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = placed.join(bases, ["key", "bucket"]).withColumn("start", F.col("base") + F.col("inner"))
    first = F.expr(f"start div {block_words}")
    last = F.expr(f"(start + size - 1) div {block_words}")
    held = F.when(F.col("size") > 0, F.sequence(first, last))
    split = placed.select("key", "bucket", "row", "doc_id", "size", "start", F.explode_outer(held).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return split.select(
        "key", "bucket", "row", "doc_id", "size", "start", "block", (low - F.col("start")).alias("from"),
        (high - low).alias("words"),
    )


def packed(pieces: DataFrame) -> DataFrame:
    """key, block and the parts of documents in it, in order; a block has ``block_words`` parts at most."""
    part = F.struct("start", "bucket", "row", "doc_id", "size", "from", "words")
    made = pieces.where("words > 0").groupBy("key", "block").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return made.withColumn("parts", F.transform("parts", lambda p: p.dropFields("start")))


def shard_blocks(
    rows: DataFrame, goals: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17
) -> DataFrame:
    """The mix as output shards: shard, slot, key, pass, block and its parts, a row for each slot.

    ``rows`` are doc_id, source, size. A shard's number of slots of each source is its multinomial
    draw; slots of a shard are ordered by source and number. Blocks are joined by index.
    """
    # Slots grow with the words, which the planner can't see before they are made: never broadcast.
    slots = draws(goals, block_words, seed).hint("merge")
    return slots.join(packed(_pieces(rows, block_words, seed)), ["key", "block"]).select(
        "shard", "slot", "key", "pass", "block", "parts"
    )


def mix(rows: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``rows`` (doc_id, source, size).

    ``taken`` is the number of words of the document in the blocks of all shards, repeats counted: at
    most twice its size. Equal input gives equal output. Null sources are a source of their own; rows
    without words take part in no block and have 0 taken; repeated rows are mixed each for itself;
    without rows there are none. A source's taken words differ from its target by rounding to
    blocks of ``block_words`` and by its last, partly filled block. The sizes are written and read again.
    """
    rows = stage(rows, "sizes")
    goals = stage(targets(rows), "mix-targets")
    row = ["key", "bucket", "row", "doc_id", "size"]
    held = shard_blocks(rows, goals, block_words, seed).select("key", F.inline("parts"))
    every = _placed(rows, seed).select(*row, F.lit(0).cast("long").alias("words"))
    taken = held.select(*row, "words").unionByName(every).groupBy(*row).agg(F.sum("words").alias("taken"))
    return taken.join(goals, "key").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of ``docs``: for each document and pass the words taken.

    A document whose words are all taken in a pass appears whole; otherwise its text is the taken
    parts in order, white space kept, and ``n_chars`` counts them. Rows are told apart by doc_id,
    source and text; rows that repeat all three share their draws. Rows without words are not mixed and
    do not appear.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    named = F.xxhash64("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")), "text").alias("_id")
    known = docs.where("text is not null").select(whole, "text", named)
    ids = sized(docs.where("text is not null").select(named.alias("doc_id"), "source", "text"))
    ids = ids.groupBy("doc_id").agg(F.max(F.struct("source", "size")).alias("one"))
    rows = stage(ids.select("doc_id", "one.source", "one.size").where("size > 0"), "sizes")
    parts = shard_blocks(rows, stage(targets(rows), "mix-targets"), block_words, seed).select("pass", F.inline("parts"))
    part = F.struct("from", "words")
    takes = parts.groupBy("doc_id", "size", "pass").agg(
        F.sort_array(F.collect_list(part)).alias("_parts"), F.sum("words").alias("_taken")
    )
    takes = takes.select(F.col("doc_id").alias("_doc"), F.col("size").alias("_size"), "_parts", "_taken")
    texts = known.join(takes, F.col("_id") == F.col("_doc"))
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), _SEAM)
    # The array of one binds the split text, so that it is split once and not for each part.
    cut = F.transform(
        F.array(words),
        lambda w: F.array_join(
            F.transform("_parts", lambda p: F.array_join(
                F.slice(w, (p["from"] + 1).cast("int"), p["words"].cast("int")), ""
            )), "",
        ),
    )[0]
    text = F.when(F.col("_taken") >= F.col("_size"), F.col("text")).otherwise(cut)
    made = texts.select("_row", text.alias("_text"))
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return made.select(*[value.alias(c) for c, value in columns.items()])
