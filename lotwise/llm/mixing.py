"""Mixing sources to target weights, with columns and joins alone.

The words of a source's documents are packed into blocks of equal length, in an order of buckets
and ids. Each shard of the output has a number of slots, and draws how many of them each source
gets: every slot draws a ticket, sources hold tickets by their quota, so the counts of a shard are
multinomial. What a source drew beyond its quota over all shards goes to the sources that drew
less, so the quotas are met. A source numbers its slots and sends each through a pseudorandom
permutation of its block numbers, another one for each round over them; slots and blocks meet in a
join by block number. No source is read more often than its cap allows, and no block twice in
a round.

Sources weigh 5, 2, 1 and so on in order of their names, the null source last. Targets are shares
of all words by weight, at most ``cap`` times the words of the source; what a source can't take is
shared among the others. Quotas are targets in blocks, rounded, so a source misses its target by
at most a block and its one short block.

Null texts and texts without words have size 0 and are in no block. Rows without an id come last
in their bucket. Rows that repeat id, source and text are documents of their own: each gives a
row, and they share the result of their place. Long texts fill many blocks. Names of other columns
can't clash, as none is kept. An empty table gives an empty result. All choices are functions
of the seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored, table
from workload.folders import work_folder

WEIGHTS = (5, 2, 1)
CAP = 3
#: Words in a block, slots in a shard of the output.
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
#: Documents in a bucket, within which they are put in order; tickets in a bin.
BUCKET_ROWS = 512
BIN_TICKETS = 1024
#: Running sums go over groups of so many rows, and then over the groups.
SUM_WIDTH = 1024
#: Steps of a permutation.
STEPS = 24
SEED = 42

#: Pseudorandom values are squares modulo a prime, plain arithmetic that fits 64 bits.
PRIME = 2_147_483_647
FACTORS = (48_271, 69_621)

WORD = r"[^\x20\x09-\x0D]+"


def noise(x: Column, salt: int) -> Column:
    """A pseudorandom value below ``PRIME``."""
    high = F.pmod(F.shiftright(x, 31), F.lit(PRIME)) * FACTORS[0]
    h = (F.pmod(x, F.lit(PRIME)) + high + salt) % PRIME
    for factor in (FACTORS[1], FACTORS[0]):
        h = (h * h + h * factor + 1) % PRIME
    return h


def wide_noise(x: Column, salt: int) -> Column:
    return noise(x, salt) * PRIME + noise(x, salt + 1)


def before(df: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of a group whose ``order`` is smaller.

    ``order`` is a long, unique in its group and without large gaps. No task gets a whole group.
    """
    part = F.floor(F.col(order) / SUM_WIDTH).alias("_part")
    parts = df.groupBy(*by, part).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*by).orderBy("_part")
    parts = parts.select(*by, "_part", (F.sum("_sum").over(over) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy(*by, "_part").orderBy(order)
    rows = df.withColumn("_part", part).withColumn("_within", F.sum(value).over(inside) - F.col(value))
    total = (F.col("_before") + F.col("_within")).alias(name)
    return rows.join(parts, [*by, "_part"]).select(*df.columns, total)


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, th, size): the number of words of each document and a hash of its text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("th"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source its place by name, words, target, blocks, quota of slots and the quotas before.

    With the sources in order of what they can take for their weight, the level is the
    largest of the shares that are left if all sources before are full. One row a source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    of_rank = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = sources.withColumn("number", number.cast("long")).withColumn(
        "weight", F.element_at(of_rank, (F.col("number") % len(weights) + 1).cast("int"))
    )
    full = F.col("source_size") * cap
    order = Window.orderBy((full / F.col("weight")), "number")
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - (F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, 0)) - full)
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", left.cast("double") / rest)
    target = F.least(full.cast("double"), F.col("weight") * F.max("level").over(every))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long")
    quota = F.floor(F.col("blocks") * F.col("target") / F.col("source_size") + 0.5).cast("long")
    return (
        levels.withColumn("target", target)
        .withColumn("blocks", blocks)
        .withColumn("quota", F.when(F.col("source_size") > 0, F.least(F.col("blocks") * cap, quota)).otherwise(0))
        .withColumn("low", F.sum("quota").over(Window.orderBy("number")) - F.col("quota"))
        .select("source", "number", "docs", "source_size", "target", "blocks", "quota", "low")
    )


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document with the words of its source before it: ``number``, ``start`` and its size.

    The order in a source is by bucket, then by id.
    """
    names = sources.select(F.col("source").alias("name"), "number", "docs")
    joined = sized.join(names, F.col("source").eqNullSafe(F.col("name")))
    buckets = F.floor(F.col("docs") / BUCKET_ROWS) + 1
    bucket = noise(F.coalesce("doc_id", "th"), SEED + 8) % buckets
    rows = joined.select("doc_id", "source", "th", "size", "number", bucket.alias("bucket"))
    sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    sums = before(sums, ["number"], "bucket", "words", "ahead").select("number", "bucket", "ahead")
    order = Window.partitionBy("number", "bucket").orderBy(F.asc_nulls_last("doc_id"), "th", "size")
    within = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    start = (F.col("ahead") + F.col("within")).alias("start")
    return (
        rows.withColumn("within", within)
        .join(sums, ["number", "bucket"])
        .select("doc_id", "source", "th", "size", "number", start)
    )


def pieces(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(number, block, doc_id, th, start, first, n_words): what each block has of each document."""
    end = F.col("start") + F.col("size")
    held = F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))
    first = F.greatest(F.col("block") * block_words, "start")
    until = F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size"))
    return (
        documents.where("size > 0")
        .select("*", F.explode(held).alias("block"))
        .select(
            "number",
            "block",
            "doc_id",
            "th",
            "start",
            (first - F.col("start")).alias("first"),
            (until - first).alias("n_words"),
        )
    )


def drawn(sources: DataFrame, total: int, folder: str | None = None) -> DataFrame:
    """(shard, slot, number, turn): the source of each slot, and the slot's number within it.

    Every slot draws one of ``total`` tickets. Quotas hold after the exchange of what sources drew too
    often for what others drew too seldom.
    """
    slots = sources.sparkSession.range(0, total, 1, total // (1 << 20) + 1).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"),
        F.col("id").alias("slot"),
        (wide_noise(F.col("id"), SEED) % max(total, 1)).alias("ticket"),
    )
    owned = sources.where("quota > 0").withColumn("high", F.col("low") + F.col("quota"))
    bins = F.sequence(F.floor(F.col("low") / BIN_TICKETS), F.floor((F.col("high") - 1) / BIN_TICKETS))
    owned = owned.select("number", "low", "high", F.explode(bins).alias("bin"))
    met = slots.withColumn("bin", F.floor(F.col("ticket") / BIN_TICKETS)).join(owned, "bin")
    met = met.where("ticket >= low AND ticket < high").select("shard", "slot", "number")
    met = stored(met, "mixing-draws", folder)

    counts = met.groupBy("number", "shard").agg(F.count("*").alias("n"))
    ahead = before(counts, ["number"], "shard", "n", "ahead").select("number", "shard", "ahead")
    within = F.row_number().over(Window.partitionBy("number", "shard").orderBy("slot")) - 1
    turns = met.withColumn("within", within).join(ahead, ["number", "shard"])
    turns = turns.select("shard", "slot", "number", (F.col("ahead") + F.col("within")).alias("turn"))

    got = sources.join(counts.groupBy("number").agg(F.sum("n").alias("got")), "number", "left")
    got = got.select("number", "quota", F.coalesce("got", F.lit(0)).alias("got"))
    by_number = Window.orderBy("number")
    over, under = (F.greatest(x, F.lit(0)) for x in (F.col("got") - F.col("quota"), F.col("quota") - F.col("got")))
    spare = got.select("number", "quota", (F.sum(over).over(by_number) - over).alias("first"))
    short = got.select("number", "got", under.alias("under"), (F.sum(under).over(by_number) - under).alias("first"))
    short = short.where("under > 0")
    short = short.select(
        F.col("number").alias("to"), "got", F.posexplode(F.sequence(F.col("first"), F.col("first") + F.col("under") - 1))
    ).select(F.col("col").alias("place"), "to", (F.col("got") + F.col("pos")).alias("turn"))

    known = turns.join(spare, "number")
    kept = known.where("turn < quota").select("shard", "slot", "number", "turn")
    moved = known.where("turn >= quota").select("shard", "slot", (F.col("first") + F.col("turn") - F.col("quota")).alias("place"))
    return kept.unionByName(moved.join(short, "place").select("shard", "slot", F.col("to").alias("number"), "turn"))


def permuted(slots: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds ``block``: the slot's turn sent through its source's permutation of block numbers.

    A step swaps ``x`` with ``key - x`` or not, by a bit that both share; any number of
    steps is a permutation of any number of blocks.
    """
    code = (F.col("number") * cap + F.col("round")) * STEPS + F.col("step")
    key = F.struct(
        (wide_noise(code, SEED + 2) % F.col("blocks")).alias("key"),
        (noise(code, SEED + 4) % (PRIME - 1) + 1).alias("factor"),
        noise(code, SEED + 5).alias("shift"),
    )
    keys = (
        sources.where("quota > 0")
        .select("number", "blocks", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("round"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("step"))
        .groupBy("number", "blocks", "round")
        .agg(F.sort_array(F.collect_list(F.struct("step", key.alias("key")))).alias("steps"))
    )
    n = sources.where("quota > 0").select("number", "blocks")
    turns = slots.join(n, "number").select(
        *slots.columns,
        F.floor(F.col("turn") / F.col("blocks")).cast("int").alias("round"),
        (F.col("turn") % F.col("blocks")).alias("x"),
    )

    def step(x: Column, s: Column) -> Column:
        other = (s["key"]["key"] + F.col("blocks") - x) % F.col("blocks")
        bit = (F.greatest(x, other) % PRIME * s["key"]["factor"] + s["key"]["shift"]) % PRIME % 2
        return F.when(bit == 1, other).otherwise(x)

    block = F.aggregate("steps", F.col("x"), step).alias("block")
    return turns.join(keys, ["number", "round"]).select("shard", "slot", "number", "round", block)


def mixed(docs: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as spans, the documents with their places, and the sources with their targets.

    A span is (shard, slot, number, round, block, doc_id, th, start, first, n_words): the words
    from ``first`` on of a document, in the order of shard, slot and start.
    """
    sized = stored(sizes(docs), "mixing-sizes", folder)
    sources = stored(targets(sized), "mixing-sources", folder)
    documents = stored(placed(sized, sources), "mixing-documents", folder)
    total = sources.agg(F.sum("quota")).first()[0] or 0
    slots = permuted(drawn(sources, total, folder), sources)
    return slots.join(pieces(documents), ["number", "block"]), documents, sources


def span_texts(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the words of each span, joined by a space, as ``words``."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_th"),
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("_words"),
    ).dropDuplicates(["_id", "_th"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    some = F.slice("_words", F.col("first").cast("int") + 1, F.col("n_words").cast("int"))
    return spans.join(texts, same).select(*spans.columns, F.array_join(some, " ").alias("words"))


def taken(spans: DataFrame, documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Per document what the mix takes of it, with the size and target of its source."""
    sums = spans.groupBy("number", "start").agg(F.sum("n_words").alias("sum"))
    sums = sums.withColumn("filled", F.lit(True))
    rows = documents.withColumn("filled", F.col("size") > 0)
    made = rows.join(sums, ["number", "start", "filled"], "left")
    return made.join(sources.select("number", "source_size", "target"), "number").select(
        "doc_id", "size", "source_size", "target", F.coalesce("sum", F.lit(0)).cast("long").alias("taken")
    )


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    return taken(*mixed(table(spark, sf_dir, "documents"), work_folder(spark)))


QUERIES = {"op13_source_mixing": op13_source_mixing}


def _sql_noise(x: str, salt: int) -> str:
    h = f"(({x}) % {PRIME} + (({x}) >> 31) % {PRIME} * {FACTORS[0]} + {salt}) % {PRIME}"
    for factor in (FACTORS[1], FACTORS[0]):
        h = f"(({h}) * ({h}) + ({h}) * {factor} + 1) % {PRIME}"
    return f"({h})"


def _sql_wide(x: str, salt: int) -> str:
    return f"({_sql_noise(x, salt)} * {PRIME} + {_sql_noise(x, salt + 1)})"


_CODE = f"((number * {CAP} + round) * {STEPS} + step)::BIGINT"

ORACLES = {
    "op13_source_mixing": f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM sized GROUP BY source
), weighed AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][number % {len(WEIGHTS)} + 1] AS weight FROM named),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * {CAP}) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW o AS (ORDER BY (source_size * {CAP})::DOUBLE / weight, number)
), aims AS (
  SELECT *, least((source_size * {CAP})::DOUBLE, weight * max(level) OVER ()) AS target,
         ceil(source_size / {BLOCK_WORDS})::BIGINT AS blocks
  FROM levels
), sources AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(blocks * {CAP}, floor(blocks * target / source_size + 0.5)::BIGINT) ELSE 0 END AS quota
  FROM aims
), owned AS (SELECT *, sum(quota) OVER (ORDER BY number) - quota AS low, sum(quota) OVER () AS total FROM sources),
places AS (
  SELECT doc_id, size, number,
         (sum(size) OVER (PARTITION BY number ORDER BY {_sql_noise("doc_id", SEED + 8)} % (docs // {BUCKET_ROWS} + 1), doc_id) - size)::BIGINT AS start
  FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source
), tickets AS (
  SELECT slot, slot // {SHARD_SLOTS} AS shard, {_sql_wide("slot", SEED)} % (SELECT sum(quota) FROM sources)::BIGINT AS ticket
  FROM (SELECT unnest(range((SELECT sum(quota) FROM sources)::BIGINT)) AS slot)
), turns AS (
  SELECT slot, number, quota, row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS turn
  FROM tickets JOIN owned ON ticket >= low AND ticket < low + quota
), got AS (
  SELECT sources.number, any_value(sources.quota) AS quota, count(slot) AS got
  FROM sources LEFT JOIN turns ON sources.number = turns.number GROUP BY 1
), spare AS (
  SELECT slot, row_number() OVER (ORDER BY number, turn) AS place FROM turns WHERE turn >= quota
), short AS (
  SELECT number, got + i AS turn, row_number() OVER (ORDER BY number, i) AS place
  FROM (SELECT number, got, unnest(range(greatest(quota - got, 0))) AS i FROM got)
), settled AS (
  SELECT number, turn FROM turns WHERE turn < quota
  UNION ALL SELECT short.number, short.turn FROM spare JOIN short USING (place)
), walk AS (
  SELECT number, blocks, turn // blocks AS round, turn % blocks AS x, 0 AS step FROM settled JOIN sources USING (number)
  UNION ALL
  SELECT number, blocks, round,
         CASE WHEN (greatest(x, other) % {PRIME} * ({_sql_noise(_CODE, SEED + 4)} % ({PRIME} - 1) + 1) + {_sql_noise(_CODE, SEED + 5)}) % {PRIME} % 2 = 1
              THEN other ELSE x END, step + 1
  FROM (SELECT *, ({_sql_wide(_CODE, SEED + 2)} % blocks + blocks - x) % blocks AS other FROM walk WHERE step < {STEPS})
), uses AS (SELECT number, x AS block, count(*) AS uses FROM walk WHERE step = {STEPS} GROUP BY 1, 2),
pieces AS (
  SELECT *, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM places WHERE size > 0
), sums AS (
  SELECT doc_id, sum(uses * (least((block + 1) * {BLOCK_WORDS}, start + size) - greatest(block * {BLOCK_WORDS}, start))) AS taken
  FROM pieces JOIN uses USING (number, block) GROUP BY 1
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM places JOIN sources USING (number) LEFT JOIN sums USING (doc_id)
"""
}
