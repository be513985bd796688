"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

1. Targets: the whole token mass is shared by weight; no source gets more than `ceiling` times its
   own mass, and what that frees is shared again by weight (water filling, in closed form).
2. Blocks of equal size are allocated to the sources by the highest quotients target / (2k + 1), and
   the blocks of a source in the same way to its shards. The quotients of all blocks are never
   formed: rounding target / divisor gives all but a few seats, and only those few are contested.
3. In a shard the documents lie on a line in seeded order. Its blocks are taken at a seeded start
   and even steps (systematic sampling: the seed orders the line and sets the start, the quota the
   step), so that whole rounds of the line and then the quota's rest are spread over it; each
   document's share follows from its two ends by arithmetic.

Shards bound what one task orders: a hot source has as many as its mass needs. A source's shards are
allocated by way of REGIONS regions, so that no task allocates to more than REGIONS regions, or to
the shards of more than one. Documents are dealt to shards by a hash of id and text, so that neither
rows without an id nor rows of one id lie together; only rows equal in both do.

Null texts have size 0 and are not taken. Null sources form the last source. Repeated rows and rows
of equal doc_id are separate documents; ties on the line go by id, then size. Very long texts are
counted as they stand. Extra columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD_PATTERN, cut, need

#: Words of a block; the mix of a source is within a block or so a shard of its target.
BLOCK = 16
#: Words that a shard holds at about; a shard is ordered by one task.
SHARD = 2_000_000
#: Regions that a source's shards are allocated by. A source of fewer shards has one in each.
REGIONS = 1024
#: Sources whose allocation is broadcast at most; that of more is joined by shuffle.
FEW_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3) -> DataFrame:
    """sizes(source, source_size), one row a source, with weight and target.

    Sources take the weights in turn by code point, null last. Capped sources are those of the
    smallest source_size / weight; the level is set by the first source that stays below its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = sizes.withColumn("weight", weight)
    out = out.withColumn("spent", F.coalesce(F.sum("source_size").over(fill), F.lit(0))).withColumn("gone", F.coalesce(F.sum("weight").over(fill), F.lit(0.0)))
    level = (F.sum("source_size").over(every) - ceiling * F.col("spent")) / (F.sum("weight").over(every) - F.col("gone"))
    out = out.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= ceiling * F.col("source_size"))
    # The first open source in filling order has the smallest level among the open ones.
    out = out.withColumn("set", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source"))).over(every))
    return out.select("source", "source_size", F.least(F.coalesce(F.col("set"), F.lit(0.0)) * F.col("weight"), ceiling * F.col("source_size").cast("double")).alias("target"))


def sainte_lague(rows: DataFrame, group: list[str], name: list[str], votes: str, seats: str, out: str) -> DataFrame:
    """rows with `out`: the seats of each row of a group by the highest quotients votes / (2k + 1).

    seats: column with the group's number of seats. Ties go to the smaller names. Rounding gives
    every row its seats at the average divisor, which is off by half a row each at most; the
    difference is settled by the largest quotients not yet used, or the smallest used.
    """
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    seats_c = F.col(seats)
    share = F.when(F.sum(votes).over(whole) > 0, F.col(votes) * seats_c / F.sum(votes).over(whole)).otherwise(F.lit(0.0))
    rows = rows.withColumn("_base", F.floor(share + 0.5)).withColumn("_off", F.when(F.sum(votes).over(whole) > 0, seats_c - F.sum("_base").over(whole)).otherwise(F.lit(0)))
    steps = F.when(F.col("_off") > 0, F.sequence(F.lit(0).cast("long"), F.col("_off") - 1)).when(F.col("_off") < 0, F.sequence(F.lit(1).cast("long"), F.least(-F.col("_off"), F.col("_base")))).otherwise(F.array().cast("array<long>"))
    steps = F.when((F.col("_off") < 0) & (F.col("_base") <= 0), F.array().cast("array<long>")).otherwise(steps)
    key = [*group, *name]
    contest = rows.select(*key, votes, "_base", "_off", F.explode(steps).alias("_k"))
    seat = F.when(F.col("_off") > 0, F.col("_base") + F.col("_k")).otherwise(F.col("_base") - F.col("_k"))
    contest = contest.withColumn("_q", F.col(votes) / (2 * seat + 1))
    rank = Window.partitionBy(*(group or [F.lit(0)])).orderBy((F.signum("_off") * -F.col("_q")).asc(), *(F.col(c).asc_nulls_last() for c in name), "_k")
    won = contest.withColumn("_r", F.row_number().over(rank)).where("_r <= abs(_off)").groupBy(*key).agg(F.sum(F.signum("_off")).cast("long").alias("_won"))
    won = won.select(*(F.col(c).alias(f"_w_{c}") for c in key), "_won")
    on = F.lit(True)
    for c in key:
        on = on & rows[c].eqNullSafe(won[f"_w_{c}"])
    return rows.join(won, on, "left").withColumn(out, F.col("_base") + F.coalesce("_won", F.lit(0))).drop("_base", "_off", "_won", *(f"_w_{c}" for c in key))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3, seed: int = 7, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of docs(doc_id, text, source)."""
    return place(docs, weights, ceiling, seed, block, shard).select("doc_id", "size", "source_size", "target", "taken")


def measure(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, size, at): what the mix needs of each document; at, 32 hex digits, is its seeded place."""
    size, at = _measures(seed)
    return need(docs, "doc_id", "source", "text").select("doc_id", "source", size.alias("size"), at.alias("at"))


def _measures(seed: int) -> tuple[Column, Column]:
    text = F.col("text")
    at = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return word_count(text), at


def allocate(measured: DataFrame, weights, ceiling: int, block: int) -> DataFrame:
    """By source: s, source_size, target, and blocks, its seats by highest quotients of the targets."""
    aims = targets(measured.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ceiling)
    every = Window.partitionBy(F.lit(0))
    aims = sainte_lague(aims.withColumn("seats", F.round(F.sum("target").over(every) / block).cast("long")), [], ["source"], "target", "seats", "blocks")
    return cut(aims.select(F.col("source").alias("s"), "source_size", "target", "blocks"))


def copies(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), ceiling: int = 3, seed: int = 7, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """docs with `copies`: how many times the mix holds each document, in whole documents.

    Blocks are allocated to sources, regions and shards as in mix(). A shard's line is of whole
    documents here, by size and in seeded order among equal ones. Each comes as often as the shard's
    quota has whole rounds of its words, and what is left over is taken at even steps of documents
    from a seeded start: as neighbours are of about one size, a shard's words come within its longest
    document of its quota, and long and short documents are taken alike. Texts without a word, which
    no block can hold, come once. Texts are shuffled once, to their shards.
    """
    measured = cut(measure(docs, seed))
    aims = _with_shards(allocate(measured, weights, ceiling, block), shard)
    few = aims.count() <= FEW_SOURCES
    rows = _dealt(measured, aims, few)
    words, rounds = _rounds(block, ceiling)
    shards = _quotas(rows.groupBy("s", "shard").agg(F.sum("size").alias("length"), F.count_if(F.col("size") == 0).alias("blank"), F.first("blocks").alias("blocks")))
    shards = shards.withColumn("rounds", rounds.cast("long")).withColumn("rest", (words - F.col("rounds") * F.col("length")).cast("long"))
    shards = cut(shards.select(F.col("s").alias("_s2"), F.col("shard").alias("_shard2"), "length", "blank", "rounds", "rest", _start(seed, F.greatest(F.col("length"), F.lit(1))).alias("begin")))
    given = [F.col(f"`{c}`") for c in docs.columns]
    size, at = _measures(seed)
    own = docs.select(F.struct(*given).alias("_row"), F.col("source"), size.alias("size"), at.alias("at"))
    line = Window.partitionBy("s", "shard").orderBy("size", "at", F.xxhash64("_row"))
    own = _dealt(own, aims, few).withColumn("_rank", F.row_number().over(line))
    own = own.select("_row", "s", "shard", "size", "_rank").join(shards, F.col("s").eqNullSafe(F.col("_s2")) & (F.col("shard") == F.col("_shard2")))

    def passed(i: Column) -> Column:
        return F.floor((i * F.col("rest") + F.col("begin")) / F.col("length"))

    i = F.col("_rank") - F.col("blank") - 1  # documents without a word come first on the line, and do not count
    n = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("rounds") + passed(i + 1) - passed(i))
    return own.select("_row.*", n.cast("int").alias("copies"))


def _with_shards(aims: DataFrame, shard: int) -> DataFrame:
    return aims.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)).cast("long"))


def _dealt(rows: DataFrame, aims: DataFrame, few: bool) -> DataFrame:
    """rows(source, at, ...) with what aims has of their source, and `shard`."""
    rows = rows.join(F.broadcast(aims) if few else aims, F.col("source").eqNullSafe(F.col("s")))
    return rows.withColumn("shard", F.pmod(F.conv(F.substring("at", 1, 8), 16, 10).cast("long"), F.col("n_shards")))


def _quotas(shards: DataFrame) -> DataFrame:
    """shards(s, shard, length, blocks, ...) with `quota`, blocks by way of regions."""
    shards = shards.withColumn("region", F.col("shard") % REGIONS)
    regions = shards.groupBy("s", "region").agg(F.sum("length").alias("length"), F.first("blocks").alias("blocks"))
    regions = sainte_lague(regions, ["s"], ["region"], "length", "blocks", "seats").select(F.col("s").alias("s3"), F.col("region").alias("region3"), "seats")
    shards = shards.join(regions, F.col("s").eqNullSafe(F.col("s3")) & (F.col("region") == F.col("region3"))).drop("s3", "region3")
    return sainte_lague(shards, ["s", "region"], ["shard"], "length", "seats", "quota")


def _rounds(block: int, ceiling: int) -> tuple[Column, Column]:
    """Words that a shard's quota takes, and whole rounds of its line in them."""
    # The line of a shard has whole blocks and a shorter last one; a quota counts full blocks' words.
    words = F.least(F.col("quota") * block, ceiling * F.col("length"))
    return words, F.when(F.col("length") > 0, F.floor(words / F.col("length"))).otherwise(F.lit(0))


def _start(seed: int, n: Column) -> Column:
    """The seeded start of a shard, below n."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"start{seed}"), F.coalesce("s", F.lit("")), F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long"), n)


def place(docs: DataFrame, weights=(5, 2, 1), ceiling=3, seed=7, block=BLOCK, shard=SHARD) -> DataFrame:
    measured = cut(measure(docs, seed))  # one pass over the texts; from here on a few numbers a document
    aims = _with_shards(allocate(measured, weights, ceiling, block), shard)
    rows = _dealt(measured, aims, aims.count() <= FEW_SOURCES)
    line = Window.partitionBy("s", "shard").orderBy("at", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0)))
    shards = rows.groupBy("s", "shard").agg(F.sum("size").alias("length"), F.first("blocks").alias("blocks"))
    shards = _quotas(shards)
    words, rounds = _rounds(block, ceiling)
    n_blocks = F.ceil(F.col("length") / block)
    rounds = F.when(F.col("length") > 0, F.floor(words / F.col("length"))).otherwise(F.lit(0))
    extra = F.when(F.col("length") > 0, F.least(n_blocks, F.round((words - rounds * F.col("length")) / block))).otherwise(F.lit(0)).cast("long")
    begin = F.when(n_blocks > 0, _start(seed, n_blocks)).otherwise(F.lit(0))
    shards = shards.select(F.col("s").alias("s2"), F.col("shard").alias("shard2"), rounds.cast("long").alias("rounds"), extra.alias("extra"), n_blocks.cast("long").alias("n_blocks"), begin.cast("long").alias("begin"))
    rows = rows.join(shards, F.col("s").eqNullSafe(F.col("s2")) & (F.col("shard") == F.col("shard2")))
    end = F.col("start") + F.col("size")

    def upto(p: Column) -> Column:
        """Words of the line before p that the extra blocks cover: those i with i * extra + begin passing a multiple of n_blocks."""
        i = F.floor(p / block)
        passed = F.floor((i * F.col("extra") + F.col("begin")) / F.col("n_blocks"))
        here = F.floor(((i + 1) * F.col("extra") + F.col("begin")) / F.col("n_blocks")) - passed
        return passed * block + here * (p - i * block)

    extra_words = F.when((F.col("extra") > 0) & (F.col("size") > 0), upto(end) - upto(F.col("start"))).otherwise(F.lit(0))
    return rows.withColumn("taken", (F.col("rounds") * F.col("size") + extra_words).cast("long"))
