"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share
share x all words by weight; a target stops at most times its source's words and the
excess is shared again by weight among the others until none is above.

Blocks: the words of each source lie on lines, one per shard, its documents in an order
seeded by their ids; a line is cut into blocks of equal length. Highest quotients
(target / 1, / 3, / 5 ...) give each source its number of blocks, and the same rule over
its shards' words gives each shard an integer quota. A shard takes its whole line as often
as the quota allows and the rest as one run of blocks, around the end, from a seeded start.
A document's take is the part of those blocks that lies on its own words, so no document
exceeds most times its size, and reruns agree whatever the partitioning.

Scale: sources and lines stay tables. Windows over all sources hold one thin row of each;
one over a line holds (order, size) of its documents, never texts. A line's run is told by
the documents at its ends, so texts are compared to them where they lie and aren't moved
while the lines can be broadcast. The driver sees single totals, and the word counts of
shards of sources that have several, at most 2 * MAX_SHARDS.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its
own, last; rows that repeat an id, or have none, are mixed one by one, told apart by their texts, and
rows that have both in common share evenly what the mix takes of them (fewer words than
they are rows are lost by it); sources without words have target 0; an empty table gives an empty result; other columns are not read, or kept as they are.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyweb.llm.common import forget, store, words

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
SEED = 17
#: Words of a block, at most; fewer where a source's target is under 400 blocks.
BLOCK_WORDS = 256
SHARD_WORDS = 200_000
MAX_SHARDS = 4096
#: A table of so many sources or shards is small enough to broadcast.
BROADCAST_ROWS = 20_000
POINTS = ("_from", "_to", "_wrapped")


def sainte_lague(votes: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 k + 1), up to caps; ties to the first."""
    seats = min(seats, sum(c for v, c in zip(votes, caps, strict=True) if v > 0))
    if seats <= 0:
        return [0] * len(votes)
    level = sum(votes) / seats
    got = [min(c, int(v / level + 0.5)) if v > 0 else 0 for v, c in zip(votes, caps, strict=True)]
    more = [(-votes[k] / (2 * got[k] + 1), k) for k in range(len(votes)) if votes[k] > 0 and got[k] < caps[k]]
    heapq.heapify(more)
    total = sum(got)
    while total < seats:
        _, k = heapq.heappop(more)
        got[k] += 1
        total += 1
        if got[k] < caps[k]:
            heapq.heappush(more, (-votes[k] / (2 * got[k] + 1), k))
    less = [(votes[k] / (2 * got[k] - 1), -k) for k in range(len(votes)) if got[k]]
    heapq.heapify(less)
    while total > seats:
        _, k = heapq.heappop(less)
        got[-k] -= 1
        total -= 1
        if got[-k]:
            heapq.heappush(less, (votes[-k] / (2 * got[-k] - 1), k))
    return got


def _sized(docs: DataFrame, source: str, text: str, doc_id: str, seed: int, carry: bool) -> DataFrame:
    """doc_id, _key (of the source), size and _at, a document's place in its line; with carry also all columns as _row."""
    own = [F.struct(*[docs[c] for c in docs.columns]).alias("_row")] if carry else []
    key = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    size = F.size(words(F.col(text).cast("string"))).cast("long")
    # Rows without an id are ordered, and dealt to shards, by their texts; so are rows that repeat an id.
    told = F.xxhash64(F.col(text).cast("string"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("~"), told.cast("string")))))
    own_columns = docs.select(F.col(doc_id).alias("doc_id"), key.alias("_key"), size.alias("size"), order.alias("_order"), told.alias("_told"), *own)
    return own_columns.select("doc_id", "_key", "size", F.struct("_order", "size", "_told").alias("_at"), *(["_row"] if carry else []))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> tuple[DataFrame, int]:
    """(_key, _source, source_size, _weight, target) of every source, stored, and the words of all.

    Sorted by size for weight, the sources whose target stops are a prefix; the first that
    takes its share of what the prefix leaves gives the level of all the rest.
    """
    place = F.row_number().over(Window.orderBy(F.col("_key") == "null", "_key")) - 1
    found = sized.groupBy("_key").agg(F.sum("size").alias("source_size")).withColumn("_source", place)
    found = store(found.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), F.col("_source") % len(weights) + 1)), "sources")
    total, weight = found.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    before = Window.orderBy(F.col("source_size").cast("double") / F.col("_weight"), "_source")
    past = before.rowsBetween(Window.unboundedPreceding, -1)
    rest = share.numerator * total - share.denominator * most * F.coalesce(F.sum("source_size").over(past), F.lit(0))
    parts = share.denominator * (weight - F.coalesce(F.sum("_weight").over(past), F.lit(0)))
    steps = found.select("source_size", "_weight", F.row_number().over(before).alias("_place"), (rest.cast("double") / parts.cast("double")).alias("_level"))
    level = steps.where(F.col("_weight") * F.col("_level") <= most * F.col("source_size")).agg(F.min_by("_level", "_place")).first()[0]
    top = (most * F.col("source_size")).cast("double")
    return found.withColumn("target", top if level is None else F.least(top, F.col("_weight") * F.lit(level))), total


def source_seats(sources: DataFrame, goal: float, seats: int, block: int) -> DataFrame:
    """sources with _seats: Sainte-Laguë over all sources by their targets, which sum to goal; ties to the first source.

    At a divisor d a source has round(target / d) seats, half a seat at most beside its
    share. So two divisors close to goal / seats leave at most some two quotients of a
    source between them, and only those are ranked.
    """
    cap = (MOST * F.ceil(F.col("source_size") / block)).cast("long")
    count, highest, room = sources.agg(F.count("*"), F.max("target"), F.sum(F.when(F.col("target") > 0, cap))).first()
    seats = min(seats, room or 0)
    if seats <= 0:
        return sources.withColumn("_seats", F.lit(0).cast("long"))

    def held(divisor: float) -> F.Column:
        return F.least(cap, F.floor(F.col("target") / divisor + 0.5))

    reach = count / 2 + 1
    while True:
        high, low = goal / (seats - reach) if seats > reach else 2 * highest + 1, goal / (seats + reach)
        sure, enough = sources.agg(F.sum(held(high)), F.sum(held(low))).first()
        if sure <= seats <= enough:
            break
        reach *= 2
    open_ = sources.select("_source", "target", F.explode(F.when(held(low) > held(high), F.sequence(held(high), held(low) - 1))).alias("_k"))
    rank = F.row_number().over(Window.orderBy((F.col("target") / (2 * F.col("_k") + 1)).desc(), "_source"))
    more = open_.select("_source", rank.alias("_rank")).where(F.col("_rank") <= seats - sure).groupBy("_source").agg(F.count("*").alias("_more"))
    return sources.join(more, "_source", "left").withColumn("_seats", held(high) + F.coalesce("_more", F.lit(0))).drop("_more")


def _placed(sized: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    shard = F.expr("CAST(CAST(conv(substr(_at._order, 1, 8), 16, 10) AS BIGINT) % _shards AS INT)")
    return sized.join(F.broadcast(sources) if few else sources, "_key").withColumn("_shard", shard)


def _runs(sized: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, bool]:
    """Sources; lines with passes and, of each word position _from, _to and _wrapped, the document it lies in; whether both are few."""
    sources, total = targets(sized)
    goal = float(min(SHARE, Fraction(MOST)) * total)
    count, least = sources.agg(F.count("*"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    block = max(1, min(BLOCK_WORDS, int((least or 1) // 400)))
    per_shard = max(SHARD_WORDS, -(-total // MAX_SHARDS))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / per_shard)).cast("int")
    sources = store(source_seats(sources, goal, int(goal / block + 0.5), block).withColumn("_shards", shards), "seats")
    few = count + 2 * MAX_SHARDS <= BROADCAST_ROWS

    placed = _placed(sized, sources, few).select("_source", "_shard", "_shards", "_seats", "_at", "size")
    lines = store(placed.groupBy("_source", "_shard", "_shards", "_seats").agg(F.sum("size").alias("_n")), "lines")
    # Sources of several shards have at most 2 * MAX_SHARDS of them together.
    parted: dict[int, list] = {}
    for r in lines.where("_shards > 1").orderBy("_source", "_shard").collect():
        parted.setdefault(r["_source"], []).append(r)
    quotas = []
    for k, line in parted.items():
        got = sainte_lague([float(r["_n"]) for r in line], line[0]["_seats"], [MOST * -(-r["_n"] // block) for r in line])
        quotas += [(k, r["_shard"], q) for r, q in zip(line, got, strict=True)]
    dealt = F.broadcast(sized.sparkSession.createDataFrame(quotas, "_source int, _shard int, _dealt long"))
    lines = lines.join(dealt, ["_source", "_shard"], "left").withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("_n") / block)))
    lines = lines.withColumn("_quota", F.coalesce("_dealt", F.when(F.col("_n") > 0, F.least("_seats", MOST * F.col("_blocks"))), F.lit(0)))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "_source", "_shard")), 1, 8), 16, 10).cast("long")
    lines = lines.withColumns({"_first": draw % F.col("_blocks"), "_run": F.col("_quota") % F.col("_blocks")})
    past = F.col("_first") + F.col("_run")
    lines = lines.select("_source", "_shard", "_n", F.expr("_quota div _blocks").alias("passes"), (F.col("_first") * block).alias("_from"), F.least("_n", past * block).alias("_to"), (F.greatest(F.lit(0), past - F.col("_blocks")) * block).alias("_wrapped"))

    line = Window.partitionBy("_source", "_shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ended = placed.select("_source", "_shard", "_at", "size", F.sum("size").over(line).alias("_end"))
    alike = ended.groupBy("_source", "_shard", "_at", "size").agg(F.min(F.col("_end") - F.col("size")).alias("_begin"), F.count("*").alias("_copies"))
    alike = alike.where("size > 0").join(F.broadcast(lines) if few else lines, ["_source", "_shard"])

    def point(x: str) -> F.Column:
        into = F.col(x) - F.col("_begin")
        here = (into >= 0) & (into < F.col("_copies") * F.col("size"))
        return F.max(F.when(here, F.struct("_at", F.floor(into / F.col("_copies")).alias("words")))).alias(f"{x}_at")

    ends = alike.groupBy("_source", "_shard").agg(*[F.first(c).alias(c) for c in ("_n", "passes", *POINTS)], *[point(x) for x in POINTS])
    return sources.select("_key", "_source", "_shards", "source_size", "target"), store(ends, "runs"), few


def _taken(sized: DataFrame, runs: tuple[DataFrame, DataFrame, bool], *more: str) -> DataFrame:
    """What the runs take of each document, by its place against the documents at their ends."""
    sources, lines, few = runs
    df = _placed(sized, sources, few).join(F.broadcast(lines) if few else lines, ["_source", "_shard"], "left")

    def before(x: str) -> F.Column:
        """How many of the document's words lie before position x of its line."""
        at, size, none = F.col(f"{x}_at"), F.col("size"), F.lit(0).cast("long")
        return F.when(F.col(x) >= F.col("_n"), size).when(at.isNull(), none).when(F.col("_at") < at["_at"], size).when(F.col("_at") == at["_at"], at["words"]).otherwise(none)

    df = df.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("passes", F.lit(0).cast("long")).alias("passes"),
        F.lit(0).cast("long").alias("head_from"),
        before("_wrapped").alias("head_to"),
        before("_from").alias("tail_from"),
        F.greatest(before("_from"), before("_to")).alias("tail_to"),
        *more,
    )
    return df.withColumn("taken", F.col("passes") * F.col("size") + F.col("head_to") - F.col("head_from") + F.col("tail_to") - F.col("tail_from"))


def mix(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, and what is taken of each document:

    passes: how often the whole text is taken; then words [head_from, head_to) and
    [tail_from, tail_to) once more.
    """
    sized = store(_sized(docs, source, text, doc_id, seed, carry=False), "sizes")
    return _taken(sized, _runs(sized, seed))


def mixed_rows(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", chars: str | None = None, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of docs: a row for each whole pass over a document

    (its text as it is) and one for the part that is taken once more (its words joined by
    one space). chars: a column that holds the text's code points, to be set anew.
    """
    sized = store(_sized(docs, source, text, doc_id, seed, carry=False), "sizes")
    plan = _taken(_sized(docs, source, text, doc_id, seed, carry=True), _runs(sized, seed), "_row")
    forget(sized)
    plan = plan.withColumn("_w", F.when(F.col("taken") > F.col("passes") * F.col("size"), words(F.col(f"_row.{text}").cast("string"))))
    cut = F.expr("concat(slice(_w, CAST(head_from AS INT) + 1, CAST(head_to - head_from AS INT)), slice(_w, CAST(tail_from AS INT) + 1, CAST(tail_to - tail_from AS INT)))")
    whole = F.transform(F.sequence(F.lit(0), F.col("passes")), lambda k: F.when(k > 0, F.col(f"_row.{text}").cast("string")))
    parts = F.concat(F.filter(whole, lambda x: x.isNotNull()), F.when(F.col("_w").isNotNull(), F.array(F.array_join(cut, " "))).otherwise(F.array().cast("array<string>")))
    # Fields first, then the explosion: pruning of nested fields below a generator can lose the struct.
    flat = plan.where("taken > 0").select(*[F.col(f"_row.`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)], parts.alias("_parts"))
    out = flat.select(*[f"_c{i}" for i in range(len(docs.columns))], F.explode("_parts").alias("_text"))
    made = {text: F.col("_text")} | ({chars: F.length("_text").cast("long")} if chars else {})
    return out.select(*[made.get(c, F.col(f"_c{i}")).alias(c) for i, c in enumerate(docs.columns)])
